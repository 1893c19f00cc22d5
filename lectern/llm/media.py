"""Media columns: interleaved document sequences from HTML, with payloads resolved by digest joins."""

from __future__ import annotations

import hashlib
import html as entities
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import bound, hot_keys, meet, short_batches, written

#: Payload bytes in a row of the stored image; payloads are padded with bytes 0 to a positive multiple.
WIDTH = 64
#: References to stored payloads: this scheme, then the hexadecimal SHA-256 of the payload.
SCHEME = "sha256:"
_MEDIA = {"img": "image", "audio": "audio", "video": "video", "source": "source", "embed": "embed"}
_BLOCK = {"p", "div", "article", "section", "figure", "figcaption", "h1", "h2", "h3", "h4", "h5", "h6", "li", "ul", "ol", "table", "tr", "td", "th", "br", "hr", "body", "html", "head", "title", "blockquote", "pre", "header", "footer", "nav", "main", "aside"}
_SILENT = {"script", "style", "template", "noscript"}
#: Elements whose content holds no tags but their own end tag.
_RAW = {"script", "style", "title", "textarea"}
#: A tag up to its end: quotes count behind an equals sign only, and one that is never closed is a sign like any other.
_TAG = re.compile(r"""<(/?)([A-Za-z][^\s/>]*+)((?:[^>"'=]++|=\s*+(?:"[^"]*+"|'[^']*+')|[="'])*+)>""")
_ATTRIBUTE = re.compile(r"""([^\s"'<>/=]++)\s*+(?:=\s*+("[^"]*+"|'[^']*+'|[^\s>]*+))?""")

ITEM = "struct<position:int,kind:string,text:string,src:string,digest:string,caption:string>"
_ITEM_ARROW = pa.struct([("position", pa.int32()), ("kind", pa.string()), ("text", pa.string()), ("src", pa.string()), ("digest", pa.string()), ("caption", pa.string())])


class _Figure:
    """The media of a figure, and its last caption, which is that of all media before it."""

    def __init__(self) -> None:
        self.media: list[dict] = []
        self.caption, self.upto = "", 0

    def close(self) -> None:
        for item in self.media[: self.upto]:
            item["caption"] = self.caption


class _Sequence:
    """Text blocks and media references in document order; a figure's caption goes to the figure's media.

    What scripts, styles, templates and noscript hold is no text. One that is left open hides what follows, as in a browser,
    but for templates and noscript only up to the end of the body. A caption ends with its tag, its figure, another caption
    or the body; blocks inside it are words apart. Comments, declarations and marked sections are no text, whatever they
    hold. A comment or tag that the page never closes ends it. Every sign is looked at a fixed number of times at most.
    """

    def __init__(self) -> None:
        self.items: list[dict] = []
        self.words: list[str] = []
        self.caption: list[str] | None = None
        self.figures: list[_Figure] = []  # those that are open
        self.silent = 0

    def flush(self) -> None:
        text = " ".join("".join(self.words).split())
        self.words = []
        if text:
            self.items.append({"position": len(self.items), "kind": "text", "text": text, "src": None, "digest": None, "caption": None})

    def handle_starttag(self, tag: str, given: dict[str, str]) -> None:
        if tag in _SILENT:
            self.silent += 1
        elif tag in _MEDIA:
            self.flush()
            if src := given.get("src"):
                digest = src[len(SCHEME) :].lower() if src.startswith(SCHEME) else None
                item = {"position": len(self.items), "kind": _MEDIA[tag], "text": None, "src": src, "digest": digest, "caption": given.get("alt") or given.get("title")}
                self.items.append(item)
                if self.figures:
                    self.figures[-1].media.append(item)
        elif tag in _BLOCK:
            if tag == "figcaption" or tag == "figure":
                self.end_caption()
            elif self.caption is not None:
                self.caption.append(" ")
                return
            self.flush()
            if tag == "figure":
                self.figures.append(_Figure())
            elif tag == "figcaption":
                self.caption = []

    def end_caption(self) -> None:
        """What the open caption says goes to its figure's media, or is text where there are none."""
        if self.caption is None:
            return
        said = " ".join("".join(self.caption).split())
        self.caption = None
        if said and self.figures and self.figures[-1].media:
            self.figures[-1].caption, self.figures[-1].upto = said, len(self.figures[-1].media)
        elif said:
            self.words.append(said)
        self.flush()

    def feed(self, page: str) -> None:
        """Cuts the page into tags, text and what is skipped."""
        done = at = 0
        while (at := page.find("<", at)) >= 0:
            follows = page[at + 1 : at + 2]
            if not (follows in ("!", "?") or (follows.isascii() and follows.isalpha()) or (follows == "/" and len(page) > at + 2)):
                at += 1  # a sign like any other
                continue
            self.handle_data(entities.unescape(page[done:at]))
            if page.startswith("<!--", at):
                shut = next((x for x in ("<!-->", "<!--->") if page.startswith(x, at)), None)
                end = at + len(shut) if shut else page.find("-->", at + 4) + 3
                if end == 2:
                    return
            elif found := _TAG.match(page, at):
                end, tag = found.end(), found[2].lower()
                if found[1]:
                    self.handle_endtag(tag)
                else:
                    shut = found[3].endswith("/")
                    given: dict[str, str] = {}
                    if tag in _MEDIA:
                        for name, value in _ATTRIBUTE.findall(found[3]):
                            given.setdefault(name.lower(), entities.unescape(value[1:-1] if value[:1] in ("'", '"') and value[-1:] == value[:1] and len(value) > 1 else value))
                    if not (shut and tag in _SILENT):
                        self.handle_starttag(tag, given)
                    if tag in _RAW and not shut:
                        close = re.compile(rf"</{tag}(?=[\s/>])", re.IGNORECASE).search(page, end)
                        rest = page[end : close.start()] if close else page[end:]
                        self.handle_data(entities.unescape(rest) if tag not in _SILENT else "")
                        end += len(rest)
            elif follows.isalpha() or page[at + 2 : at + 3].isalpha() and follows == "/":
                return  # a tag without an end
            else:
                end = page.find(">", at) + 1
                if not end:
                    return
            done = at = end
        self.handle_data(entities.unescape(page[done:]))

    def handle_endtag(self, tag: str) -> None:
        if tag in _SILENT:
            self.silent = max(0, self.silent - 1)
        elif tag in ("body", "html"):
            self.silent = 0
            self.end_caption()
            self.flush()
        elif tag == "figcaption":
            self.end_caption()
        elif tag in _BLOCK:
            if tag == "figure":
                self.end_caption()
                if self.figures:
                    self.figures.pop().close()
            elif self.caption is not None:
                self.caption.append(" ")
                return
            self.flush()

    def handle_data(self, data: str) -> None:
        if not self.silent:
            (self.words if self.caption is None else self.caption).append(data)

    def finish(self) -> list[dict]:
        self.end_caption()
        self.flush()
        for figure in self.figures:
            figure.close()
        return self.items


def sequence(html: str | None) -> list[dict]:
    """The items of a page. Null, empty or broken pages give what can be read, perhaps nothing; no markup raises or takes
    more than linear time.
    """
    parser = _Sequence()
    parser.feed(html or "")
    return parser.finish()


def interleaved(pages: DataFrame, *, keep: tuple[str, ...], html: str = "html") -> DataFrame:
    """The columns `keep`, then items: array of (position, kind, text, src, digest, caption) in document order. No shuffle.

    A null or empty page has an empty array. Repeated rows stay; other columns are ignored.
    """
    if {"items", html} & set(keep):
        raise ValueError("keep names the result column or the page")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = pa.array([sequence(h) for h in batch.column(html).to_pylist()], pa.list_(_ITEM_ARROW))
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in keep], found], names=[*keep, "items"])

    short_batches(pages.sparkSession)
    source = pages.select(*keep, html)
    kinds = ", ".join(f"`{c}` {source.schema[c].dataType.simpleString()}" for c in keep)
    return source.mapInArrow(run, f"{kinds}, items array<{ITEM}>")


def padded(text: Column) -> Column:
    """UTF-8 of the text (null: empty) with bytes 0 up to a positive multiple of WIDTH."""
    data = F.coalesce(text, F.lit("")).cast("binary")
    n = F.octet_length(data)
    return F.rpad(data, F.greatest(F.lit(WIDTH), F.ceil(n / WIDTH) * WIDTH).cast("int"), F.lit(b"\0"))


def as_image(payload: Column) -> Column:
    """The payload as 8-bit samples of a grey image in the portable graymap format, WIDTH samples a row."""
    rows = (F.octet_length(payload) / WIDTH).cast("long").cast("string")
    return F.concat(F.concat(F.lit(f"P5\n{WIDTH} "), rows, F.lit("\n255\n")).cast("binary"), payload)


def samples(media: bytes) -> bytes:
    """The samples of a stored image."""
    kind, size, depth, data = media.split(b"\n", 3)
    width, height = map(int, size.split())
    if kind != b"P5" or depth != b"255" or len(data) != width * height:
        raise ValueError("not an 8-bit portable graymap")
    return data


def features(media: bytes) -> dict:
    """Digests and a feature string of one stored payload, all from what is read back; of a null or a form that isn't whole an error."""
    data = samples(media)
    counts = np.bincount(np.frombuffer(data, np.uint8), minlength=256)
    share = counts[counts > 0] / len(data)
    mean = float((counts * np.arange(256)).sum()) / len(data)
    return {
        "payload_bytes": len(data),
        "payload_sha256": hashlib.sha256(data).hexdigest(),
        "tail_crc32": zlib.crc32(data[-64:]),
        "media_bytes": len(media),
        "media_sha256": hashlib.sha256(media).hexdigest(),
        "feature": f"{WIDTH}x{len(data) // WIDTH};mean={mean:.4f};entropy={float(-(share * np.log2(share)).sum()):.4f};distinct={len(share)}",
    }


FEATURES = "payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string"


def _features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    kinds = (pa.string(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string())
    for batch in batches:
        rows = [(d, *features(m).values()) for d, m in zip(batch.column("digest").to_pylist(), batch.column("media").to_pylist())]
        cols = list(zip(*rows)) or [[]] * 7
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)], names=["digest", "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "feature"])


def store(payloads: DataFrame, payload: str = "payload") -> DataFrame:
    """A written media table (digest, media) of the payloads; equal payloads may stand in it more than once.

    Null payloads aren't stored. Empty table: empty table.
    """
    rows = payloads.where(F.col(payload).isNotNull())
    return written(rows.select(F.sha2(F.col(payload), 256).alias("digest"), as_image(F.col(payload)).alias("media")), "media")


def store_features(media: DataFrame) -> DataFrame:
    """One row per digest of a media table: the payloads are read once, only digests and features are shuffled.

    Rows of the same digest hold the same payload. A stored form that isn't whole is an error. Empty table: empty result.
    """
    short_batches(media.sparkSession)
    read = media.select("digest", "media").mapInArrow(_features, f"digest string, {FEATURES}")
    names = [c for c in read.columns if c != "digest"]
    return read.groupBy("digest").agg(*[F.min(c).alias(c) for c in names])


def hot_digests(media: DataFrame) -> DataFrame | None:
    """The digests that many rows of a media table have, for the joins below; only the digests are read."""
    return hot_keys(media.groupBy("digest").agg(F.count("*").alias("n")), "digest")


def resolve(sequences: DataFrame, found: DataFrame, *, keep: tuple[str, ...], hot: DataFrame | None = None) -> DataFrame:
    """One row per item of the sequences, positions and captions beside what `found` (digest, ...) has for its digest.

    Items without a stored payload, texts among them, keep nulls; documents without items have no row. `found` has one
    row per digest; `hot` (hot_digests) deals out digests that many items refer to. Repeated documents stay repeated.
    """
    items = sequences.select(*keep, F.explode("items").alias("_item")).select(*keep, "_item.*")
    return meet(items, found, "digest", hot, "left")


def resolve_references(sequences: DataFrame, found: DataFrame, *, keep: tuple[str, ...], hot: DataFrame | None = None) -> DataFrame:
    """One row per document and digest that it refers to: `places`, an array of (position, kind, src, caption) in document
    order, beside what `found` has for the digest. A payload that a document shows many times is met once.

    References without a digest are one row of a null digest; documents without references have none.
    """
    shown = F.filter("items", lambda i: i["kind"] != "text")
    rows = sequences.select(*keep, shown.alias("_shown")).where(F.size("_shown") > 0)
    rows = rows.select(*keep, "_shown", F.explode(F.array_distinct(F.transform("_shown", lambda i: i["digest"]))).alias("digest"))
    own = F.filter("_shown", lambda i: i["digest"].eqNullSafe(F.col("digest")))
    places = F.transform(own, lambda i: F.struct(i["position"].alias("position"), i["kind"].alias("kind"), i["src"].alias("src"), i["caption"].alias("caption")))
    return meet(rows.select(*keep, "digest", places.alias("places")), found, "digest", hot, "left")


def text_page(text: Column, digest: Column, caption: Column) -> Column:
    """A page of a text: its lines as paragraphs, after the first of them a figure with the payload of that digest and its
    caption, and the payload once more at the end.
    """
    safe = F.coalesce(text, F.lit(""))
    for sign, name in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;")):
        safe = F.replace(safe, F.lit(sign), F.lit(name))
    src = F.concat(F.lit(f' src="{SCHEME}'), digest, F.lit('"'))
    figure = F.concat(F.lit("</p><figure><img"), src, F.lit("><figcaption>"), caption, F.lit("</figcaption></figure><p>"))
    page = lambda lines: F.concat(F.lit("<article><p>"), lines[0], figure, F.array_join(F.slice(lines, 2, F.size(lines)), "</p><p>"), F.lit("</p><img"), src, F.lit(' alt="whole text"></article>'))
    return bound(F.split(safe, "\n"), page)


def text_payload_report(docs: DataFrame) -> DataFrame:
    """Each document (doc_id, text) as a page of its own paragraphs and its own text as an image, shown between them and at
    the end: parsed, stored, referred to by digest, read back.

    doc_id, n_bytes, what features() says of the stored payload, and of the parsed sequence: n_items, n_texts,
    texts_sha256 (text items, joined by line ends), places ("position kind caption" of each reference, joined by line ends).
    Null texts are empty; empty ones are one row of bytes 0 and a page without text. Equal texts share a digest and all
    values. Very long texts are read whole. Repeated rows stay repeated; extra columns are ignored; an empty table gives
    an empty result.
    """
    payload = padded(F.col("text"))
    media = store(docs.select(payload.alias("payload")))
    size = F.octet_length(F.coalesce(F.col("text"), F.lit(""))).cast("long")
    page = text_page(F.col("text"), F.sha2(payload, 256), F.concat(size.cast("string"), F.lit(" bytes")))
    parsed = interleaved(docs.select("doc_id", size.alias("n_bytes"), page.alias("html")), keep=("doc_id", "n_bytes"))
    texts = F.transform(F.filter("items", lambda i: i["kind"] == "text"), lambda i: i["text"])
    own = ("doc_id", "n_bytes", "n_items", "n_texts", "texts_sha256")
    parsed = parsed.select("doc_id", "n_bytes", F.size("items").cast("long").alias("n_items"), F.size(texts).cast("long").alias("n_texts"), F.sha2(F.array_join(texts, "\n"), 256).alias("texts_sha256"), F.filter("items", lambda i: i["kind"] != "text").alias("items"))
    rows = resolve_references(parsed, store_features(media), keep=own, hot=hot_digests(media))
    places = F.array_join(F.transform("places", lambda p: F.concat_ws(" ", p["position"].cast("string"), p["kind"], p["caption"])), "\n")
    return rows.select("doc_id", "n_bytes", "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "feature", "n_items", "n_texts", "texts_sha256", places.alias("places"))


def page_report(pages: DataFrame) -> DataFrame:
    """page_id, n_texts, n_media, first_text, texts_md5 (text items joined by line ends) of the sequence of each page.

    Null, empty and broken pages have what can be read of them, at least 0 texts, a null first_text and the digest of nothing.
    Repeated rows stay repeated; extra columns are ignored; an empty table gives an empty result.
    """
    texts = F.transform(F.filter("items", lambda i: i["kind"] == "text"), lambda i: i["text"])
    rows = interleaved(pages, keep=("page_id",)).select("page_id", texts.alias("_t"), F.size(F.filter("items", lambda i: i["kind"] != "text")).cast("long").alias("n_media"))
    return rows.select("page_id", F.size("_t").cast("long").alias("n_texts"), "n_media", F.get("_t", F.lit(0)).alias("first_text"), F.md5(F.array_join("_t", "\n").cast("binary")).alias("texts_md5"))


_HIDDEN = r"(?s)<script.*?</script>|<style.*?</style>|<!--.*?-->|<![^>]*>"
_UNESCAPED = "t"
for _name, _sign in (("copy", "©"), ("middot", "·"), ("quot", '"'), ("#x27", "''"), ("lt", "<"), ("gt", ">"), ("amp", "&")):  # the last one last
    _UNESCAPED = f"regexp_replace({_UNESCAPED}, '&{_name};?', '{_sign}', 'g')"
#: The same for pages of plain tags and the character references that the test pages hold.
PAGES_ORACLE = rf"""
with m as (select page_id, regexp_replace(coalesce(html, ''), '{_HIDDEN}', '', 'g') as h from pages),
b as (select page_id, h, regexp_replace(regexp_replace(h, '</?(?:{"|".join(sorted(_BLOCK))})(?:\s[^>]*)?>', chr(1), 'g'), '<[^>]*>', '', 'g') as t from m),
u as (select page_id, h, {_UNESCAPED} as t from b),
l as (select page_id, h, list_filter(list_transform(string_split(t, chr(1)), lambda x: trim(regexp_replace(x, '\s+', ' ', 'g'))), lambda x: x <> '') as t from u)
select page_id, cast(len(t) as bigint) as n_texts, cast(len(regexp_extract_all(h, '<(?:{"|".join(sorted(_MEDIA))})\s[^>]*src=')) as bigint) as n_media,
       t[1] as first_text, md5(array_to_string(t, chr(10))) as texts_md5 from l
"""
