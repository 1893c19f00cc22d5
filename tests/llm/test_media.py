import hashlib
import time
import zlib
from collections import Counter

import duckdb
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from lectern.llm import media


def said(items):
    return [(i["kind"], i["text"] or i["src"], i["caption"]) for i in items]


def test_sequences():
    page = "<html><head><title>T &amp; x</title><style>no</style></head><body>lead <b>bold</b> text<p>one<figure><img src='a.png' alt='old'><img src='sha256:AB'><figcaption>the <i>cap</i></figcaption></figure>two<video src=v.mp4></video><script>var a='<img src=z>';</script><img alt='no src'><br>end"
    assert said(media.sequence(page)) == [("text", "T & x", None), ("text", "lead bold text", None), ("text", "one", None), ("image", "a.png", "the cap"), ("image", "sha256:AB", "the cap"), ("text", "two", None), ("video", "v.mp4", None), ("text", "end", None)]
    items = media.sequence(page)
    assert [i["position"] for i in items] == list(range(len(items)))
    assert [i["digest"] for i in items if i["src"] and i["src"].startswith("sha256:")] == ["ab"]


def test_odd_pages():
    assert media.sequence(None) == media.sequence("") == media.sequence("  \n") == []
    for page in ("<", "<p", "<img src=", "</figure></p>", "<figcaption>cap only", "<figure><figcaption>c</figcaption><img src=x></figure>", "&#xZZ; &", "<!-- <img src=x>", "<p>" * 5000):
        media.sequence(page)
    assert said(media.sequence("<figcaption>alone</figcaption>")) == [("text", "alone", None)]


def test_broken_markup_neither_raises_nor_moves_captions():
    assert said(media.sequence("a<![foo[bar]]>b<![CDATA[<img src=x>]]>c<![if IE]>d<!>e<?php x ?>f</3>g")) == [("text", "ab]]>cdefg", None)]
    open_caption = "<figure><img src=x><figcaption>c1</figure><p>a<p>b<img src=y><p>c"
    assert said(media.sequence(open_caption)) == [("image", "x", "c1"), ("text", "a", None), ("text", "b", None), ("image", "y", None), ("text", "c", None)]
    assert said(media.sequence("<figure><img src=x><figcaption><p>c1</p><div>c2</div></figcaption></figure>d")) == [("image", "x", "c1 c2"), ("text", "d", None)]
    assert said(media.sequence("<figure><img src=x><figcaption>one<img src=y><figcaption>two</figure>e")) == [("image", "x", "two"), ("image", "y", "two"), ("text", "e", None)]
    assert said(media.sequence("<!-- a")) == said(media.sequence("<p a='")) == []
    assert said(media.sequence("""1 < 2 <img alt='a>b' src="c&amp;d" x=>e<IMG SRC=/f/g.png/>h <img src='i>j<p>k""")) == [("text", "1 < 2", None), ("image", "c&d", "a>b"), ("text", "e", None), ("image", "/f/g.png/", None), ("text", "h", None), ("image", "'i", None), ("text", "j", None), ("text", "k", None)]


@settings(max_examples=500, deadline=None)
@given(st.lists(st.sampled_from(["<", ">", "!", "--", "[", "]", "/", "figure", "figcaption", "img src=x", "'", '"', "=", "p", " ", "script", "&lt;", "é", "<p>", "</", "<!--", "-->", "title"]), max_size=40))
def test_no_markup_raises(parts):
    items = media.sequence("".join(parts))
    assert [i["position"] for i in items] == list(range(len(items)))


def test_broken_markup_takes_linear_time():
    n = 40_000
    began = time.perf_counter()
    for page in ("<a " * n, "<!--" * n, "<a b='" * n, "<a/" * n, "</a " * n, "<![ " * n, "<" * n, '<a b="c>' * n, "<script>" * n, "<title>a</titl" * n, "<figure>" + "<img src=x><figcaption>c" * n, "<a b=' >" + "<a c=\" >" * n, "<img src = " * n + ">", "<a" + " " * n + ">"):
        media.sequence(page)
    assert time.perf_counter() - began < 20


def test_whole_table_round_trip(spark, sf):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    docs += [(10**6, None), (10**6 + 1, ""), (10**6 + 2, "x" * 64), (10**6 + 3, "é" * 100_001), (None, "same"), (7, "same"), (7, "same"), (8, "\0" * 3), (9, "a <b> &amp; c\n\n \n<img src=x> &lt;\nd\r\n"), (10, "\n\n"), (11, "x &copy y\n<!-- z --> </p>")]
    frame = spark.createDataFrame([(d, t, "x", b"y") for d, t in docs], "doc_id long, text string, digest string, media binary")
    rows = media.text_payload_report(frame).collect()
    want = Counter()
    for doc, text in docs:
        data = (text or "").encode()
        payload = data + b"\0" * (max(64, -(-len(data) // 64) * 64) - len(data))
        want[doc, len(data), len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-64:])] += 1
    assert Counter((r.doc_id, r.n_bytes, r.payload_bytes, r.payload_sha256, r.tail_crc32) for r in rows) == want
    by = {}
    for r in rows:
        assert by.setdefault(r.payload_sha256, tuple(r[c] for c in ("media_bytes", "media_sha256", "feature"))) == tuple(r[c] for c in ("media_bytes", "media_sha256", "feature"))
        assert r.media_bytes > r.payload_bytes
    want = Counter()
    for doc, text in docs:
        lines = [" ".join(x.split()) for x in (text or "").split("\n")]
        texts = [x for x in lines if x]
        first = int(bool(lines[0]))
        places = f"{first} image {len((text or '').encode())} bytes\n{len(texts) + 1} image whole text"
        want[doc, len(texts) + 2, len(texts), hashlib.sha256("\n".join(texts).encode()).hexdigest(), places] += 1
    assert Counter((r.doc_id, r.n_items, r.n_texts, r.texts_sha256, r.places) for r in rows) == want


def test_hidden_parts_end_with_the_body():
    assert said(media.sequence("<body>a<noscript>no<p>no</body><p>b")) == [("text", "a", None), ("text", "b", None)]
    assert said(media.sequence("<template>no")) == []


def test_one_payload_in_many_places(spark, monkeypatch):
    monkeypatch.setattr("lectern.llm.common.HOT_ROWS", 3)
    payloads = [b"a" * 64, b"b" * 64]
    digests = [hashlib.sha256(p).hexdigest() for p in payloads]
    img = lambda i, alt: f'<img src="sha256:{digests[i]}" alt="{alt}">'
    pages = [(i, "p " + img(0, "x") + "<p>q" + img(1, "y") + img(0, "z") + '<img src="http://e/x.png" alt="far">') for i in range(20)] + [(90, "no media"), (91, None)]
    stored = media.store(spark.createDataFrame([(payloads[0],)] * 9 + [(payloads[1],), (None,)], "payload binary"))
    assert stored.count() == 10
    hot = media.hot_digests(stored)
    assert [r.digest for r in hot.collect()] == [digests[0]]
    parsed = media.interleaved(spark.createDataFrame(pages, "page_id long, html string"), keep=("page_id",))
    rows = media.resolve_references(parsed, media.store_features(stored), keep=("page_id",), hot=hot).collect()
    got = {(r.page_id, r.digest): ([tuple(p)[:2] + (p.caption,) for p in r.places], r.payload_bytes) for r in rows}
    assert len(got) == len(rows) == 60
    for i in range(20):
        assert got[i, digests[0]] == ([(1, "image", "x"), (4, "image", "z")], 64)
        assert got[i, digests[1]] == ([(3, "image", "y")], 64)
        assert got[i, None] == ([(5, "image", "far")], None)
    assert media.resolve(parsed, media.store_features(stored), keep=("page_id",), hot=hot).count() == 20 * 6 + 1


def test_stored_images_are_lossless(spark):
    payloads = [bytes(range(64)), b"\n\r\0 \xff" * 64]
    stored = media.store(spark.createDataFrame([(p,) for p in payloads], "payload binary")).collect()
    assert {bytes(media.samples(bytes(r.media))) for r in stored} == set(payloads)
    assert all(r.digest == hashlib.sha256(media.samples(bytes(r.media))).hexdigest() for r in stored)


def test_pages_resolve_what_is_stored(spark, sf):
    pages = spark.read.parquet(f"{sf}/pages.parquet")
    payload = b"abc".ljust(64, b"\0")
    digest = hashlib.sha256(payload).hexdigest()
    extra = spark.createDataFrame([(-1, "u", f'<p>a<img src="sha256:{digest}" alt="pic">b<img src="sha256:{"0" * 64}">'), (-2, "u", None)], pages.schema)
    found = media.store_features(media.store(spark.createDataFrame([(payload,), (payload,)], "payload binary")))
    rows = media.resolve(media.interleaved(pages.union(extra), keep=("page_id",)), found, keep=("page_id",))
    got = sorted((r.position, r.kind, r.text, r.caption, r.payload_bytes) for r in rows.where("page_id = -1").collect())
    assert got == [(0, "text", "a", None, None), (1, "image", None, "pic", 64), (2, "text", "b", None, None), (3, "image", None, None, None)]
    assert rows.where("page_id = -2").count() == 0
    assert rows.where("page_id >= 0 and kind = 'text'").select("page_id").distinct().count() == pages.count()


def test_sql_reads_the_pages_alike(spark):
    sf = "/root/testdata/sf0.01"
    with duckdb.connect() as con:
        con.execute(f"create view pages as select * from '{sf}/pages.parquet'")
        want = sorted(con.execute(media.PAGES_ORACLE).fetchall())
    got = sorted(map(tuple, media.page_report(spark.read.parquet(f"{sf}/pages.parquet")).collect()))
    assert got == want and all(r[1] > 3 for r in got)


def test_empty_table(spark):
    assert media.text_payload_report(spark.createDataFrame([], "doc_id long, text string")).count() == 0
    assert spark.range(1).select(media.padded(F.lit(None).cast("string")).alias("p")).first().p == bytearray(64)
