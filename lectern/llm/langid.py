"""Language identification by compression: the language whose raw-content dictionary encodes a text in the fewest bytes."""

from __future__ import annotations

import math
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import short_batches

#: The bounded sample that the dictionaries are made of: so many labelled documents of each language, one slice of each.
SAMPLE_DOCS, SLICE_CHARS = 1000, 400
#: Slices of all languages together, as all dictionaries are sent to every executor: many languages have fewer each, at least one.
ALL_SLICES = 64_000
#: Texts are encoded whole, in blocks of so many bytes, each against the dictionary alone.
BLOCK_BYTES = 4096
#: Matches of four bytes on: words are made of short syllables. The window holds a dictionary and a block.
MIN_MATCH, WINDOW_LOG, HASH_LOG = 4, 19, 17
#: Every block is filled up to so many bytes by repeating it, whatever the text it is from: of a few bytes alone zstandard
#: makes raw blocks, as long in any language. Of held-out texts cut to 20 characters 0.99 are told right so, 0.22 without.
LEAST_BYTES = 256
#: A decision is rejected if the runner-up needs less than this share more bytes.
MIN_MARGIN = 0.002
UNKNOWN = "und"
#: ASCII: letters in lower case, all else a space.
_PLAIN = bytes(c if c >= 128 or 97 <= c <= 122 else c + 32 if 65 <= c <= 90 else 32 for c in range(256))


def plain(text: str) -> bytes:
    """What is encoded: the whole text in lower case, its ASCII digits and punctuation as spaces, runs of space as one."""
    return b" ".join(text.lower().encode("utf-8", "surrogatepass").translate(_PLAIN).split())


def fit_dictionaries(docs: DataFrame, train: Column | None = None, *, sample_docs: int = SAMPLE_DOCS, slice_chars: int = SLICE_CHARS, all_slices: int = ALL_SLICES, seed: int = 7) -> dict[str, bytes]:
    """language -> raw-content dictionary, from docs (doc_id, text, lang) where `train` holds and lang isn't null.

    Of each language the `sample_docs` rows of lowest seeded hash give one slice of `slice_chars` characters each, from
    a seeded place in the text (short texts whole), so the sample is bounded and the same on every run. The choice reads
    doc_id and lang alone, and ranks only rows below a hash that lets through about four times as many; texts are read for the chosen ids. Null or empty texts give nothing. No labelled rows: {}.
    Of many languages each gives fewer, so that all together give about `all_slices`. The driver sees one count a language.
    """
    rows = docs.where(F.col("lang").isNotNull() & F.col("doc_id").isNotNull())
    rows = rows if train is None else rows.where(train)
    counts = rows.groupBy("lang").count().collect()
    if not counts:
        return {}
    sample_docs = max(1, min(sample_docs, all_slices // len(counts)))
    order = F.xxhash64(F.col("doc_id"), F.lit(seed))
    # so many that the lowest hashes are surely among them, and few for the task that ranks them
    share = F.create_map(*[x for lang, n in counts for x in (F.lit(lang), F.lit(min(1.0, 4 * sample_docs / n)))])[F.col("lang")]
    few = rows.select("doc_id", "lang", order.alias("_order")).where(F.col("_order") / F.lit(2.0**64) + 0.5 < share)
    rank = F.row_number().over(Window.partitionBy("lang").orderBy("_order", "doc_id"))
    chosen = few.withColumn("_rank", rank).where(F.col("_rank") <= sample_docs).select("doc_id", "lang").distinct()
    at = F.pmod(F.xxhash64(F.col("doc_id"), F.lit(seed + 1)), F.greatest(F.length("text") - slice_chars, F.lit(0)) + 1) + 1
    picked = rows.join(F.broadcast(chosen), ["doc_id", "lang"]).where("text <> ''")
    picked = picked.select("lang", "doc_id", F.substring(F.col("text"), at.cast("int"), F.lit(slice_chars)).alias("slice"))
    slices: dict[str, list] = {}
    for lang, doc, piece in picked.groupBy("lang", "doc_id").agg(F.min("slice").alias("slice")).collect():
        slices.setdefault(lang, []).append((doc, piece))
    return {lang: b" ".join(plain(piece) for _, piece in sorted(slices[lang])) for lang in sorted(slices)}


class Classifier:
    """Encodes texts with each language's dictionary."""

    def __init__(self, dictionaries: dict[str, bytes], min_margin: float = MIN_MARGIN):
        self.langs, self.min_margin = sorted(dictionaries), min_margin
        self.coders = []
        longest = max(map(len, dictionaries.values()), default=1)
        tables = max(10, min(HASH_LOG, longest.bit_length()))
        how = zstandard.ZstdCompressionParameters(window_log=WINDOW_LOG, hash_log=tables, chain_log=tables, search_log=4, min_match=MIN_MATCH, strategy=zstandard.STRATEGY_GREEDY, write_content_size=False, write_dict_id=False)
        for lang in self.langs:
            held = zstandard.ZstdCompressionDict(dictionaries[lang], dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            held.precompute_compress(compression_params=how)
            self.coders.append(zstandard.ZstdCompressor(dict_data=held, compression_params=how))

    def sizes(self, data: bytes) -> list[int]:
        blocks = [data[i : i + BLOCK_BYTES] for i in range(0, len(data), BLOCK_BYTES)]
        blocks = [b if len(b) >= LEAST_BYTES else (b + b" ") * -(-LEAST_BYTES // (len(b) + 1)) for b in blocks]
        return [sum(len(coder.compress(b)) for b in blocks) for coder in self.coders]

    def __call__(self, text: str | None) -> tuple[str, float, bool]:
        """Language, score in 0 to 1, whether the decision is rejected. Ties: the first language by code point."""
        if not text or not self.langs or not any(map(str.isalpha, text)):
            return UNKNOWN, 0.0, True
        sizes = self.sizes(plain(text))
        best = min(range(len(sizes)), key=lambda i: (sizes[i], i))
        if len(sizes) == 1:
            return self.langs[0], 1.0, False
        second = min(s for i, s in enumerate(sizes) if i != best)
        margin = (second - sizes[best]) / max(second, 1)
        score = 1 / sum(math.exp(max(-60.0, -math.log(2) * 8 * (s - sizes[best]) / 16)) for s in sizes)
        return self.langs[best], min(1.0, score), margin < self.min_margin


def _predict(dictionaries: dict[str, bytes], min_margin: float, text: str, drop: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        classify = Classifier(dictionaries, min_margin)
        for batch in batches:
            found = [classify(t) for t in batch.column(text).to_pylist()]
            if drop:
                yield batch.filter(pa.array([not rejected for _, _, rejected in found], pa.bool_()))
            else:
                kept = [c for c in batch.schema.names if c != text]
                columns = [batch.column(c) for c in kept] + [pa.array([f[i] for f in found], kind) for i, kind in enumerate((pa.string(), pa.float64(), pa.bool_()))]
                yield pa.RecordBatch.from_arrays(columns, names=[*kept, "lang_pred", "score", "rejected"])

    return run


def identify(docs: DataFrame, dictionaries: dict[str, bytes], *, keep: tuple[str, ...] = ("doc_id",), text: str = "text", min_margin: float = MIN_MARGIN) -> DataFrame:
    """The columns `keep`, then lang_pred, score, rejected for every row of docs; no shuffle.

    Each text is encoded whole. Null texts, texts without a letter, and any text when there are no dictionaries give
    `und`, score 0, rejected. Equal sizes give the first language by code point and are rejected. Repeated rows give
    repeated rows; other columns of docs are ignored, whatever their names. Empty table: empty result.
    """
    if {"lang_pred", "score", "rejected", text} & set(keep):
        raise ValueError("keep names a result column or the text")
    short_batches(docs.sparkSession)
    source = docs.select(*keep, text)
    schema = T.StructType([*[source.schema[c] for c in keep], T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType()), T.StructField("rejected", T.BooleanType())])
    return source.mapInArrow(_predict(dictionaries, min_margin, text, False), schema)


def keep_identified(docs: DataFrame, dictionaries: dict[str, bytes], *, text: str = "text", min_margin: float = MIN_MARGIN) -> DataFrame:
    """The rows of docs, all columns unchanged, whose language decision isn't rejected.

    Null texts, texts without a letter, and all texts if there are no dictionaries are rejected. Repeated rows stay
    repeated, columns may have any names, an empty table stays empty. Very long texts are encoded whole, block by block.
    """
    short_batches(docs.sparkSession)
    return docs.mapInArrow(_predict(dictionaries, min_margin, text, True), docs.schema)


def in_training(doc_id: str = "doc_id") -> tuple[Column, Column]:
    """(held out, may be learned from): crc32 of the id as text, modulo 4, is 2, and isn't. A null id is neither."""
    left = F.crc32(F.col(doc_id).cast("string").cast("binary")) % 4
    return F.coalesce(left == 2, F.lit(False)), F.coalesce(left != 2, F.lit(False))
