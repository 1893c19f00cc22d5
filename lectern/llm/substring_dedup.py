"""Substring deduplication by level-wise doubling: what repeats at one length alone is looked at again at twice that length."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Scratch, WordHashes, mixed, shared_path, short_batches, window_hashes, written

WINDOW = 35
#: Documents and bytes of text after which a batch is closed. A batch is the unit in which windows are asked after and answered.
BATCH_DOCS, BATCH_BYTES = 1500, 2_000_000
#: Bytes of window hashes that one bucket should gather, about.
BUCKET_BYTES = 24_000_000
#: Bytes of texts in one bucket of batches, about: a task of every level.
PART_BYTES = 128_000_000


#: Length of the shortest windows that are asked after, about; results are the same for any. Of the windows in 9,800 different
#: test documents 0.064 repeat at 35 words, 0.099 at 18, 0.130 at 9 and 0.185 at 5: a pass at 9 words would send the minima
#: (0.07 of all windows) to be spared hardly fewer at 18 (0.10 there), and each pass reads all texts again.
SHORTEST = 16


def levels(window: int, shortest: int = SHORTEST) -> list[int]:
    """Lengths that are asked after: each at most twice the one before, the last the window itself, the first `shortest` or
    a little more.

    The windows of the first length number as many as words, so of those only the local minima of a hash are asked
    after. For any repeated run of the window's length both occurrences choose the same minima.
    """
    found = [window]
    while found[0] > max(1, shortest) and -(-found[0] // 2) >= shortest:
        found.insert(0, -(-found[0] // 2))
    return found


def minima(values: np.ndarray, span: int) -> np.ndarray:
    """Sorted places that are the leftmost least value of some `span` consecutive values; all the least one if fewer."""
    n = len(values)
    if n == 0:
        return np.empty(0, np.int64)
    if n <= span:
        return np.array([int(values.argmin())])
    # doubling again: least of 1, 2, 4 ... values with its place, then two that overlap cover the span
    least, place, now = values, np.arange(n), 1

    def joined(a, pa_, b, pb):
        right = b < a
        return np.where(right, b, a), np.where(right, pb, pa_)

    while 2 * now <= span:
        least, place = joined(least[:-now], place[:-now], least[now:], place[now:])
        now *= 2
    if now < span:
        shift = span - now
        least, place = joined(least[:-shift], place[:-shift], least[shift:], place[shift:])
    return np.unique(place)


class Batch:
    """The windows of some documents, laid end to end; windows never cross from one document to the next."""

    def __init__(self, texts: list[bytes | None], hashes: WordHashes):
        self.words = [t.split() if t else [] for t in texts]
        self.sizes = np.array([len(w) for w in self.words], np.int64)
        self.starts = np.cumsum(self.sizes) - self.sizes
        self.flat = hashes.of([x for w in self.words for x in w])

    def windows(self, length: int) -> tuple[np.ndarray, np.ndarray]:
        """Places at which a window of one document begins, and the windows' hashes."""
        if len(self.flat) < length:
            return np.empty(0, np.int64), np.empty(0, np.uint64)
        owner = np.repeat(np.arange(len(self.sizes)), self.sizes)
        at = np.flatnonzero(owner[: len(owner) - length + 1] == owner[length - 1 :])
        return at, window_hashes(self.flat, length)[at]

    def selected(self, length: int, span: int) -> tuple[np.ndarray, np.ndarray]:
        """The windows of `length` that are least of some `span` consecutive ones, and some more where documents meet."""
        at, found = self.windows(length)
        keep = minima(mixed(found, found), span)
        return at[keep], found[keep]

    def candidates(self, length: int, parts: np.ndarray, part: int) -> tuple[np.ndarray, np.ndarray]:
        """The windows of `length` that contain one of the repeated parts (places, each `part` words long)."""
        at, found = self.windows(length)
        before = np.searchsorted(parts, at)  # the first part that begins in the window
        inside = before < len(parts)
        inside[inside] = parts[before[inside]] + part <= at[inside] + length
        return at[inside], found[inside]


def _asked(batch: Batch, answers: list[np.ndarray], lengths: list[int]) -> tuple[np.ndarray, np.ndarray]:
    """Places and hashes of what is asked after at the next level, given the answers of the levels before."""
    window = lengths[-1]
    at, found = batch.selected(lengths[0], window - lengths[0] + 1) if len(lengths) > 1 else batch.windows(window)
    for k, answer in enumerate(answers):
        repeated = answer[np.searchsorted(_distinct(found)[0], found)]
        at = at[repeated]
        if k + 1 < len(lengths):
            at, found = batch.candidates(lengths[k + 1], at, lengths[k])
    return at, found


def _distinct(found: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct hashes, and whether each occurs more than once in the batch."""
    values, counts = np.unique(found, return_counts=True)
    return values, counts > 1


def _buckets_of(values: np.ndarray, buckets: int) -> np.ndarray:
    """The bucket of each hash: equal ranges of the upper 32 bits, so that sorted hashes have sorted buckets."""
    return (values >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)


def _batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    from pyspark import TaskContext

    part, made = TaskContext.get().partitionId(), 0

    def closed(rows: list) -> pa.RecordBatch:
        ids, texts = zip(*rows)
        return pa.RecordBatch.from_arrays([pa.array([f"{part}-{made}"]), pa.array([list(ids)], pa.list_(kind)), pa.array([list(texts)], pa.list_(pa.binary()))], names=["batch", "doc_ids", "texts"])

    rows, held, kind = [], 0, None
    for batch in batches:
        kind = batch.schema.types[0]
        for doc, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            rows.append((doc, text))
            held += len(text or b"")
            if len(rows) >= BATCH_DOCS or held >= BATCH_BYTES:
                yield closed(rows)
                rows, held, made = [], 0, made + 1
    if rows:
        yield closed(rows)


_HASHES = WordHashes()


def _masks(row: pa.RecordBatch, count: int) -> list[np.ndarray]:
    """The answers of each level: bits of the distinct hashes in order, put together from the buckets."""
    out = []
    for k in range(count):
        parts = row.column(f"answers{k}")[0].as_py() or []
        bits = [np.unpackbits(np.frombuffer(p["bits"], np.uint8), count=p["n"]).astype(bool) for p in sorted(parts, key=lambda p: p["bucket"])]
        out.append(np.concatenate(bits) if bits else np.empty(0, bool))
    return out


def _ask(lengths: list[int], count: int, buckets: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1)
                docs = Batch(row.column("texts")[0].as_py(), _HASHES)
                values, twice = _distinct(_asked(docs, _masks(row, count), lengths)[1])
                if not len(values):
                    continue
                bucket = _buckets_of(values, buckets)
                ends = np.append(np.flatnonzero(bucket[1:] != bucket[:-1]) + 1, len(values))
                starts, name = np.append(0, ends[:-1]), row.column("batch")[0].as_py()
                rows = [(b, name, values[x:y].astype("<u8").tobytes(), np.packbits(twice[x:y]).tobytes()) for b, x, y in zip(bucket[starts].tolist(), starts.tolist(), ends.tolist())]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), (pa.int32(), pa.string(), pa.binary(), pa.binary()))], names=["bucket", "batch", "hashes", "twice"])

    return run


def _answer(key: tuple, table: pa.Table) -> pa.Table:
    """For each batch's distinct hashes in a bucket: which occur in another batch, or twice in the batch itself."""
    names, blobs, flags = table["batch"].to_pylist(), table["hashes"].to_pylist(), table["twice"].to_pylist()
    sizes = np.array([len(b) // 8 for b in blobs])
    values = np.frombuffer(b"".join(blobs), "<u8")
    order = np.argsort(values, kind="stable")
    ordered = values[order]
    same = ordered[1:] == ordered[:-1]
    repeated = np.zeros(len(values), bool)
    repeated[order[1:]] = same
    repeated[order[:-1]] |= same
    own = np.concatenate([np.unpackbits(np.frombuffer(f, np.uint8), count=n) for f, n in zip(flags, sizes)]).astype(bool)
    # a hash that is twice in one batch is repeated there; if other batches have it, they see it by `same`
    repeated |= own
    ends = np.cumsum(sizes)
    bits = [np.packbits(repeated[e - n : e]).tobytes() for e, n in zip(ends, sizes)]
    return pa.table({"batch": names, "bucket": pa.array([key[0].as_py()] * len(names), pa.int32()), "n": pa.array(sizes, pa.int32()), "bits": pa.array(bits, pa.binary())})


def _finish(lengths: list[int], texts: bool):
    window = lengths[-1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1)
                docs = Batch(row.column("texts")[0].as_py(), _HASHES)
                at, _ = _asked(docs, _masks(row, len(lengths)), lengths)
                cover = np.zeros(len(docs.flat) + 1, np.int64)
                cover[at] += 1
                cover[at + window] -= 1
                gone = np.cumsum(cover)[:-1] > 0
                removed, shas, kept_texts = [], [], []
                for words, a, n in zip(docs.words, docs.starts, docs.sizes):
                    out = gone[a : a + n]
                    m = int(out.sum())
                    kept = b" ".join(words) if not m else b" ".join([w for w, x in zip(words, out.tolist()) if not x])
                    removed.append(m)
                    shas.append(hashlib.sha256(kept).hexdigest())
                    kept_texts.append(kept.decode("utf-8", "surrogatepass") if texts else None)
                columns = [row.column("doc_ids")[0].values, pa.array(docs.sizes), pa.array(removed, pa.int64()), pa.array(shas), *([pa.array(kept_texts, pa.string())] if texts else [])]
                yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "n_words", "n_removed", "kept_sha256", *["kept"] * texts])

    return run


def remove_repeats(docs: DataFrame, *, window: int = WINDOW, shortest: int = SHORTEST, with_text: bool = False) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256 (and kept) for every row of docs (doc_id, text).

    Every word that lies in a window of `window` words whose sequence also begins anywhere else goes, judged on the input.
    Documents are written once as batches, bucketed by batch, so that later joins don't move texts. A batch is named by its
    partition and place, so a task that runs again makes the same ones, if docs is read from files (write it first, else). At each level a
    batch sends its distinct window hashes (8 bytes each), dealt by hash range, and gets one bit back for each. At the first
    level only local minima are sent; at the next, twice as long, only windows around those that repeat, and so on, up to
    the window or until nothing repeats. The number of batch buckets and of hash ranges follows the size of the texts.
    A hot passage is one hash from each batch. Windows count as equal if their 64-bit hashes are.
    Null and empty texts have no words. Texts of fewer words than the window are kept. Repeated rows remove each other.
    Null ids are ids like any other; extra columns are ignored. Empty table: empty result.
    The result is a written table; the batches and answers are deleted once it stands.
    """
    spark = docs.sparkSession
    short_batches(spark)
    kind = docs.schema["doc_id"].dataType.simpleString()
    total = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-total // PART_BYTES))
    buckets = max(2 * n, int(total * 8 / 6 / 2 / BUCKET_BYTES))
    name = "lectern_batches_" + shared_path(spark, "x").rsplit("-", 1)[1]
    lengths, answers = levels(window, shortest), []
    result = f"doc_id {kind}, n_words long, n_removed long, kept_sha256 string" + ", kept string" * with_text

    def with_answers() -> DataFrame:
        rows = spark.table(name)
        for k, found in enumerate(answers):
            rows = rows.join(found.groupBy("batch").agg(F.collect_list(F.struct("bucket", "n", "bits")).alias(f"answers{k}")), "batch", "left")
        return rows

    with Scratch(spark) as scratch:
        packed = docs.select("doc_id", F.col("text").cast("binary")).mapInArrow(_batches, f"batch string, doc_ids array<{kind}>, texts array<binary>")
        try:
            packed.repartition(n, "batch").write.option("compression", "zstd").option("path", scratch.path("batches")).bucketBy(n, "batch").sortBy("batch").saveAsTable(name)
            for k in range(len(lengths)):
                asked = with_answers().mapInArrow(_ask(lengths, k, buckets), "bucket int, batch string, hashes binary, twice binary")
                answered = asked.groupBy("bucket").applyInArrow(_answer, "batch string, bucket int, n int, bits binary")
                answers.append(scratch.written(answered, "answers"))
            return written(with_answers().mapInArrow(_finish(lengths, with_text), result), "kept")
        finally:
            spark.sql(f"drop table if exists {name}")
