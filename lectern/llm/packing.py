"""Packing documents into sequences of fixed capacity: length patterns fitted to the histogram by non-negative least squares."""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import short_batches, written
from .tokenizing import encoder

CAPACITY = 2048
END_ID = 0
#: Documents in a pattern, patterns kept after the fit (the slots sent to executors are at most three times as many, plus
#: those of the residual, which are bounded by the capacity), steps of the fit.
MOST_IN_PATTERN, MAX_PATTERNS, STEPS = 3, 20_000, 300


def patterns(lengths: np.ndarray, capacity: int) -> np.ndarray:
    """All multisets of one to three of the given lengths that sum to the capacity, as rows padded with 0, longest first."""
    lengths = np.unique(lengths)
    has = np.zeros(capacity + 1, bool)
    has[lengths] = True
    found = [np.array([[capacity, 0, 0]])] if has[capacity] else []
    a = lengths[(lengths < capacity) & (2 * lengths >= capacity)]
    a = a[has[capacity - a]]
    found.append(np.stack([a, capacity - a, 0 * a], 1))
    for x in lengths[3 * lengths >= capacity]:
        rest = capacity - x
        if rest < 2:
            continue
        b = lengths[(lengths <= min(x, rest - 1)) & (2 * lengths >= rest)]
        b = b[has[rest - b]]
        found.append(np.stack([np.full(len(b), x), b, rest - b], 1))
    return np.concatenate(found).astype(np.int64) if found else np.empty((0, 3), np.int64)


def fit(rows: np.ndarray, histogram: np.ndarray, steps: int = STEPS) -> np.ndarray:
    """x >= 0 that makes the patterns' total use of each length nearest to the histogram, by accelerated projected gradient."""
    size = len(histogram)
    use = [rows[:, i] for i in range(rows.shape[1])]
    made = lambda x: sum(np.bincount(u, x, size) for u in use) * inside
    inside = np.ones(size)
    inside[0] = 0
    scale = max(float(histogram.max()), 1.0)
    want = histogram / scale
    v = np.random.default_rng(0).random(len(rows))
    for _ in range(12):
        g = made(v)
        v = sum(g[u] for u in use)
        bound = float(np.linalg.norm(v))
        v /= max(bound, 1e-12)
    step = 1 / max(bound * 1.05, 1e-9)
    x = y = np.zeros(len(rows))
    t = 1.0
    for _ in range(steps):
        g = made(y) - want
        new = np.maximum(0, y - step * sum(g[u] for u in use))
        t, before = (1 + (1 + 4 * t * t) ** 0.5) / 2, t
        y = new + (before - 1) / t * (new - x)
        x = new
    return x * scale


def pack_histogram(histogram: dict[int, int], capacity: int = CAPACITY, max_patterns: int = MAX_PATTERNS) -> list[tuple[tuple[int, ...], int]]:
    """(lengths of one sequence, number of such sequences), using each length exactly as often as the histogram has it.

    Fitted counts are rounded to the nearest and never use more than is left; the residual is packed best fit, longest first, on
    counts, so the work follows the number of distinct lengths, not of documents.
    """
    left = np.zeros(capacity + 1, np.int64)
    for length, n in histogram.items():
        left[length] = n
    bins: list[tuple[tuple[int, ...], int]] = []
    if left.any():
        rows = patterns(np.flatnonzero(left), capacity)
        times = fit(rows, left.astype(float)) if len(rows) else np.empty(0)
        for i in np.argsort(-times, kind="stable")[:max_patterns]:
            if times[i] < 0.5:
                break
            parts = tuple(int(p) for p in rows[i] if p)
            n = min(int(times[i] + 0.5), *(int(left[p]) // parts.count(p) for p in parts))
            if n > 0:
                bins.append((parts, n))
                for p in parts:
                    left[p] -= n
    room: list[int] = []
    groups: dict[int, list[tuple[tuple[int, ...], int]]] = {}

    def keep(parts: tuple[int, ...], n: int) -> None:
        free = capacity - sum(parts)
        if free not in groups:
            insort(room, free)
            groups[free] = []
        groups[free].append((parts, n))

    for length in np.flatnonzero(left)[::-1].tolist():
        n = int(left[length])
        while n:
            at = bisect_left(room, length)
            if at < len(room):
                free = room[at]
                parts, held = groups[free].pop()
                if not groups[free]:
                    del groups[free], room[at]
                used = min(n, held)
                fits = max(1, min(free // length, n // used))
                keep(parts + (length,) * fits, used)
                if held > used:
                    keep(parts, held - used)
                n -= used * fits
            else:
                each = min(capacity // length, n)
                keep((length,) * each, n // each)
                n -= n // each * each
    return bins + [x for free in room for x in groups[free]]


def _pieces(path: str, end_id: int, capacity: int, with_ids: bool, special_as_text: bool, names: tuple[str, ...]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, end = encoder(path, special_as_text), int(end_id).to_bytes(4, "little")
        for batch in batches:
            rows = []
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                data = encode(text) + end
                n = len(data) // 4
                first = n % capacity or min(n, capacity)
                cuts = [0, *range(first, n + 1, capacity)] if n > capacity else [0, n]
                for i, (a, b) in enumerate(zip(cuts, cuts[1:])):
                    part = data[4 * a : 4 * b]
                    rows.append((doc, i, a, b - a, zlib.crc32(part), part))
            cols = list(zip(*rows)) or [[]] * 6
            kinds = (batch.schema.types[0], pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary())
            upto = 6 if with_ids else 5
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols[:upto], kinds[:upto])], names=list(names[:upto]))

    return run


_NAMES = ("doc_id", "piece", "start", "length", "ids_crc32", "ids")


def pieces(docs: DataFrame, tokenizer: str, *, end_id: int = END_ID, capacity: int = CAPACITY, with_ids: bool = False, special_as_text: bool = False) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32 (and ids): each document's ids with the end id, cut only if over the capacity.

    A longer document gives pieces of the full capacity, but for the first, which takes what doesn't fill one. Null and
    empty texts are the end id alone. No shuffle. Repeated rows give repeated pieces; extra columns are ignored. With
    special_as_text the strings of special tokens in a text are ordinary text, so that a text can't forge one.
    """
    short_batches(docs.sparkSession)
    schema = f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, piece int, start long, length long, ids_crc32 long" + ", ids binary" * with_ids
    return docs.select("doc_id", "text").mapInArrow(_pieces(tokenizer, end_id, capacity, with_ids, special_as_text, _NAMES), schema)


def _slots(bins: list[tuple[tuple[int, ...], int]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Keys length << 40 | first rank, in order, with the first sequence and the offset of each run of slots."""
    taken: dict[int, int] = {}
    rows, base = [], 0
    for parts, n in bins:
        at = 0
        for length in parts:
            rank = taken.get(length, 0)
            taken[length] = rank + n
            rows.append((length << 40 | rank, base, at))
            at += length
        base += n
    rows.sort()
    a = np.array(rows, np.int64).reshape(-1, 3)
    return a[:, 0].copy(), a[:, 1].copy(), a[:, 2].copy()


def _place(keys: np.ndarray, bases: np.ndarray, offsets: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            key = batch.column("length").to_numpy() << 40 | batch.column("rank").to_numpy()
            i = np.searchsorted(keys, key, "right") - 1
            columns = [batch.column(c) for c in _NAMES[:5]]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(bases[i] + key - keys[i], pa.int64()), pa.array(offsets[i], pa.int64())], names=[*_NAMES[:5], "sequence_id", "offset"])

    return run


def place(cut: DataFrame, *, capacity: int = CAPACITY, max_patterns: int = MAX_PATTERNS) -> DataFrame:
    """Adds sequence_id and offset to the pieces (a written table: it is read twice).

    The driver sees one count for each length, at most `capacity` rows. A piece's slot follows from its rank among those
    of its length; ranks are counted within hash buckets and shifted by the buckets before, so a length that a third
    of all pieces have is no single task. Pieces that are alike in all columns are interchangeable. Empty: empty.
    """
    spark = cut.sparkSession
    salts = max(16, 4 * int(spark.conf.get("spark.sql.shuffle.partitions")))
    salted = cut.withColumn("_salt", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.lit(salts)))
    counts = written(salted.groupBy("length", "_salt").agg(F.count("*").alias("_n")), "pack-counts")
    histogram = {r[0]: r[1] for r in counts.groupBy("length").agg(F.sum("_n")).collect()}
    keys, bases, offsets = _slots(pack_histogram(histogram, capacity, max_patterns))
    before = Window.partitionBy("length").orderBy("_salt").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("length", "_salt", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    own = Window.partitionBy("length", "_salt").orderBy("doc_id", "piece", "ids_crc32")
    ranked = salted.withColumn("_own", F.row_number().over(own)).join(starts, ["length", "_salt"])
    ranked = ranked.select(*_NAMES[:5], (F.col("_before") + F.col("_own") - 1).alias("rank"))
    kind = cut.schema["doc_id"].dataType.simpleString()
    return ranked.mapInArrow(_place(keys, bases, offsets), f"doc_id {kind}, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long")


def pack(docs: DataFrame, tokenizer: str, *, end_id: int = END_ID, capacity: int = CAPACITY, max_patterns: int = MAX_PATTERNS, special_as_text: bool = False) -> DataFrame:
    """pieces() with their places: one row per piece. Texts are encoded once and aren't shuffled."""
    cut = written(pieces(docs, tokenizer, end_id=end_id, capacity=capacity, special_as_text=special_as_text), "pack-pieces")
    return place(cut, capacity=capacity, max_patterns=max_patterns)


def sequences(docs: DataFrame, tokenizer: str, **options) -> DataFrame:
    """The packed sequences themselves: sequence_id, ids (array of int), ends (where each piece ends), doc_ids.

    Null and empty texts are one piece, the end id; null ids are ids like any other; repeated rows are pieces each; extra
    columns are ignored. A sequence is one task's row, of at most the capacity. Empty table: no sequences.
    """
    cut = written(pieces(docs, tokenizer, with_ids=True, **options), "pack-ids")
    where = place(cut.drop("ids"), capacity=options.get("capacity", CAPACITY))
    copy = Window.partitionBy(*_NAMES[:5]).orderBy(F.lit(1))
    joined = where.withColumn("_copy", F.row_number().over(copy)).join(cut.withColumn("_copy", F.row_number().over(copy)), [*_NAMES[:5], "_copy"])

    def run(group: pa.Table) -> pa.Table:
        group = group.sort_by("offset")
        ids = np.frombuffer(b"".join(group["ids"].to_pylist()), "<u4").astype(np.int32)
        ends = np.cumsum(group["length"].to_numpy())
        return pa.table({"sequence_id": group["sequence_id"][:1], "ids": pa.array([ids.tolist()], pa.list_(pa.int32())), "ends": pa.array([ends.tolist()], pa.list_(pa.int64())), "doc_ids": pa.array([group["doc_id"].to_pylist()], pa.list_(group.schema.field("doc_id").type))})

    kind = cut.schema["doc_id"].dataType.simpleString()
    return joined.select("sequence_id", "offset", "length", "doc_id", "ids").groupBy("sequence_id").applyInArrow(run, f"sequence_id long, ids array<int>, ends array<long>, doc_ids array<{kind}>")
