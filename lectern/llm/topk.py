"""Exact top-k by branch and bound over a columnar layout: dimensions are added block by block, candidates that can't win go."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import Scratch, keep, shared_path

K = 20
SCALE = 64
#: Dimensions added before bounds are taken again.
DIM_BLOCK = 16
#: Rows of a vertical block, queries that are sent to the executors at a time, at most, and bytes of them.
ROWS, QUERIES, QUERY_BYTES = 1024, 4096, 4_000_000
#: Queries of a wave against which each of them is scored beforehand: their k-th best score is a floor for all tasks.
SAMPLE = 512
#: Share of pairs left at which they are followed one by one, and no longer as a whole matrix.
SPARSE = 0.2
#: Up to here sums of products of integers are exact in double precision.
_EXACT = 2.0**53


def quantised(vector: Column, scale: int = SCALE) -> Column:
    """floor(scale * x) of every component, x as double; null if the vector or a component is null or not finite. What doesn't
    fit 64 bits is an error.
    """
    as_double = F.transform(vector, lambda x: x.cast("double"))
    bad = F.exists(as_double, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(float("inf"))))
    beyond = F.exists(as_double, lambda x: F.abs(x * scale) >= F.lit(2.0**63))
    floors = F.transform(as_double, lambda x: F.floor(x * scale).cast("long"))
    whole = F.when(F.coalesce(beyond, F.lit(False)), F.raise_error(F.lit("a component is beyond 64 bits")).cast("array<bigint>")).otherwise(floors)
    return F.when(vector.isNotNull() & ~F.coalesce(bad, F.lit(True)), whole)


def _largest(a: np.ndarray) -> float:
    return float(max(a.max(initial=0), -float(a.min(initial=0))))


def _in_double(a: float, b: float, dims: int) -> bool:
    """Whether sums of products of integers up to a and b, over so many dimensions, are exact in double precision. It is
    asked of all dimensions, not of a block: blocks are added up.
    """
    return a * b * dims < _EXACT


def _product(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """a @ b of integers, whole vectors each, in double precision where that is exact and in 64-bit integers elsewhere."""
    if _in_double(_largest(a), _largest(b), a.shape[1]):
        return a.astype(np.float64) @ b.astype(np.float64)
    return a @ b


def floors(queries: np.ndarray, k: int, sample: int = SAMPLE) -> np.ndarray:
    """For each of the queries (different rows of one table) a score that k other rows reach; -inf where too few are known."""
    known = queries[:sample]
    if len(known) <= k:
        return np.full(len(queries), -np.inf)
    score = _product(queries, known.T).astype(np.float64)
    own = np.arange(len(known))
    score[own, own] = -np.inf
    return np.partition(score, score.shape[1] - k, 1)[:, score.shape[1] - k]


class Bounded:
    """The best k so far of each query of one wave, over the vertical blocks that are shown to it."""

    def __init__(self, ids: np.ndarray, queries: np.ndarray, k: int, floor: np.ndarray | None = None):
        self.ids, self.queries, self.k = ids, queries, k
        self.order = np.argsort(-np.abs(queries.astype(np.float64)).sum(0), kind="stable")  # heavy dimensions first
        self.q = queries[:, self.order]
        self.q_double, self.largest = self.q.astype(np.float64), _largest(queries)
        self.q_left = np.sqrt(np.cumsum((self.q_double**2)[:, ::-1], 1)[:, ::-1])
        self.floor = np.full(len(ids), -np.inf) if floor is None else floor.astype(np.float64)
        self.by_id = np.argsort(ids, kind="stable")
        none = np.empty(0, np.int64)
        self.found = (none, none, none, none)  # query's place, score, id, copies; by query, best first

    def _own(self, ids: np.ndarray, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(query's place, candidate's place) of candidates that are the query's own row: same id, same vector."""
        ordered = self.ids[self.by_id]
        first, last = np.searchsorted(ordered, ids, "left"), np.searchsorted(ordered, ids, "right")
        j = np.repeat(np.arange(len(ids)), last - first)
        at = np.repeat(first - (np.cumsum(last - first) - (last - first)), last - first) + np.arange(len(j))
        i = self.by_id[at]
        same = (self.queries[i] == vectors[j]).all(1)
        return i[same], j[same]

    def show(self, ids: np.ndarray, vectors: np.ndarray, copies: np.ndarray) -> None:
        """vectors: one row per candidate, of which there are so many copies; laid out by dimension here."""
        columns = np.ascontiguousarray(vectors[:, self.order].T)  # dimension x candidate
        dims, n = columns.shape
        cuts = [*range(0, dims, DIM_BLOCK), dims]
        squares = np.cumsum((columns.astype(np.float64) ** 2)[::-1], 0)[::-1]
        if self.q_left[:, 0].max(initial=0) * np.sqrt(squares[0].max(initial=0)) >= 2.0**62.99:
            raise OverflowError("scores are beyond 64 bits")  # no partial sum is larger than the norms' product
        double = _in_double(self.largest, _largest(columns), dims)
        q = self.q_double if double else self.q
        columns = columns.astype(np.float64) if double else columns
        unsure = 0.0 if double else 2.0**-50  # share of a 64-bit score that comparing it in double precision may lose
        own_i, own_j = self._own(ids, vectors)
        single = copies[own_j] == 1
        gone = (own_i[single], own_j[single])
        score = q[:, : cuts[1]] @ columns[: cuts[1]]
        pairs = None
        for b in range(1, len(cuts) - 1):
            c, d = cuts[b], cuts[b + 1]
            left, right = self.q_left[:, c], np.sqrt(squares[c])
            if pairs is None:
                bound = left[:, None] * right[None, :] * (1 + 1e-9) + 1e-6
                if unsure:
                    bound += np.abs(score) * unsure
                sure = score - bound
                sure[gone] = -np.inf
                if n > self.k:  # the k-th best of what is surely reached
                    open_ = np.flatnonzero(np.isneginf(self.floor))
                    if len(open_):
                        self.floor[open_] = np.partition(sure[open_], n - self.k, 1)[:, n - self.k]
                stay = score + bound >= self.floor[:, None]
                stay[gone] = False
                if stay.mean() > SPARSE:
                    score = score + q[:, c:d] @ columns[c:d]
                    continue
                i, j = np.nonzero(stay)
                pairs, score = (i, j), score[i, j]
            else:
                i, j = pairs
                stay = score + (left[i] * right[j] * (1 + 1e-9) + 1e-6 + np.abs(score) * unsure) >= self.floor[i]
                i, j, score = i[stay], j[stay], score[stay]
                pairs = i, j
            score = score + self._pair_products(q, i, j, columns, c, d)
        if pairs is None:
            stay = score >= self.floor[:, None]
            stay[gone] = False
            pairs = i, j = np.nonzero(stay)
            score = score[i, j]
        i, j = pairs
        others = copies[j].copy()
        own = np.zeros(len(others), bool)  # of the query's own row the other copies are candidates
        if len(own_i):
            own = np.isin(i * n + j, own_i * n + own_j)
        others[own] -= 1
        self._take(i, np.rint(score).astype(np.int64) if score.dtype.kind == "f" else score, ids[j], others)

    def _pair_products(self, q: np.ndarray, i: np.ndarray, j: np.ndarray, columns: np.ndarray, c: int, d: int) -> np.ndarray:
        out = np.empty(len(i), columns.dtype)
        rows = np.ascontiguousarray(columns[c:d].T)
        for a in range(0, len(i), 1 << 18):
            out[a : a + (1 << 18)] = np.einsum("pd,pd->p", q[i[a : a + (1 << 18)], c:d], rows[j[a : a + (1 << 18)]])
        return out

    def _take(self, i: np.ndarray, score: np.ndarray, ids: np.ndarray, copies: np.ndarray) -> None:
        """Keeps the k best of what is held and what has come; a query that holds k has the last one's score as its floor."""
        i, score, ids, copies = (np.concatenate(x) for x in zip(self.found, (i, score, ids, copies)))
        order = np.lexsort((ids, -score, i))
        i, score, ids, copies = i[order], score[order], ids[order], copies[order]
        starts = np.flatnonzero(np.concatenate([[True], i[1:] != i[:-1]])) if len(i) else np.empty(0, np.int64)
        rank = np.arange(len(i)) - np.repeat(starts, np.diff(np.append(starts, len(i))))
        some = rank < self.k
        self.found = (i[some], score[some], ids[some], copies[some])
        full = rank == self.k - 1
        self.floor[i[full]] = np.maximum(self.floor[i[full]], score[full])


def _matrix(column: pa.Array, dims: int) -> np.ndarray:
    return column.flatten().to_numpy().reshape(-1, dims)


_FOUND = "q int, query_id long, vec_id long, score long, copies long"


def _search(ids: np.ndarray, queries: np.ndarray, floor: np.ndarray, k: int, rows: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = Bounded(ids, queries, k, floor.copy())
        for batch in batches:
            names, vectors, copies = batch.column("vec_id").to_numpy(), _matrix(batch.column("v"), queries.shape[1]), batch.column("n").to_numpy()
            for a in range(0, len(names), rows):
                best.show(names[a : a + rows], vectors[a : a + rows], copies[a : a + rows])
        q, score, names, copies = best.found
        yield pa.RecordBatch.from_arrays([pa.array(q, pa.int32()), pa.array(ids[q]), pa.array(names), pa.array(score), pa.array(copies)], names=["q", "query_id", "vec_id", "score", "copies"])

    return run


def top_k(vectors: DataFrame, is_query: Column, *, k: int = K, queries: int = QUERIES, rows: int = ROWS) -> DataFrame:
    """query_id, rank, vec_id, score: for each row of vectors (vec_id, v: array of integers) where is_query holds, the k
    other rows with the highest inner products, ties to the smaller id; all, if there are fewer.

    Rows with a null id or vector take no part; other ids than integers are an error. Vectors are compared with those of
    their own length, each length on its own (lengths are few). Repeated rows are candidates and queries each: they are
    one row with a count until ranks are given, so that many of them aren't many candidates. Queries go out in waves, which
    bounds what a wave sends to the executors (QUERY_BYTES); each wave scans the candidates once where they stand, each
    task returns its best k for each query, and a wave's result is written before the next is asked, so neither the
    driver nor the plan grows with the number of waves. Scores are exact; where the vectors' norms allow one beyond 64 bits
    that is an error. Extra columns are ignored. Empty table: empty result.
    """
    spark = vectors.sparkSession
    if vectors.schema["vec_id"].dataType.simpleString() not in ("tinyint", "smallint", "int", "bigint"):
        raise ValueError("vec_id isn't an integer")
    out = keep(shared_path(spark, "nearest"))
    spark.createDataFrame([], f"wave int, {_FOUND}, asked long").write.parquet(out)
    with Scratch(spark) as scratch:
        chosen = vectors.where("vec_id is not null and v is not null").select(F.col("vec_id").cast("long").alias("vec_id"), "v", F.coalesce(is_query, F.lit(False)).cast("long").alias("_q"))
        usable = scratch.written(chosen.groupBy("vec_id", "v").agg(F.count("*").alias("n"), F.sum("_q").alias("nq")), "vectors")
        wave = 0
        for dims in sorted(r["n"] for r in usable.select(F.size("v").alias("n")).distinct().collect()):
            alike = usable.where(F.size("v") == dims)
            if not dims:  # every score is 0
                alike, dims = alike.withColumn("v", F.array(F.lit(0).cast("long"))), 1
            asked = alike.where("nq > 0")
            waves = -(-asked.count() // max(1, min(queries, QUERY_BYTES // (8 * dims))))
            for part in range(waves):
                some = asked.where(F.pmod(F.xxhash64("vec_id", "v"), F.lit(waves)) == part).select("vec_id", "v", "nq").toArrow().combine_chunks()
                if some.num_rows:
                    ids = some["vec_id"].to_numpy().astype(np.int64)
                    matrix = _matrix(some["v"].combine_chunks(), dims)
                    found = alike.select("vec_id", "v", "n").mapInArrow(_search(ids, matrix, floors(matrix, k), k, rows), _FOUND)
                    best = Window.partitionBy("q").orderBy(F.desc("score"), "vec_id")
                    found = found.withColumn("_r", F.row_number().over(best)).where(F.col("_r") <= k).drop("_r")
                    times = spark.createDataFrame([(i, n) for i, n in enumerate(some["nq"].to_pylist())], "q int, asked long")
                    found = found.join(F.broadcast(times), "q")  # a row for each query of the wave
                    found.select(F.lit(wave).alias("wave"), "q", "query_id", "vec_id", "score", "copies", "asked").write.mode("append").parquet(out)
                    wave += 1
    found = spark.read.schema(f"wave int, {_FOUND}, asked long").parquet(out)
    each = found.withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("long"), F.least("copies", F.lit(k).cast("long")))))
    best = Window.partitionBy("wave", "q").orderBy(F.desc("score"), "vec_id", "_copy")
    ranked = each.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
    return ranked.withColumn("_time", F.explode(F.sequence(F.lit(1).cast("long"), F.col("asked")))).select("query_id", "rank", "vec_id", "score")


ORACLE = f"""
with v as (
  select row_number() over () as r, vec_id, [cast(floor({SCALE} * cast(x as double)) as bigint) for x in embedding] as v from embeddings
  where embedding is not null and vec_id is not null
    and len([x for x in embedding if x is null or isnan(x) or isinf(x)]) = 0),
s as (select q.r, q.vec_id as query_id, c.vec_id, cast(list_dot_product(q.v::double[], c.v::double[]) as bigint) as score
      from v q join v c on q.r <> c.r and len(q.v) = len(c.v) where q.vec_id % 20 = 0),
k as (select *, cast(row_number() over (partition by r order by score desc, vec_id) as integer) as rank from s)
select query_id, rank, vec_id, score from k where rank <= {K}
"""
