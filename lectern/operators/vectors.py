"""Vector search: exact by matrix products, and an inverted-file index of product-quantised codes as a partitioned table."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..sources.readers import delete
from ..sources.writers import work_folder

TOP_K = 10
#: Queries and bytes of them that go to the executors at a time, at most.
MAX_QUERIES, QUERY_BYTES = 4096, 16_000_000
#: Vectors that are fitted to, those of lowest hash; cells, at most; codes of a part; passes of k-means; rows of a Python batch.
SAMPLE, MAX_CELLS, CODES, PASSES, BATCH = 65_536, 4096, 256, 12, 2048
#: Candidates that are scored exactly, for each of the k wanted; least recall among the sample that probes are chosen for.
RERANK, RECALL = 20, 0.97
#: Queries that a task scores at a time, codes that it holds for that, and candidates before the best are chosen: what a task has in memory doesn't follow the wave.
QUERY_BLOCK, HELD_CODES, HELD_FOUND = 256, 65_536, 262_144
#: Scores of a matrix product are this near to those of the plain sum, about.
_NEAR = 1e-9


def _unit(lists: pa.Array, dims: int) -> tuple[np.ndarray, np.ndarray]:
    """(places, unit vectors in double precision) of the vectors of that length that have a direction."""
    at = np.flatnonzero((lists.value_lengths().fill_null(-1).to_numpy(zero_copy_only=False) == dims))
    flat = lists.take(pa.array(at)).flatten().cast(pa.float64())
    v = flat.to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(at), dims)
    with np.errstate(over="ignore", invalid="ignore", divide="ignore"):
        norms = np.sqrt((v * v).sum(1))
        good = np.isfinite(norms) & (norms > 0)
    return at[good], v[good] / norms[good, None]


class _Best:
    """The k best so far of each query: by score, ties by the smaller key."""

    def __init__(self, queries: int, k: int):
        self.k, self.floor = k, np.full(queries, -np.inf)
        self.q, self.score, self.key = np.empty(0, np.int64), np.empty(0), None

    def take(self, q: np.ndarray, score: np.ndarray, key: np.ndarray) -> None:
        if self.key is not None:
            q, score, key = np.concatenate([self.q, q]), np.concatenate([self.score, score]), np.concatenate([self.key, key])
        if not len(q):
            return
        order = np.lexsort((np.unique(key, return_inverse=True)[1], -score, q))
        q, score, key = q[order], score[order], key[order]
        starts = np.flatnonzero(np.concatenate([[True], q[1:] != q[:-1]]))
        rank = np.arange(len(q)) - np.repeat(starts, np.diff(np.append(starts, len(q))))
        keep, full = rank < self.k, rank == self.k - 1
        self.floor[q[full]] = score[full]
        self.q, self.score, self.key = q[keep], score[keep], key[keep]

    def batch(self, kind: pa.DataType, first: int = 0) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(self.q + first, pa.int32()), pa.array([] if self.key is None else self.key.tolist(), kind), pa.array(self.score)], names=["q", "key", "score"])


def _blocks(asked: np.ndarray, k: int) -> list[tuple[int, np.ndarray, _Best]]:
    """(first query, unit vectors, best so far) of each QUERY_BLOCK of a wave's queries."""
    return [(a, part := asked[a : a + QUERY_BLOCK], _Best(len(part), k)) for a in range(0, len(asked), QUERY_BLOCK)]


def _scored(best: _Best, asked: np.ndarray, keys: np.ndarray, vectors: np.ndarray) -> None:
    """Shows unit vectors to all queries: a matrix product finds who may be among the best, a plain sum scores them."""
    rough, floor = asked @ vectors.T, best.floor
    if len(keys) > best.k:
        floor = np.maximum(floor, np.partition(rough, len(keys) - best.k, 1)[:, len(keys) - best.k])
    i, j = np.nonzero(rough >= floor[:, None] - _NEAR)
    score = np.empty(len(i))
    for a in range(0, len(i), 1 << 14):
        score[a : a + (1 << 14)] = (asked[i[a : a + (1 << 14)]] * vectors[j[a : a + (1 << 14)]]).sum(1)
    best.take(i, score, keys[j])


def _held(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, pa.DataType]]:
    """(cells, keys, codes, type of the keys) of about HELD_CODES rows at a time."""
    held, n = [], 0
    for batch in batches:
        if not batch.num_rows:
            continue
        codes = np.frombuffer(b"".join(batch.column("codes").to_pylist()), np.uint8).reshape(batch.num_rows, -1)
        held.append((batch.column("cell").to_numpy(), batch.column("key").to_numpy(zero_copy_only=False), codes))
        n += batch.num_rows
        if n >= HELD_CODES:
            yield *map(np.concatenate, zip(*held)), batch.schema.field("key").type
            held, n = [], 0
    if n:
        yield *map(np.concatenate, zip(*held)), batch.schema.field("key").type


def _by_code(block: tuple[int, np.ndarray, _Best], probed: np.ndarray, model: Quantiser, cell: np.ndarray, keys: np.ndarray, codes: np.ndarray) -> None:
    """Shows codes to the queries of a block that probe their cells, by what each code adds to the product."""
    first, asked, best = block
    probed, tables, centres = probed[first : first + len(asked)], model.tables(asked), asked @ model.cells.T
    order, found, n = np.argsort(cell, kind="stable"), [], 0
    for own in np.split(order, np.flatnonzero(np.diff(cell[order])) + 1):
        c, of = cell[own[0]], np.flatnonzero((probed == cell[own[0]]).any(1))
        for a in range(0, len(own) if len(of) else 0, BATCH):
            rows = own[a : a + BATCH]
            score = np.zeros((len(of), len(rows)))
            for p in range(codes.shape[1]):
                score += tables[of, p][:, codes[rows, p]]
            score += centres[of, c][:, None]
            floor = best.floor[of]
            if len(rows) > best.k:
                floor = np.maximum(floor, np.partition(score, len(rows) - best.k, 1)[:, len(rows) - best.k])
            i, j = np.nonzero(score >= floor[:, None])
            found.append((of[i], score[i, j], keys[rows[j]]))
            n += len(i)
            if n >= HELD_FOUND:
                best.take(*map(np.concatenate, zip(*found)))
                found, n = [], 0
    if n:
        best.take(*map(np.concatenate, zip(*found)))


def _short_batches(df: DataFrame) -> None:
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(df.sparkSession.conf.get(name)) <= BATCH:
        df.sparkSession.conf.set(name, str(BATCH))


def _waves(queries: DataFrame, vector: str, dims: int, wave: int) -> Iterator[tuple[pa.Array, np.ndarray]]:
    """(ids, unit vectors) of the queries of one length, so many at a time."""
    own = queries.where(F.size(vector) == dims)
    n = -(-own.count() // max(1, min(wave, QUERY_BYTES // (8 * max(1, dims)))))
    for part in range(n):
        some = own.where(F.pmod(F.xxhash64("query_id", vector), F.lit(n)) == part).select("query_id", vector).toArrow().combine_chunks()
        if some.num_rows:
            at, unit = _unit(some[vector].combine_chunks(), dims)
            yield some["query_id"].combine_chunks().take(pa.array(at)), unit


def nearest(index: DataFrame, queries: DataFrame, *, key: str = "vec_id", vector: str = "embedding", k: int = TOP_K, wave: int = MAX_QUERIES) -> DataFrame:
    """query_id, rank, key, score: for each of queries (query_id, vector) the k rows of index with the highest cosine, ties to
    the smaller key. Exact: each wave of queries is multiplied with the index where it stands, a batch at a time, every task
    returns its k best of each query, and a wave's result is written before the next one is asked.

    Rows and queries without a direction (null, null or infinite components, zero) and rows of another length take no part;
    null keys neither. Repeated rows are answers each; query ids should be unique. Extra columns are ignored. Empty tables: no rows.
    """
    _short_batches(index)
    spark, kind = index.sparkSession, index.schema[key].dataType.simpleString()
    id_kind = queries.schema["query_id"].dataType.simpleString()
    out, made = work_folder(spark, "nearest"), 0
    spark.createDataFrame([], f"query_id {id_kind}, `{key}` {kind}, score double, rank int").write.parquet(f"{out}/wave=-1")
    usable = queries.where("query_id is not null").select("query_id", vector)
    lengths = sorted(r.n for r in usable.select(F.size(vector).alias("n")).where("n > 0").distinct().collect())  # few
    for dims in lengths:
        rows = index.where((F.size(vector) == dims) & F.col(key).isNotNull()).select(F.col(key).alias("key"), F.col(vector).alias("v"))
        for ids, asked in _waves(usable, vector, dims, wave):
            shared = spark.sparkContext.broadcast(asked)

            def run(batches: Iterator[pa.RecordBatch], shared=shared, dims=dims) -> Iterator[pa.RecordBatch]:
                blocks, arrow = _blocks(shared.value, k), None
                for batch in batches:
                    arrow = batch.schema.field("key").type
                    at, unit = _unit(batch.column("v"), dims)
                    keys = batch.column("key").take(pa.array(at)).to_numpy(zero_copy_only=False)
                    for _, asked, best in blocks:
                        _scored(best, asked, keys, unit)
                if arrow is not None:
                    for first, _, best in blocks:
                        yield best.batch(arrow, first)

            found = rows.mapInArrow(run, f"q int, key {kind}, score double")
            _ranked(found, ids, id_kind, key, k).write.parquet(f"{out}/wave={made}")
            shared.destroy()
            made += 1
    return spark.read.parquet(out).select("query_id", "rank", key, "score")


def _ranked(found: DataFrame, ids: pa.Array, id_kind: str, key: str, k: int) -> DataFrame:
    """The k best of what the tasks found, beside the queries' ids: a row a query of the wave."""
    spark = found.sparkSession
    names = spark.createDataFrame(list(enumerate(ids.to_pylist())), f"q int, query_id {id_kind}")
    best = Window.partitionBy("q").orderBy(F.desc("score"), "key")
    ranked = found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
    return ranked.join(F.broadcast(names), "q").select("query_id", F.col("key").alias(key), "score", "rank")


@dataclass
class Quantiser:
    """Cells of unit vectors, and for each part of what is left the codes that stand for it."""

    cells: np.ndarray  # cell x dimension
    codes: np.ndarray  # part x code x dimension of the part
    probes: int

    @property
    def dims(self) -> int:
        return self.cells.shape[1]

    def cell_of(self, unit: np.ndarray) -> np.ndarray:
        return _closest(unit, self.cells)

    def encode(self, unit: np.ndarray, cell: np.ndarray) -> np.ndarray:
        left = (unit - self.cells[cell]).reshape(len(unit), len(self.codes), -1)
        return np.stack([_closest(left[:, p], self.codes[p]) for p in range(len(self.codes))], 1).astype(np.uint8)

    def tables(self, asked: np.ndarray) -> np.ndarray:
        """query x part x code: what each code adds to the product with each query."""
        return np.einsum("qpd,pcd->qpc", asked.reshape(len(asked), len(self.codes), -1), self.codes)

    def probed(self, asked: np.ndarray) -> np.ndarray:
        """query x probe: the cells whose centres have the highest products."""
        return np.argsort(-(asked @ self.cells.T), 1, kind="stable")[:, : self.probes]


def _closest(points: np.ndarray, centres: np.ndarray) -> np.ndarray:
    half = (centres * centres).sum(1) / 2
    return np.concatenate([(points[a : a + 4096] @ centres.T - half).argmax(1) for a in range(0, len(points), 4096)] or [np.empty(0, np.int64)])


def k_means(points: np.ndarray, n: int, passes: int = PASSES, seed: int = 7) -> np.ndarray:
    """n centres, at most as many as points; one that loses all its points takes one of the largest cell's."""
    rng = np.random.default_rng(seed)
    centres = points[rng.choice(len(points), min(n, len(points)), replace=False)].copy()
    for _ in range(passes):
        own = _closest(points, centres)
        counts = np.bincount(own, minlength=len(centres))
        sums = np.zeros_like(centres)
        np.add.at(sums, own, points)
        full = counts > 0
        centres[full] = sums[full] / counts[full, None]
        empty = np.flatnonzero(~full)
        if len(empty):
            crowd = np.flatnonzero(own == counts.argmax())
            centres[empty] = points[rng.choice(crowd, len(empty))] + 1e-6 * rng.standard_normal((len(empty), points.shape[1]))
    return centres


def fit(vectors: DataFrame, *, vector: str = "embedding", parts: int = 16, sample: int = SAMPLE, max_cells: int = MAX_CELLS, recall: float = RECALL, k: int = TOP_K) -> Quantiser | None:
    """The cells, codes and number of probes for a table of vectors, from at most `sample` different vectors, those of lowest
    hash and of the most frequent length. None if no vector has a direction.

    There are about as many cells as the square root of the rows, at most max_cells and a quarter of the sample; vectors
    whose length `parts` doesn't divide are one part a component. Probes are the fewest that find `recall` of the k nearest
    within the sample.
    """
    rows = vectors.where(F.col(vector).isNotNull() & (F.size(vector) > 0)).select(F.col(vector).alias("v"))
    lengths = rows.groupBy(F.size("v").alias("n")).agg(F.count("*").alias("c")).orderBy(F.desc("c"), "n").first()
    if lengths is None:
        return None
    dims = lengths.n
    some = rows.where(F.size("v") == dims).distinct().orderBy(F.xxhash64("v"), "v").limit(sample).toArrow().combine_chunks()
    _, unit = _unit(some["v"].combine_chunks(), dims)
    if not len(unit):
        return None
    cells = k_means(unit, max(1, min(max_cells, int(lengths.c**0.5), len(unit) // 4)))
    own = _closest(unit, cells)
    parts = parts if dims % parts == 0 else dims
    left = (unit - cells[own]).reshape(len(unit), parts, -1)
    codes = [k_means(left[:, p], CODES) for p in range(parts)]
    width = max(map(len, codes))
    codes = np.stack([np.concatenate([c, np.full((width - len(c), c.shape[1]), 1e6)]) for c in codes])  # the filling is never closest
    model = Quantiser(cells, codes, len(cells))
    asked = unit[:: max(1, len(unit) // 256)]
    score = asked @ unit.T
    near = np.argpartition(-score, min(k, len(unit) - 1), 1)[:, :k]
    order = np.argsort(-(asked @ cells.T), 1, kind="stable")
    place = np.empty_like(order)
    np.put_along_axis(place, order, np.arange(len(cells))[None, :], 1)
    needed = np.sort(np.take_along_axis(place, own[near], 1).ravel())  # probes after which each neighbour is met
    model.probes = int(needed[min(len(needed) - 1, int(np.ceil(recall * len(needed))) - 1)]) + 1
    return model


def write_index(vectors: DataFrame, model: Quantiser, path: str, *, key: str = "vec_id", vector: str = "embedding") -> None:
    """Every row of vectors as (cell, key, codes, vector) under path, in a folder a cell; vectors without a direction or of
    another length have the cell -1 and no codes, so that every row is in the index. One shuffle, by ranges of cell and key:
    a cell with many rows is many files.
    """
    shared = vectors.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in batches:
            at, unit = _unit(batch.column("v"), model.dims)
            cell, codes = np.full(batch.num_rows, -1, np.int32), np.full(batch.num_rows, None, object)
            cell[at] = model.cell_of(unit)
            codes[at] = [c.tobytes() for c in model.encode(unit, cell[at])] if len(at) else []
            yield pa.RecordBatch.from_arrays([pa.array(cell), batch.column("key"), pa.array(codes.tolist(), pa.binary()), batch.column("v")], names=["cell", "key", "codes", "v"])

    _short_batches(vectors)
    rows = vectors.select(F.col(key).alias("key"), F.col(vector).alias("v"))
    kinds = ", ".join(f"{c} {rows.schema[c].dataType.simpleString()}" for c in ("key", "v"))
    coded = rows.mapInArrow(run, f"cell int, {kinds.replace(', v', ', codes binary, v')}")
    coded.repartitionByRange("cell", "key").sortWithinPartitions("cell", "key").write.partitionBy("cell").parquet(path)


def search(spark, path: str, model: Quantiser, queries: DataFrame, *, vector: str = "embedding", k: int = TOP_K, rerank: int = RERANK, wave: int = MAX_QUERIES) -> DataFrame:
    """query_id, rank, key, score: about the k nearest of each query by cosine, from an index at `path`; scores are exact.

    A wave's queries read the codes of the cells that they probe, and nothing else (the others are pruned as folders); each
    task returns the rerank * k best of each query by code; of the best of those the vectors are read, and scored exactly.
    Queries of other lengths or without a direction have no answers; query ids should be unique.
    """
    index = spark.read.parquet(path)
    kind, id_kind = index.schema["key"].dataType.simpleString(), queries.schema["query_id"].dataType.simpleString()
    out = work_folder(spark, "searched")
    spark.createDataFrame([], f"query_id {id_kind}, key {kind}, score double, rank int").write.parquet(f"{out}/wave=-1")
    wanted, made = k * rerank, 0
    for ids, asked in _waves(queries.where("query_id is not null").select("query_id", vector), vector, model.dims, wave):
        if not len(asked):
            continue
        probed = model.probed(asked)
        shared = spark.sparkContext.broadcast((asked, probed, model))
        own = index.where(F.col("cell").isin(sorted(set(probed.ravel().tolist()))) & F.col("key").isNotNull())

        def by_code(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            asked, probed, model = shared.value
            blocks, arrow = _blocks(asked, wanted), None
            for cell, keys, codes, arrow in _held(batches):
                for block in blocks:
                    _by_code(block, probed, model, cell, keys, codes)
            if arrow is not None:
                for first, _, best in blocks:
                    yield best.batch(arrow, first)

        def exact(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            asked, _, model = shared.value
            for batch in batches:
                at, unit = _unit(batch.column("v"), model.dims)
                q = batch.column("q").to_numpy()[at]
                yield pa.RecordBatch.from_arrays([pa.array(q, pa.int32()), batch.column("key").take(pa.array(at)), pa.array((asked[q] * unit).sum(1))], names=["q", "key", "score"])

        rough = own.select("cell", "key", "codes").mapInArrow(by_code, f"q int, key {kind}, score double")
        order = Window.partitionBy("q").orderBy(F.desc("score"), "key")
        chosen = rough.withColumn("_r", F.row_number().over(order)).where(F.col("_r") <= wanted).select("q", "key")
        met = own.select("key", "v").join(F.broadcast(chosen), "key")  # at most wanted rows for each query of the wave
        _ranked(met.select("q", "key", "v").mapInArrow(exact, f"q int, key {kind}, score double"), ids, id_kind, "key", k).write.parquet(f"{out}/wave={made}")
        shared.destroy()
        made += 1
    return spark.read.parquet(out).select("query_id", "rank", "key", "score")


def drop_index(spark, path: str) -> None:
    delete(spark, path)
