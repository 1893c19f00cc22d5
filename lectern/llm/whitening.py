"""Embedding whitening by a two-pass covariance: exact integer sums give the mean, a second pass sums centred outer products."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import Scratch, short_batches
from .topk import quantised

SCALE, COMPONENTS = 256, 4
#: Branching depth of the merge of partial sums.
DEPTH = 3
_LONG = 1 << 63


@dataclass
class Whitening:
    """The fitted projection of vectors of one length: n distinct vectors with sums per dimension, components by falling variance."""

    n: int
    sums: list[int]
    variances: np.ndarray
    components: np.ndarray  # dimension x component, unit columns
    trace: float
    identity_error: float | None = None

    @property
    def usable(self) -> np.ndarray:
        """Components whose variance isn't nothing next to the largest: only they can be scaled to 1."""
        return self.variances > max(0.0, float(self.variances[0])) * len(self.sums) * np.finfo(float).eps if len(self.variances) else np.empty(0, bool)


def scaled_centre(x: np.ndarray, n: int, sums: list[int]) -> np.ndarray:
    """n * x - S, exact: 64-bit integers where they suffice, else Python's."""
    top = max(int(x.max(initial=0)), -int(x.min(initial=0))) * n + max((abs(s) for s in sums), default=0)
    if top < _LONG:
        return x * np.int64(n) - np.array(sums, np.int64)
    return x.astype(object) * n - np.array(sums, object)


def squares(y: np.ndarray) -> list[int]:
    """The sum of squares of each row of integers, exact."""
    top = 0 if y.size == 0 else max(int(y.max()), -int(y.min()))
    exact = y if y.dtype == object or top * top * y.shape[1] < _LONG else y.astype(object)
    return [int(v) for v in (exact * exact).sum(1)] if y.shape[1] else [0] * len(y)


def _two_sum(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    s = a + b
    t = s - a
    return s, (a - (s - t)) + (b - t)


def _added(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Sums as value and error: what is added up in another order comes out the same to the last bits."""
    s, e = _two_sum(a[0], b[0])
    return _two_sum(s, e + a[1] + b[1])


def _matrices(batches: Iterator[pa.RecordBatch]) -> Iterator[np.ndarray]:
    """The vectors of each batch as matrices, one for each length."""
    for batch in batches:
        lists = batch.column("x")
        sizes = lists.value_lengths().to_numpy()
        for d in np.unique(sizes):
            yield lists.filter(pa.array(sizes == d)).flatten().to_numpy().reshape(int((sizes == d).sum()), d).astype(np.int64)


def _sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For each length: how many vectors, and exact sums, as text: they may be longer than 64 bits."""
    held: dict[int, tuple[int, list[int]]] = {}
    for x in _matrices(batches):
        top = max(int(x.max(initial=0)), -int(x.min(initial=0)))
        some = [int(v) for v in (x if top * len(x) < _LONG else x.astype(object)).sum(0)]
        n, sums = held.get(x.shape[1], (0, [0] * x.shape[1]))
        held[x.shape[1]] = n + len(x), [a + b for a, b in zip(sums, some)]
    yield pa.RecordBatch.from_pydict({"d": pa.array(held, pa.int32()), "n": pa.array([n for n, _ in held.values()], pa.int64()), "sums": pa.array([[str(v) for v in s] for _, s in held.values()], pa.list_(pa.string()))})


def _outer(means: dict, projected: bool):
    """For each length: sums of outer products of the centred vectors, or of what they are projected to."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        for x in _matrices(batches):
            model = means.value[x.shape[1]]
            c = project(x, model)[:, model.usable] if projected else centred(x, model)
            some = c.T @ c
            held[x.shape[1]] = _added(held.get(x.shape[1], (np.zeros_like(some), np.zeros_like(some))), (some, np.zeros_like(some)))
        yield pa.RecordBatch.from_pydict({"d": pa.array(held, pa.int32()), "high": pa.array([h.tobytes() for h, _ in held.values()], pa.binary()), "low": pa.array([low.tobytes() for _, low in held.values()], pa.binary())})

    return run


def centred(x: np.ndarray, model: Whitening) -> np.ndarray:
    """x - S/n, rounded once."""
    return scaled_centre(x, model.n, model.sums).astype(np.float64) / model.n


def project(x: np.ndarray, model: Whitening) -> np.ndarray:
    """The centred vectors on each component, over its standard deviation; NaN where that is nothing."""
    scale = np.where(model.usable, np.sqrt(np.where(model.usable, model.variances, 1.0)), np.nan)
    return centred(x, model) @ model.components / scale


def eigen(covariance: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The k largest eigenvalues, falling, and their unit eigenvectors, each with its largest entry positive."""
    values, vectors = np.linalg.eigh(covariance) if len(covariance) else (np.empty(0), np.empty((0, 0)))
    values, vectors = values[::-1][:k], vectors[:, ::-1][:, :k]
    signs = np.sign(vectors[np.abs(vectors).argmax(0), np.arange(vectors.shape[1])]) if vectors.size else np.ones(vectors.shape[1])
    return values, vectors * signs


def _merged(partials: DataFrame, read, add) -> dict:
    """The partial sums of each length, merged on the executors."""

    def one(held: dict, row) -> dict:
        return both(held, {row["d"]: read(row)})

    def both(a: dict, b: dict) -> dict:
        return a | {d: add(a[d], v) if d in a else v for d, v in b.items()}

    return partials.rdd.treeAggregate({}, one, both, DEPTH)


def _read_matrix(row) -> tuple[np.ndarray, np.ndarray]:
    high, low = np.frombuffer(row["high"]), np.frombuffer(row["low"])
    side = int(round(len(high) ** 0.5))
    return high.reshape(side, side), low.reshape(side, side)


def fit(distinct: DataFrame, k: int = COMPONENTS) -> dict[int, Whitening]:
    """Length -> its whitening, given every different vector x (array of longs) once. Table must not change between its reads.

    Three passes, each a map over the table and a tree of merges: counts and exact sums; covariance of the centred vectors
    (divisor n); covariance of what the projection makes of them, whose distance from the identity is measured. What goes
    to the driver is a d x d matrix for each length. Empty table: no whitening.
    """
    spark = distinct.sparkSession
    sums = _merged(distinct.mapInArrow(_sums, "d int, n long, sums array<string>"), lambda r: (r["n"], [int(v) for v in r["sums"]]), lambda a, b: (a[0] + b[0], [x + y for x, y in zip(a[1], b[1])]))
    models = {d: Whitening(n, s, np.empty(0), np.empty((d, 0)), 0.0) for d, (n, s) in sums.items()}
    matrix = "d int, high binary, low binary"
    shared = spark.sparkContext.broadcast(models)
    for d, (high, low) in _merged(distinct.mapInArrow(_outer(shared, False), matrix), _read_matrix, _added).items():
        covariance = (high + low) / models[d].n
        models[d].variances, models[d].components = eigen(covariance, k)
        models[d].trace = float(np.trace(covariance))
    shared = spark.sparkContext.broadcast(models)
    for d, (high, low) in _merged(distinct.mapInArrow(_outer(shared, True), matrix), _read_matrix, _added).items():
        error = np.abs((high + low) / models[d].n - np.eye(len(high)))
        models[d].identity_error = float(error.max()) if error.size else None
    return models


def _projection(models, exact_long: bool, error: float | None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = batch.column("x").value_lengths().to_numpy()
            for d in np.unique(sizes):
                if not d:
                    continue
                model, some = models.value[int(d)], batch.filter(pa.array(sizes == d))
                x = some.column("x").flatten().to_numpy().reshape(-1, d).astype(np.int64)
                z, k = project(x, model), model.components.shape[1]
                away = squares(scaled_centre(x, model.n, model.sums))
                explained = [float(v) / model.trace if model.trace > 0 else None for v in model.variances]
                kind = pa.int64() if exact_long else pa.decimal128(38, 0)
                columns = {
                    "vec_id": some.column("vec_id").take(pa.array(np.repeat(np.arange(len(x)), k))),
                    "component": pa.array(np.tile(np.arange(1, k + 1), len(x)), pa.int32()),
                    "n": pa.array(np.full(len(x) * k, model.n)),
                    "deviation": pa.array(away, kind).take(pa.array(np.repeat(np.arange(len(x)), k))),
                    "whitened": pa.array(z.ravel(), from_pandas=True),
                    "explained": pa.array(explained * len(x), pa.float64()),
                    "identity_error": pa.array([error] * (len(x) * k), pa.float64()),
                }
                yield pa.RecordBatch.from_pydict(columns)

    return run


def whiten(vectors: DataFrame, *, embedding: str = "embedding", scale: int = SCALE, k: int = COMPONENTS) -> DataFrame:
    """vec_id, component, n, deviation, whitened, explained, identity_error: for each row of vectors (vec_id, embedding)
    and each of the first k components.

    Entries become x = floor(scale * entry); rows whose vector is null or holds a null or a not finite entry are dropped,
    entries beyond 64 bits are an error. Fitted to each different x once, so repeated rows and hot vectors weigh
    nothing more. Vectors of another length have their own whitening (lengths are few); vectors shorter than k have as many
    components as entries, empty ones none. deviation is a long, or a decimal where the table's longest is too large for
    that. Where a component has no variance whitened is null, and where no entry varies explained is too; identity_error
    is the largest of all lengths, null if no component varies. Null and repeated ids are ids like any other; extra
    columns are ignored. Empty table: no rows. Different vectors are shuffled once, by themselves; nothing else is.
    """
    spark = vectors.sparkSession
    short_batches(spark)
    rows = vectors.select("vec_id", quantised(F.col(embedding), scale).alias("x")).where("x is not null")
    with Scratch(spark) as scratch:
        models = fit(scratch.written(rows.select("x").distinct(), "distinct"), k)
        far: Column = F.aggregate("x", F.lit(0.0), lambda a, v: F.greatest(a, F.abs(v.cast("double"))))
        largest = {r["d"]: r["top"] for r in rows.groupBy(F.size("x").alias("d")).agg(F.max(far).alias("top")).collect()}  # a row a length
    bound = max((d * (largest[d] * m.n + max(map(abs, m.sums), default=0)) ** 2 for d, m in models.items()), default=0)
    errors = [m.identity_error for m in models.values() if m.identity_error is not None]
    exact_long = bound < _LONG
    kind = vectors.schema["vec_id"].dataType.simpleString()
    result = f"vec_id {kind}, component int, n long, deviation {'long' if exact_long else 'decimal(38,0)'}, whitened double, explained double, identity_error double"
    return rows.mapInArrow(_projection(spark.sparkContext.broadcast(models), exact_long, max(errors, default=None)), result)


def whiten_embeddings(vectors: DataFrame) -> DataFrame:
    """whiten() with its defaults; deviation is a long (an error where it doesn't fit)."""
    return whiten(vectors).withColumn("deviation", F.col("deviation").cast("long"))
