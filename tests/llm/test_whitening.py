import math
from fractions import Fraction

import numpy as np
import pytest

from lectern.llm import whitening as W

SCHEMA = "vec_id long, embedding array<float>"


def plain(rows, scale=256, k=4):
    """vec_id -> (n, deviation, projections, explained) by exact sums and one covariance in double precision."""
    kept = [(i, [math.floor(scale * float(np.float32(c))) for c in v]) for i, v in rows if v is not None and all(c is not None and math.isfinite(c) for c in v)]
    fit = sorted({tuple(x) for _, x in kept})
    n, sums = len(fit), [sum(c) for c in zip(*fit)]
    exact = [[sum(Fraction(x[a] * n - sums[a]) * (x[b] * n - sums[b]) for x in fit) / n**3 for b in range(len(sums))] for a in range(len(sums))]
    values, vectors = np.linalg.eigh(np.array(exact, float))
    values, vectors = values[::-1][:k], vectors[:, ::-1][:, :k]
    out = []
    for i, x in kept:
        away = [n * c - s for c, s in zip(x, sums)]
        out.append((i, n, sum(a * a for a in away), np.array(away, float) / n @ vectors / np.sqrt(values), values / float(sum(exact[a][a] for a in range(len(sums))))))
    return out


def compare(found, wanted, k=4):
    rows = {}
    for r in found:
        rows.setdefault((r.vec_id, r.deviation), {})[r.component] = r
    signs = None
    for i, n, deviation, z, explained in wanted:
        mine = rows[i, deviation]
        assert sorted(mine) == list(range(1, k + 1)) and {r.n for r in mine.values()} == {n}
        ours = np.array([mine[c].whitened for c in range(1, k + 1)])
        if signs is None and (abs(z) > 1e-3).all():
            signs = np.sign(ours * z)
        np.testing.assert_allclose(np.abs(ours), np.abs(z), rtol=1e-9, atol=1e-9)
        if signs is not None:
            np.testing.assert_allclose(ours, signs * z, rtol=1e-9, atol=1e-9)
        np.testing.assert_allclose([mine[c].explained for c in range(1, k + 1)], explained, rtol=1e-9)
        assert all(r.identity_error < 1e-9 for r in mine.values())


@pytest.mark.parametrize("batch", ["7", "1000"])
def test_against_exact_fractions(spark, batch):
    rng = np.random.default_rng(3)
    vectors = (rng.normal(size=(150, 9)) * np.arange(1, 10) + 5).astype(np.float32)
    rows = [(k, v.tolist()) for k, v in enumerate(vectors)]
    rows += [(900 + k, vectors[0].tolist()) for k in range(60)]  # a hot vector weighs once
    rows += [(5000, None), (5001, [None] * 9), (5002, [float("nan")] + [0.0] * 8), (5003, [float("inf")] + [0.0] * 8), (5004, [-0.0] * 9)]
    held = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    try:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", batch)
        found = W.whiten_embeddings(spark.createDataFrame(rows, SCHEMA).repartition(5)).collect()
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", held)
    compare(found, plain(rows))
    assert {r.vec_id for r in found} == {i for i, v in rows if i < 5000 or i == 5004}


def test_whole_table(spark, sf):
    table = spark.read.parquet(f"{sf}/embeddings.parquet")
    found = W.whiten_embeddings(table).collect()
    compare(found, plain([(r.vec_id, r.embedding) for r in table.collect()]))


def test_numbers_beyond_64_bits_stay_exact(spark):
    rng = np.random.default_rng(4)
    rows = [(k, v.tolist()) for k, v in enumerate((rng.normal(size=(40, 5)) * 2.0**45).astype(np.float32))]
    found = W.whiten(spark.createDataFrame(rows, SCHEMA)).collect()
    assert max(int(r.deviation) for r in found) > 2**63
    compare(found, plain(rows))
    with pytest.raises(Exception, match="64 bits"):
        W.whiten(spark.createDataFrame([(1, [1e30])], SCHEMA)).collect()


def test_odd_tables(spark):
    assert W.whiten_embeddings(spark.createDataFrame([], SCHEMA)).count() == 0
    assert W.whiten_embeddings(spark.createDataFrame([(1, None), (2, [])], SCHEMA)).count() == 0
    one = W.whiten_embeddings(spark.createDataFrame([(1, [1.0, 2.0]), (1, [1.0, 2.0])], SCHEMA)).collect()
    assert [(r.vec_id, r.n, r.deviation, r.whitened, r.explained, r.identity_error) for r in one] == [(1, 1, 0, None, None, None)] * 4
    flat = W.whiten_embeddings(spark.createDataFrame([(1, [1.0, 2.0]), (2, [1.0, 5.0]), (None, [1.0, 3.0])], SCHEMA)).collect()
    assert {(r.component, r.whitened is None) for r in flat} == {(1, False), (2, True)} and len(flat) == 6
    assert max(r.identity_error for r in flat) < 1e-9
    mixed = spark.createDataFrame([(k, [float(k)] * 3 if k % 2 else [float(k * k), 1.0 * k], 1) for k in range(20)], "vec_id long, embedding array<double>, n int")
    assert {(r.vec_id % 2, r.n, r.component) for r in W.whiten_embeddings(mixed).collect()} == {(0, 10, 1), (0, 10, 2), (1, 10, 1), (1, 10, 2), (1, 10, 3)}
