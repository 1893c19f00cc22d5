import numpy as np
import pytest
from pyspark.sql import functions as F

from lectern.operators import vectors

SCHEMA = "vec_id long, embedding array<float>, key int, score int"


def plain(rows, asked, k):
    out = []
    for q, a in asked:
        found = []
        for i, v in rows:
            if v is not None and len(v) == len(a) and i is not None and None not in v and np.isfinite(v).all() and any(v):
                x, y = np.float32(v).astype(float), np.float32(a).astype(float)
                found.append((-round(float(x @ y) / float(np.sqrt(x @ x) * np.sqrt(y @ y)), 9), i))
        out += [(q, r + 1, i, -s) for r, (s, i) in enumerate(sorted(found)[:k])]
    return sorted(out)


def made(spark, rows):
    return spark.createDataFrame([(i, v, 1, 2) for i, v in rows], SCHEMA)


def read(df):
    return sorted((r.query_id, r["rank"], r.vec_id, round(r.score, 9)) for r in df.collect())


@pytest.mark.parametrize("wave, batch", [(4096, "10000"), (5, "7")])
def test_nearest_against_a_plain_loop(spark, wave, batch):
    rng = np.random.default_rng(1)
    rows = [(i, rng.normal(size=6).tolist()) for i in range(150)] + [(500 + i, [1.0, 2.0, 3.0, 4.0, 5.0, 6.0]) for i in range(40)]
    rows += [(900, None), (901, [0.0] * 6), (902, [None] + [1.0] * 5), (903, [float("nan")] * 6), (None, [1.0] * 6), (904, [1.0, 2.0]), (905, [2.0, 1.0]), (906, [])]
    asked = [(i, v) for i, v in rows if i is not None and i % 10 == 0 and v is not None and i not in (900,)] + [(2000, [3.0, 1.0])]
    queries = spark.createDataFrame(asked, "query_id long, embedding array<float>")
    held = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    try:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", batch)
        found = vectors.nearest(made(spark, rows).repartition(5), queries, k=7, wave=wave)
        assert read(found) == plain(rows, asked, 7)
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", held)
    assert vectors.nearest(made(spark, []), queries).count() == 0
    assert vectors.nearest(made(spark, rows), queries.limit(0)).count() == 0


def test_index_holds_every_row_and_finds_the_nearest(spark, sf, tmp_path):
    table = spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet")
    odd = spark.createDataFrame([(10**6, None), (10**6 + 1, [0.0] * 64), (10**6 + 2, [1.0])], "vec_id long, embedding array<float>")
    rows = table.select("vec_id", "embedding").union(odd)
    model = vectors.fit(rows)
    assert model.probes <= len(model.cells) <= 22 and model.dims == 64
    path = str(tmp_path / "index")
    vectors.write_index(rows, model, path)
    index = spark.read.parquet(path)
    assert index.count() == rows.count() and {r.key for r in index.where("cell = -1").collect()} == {10**6, 10**6 + 1, 10**6 + 2}
    queries = table.where("vec_id % 50 = 0").select(F.col("vec_id").alias("query_id"), "embedding")
    exact = read(vectors.nearest(rows, queries))
    for wave in (4096, 3):
        found = read(vectors.search(spark, path, model, queries, wave=wave).withColumnRenamed("key", "vec_id"))
        assert len(found) == len(exact)
        assert len({f[::2][:1] + (f[2],) for f in found} & {e[::2][:1] + (e[2],) for e in exact}) >= 0.9 * len(exact)
        scores = {(q, i): s for q, _, i, s in exact}
        assert all(abs(scores[q, i] - s) < 1e-9 for q, _, i, s in found if (q, i) in scores)
    every = vectors.Quantiser(model.cells, model.codes, len(model.cells))  # all cells, all candidates: exact
    assert read(vectors.search(spark, path, every, queries, rerank=60).withColumnRenamed("key", "vec_id")) == exact


def test_cells_that_are_not_probed_are_not_read(spark, tmp_path):
    rng = np.random.default_rng(2)
    centres = rng.normal(size=(8, 16)) * 5
    rows = [(i, (centres[i % 8] + 0.1 * rng.normal(size=16)).tolist()) for i in range(400)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    model = vectors.fit(frame, max_cells=8)
    path = str(tmp_path / "index")
    vectors.write_index(frame, model, path)
    assert model.probes < len(model.cells)
    plan = spark.read.parquet(path).where(F.col("cell").isin([1])).select("key", "codes")._jdf.queryExecution().toString()
    assert "PartitionFilters: [isnotnull(cell" in plan and "codes:binary>" in plan
    queries = frame.where("vec_id < 8").withColumnRenamed("vec_id", "query_id")
    found = read(vectors.search(spark, path, model, queries, k=5).withColumnRenamed("key", "vec_id"))
    assert all(i % 8 == q % 8 for q, _, i, _ in found) and len(found) == 40


def test_fit_of_odd_tables(spark):
    assert vectors.fit(made(spark, [])) is None
    assert vectors.fit(made(spark, [(1, None), (2, [0.0, 0.0])])) is None
    one = vectors.fit(made(spark, [(1, [1.0, 2.0, 3.0])] * 50))
    assert len(one.cells) == 1 and one.probes == 1
