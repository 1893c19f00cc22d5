import math
import random
import struct

import pytest
from pyspark.sql import functions as F

from lectern.llm import topk


def brute(rows, k, is_query):
    out = []
    for here, (q, v) in enumerate(rows):
        if is_query(q):
            found = sorted((-sum(a * b for a, b in zip(v, w)), j) for there, (j, w) in enumerate(rows) if there != here)
            out += [(q, i + 1, j, -s) for i, (s, j) in enumerate(found[:k])]
    return sorted(out)


def ask(spark, data, k, **options):
    frame = spark.createDataFrame([(j, list(v), 1, 2) for j, v in data], "vec_id long, v array<long>, score int, rank int")
    return sorted(map(tuple, topk.top_k(frame, F.col("vec_id") % 5 == 0, k=k, **options).collect()))


def test_against_brute_force_with_ties_and_waves(spark):
    rng = random.Random(4)
    for dims, top in ((40, 64), (40, 1), (3, 2), (1, 1)):
        rows = [(i, tuple(rng.randrange(-top, top + 1) for _ in range(dims))) for i in range(300)] + [(1000 + i, (1,) * dims) for i in range(30)]
        rows += rows[:5] * 2 + [(rows[5][0], (1,) * dims), (rows[0][0], (2,) * dims)] + [(2000, (top,) * dims)] * 30
        assert ask(spark, rows, 7) == brute(rows, 7, lambda q: q % 5 == 0)
        assert ask(spark, rows, 7, queries=20, rows=50) == brute(rows, 7, lambda q: q % 5 == 0)


def test_each_length_is_searched_on_its_own(spark):
    rng = random.Random(5)
    by = {n: [(i, tuple(rng.randrange(-9, 10) for _ in range(n))) for i in range(j, 200, 3)] for j, n in enumerate((40, 3, 0))}
    by[3] = by[3][:20]
    want = sorted(r for rows in by.values() for r in brute(rows, 7, lambda q: q % 5 == 0))
    assert ask(spark, [r for rows in by.values() for r in rows], 7, queries=5, rows=10) == want


def test_large_values_stay_exact(spark):
    rng = random.Random(6)
    rows = [(i, tuple(rng.randrange(2**26, 2**27) for _ in range(20))) for i in range(60)]
    assert ask(spark, rows, 5) == brute(rows, 5, lambda q: q % 5 == 0)


def test_sums_of_blocks_stay_exact(spark):
    """Each block of dimensions would be exact in double precision, their sum isn't."""
    rng = random.Random(7)
    for low in (2**16, 2**12):
        vectors = [(i, [struct.unpack("f", struct.pack("f", rng.uniform(low, 2 * low)))[0] for _ in range(512)]) for i in range(60)]
        frame = spark.createDataFrame(vectors, "vec_id long, embedding array<float>").select("vec_id", topk.quantised(F.col("embedding")).alias("v"))
        rows = [(i, tuple(math.floor(64 * x) for x in v)) for i, v in vectors]
        assert {r.vec_id: tuple(r.v) for r in frame.collect()} == dict(rows)
        found = sorted(map(tuple, topk.top_k(frame, F.col("vec_id") % 5 == 0, k=10, rows=16).collect()))
        assert found == brute(rows, 10, lambda q: q % 5 == 0)


def test_beyond_64_bits_is_an_error(spark):
    with pytest.raises(Exception, match="64 bits"):
        ask(spark, [(0, (2**40, 1)), (1, (2**40, 2))], 1)
    with pytest.raises(Exception, match="64 bits"):
        spark.createDataFrame([([1e30],)], "e array<double>").select(topk.quantised(F.col("e"))).collect()


def test_other_ids_are_an_error(spark):
    with pytest.raises(ValueError):
        topk.top_k(spark.createDataFrame([("a", [1])], "vec_id string, v array<long>"), F.lit(True))


def test_fewer_than_k(spark):
    rows = [(0, (1, 2)), (5, (3, 4)), (7, (-1, 0))]
    assert ask(spark, rows, 20) == brute(rows, 20, lambda q: q % 5 == 0)


def test_rows_without_a_usable_vector_take_no_part(spark):
    odd = [(0, [1.0, 2.0]), (1, None), (2, [None, 1.0]), (3, [float("nan"), 1.0]), (4, [float("inf"), 0.0]), (None, [1.0, 1.0]), (6, [-0.51, 0.999])]
    frame = spark.createDataFrame(odd, "vec_id long, embedding array<float>").select("vec_id", topk.quantised(F.col("embedding")).alias("v"))
    assert sorted((r.vec_id, r.v) for r in frame.where("v is not null and vec_id is not null").collect()) == [(0, [64, 128]), (6, [-33, 63])]
    assert [tuple(r) for r in topk.top_k(frame, F.col("vec_id") == 0).collect()] == [(0, 1, 6, 64 * -33 + 128 * 63)]


def test_empty_table(spark):
    assert topk.top_k(spark.createDataFrame([], "vec_id long, v array<long>"), F.lit(True)).count() == 0
