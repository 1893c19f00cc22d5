import random

import pytest
from pyspark.sql import functions as F

from lectern.operators import alignment, scan
from lectern.plans import queries


def plain(rows):
    out, state = [], {}
    for k, a, b, v in sorted(rows, key=lambda r: ((r[0] is not None, r[0] or 0), (r[1] is not None, r[1] or 0), r[2])):
        total, top = state.get(k, (None, None))
        if v is not None:
            total, top = (total or 0) + v, v if top is None else max(top, v)
        state[k] = total, top
        out.append((k, a, b, v, total, top))
    return sorted(out, key=str)


@pytest.mark.parametrize("bucket_rows", [1, 7, 100, 10**6])
def test_against_a_plain_loop(spark, bucket_rows):
    rng = random.Random(3)
    rows = [(rng.choice([1, 1, 1, 1, 2, 3, None]), rng.choice([None, *range(5)]), i, rng.choice([None, *range(-5, 9)])) for i in range(900)]
    frame = spark.createDataFrame(rows, "k int, a int, b int, v int")
    found = scan.running(frame, "k", ["a", "b"], {"total": ("sum", F.col("v")), "top": ("max", F.col("v"))}, bucket_rows=bucket_rows)
    assert found.columns == ["k", "a", "b", "v", "total", "top"]
    assert sorted(map(tuple, found.collect()), key=str) == plain(rows)


def test_odd_tables(spark):
    empty = spark.createDataFrame([], "k int, a int")
    assert scan.running(empty, "k", ["a"], {"n": ("sum", F.lit(1))}, bucket_rows=1).count() == 0
    with pytest.raises(ValueError, match="names"):
        scan.running(empty.withColumn("n", F.lit(1)), "k", ["a"], {"n": ("sum", F.lit(1))})


def test_one_recording_is_many_tasks(spark, sf):
    """All events as one recording: cut by order, it is no single task, and the rows are those of a single window."""
    events = spark.read.parquet(f"{sf}/events.parquet").select(F.lit(0).alias("k"), F.unix_micros(F.col("ts").cast("timestamp")).alias("us"), "event_id", "value")
    found = {"total": ("sum", F.floor(F.col("value") * 100))}
    whole = scan.running(events, "k", ["us", "event_id"], found)
    cut = scan.running(events, "k", ["us", "event_id"], found, bucket_rows=50)
    n = events.count()
    assert n > 900 and cut.exceptAll(whole).isEmpty() and whole.exceptAll(cut).isEmpty() and cut.count() == n
    bounds = scan._bounds(events, "k", ["us", "event_id"], 50)
    row = bounds.first()
    begins = len(row._scan_coarse) + sum(map(len, row._scan_fine))
    assert bounds.count() == 1 and begins == min(scan.STEP**2, -(-n // 50)) - 1


@pytest.mark.parametrize("bucket_rows", [3, 40])
def test_words_and_segments_do_not_depend_on_buckets(spark, sf, bucket_rows):
    docs, turns = queries._event_documents(spark, sf)
    whole = alignment.isolate(docs, turns, key="user_id")
    cut = alignment.isolate(docs, turns, key="user_id", bucket_rows=bucket_rows)
    columns = ["user_id", "target_speaker", "target_speaker_segments", "target_speaker_text"]
    wanted = {r.user_id: r for r in whole.select(*columns).collect()}
    assert {r.user_id: r for r in cut.select(*columns).collect()} == wanted and wanted
    words = spark.createDataFrame([(1, float(t), float(t), t) for t in range(60)] * 3 + [(1, 5.0, 5.0, -1)] * 50, "k int, start double, end double, w int")
    spans = spark.createDataFrame([(1, 3.0, 9.0), (1, 5.0, 5.0), (1, 4.0, 4.0), (1, 40.0, 41.0)], "k int, start double, end double")
    kept = alignment.in_turns(words, spans, "k", bucket_rows=bucket_rows)
    assert sorted(r.w for r in kept.collect()) == sorted([*range(3, 10), 40, 41] * 3 + [-1] * 50)
