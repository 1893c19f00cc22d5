import csv
import json
from concurrent.futures import ThreadPoolExecutor

import pytest
from pyspark.sql import functions as F

import __spark_entry__
from lectern.operators import ledger
from lectern.schemas import TRANSCRIPT
from lectern.sources import commit_log, readers, writers
from lectern.streaming import incremental


def test_listing_and_documents(spark, tmp_path):
    (tmp_path / "b.json").write_text(json.dumps({"video_id": "b", "speakers": {"S0": {"total_seconds": 1.5, "turn_count": 2}}, "turns": None}))
    (tmp_path / "a.json").write_text(json.dumps({"duration": 3, "target_speaker": None}))
    (tmp_path / "note.txt").write_text("hi\nthere")
    (tmp_path / "sub").mkdir()
    assert [r.stem for r in readers.files(spark, str(tmp_path)).collect()] == ["a", "b", "note"]
    assert readers.files(spark, str(tmp_path / "none")).count() == 0
    rows = {r.video_id: r for r in readers.diarized(spark, str(tmp_path)).collect()}
    assert rows["b"].speakers["S0"].turn_count == 2 and rows["a"].duration == 3.0
    assert readers.documents(spark, str(tmp_path / "none"), TRANSCRIPT).count() == 0
    assert [tuple(r) for r in readers.references(spark, str(tmp_path)).collect()] == [("note", "hi\nthere")]


def test_ledger_files(spark, tmp_path):
    odd = ['quote " comma , line\nend \\ é', "", "plain"]
    with (tmp_path / "old.csv").open("w", newline="", encoding="utf-8") as f:
        w = csv.DictWriter(f, ["video_id", "status", "error"])
        w.writeheader()
        w.writerows({"video_id": str(i), "status": "success", "error": e} for i, e in enumerate(odd))
    rows = readers.read_ledger(spark, str(tmp_path / "old.csv"))
    assert sorted((r.video_id, r.error, r["mode"]) for r in rows.collect()) == [(str(i), e, "video") for i, e in enumerate(odd)]
    path = str(tmp_path / "ledger")
    writers.append_ledger(rows, path, ledger.DOWNLOAD)
    writers.append_ledger(rows, path, ledger.DOWNLOAD)
    again = readers.read_ledger(spark, path)
    assert again.count() == 6 and {r.error for r in again.collect()} == set(odd)
    assert readers.read_ledger(spark, str(tmp_path / "none")).count() == 0


def test_titles(spark, tmp_path):
    (tmp_path / "cache.json").write_text(json.dumps({"a": "T", "b": None}))
    assert sorted(map(tuple, readers.titles(spark, str(tmp_path / "cache.json")).collect())) == [("a", "T"), ("b", None)]
    assert readers.titles(spark, str(tmp_path / "none.json")).count() == 0


def test_documents_are_replaced_by_key(spark, tmp_path):
    path = str(tmp_path / "docs")
    writers.write_documents(spark.createDataFrame([("a", 1), ("b", 2)], "video_id string, n int"), path)
    writers.write_documents(spark.createDataFrame([("b", 3)], "video_id string, n int"), path)
    assert sorted((r.video_id, r.n) for r in spark.read.schema("video_id string, n int").json(path).collect()) == [("a", 1), ("b", 3)]
    with pytest.raises(Exception, match="blank video_id"):
        writers.guarded(spark.createDataFrame([("",)], "video_id string")).collect()


def test_texts_and_report(spark, tmp_path):
    path = str(tmp_path / "texts")
    rows = spark.createDataFrame([("a", " x "), ("b", "y")], "video_id string, text string")
    assert tuple(writers.write_texts(rows, path).first()) == (2, 0)
    assert {p.name: p.read_text() for p in (tmp_path / "texts").glob("*.txt")} == {"a.txt": "x\n", "b.txt": "y\n"}
    more = rows.union(spark.createDataFrame([("c", "z")], rows.schema))
    assert tuple(writers.write_texts(more, path).first()) == (1, 2)
    value = writers.report(rows, [F.count("*").alias("num_files")], ["video_id", "text"]).first().value
    assert json.loads(value) == {"num_files": 2, "files": [{"video_id": "a", "text": " x "}, {"video_id": "b", "text": "y"}]}
    writers.write_report(spark.createDataFrame([(value,)], "value string"), str(tmp_path / "report"))
    writers.write_captions(rows, str(tmp_path / "captions"))
    assert {r.parsed for r in spark.read.parquet(str(tmp_path / "captions")).collect()} == {"x", "y"}
    few = writers.report(rows, [F.count("*").alias("n")], ["video_id"], listed=F.col("text") == "y").first().value
    assert json.loads(few) == {"n": 2, "files": [{"video_id": "b"}]}
    with pytest.raises(ValueError, match="unknown targets"):
        writers.mirror_targets({"a": rows}, str(tmp_path / "all"), "video_id", only=["z"])
    assert writers.mirror_targets({"a": rows, "b": rows}, str(tmp_path / "all"), "video_id", only=["b"]) == ["b"]
    assert spark.read.parquet(str(tmp_path / "all/b")).count() == 2 and not (tmp_path / "all/a").exists()
    for delete in (False, True):
        writers.mirror(rows, str(tmp_path / "mirror"), "video_id", delete)
        writers.mirror(rows.where("video_id = 'a'"), str(tmp_path / "mirror"), "video_id", delete)
        assert spark.read.parquet(str(tmp_path / "mirror")).count() == (1 if delete else 2)


def test_waveforms(spark, tmp_path):
    (tmp_path / "x.wav").write_bytes(bytes([0, 64, 0, 192]))
    import numpy as np

    rows = readers.waveforms(spark, str(tmp_path), lambda data, rate: np.frombuffer(data, "<i2")).collect()
    assert [(r.video_id, r.sample_rate, r.samples) for r in rows] == [("x", 16000, [0.5, -0.5])]


def test_stream_skips_what_succeeded(spark, tmp_path):
    schema = spark.createDataFrame([], "video_id string").schema
    folder, book, checkpoint = (str(tmp_path / n) for n in ("in", "ledger", "checkpoint"))
    seen = []

    def process(rows):
        seen.append(sorted(r.video_id for r in rows.collect()))
        return rows.select("video_id", F.when(F.col("video_id") == "b", "failed").otherwise("success").alias("status"), F.lit("").alias("error"))

    spark.createDataFrame([("a",), ("b",)], schema).coalesce(1).write.parquet(folder)
    incremental.follow(spark, folder, schema, book, checkpoint, process).awaitTermination()
    incremental.follow(spark, folder, schema, book, checkpoint, process).awaitTermination()
    spark.createDataFrame([("a",), ("c",)], schema).coalesce(1).write.mode("append").parquet(folder)
    incremental.follow(spark, folder, schema, book, checkpoint, process).awaitTermination()
    assert seen == [["a", "b"], ["c"]]
    incremental.run_pending(spark.read.schema(schema).parquet(folder), book, process)
    assert seen[-1] == ["b"]


def test_a_replayed_batch_is_recorded_once(spark, tmp_path):
    book = str(tmp_path / "book")
    rows = spark.createDataFrame([("a",), ("b",)], "video_id string")
    runs = []

    def process(todo):
        runs.append(todo.count())
        return todo.selectExpr("video_id", "case when video_id = 'b' then 'failed' else 'success' end as status", "'x' as error")

    for _ in range(2):
        incremental.run_pending(rows, book, process, ("query", 0))
    assert runs == [2] and incremental.read_outcomes(spark, book).count() == 2
    assert not incremental.record(process(rows), book, ("query", 0))  # it came in while this one was processed
    incremental.run_pending(rows, book, process, ("query", 1))
    incremental.run_pending(rows, book, process, ("other", 0))
    assert runs == [2, 2, 1, 1] and incremental.read_outcomes(spark, book).count() == 4
    commit_log.compact(spark, book, incremental.LEDGER)
    commit_log.vacuum(spark, book)
    assert len(list((tmp_path / "book/data").iterdir())) == 1
    assert incremental.read_outcomes(spark, book).count() == 4 and commit_log.holds(spark, book, "query", 1) and not commit_log.holds(spark, book, "query", 2)
    assert not incremental.record(process(rows), book, ("query", 1))


def test_two_writers_lose_nothing(spark, tmp_path):
    book = f"file://{tmp_path}/book"
    row = lambda i: spark.createDataFrame([(str(i), "success", "", "")], incremental.LEDGER)
    with ThreadPoolExecutor(6) as pool:
        assert all(pool.map(lambda i: commit_log.append(row(i), book), range(12)))
        assert sum(pool.map(lambda i: commit_log.append(row(99), book, stream="s", batch=0), range(4))) == 1
    assert sorted(r.video_id for r in incremental.read_outcomes(spark, book).collect()) == sorted([*map(str, range(12)), "99"])
    assert sorted(commit_log._entries(spark, book)) == list(range(13))


def test_due_times(spark):
    rows = [("a", "failed", "", "2024-01-01T00:00:00"), ("a", "failed", "", "2024-01-01T00:01:00"), ("b", "failed", "", "2024-01-01T00:00:00"), ("b", "success", "", "2024-01-01T00:00:01"), ("c", "failed", "", "2024-01-01T00:00:30")]
    found = incremental.schedule(spark.createDataFrame(rows, incremental.LEDGER), wait=5, factor=3)
    assert sorted((r.video_id, r.attempts, str(r.due)) for r in found.collect()) == [("a", 2, "2024-01-01 00:01:15"), ("c", 1, "2024-01-01 00:00:35")]


def test_registry(spark):
    names = set(__spark_entry__.queries())
    assert names >= set(__spark_entry__.oracle_sql()) and len(names) >= 40
    assert __spark_entry__.entry(spark).count() == 200
