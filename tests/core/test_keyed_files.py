import json
import os

import pytest
from pyspark.sql import functions as F

from lectern.sources import keyed_files as K
from lectern.sources import readers


def table(spark, rows):
    return spark.createDataFrame(rows, "id string, body string")


def found(df):
    return {r.key: r.content for r in df.collect()}


def test_a_file_a_key(spark, tmp_path):
    at = str(tmp_path / "texts")
    assert found(K.read(spark, at, ".txt")) == {}
    rows = [("a", "one\r\ntwo\n"), ("b c", "é漢 \0"), ("d.e", None), ("%41", "x" * 300_000)]
    K.write(table(spark, rows).repartition(3), at, ".txt", key="id", content="body")
    assert sorted(n for n in os.listdir(at) if not n.startswith("_")) == ["%41.txt", "a.txt", "b c.txt", "d.e.txt"]
    assert found(K.read(spark, at, ".txt")) == {k: v or "" for k, v in rows}
    assert sorted(os.listdir(f"{at}/_commits"))[0] == "000000000000.json" and not [n for n in os.listdir(at) if n.startswith("_staging")]
    K.write(table(spark, [("a", "new"), ("f", "new")]), at, ".txt", key="id", content="body", existing="skip")
    assert found(K.read(spark, at, ".txt"))["a"] == "one\r\ntwo\n" and found(K.read(spark, at, ".txt"))["f"] == "new"
    K.write(table(spark, [("a", "new")]), at, ".txt", key="id", content="body")
    assert found(K.read(spark, at, ".txt"))["a"] == "new" and len(K.commits(at)) == 3
    (tmp_path / "texts/a.json").write_text("{}")
    K.write(table(spark, [("z", "last")]), at, ".txt", key="id", content="body", overwrite=True)
    assert found(K.read(spark, at, ".txt")) == {"z": "last"} and found(K.read(spark, at, ".json")) == {"a": "{}"} and len(K.commits(at)) == 1
    K.write(table(spark, []), at, ".txt", key="id", content="body")
    assert len(K.commits(at)) == 2


@pytest.mark.parametrize("key", [None, "", " ", "a/b", "..", "_x"])
def test_keys_that_are_no_names(spark, tmp_path, key):
    with pytest.raises(Exception, match="can't be the key"):
        K.write(table(spark, [(key, "x")]), str(tmp_path / "t"), ".txt", key="id", content="body")


def test_a_job_that_fails_leaves_whole_files_and_no_commit(spark, tmp_path):
    at = str(tmp_path / "t")
    K.write(table(spark, [("old", "1")]), at, ".txt", key="id", content="body")
    rows = spark.range(40).repartitionByRange(4, "id").select(F.col("id").cast("string").alias("id"), F.when(F.col("id") == 25, F.raise_error(F.lit("broken"))).otherwise(F.lit("y" * 1000)).alias("body"))
    with pytest.raises(Exception, match="broken"):
        K.write(rows, at, ".txt", key="id", content="body")
    assert len(K.commits(at)) == 1 and not [n for n in os.listdir(at) if n.startswith("_staging")]
    assert {v for k, v in found(K.read(spark, at, ".txt")).items() if k != "old"} <= {"y" * 1000}
    with pytest.raises(Exception, match="mounted"):
        K.read(spark, "hdfs://there/x", ".txt").collect()


def test_two_writers_lose_no_commit(tmp_path):
    at = str(tmp_path)
    assert [K.commit(at, name, 1) for name in "ab"] == [0, 1]
    os.link(f"{at}/_commits/000000000001.json", f"{at}/_commits/000000000002.json")  # another one came first
    assert K.commit(at, "c", 1) == 3 and [m for _, m in K.commits(at)] == ["a", "b", "b", "c"]


def test_stream_of_commits(spark, tmp_path):
    at, seen = str(tmp_path / "in"), str(tmp_path / "seen")

    def follow():
        stream = K.read_stream(spark, at, ".txt").writeStream.format("parquet").option("checkpointLocation", str(tmp_path / "c"))
        stream.trigger(availableNow=True).start(seen).awaitTermination()
        return sorted((r.key, r.content) for r in spark.read.parquet(seen).collect())

    K.write(table(spark, [("a", "1"), ("b", "1")]), at, ".txt", key="id", content="body")
    assert follow() == [("a", "1"), ("b", "1")]
    assert follow() == [("a", "1"), ("b", "1")]
    K.write(table(spark, [("c", "2")]), at, ".txt", key="id", content="body")
    K.write(table(spark, [("a", "3")]), at, ".txt", key="id", content="body")
    assert follow() == [("a", "1"), ("a", "3"), ("b", "1"), ("c", "2")]


def test_documents_are_read_back(spark, tmp_path):
    at = str(tmp_path / "docs")
    rows = spark.createDataFrame([("v 1", 2.5, None), ("v2", None, "t")], "video_id string, duration double, text string")
    K.write_documents(rows, at)
    assert json.load(open(f"{at}/v 1.json")) == {"video_id": "v 1", "duration": 2.5, "text": None}
    assert {(r.video_id, r.duration, r.text) for r in readers.transcripts(spark, at).collect()} == {("v 1", 2.5, None), ("v2", None, "t")}


def test_partitions_are_bounded(monkeypatch):
    monkeypatch.setattr(K, "FILES", 3)
    monkeypatch.setattr(K, "BYTES", 10)
    parts = K._split([("a", 4), ("b", 4), ("c", 4), ("d", 40), ("e", 0), ("f", 0), ("g", 0), ("h", 0)])
    assert [p.names for p in parts] == [["a", "b"], ["c"], ["d"], ["e", "f", "g"], ["h"]]
