"""Sinks: documents by key, ledgers, reports, texts, mirrors."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Collection, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..functions.text import caption_text
from ..operators import export
from . import keyed_files
from .readers import delete, exists


def put(spark: SparkSession, path: str, text: str) -> None:
    """One small file of a given name, written by the driver; an old one is replaced."""
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    out = at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).create(at, True)
    try:
        out.write(bytearray(text.encode("utf-8")))
    finally:
        out.close()


_OWN: dict[str, str] = {}


def work_folder(spark: SparkSession, what: str) -> str:
    """A new path in the application's own folder below spark.checkpoint.dir, which all machines see; that folder goes when
    the driver ends. Where none is named a session on one machine takes a temporary one, any other is an error.
    """
    context = spark.sparkContext
    if context.applicationId not in _OWN:
        named = spark.conf.get("spark.checkpoint.dir", None)
        if not named:
            if not re.match(r"local(\[|$)", context.master):
                raise ValueError("spark.checkpoint.dir names no folder that the driver and the executors share")
            named = tempfile.mkdtemp(prefix="lectern-")
        own = f"{named.rstrip('/')}/lectern-work-{context.applicationId}"
        at = context._jvm.org.apache.hadoop.fs.Path(own)
        files = at.getFileSystem(context._jsc.hadoopConfiguration())
        files.mkdirs(at)
        files.deleteOnExit(at)
        _OWN[context.applicationId] = own
    return f"{_OWN[context.applicationId]}/{what}-{uuid.uuid4().hex}"


def guarded(rows: DataFrame, key: str = "video_id") -> DataFrame:
    """Fails on a blank key."""
    blank = F.coalesce(F.col(key), F.lit("")) == ""
    return rows.withColumn(key, F.when(blank, F.raise_error(F.lit(f"blank {key}"))).otherwise(F.col(key)))


def write_documents(rows: DataFrame, path: str, key: str = "video_id") -> None:
    """A JSON document `<key>.json` for each row; those that are there already are replaced, others stay. On a store that
    isn't mounted the document stands in a folder of its key, under a name of Spark's.
    """
    if keyed_files.mounted(path):
        return keyed_files.write_documents(rows, path, key)
    guarded(rows, key).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").option("ignoreNullFields", "false").partitionBy(key).format("json").save(path)


def document_path(path: str, key: Column) -> Column:
    """Where write_documents() puts the document of a key."""
    return F.concat(F.lit(f"{path}/"), key, F.lit(".json")) if keyed_files.mounted(path) else F.concat(F.lit(f"{path}/video_id="), key)


def append_ledger(rows: DataFrame, path: str, columns: tuple[str, ...]) -> None:
    """Rows appended to a ledger directory of CSV files with headers."""
    rows.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in columns]).write.mode("append").option("header", True).option("escape", '"').option("emptyValue", "").csv(path)


def report(rows: DataFrame, summary: Sequence[Column], fields: Sequence[str], *, name: str = "files", listed: Column | None = None) -> DataFrame:
    """One row, one column of JSON: the summary's aggregates over rows, and an array of the fields of the rows that are listed,
    in the order of the fields. One pass over rows. The array is one value: list few rows, or write_report_table().
    """
    found = F.struct(*fields)
    array = F.array_sort(F.collect_list(found if listed is None else F.when(listed, found))).alias(name)
    one = rows.agg(*summary, array)
    return one.select(F.to_json(F.struct(*one.columns), {"ignoreNullFields": "false"}).alias("value"))


def write_report(value: DataFrame, path: str) -> None:
    value.coalesce(1).write.mode("overwrite").text(path)


def write_report_table(rows: DataFrame, summary: Sequence[Column], path: str, *, order: str, name: str = "files") -> None:
    """A report of any number of rows: `path/name` holds them as JSON lines in the order of a column, `path/summary` the
    aggregates as one line. The rows are computed once, into a table that goes when both stand.
    """
    spark, once = rows.sparkSession, f"{path}/_rows-{uuid.uuid4().hex}"
    try:
        rows.write.parquet(once)
        rows = spark.read.parquet(once)
        rows.repartitionByRange(order).sortWithinPartitions(order).write.mode("overwrite").option("ignoreNullFields", "false").json(f"{path}/{name}")
        rows.agg(*summary).coalesce(1).write.mode("overwrite").option("ignoreNullFields", "false").json(f"{path}/summary")
    finally:
        delete(spark, once)


def write_texts(rows: DataFrame, path: str, key: str = "video_id", overwrite: bool = False) -> DataFrame:
    """A text `<key>.txt` for each row; keys that have one are skipped unless overwrite. One row: exported, skipped. On a
    store that isn't mounted the text stands in a folder of its key.
    """
    spark, texts, seen = rows.sparkSession, export.plain_texts(rows, key), Observation()
    texts = texts.observe(seen, F.count(F.lit(1)).alias("n"))
    if keyed_files.mounted(path):
        keyed_files.write(texts, path, ".txt", key=key, content="value", existing="replace" if overwrite else "skip")
        fresh = keyed_files.last_commit(path)
    else:
        there = None
        if not overwrite and exists(spark, path):
            there = spark.read.option("basePath", path).text(path).select(F.col(key).cast("string").alias(key)).distinct()
        new, written = texts if there is None else texts.join(there, key, "left_anti"), Observation()
        lines = new.observe(written, F.count(F.lit(1)).alias("n")).select(key, F.expr("left(value, length(value) - 1)").alias("value"))  # the writer ends a line itself
        lines.write.mode("overwrite" if overwrite else "append").partitionBy(key).text(path)
        fresh = written.get["n"]
    return spark.createDataFrame([(fresh, seen.get["n"] - fresh)], "exported long, skipped long")


def write_captions(raw: DataFrame, path: str) -> None:
    """video_id, raw and parsed caption text side by side, as a table."""
    raw.select("video_id", F.col("text").alias("raw"), caption_text(F.col("text")).alias("parsed")).write.mode("overwrite").parquet(path)


def write_caption_files(raw: DataFrame, path: str) -> None:
    """`<video_id>.vtt` as it is and `<video_id>.txt` parsed, of captions (video_id, text), in a mounted folder."""
    keyed_files.write(raw, path, ".vtt", key="video_id", content="text")
    keyed_files.write(raw.select("video_id", caption_text(F.col("text")).alias("text")), path, ".txt", key="video_id", content="text")


def write_blocks(blocks: DataFrame, path: str, key: str = "video_id") -> None:
    """The blocks (key, block) of a combined export in the order of their keys, as text files in that order, a rule after each.
    Any number of blocks: no file is more than a range of them.
    """
    rows = blocks.repartitionByRange(key).sortWithinPartitions(key)
    rows.select(F.concat("block", F.lit(export.RULE[:-1])).alias("value")).write.mode("overwrite").text(path)


def write_titles(titles: DataFrame, path: str, entries: int = 10_000) -> None:
    """A title cache (video_id, title; null titles are known failures) as a folder of JSON objects of about so many entries."""
    parts = max(1, -(-titles.count() // entries))
    entry = F.map_from_entries(F.array_sort(F.collect_list(F.struct("video_id", "title"))))
    objects = titles.groupBy(F.pmod(F.xxhash64("video_id"), F.lit(parts)).alias("_part")).agg(F.to_json(entry, {"ignoreNullFields": "false"}).alias("value"))
    objects.select("value").write.mode("overwrite").text(path)


def mirror(rows: DataFrame, path: str, key: str, delete: bool = False) -> None:
    """Copy: keys of rows replace those of the target, others stay. With delete the target becomes rows."""
    writer = rows.write.mode("overwrite").partitionBy(key)
    (writer if delete else writer.option("partitionOverwriteMode", "dynamic")).parquet(path)


def mirror_targets(sources: Mapping[str, DataFrame], root: str, key: str, *, only: Collection[str] | None = None, delete: bool = False) -> list[str]:
    """mirror() for each named table to root/name, for those in `only` if it is given; the names done. Unknown names are an
    error before anything is written.
    """
    unknown = set(only or ()) - set(sources)
    if unknown:
        raise ValueError(f"unknown targets: {sorted(unknown)}")
    names = [n for n in sources if only is None or n in only]
    for name in names:
        mirror(sources[name], f"{root.rstrip('/')}/{name}", key, delete)
    return names
