"""Scans: listings, documents, captions, ledgers, titles. A missing folder is an empty table."""

from __future__ import annotations

import fnmatch
import os
import re
import zlib
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from ..functions.text import stem
from ..operators import ledger
from ..schemas import DIARIZED, LISTING, METADATA, TRANSCRIPT
from . import keyed_files

_FILES = "path string, modificationTime timestamp, length long"


def exists(spark: SparkSession, path: str) -> bool:
    """Asked of the file system that the path belongs to."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    at = jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(conf).exists(at)


def delete(spark: SparkSession, path: str) -> None:
    """Removes a folder from the file system that it belongs to; nothing if it isn't there."""
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)


def folders(spark: SparkSession, path: str, key: str) -> DataFrame:
    """The distinct values of a key whose folders (key=value) stand under a path; no file is opened."""
    rows = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).select("path")
    value = F.regexp_extract("path", f"/{key}=([^/]*)/[^/]*$", 1)
    return rows.select(F.url_decode(F.replace(value, F.lit("+"), F.lit("%2B"))).alias(key)).where(F.col(key) != "").distinct()


def _listed(spark: SparkSession, folder: str, glob: str) -> DataFrame:
    """The files of a mounted folder, listed by as many tasks as there are cores: each goes over the names and asks for the
    length of its share. Spark's own listing holds all files in the driver, and makes a task of each few.
    """
    n, folder = spark.sparkContext.defaultParallelism, folder.rstrip("/")
    names = ["path", "file_name", "length", "modificationTime"]
    kinds = [pa.string(), pa.string(), pa.int64(), pa.timestamp("us", "UTC")]

    def hidden(name: str) -> bool:
        return name.startswith(".") or (name.startswith("_") and "=" not in name) or name.endswith("._COPYING_")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made = lambda rows: pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=names)
        for part in (i for batch in batches for i in batch.column(0).to_pylist()):
            rows = []
            with os.scandir(folder) as entries:
                for e in entries:
                    if zlib.crc32(os.fsencode(e.name)) % n != part or hidden(e.name) or not fnmatch.fnmatchcase(e.name, glob) or not e.is_file():
                        continue
                    at, name = e.stat(), os.fsencode(e.name).decode("utf-8", "replace")
                    if at.st_size:
                        rows.append((f"file:{folder}/{name}", name, at.st_size, at.st_mtime_ns // 1_000_000 * 1000))
                    if len(rows) == 10_000:
                        yield made(rows)
                        rows = []
            if rows:
                yield made(rows)

    return spark.range(0, n, 1, n).mapInArrow(run, "path string, file_name string, length long, modificationTime timestamp")


def files(spark: SparkSession, folder: str, glob: str | None = None) -> DataFrame:
    """path, file_name, stem, length, modificationTime of the regular files directly in a folder, by path; contents unread. Empty files aren't listed."""
    if not exists(spark, folder):
        return spark.createDataFrame([], "path string, file_name string, stem string, length long, modificationTime timestamp")
    if keyed_files.mounted(folder) and not re.search(r"[\[\]{}\\]", glob or ""):
        rows = _listed(spark, keyed_files.local(folder), glob or "*")
        return rows.select("path", "file_name", stem(F.col("file_name")).alias("stem"), "length", "modificationTime").orderBy("path")
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", "false")
    reader = reader if glob is None else reader.option("pathGlobFilter", glob)
    name = F.element_at(F.split("path", "/"), -1)
    rows = reader.load(folder).select("path", name.alias("file_name"), "length", "modificationTime")
    return rows.select("path", "file_name", stem(F.col("file_name")).alias("stem"), "length", "modificationTime").orderBy("path")


def _file_name() -> Column:
    """The name of the file a row is from, as it is on disk; the metadata column has it escaped."""
    return F.url_decode(F.replace(F.col("_metadata.file_name"), F.lit("+"), F.lit("%2B")))


def matching(spark: SparkSession, pattern: str) -> bool:
    """Whether a path pattern matches anything. Names in a local folder are gone over up to the first match; Hadoop's glob
    would ask for the status of all its files, and hold them.
    """
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(pattern)
    files = at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    folder, _, glob = re.sub("^file:(//)?", "", pattern).rpartition("/")
    if files.getUri().getScheme() == "file" and not re.search(r"[\[\]{}\\]", pattern) and not re.search("[*?]", folder):
        if not os.path.isdir(folder):
            return False
        fits = re.compile(fnmatch.translate(glob)).match
        with os.scandir(folder) as entries:
            return any(fits(e.name) for e in entries)
    found = files.globStatus(at)
    return found is not None and len(found) > 0


def documents(spark: SparkSession, folder: str, schema: str) -> DataFrame:
    """One JSON document per file, with file_name, under an explicit schema.

    Files directly in the folder and, as writers.write_documents() makes them, in folders of a key (key=value); other
    folders, such as a ledger's, aren't read.
    """
    reader = lambda: spark.read.schema(schema).option("multiLine", True).option("pathGlobFilter", "*.json")
    found = []
    if matching(spark, f"{folder}/*.json"):
        found.append(reader().json(f"{folder}/*.json"))
    if matching(spark, f"{folder}/*=*"):
        found.append(reader().option("basePath", folder).json(f"{folder}/*=*"))
    if not found:
        return spark.createDataFrame([], f"{schema}, file_name string")
    names = spark.createDataFrame([], schema).columns
    rows = [r.select(*names, _file_name().alias("file_name")) for r in found]
    return rows[0] if len(rows) == 1 else rows[0].unionByName(rows[1])


def transcripts(spark: SparkSession, folder: str) -> DataFrame:
    return documents(spark, folder, TRANSCRIPT)


def diarized(spark: SparkSession, folder: str) -> DataFrame:
    rows = documents(spark, folder, DIARIZED)
    return rows.withColumn("video_id", F.coalesce("video_id", stem(F.col("file_name"))))


def metadata(spark: SparkSession, folder: str) -> DataFrame:
    return documents(spark, folder, METADATA)


def listing(spark: SparkSession, folder: str) -> DataFrame:
    return documents(spark, folder, LISTING)


def whole_texts(spark: SparkSession, folder: str, glob: str) -> DataFrame:
    """video_id, text: one row per file, its whole content; files directly in the folder by their stems, and files in folders
    of a key (video_id=value) by that. Of a mounted folder many files are one partition.
    """
    reader = lambda: spark.read.option("pathGlobFilter", glob)
    empty = spark.createDataFrame([], "video_id string, text string")
    if keyed_files.mounted(folder):
        empty = empty.union(keyed_files.read(spark, folder, glob.removeprefix("*")))
    elif matching(spark, f"{folder}/{glob}"):
        empty = empty.union(reader().text(f"{folder}/{glob}", wholetext=True).select(stem(_file_name()), "value"))
    if matching(spark, f"{folder}/video_id=*"):
        value = F.regexp_extract(F.col("_metadata.file_path"), "/video_id=([^/]*)/[^/]*$", 1)
        twice = lambda c: F.url_decode(F.replace(c, F.lit("+"), F.lit("%2B")))
        empty = empty.union(reader().text(f"{folder}/video_id=*", wholetext=True).select(twice(twice(value)), "value"))
    return empty


def references(spark: SparkSession, folder: str) -> DataFrame:
    return whole_texts(spark, folder, "*.txt")


def captions(spark: SparkSession, folder: str) -> DataFrame:
    return whole_texts(spark, folder, "*.vtt")


def read_ledger(spark: SparkSession, path: str, columns: Sequence[str] = ledger.DOWNLOAD) -> DataFrame:
    """A CSV ledger with a header, whatever its columns, as the given layout; empty if it isn't there."""
    if not exists(spark, path):
        return spark.createDataFrame([], StructType([StructField(c, StringType()) for c in columns]))
    rows = spark.read.option("header", True).option("inferSchema", False).option("multiLine", True).option("escape", '"').csv(path)
    return ledger.migrate(rows, columns)


def titles(spark: SparkSession, path: str) -> DataFrame:
    """video_id, title from a JSON object, or a folder of files with an object a line; null titles are known failures. Empty if
    it isn't there.
    """
    if not exists(spark, path):
        return spark.createDataFrame([], "video_id string, title string")
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    whole = at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).getFileStatus(at).isFile()
    rows = spark.read.text(path, wholetext=whole)
    return rows.select(F.explode(F.from_json("value", "map<string,string>")).alias("video_id", "title"))


def waveforms(spark: SparkSession, folder: str, decode, rate: int = 16_000) -> DataFrame:
    """video_id, sample_rate, samples (float, 16-bit by 32768) of the audio files of a folder.

    decode(bytes, rate) -> 16-bit samples is the caller's; files are read and decoded on the executors, a file a row.
    """
    import numpy as np
    import pandas as pd

    def run(batches):
        for batch in batches:
            samples = [(np.asarray(decode(bytes(c), rate), np.int16).astype(np.float32) / 32768.0).tolist() for c in batch["content"]]
            yield pd.DataFrame({"video_id": batch["video_id"], "sample_rate": rate, "samples": samples})

    name = F.element_at(F.split("path", "/"), -1)
    rows = spark.read.format("binaryFile").load(folder).select(stem(name).alias("video_id"), "content")
    return rows.mapInPandas(run, "video_id string, sample_rate int, samples array<float>")
