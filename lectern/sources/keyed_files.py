"""A data source for folders of one file a key, `<key><suffix>`: whole files or none, numbered commits, and a stream of what commits added."""

from __future__ import annotations

import json
import os
import shutil
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from urllib.parse import unquote, urlparse

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, DataSourceWriter, InputPartition, WriterCommitMessage

NAME = "keyed_files"
#: Files and bytes of a stream's partition, at most; a larger file is one by itself.
FILES, BYTES = 10_000, 64_000_000
_COMMITS = "_commits"


def local(path: str) -> str:
    """The folder of a path that the driver and all executors have mounted: plain, or file://."""
    parsed = urlparse(path)
    if parsed.scheme not in ("", "file"):
        raise ValueError(f"{NAME} needs a folder that all machines have mounted, not {path}")
    return unquote(parsed.path) if parsed.scheme else path


def mounted(path: str) -> bool:
    return urlparse(path).scheme in ("", "file")


def file_name(key: str | None, suffix: str) -> str:
    """The name of a key's file. Blank keys and such as can't be a name in a folder are an error."""
    if key is None or not key.strip() or "/" in key or "\0" in key or key in (".", "..") or key.startswith("_"):
        raise ValueError(f"{key!r} can't be the key of a file")
    return key + suffix


def commits(folder: str) -> list[tuple[int, str]]:
    """(number, manifest's folder) of each commit, in order."""
    try:
        names = os.listdir(f"{folder}/{_COMMITS}")
    except FileNotFoundError:
        return []
    found = []
    for name in sorted(n for n in names if n.endswith(".json")):
        with open(f"{folder}/{_COMMITS}/{name}", encoding="utf-8") as f:
            found.append((int(name[:-5]), json.load(f)["manifest"]))
    return found


def last_commit(path: str) -> int:
    """How many files the last commit of a folder wrote."""
    folder = local(path)
    number = max(n for n, _ in commits(folder))
    with open(f"{folder}/{_COMMITS}/{number:012d}.json", encoding="utf-8") as f:
        return json.load(f)["files"]


def commit(folder: str, manifest: str, files: int) -> int:
    """Puts the next number's commit, if nobody else has meanwhile; else the one after. Returns the number."""
    os.makedirs(f"{folder}/{_COMMITS}", exist_ok=True)
    staged = f"{folder}/{_COMMITS}/.{uuid.uuid4().hex}"
    with open(staged, "w", encoding="utf-8") as f:
        json.dump({"manifest": manifest, "files": files}, f)
    number = max((n for n, _ in commits(folder)), default=-1) + 1
    while True:
        try:
            os.link(staged, f"{folder}/{_COMMITS}/{number:012d}.json")  # fails if it is there, and is never half there
            break
        except FileExistsError:
            number += 1
    os.unlink(staged)
    return number


@dataclass
class _Files(InputPartition):
    names: list[str]


@dataclass
class _Share(InputPartition):
    part: int
    of: int


@dataclass
class _Written(WriterCommitMessage):
    files: int


def _split(sized: list[tuple[str, int]]) -> list[_Files]:
    parts: list[list[str]] = []
    held = BYTES
    for name, size in sized:
        if held + size > BYTES or len(parts[-1]) >= FILES:
            parts.append([])
            held = 0
        parts[-1].append(name)
        held += size
    return [_Files(p) for p in parts or [[]]]  # no partition at all would be one of None


class _Reading:
    def __init__(self, options: dict):
        self.folder, self.suffix = local(options["path"]), options.get("suffix", "")

    def names(self, partition: _Files) -> list[str]:
        return partition.names

    def read(self, partition: _Files | _Share) -> Iterator[tuple]:
        for name in self.names(partition):
            try:
                with open(f"{self.folder}/{name}", encoding="utf-8", errors="replace", newline="") as f:
                    yield name[: len(name) - len(self.suffix)], f.read()
            except FileNotFoundError:
                continue  # taken away since it was listed


class _Reader(_Reading, DataSourceReader):
    """Nothing is listed in the driver: each task goes over the folder's names and reads its share of them, in their order."""

    def __init__(self, options: dict):
        super().__init__(options)
        self.tasks = int(options.get("tasks", 1))

    def partitions(self) -> list[_Share]:
        return [_Share(i, self.tasks) for i in range(self.tasks)]

    def names(self, partition: _Share) -> list[str]:
        if not os.path.isdir(self.folder):
            return []
        with os.scandir(self.folder) as entries:
            mine = (e for e in entries if e.name.endswith(self.suffix) and zlib.crc32(os.fsencode(e.name)) % partition.of == partition.part)
            return sorted(e.name for e in mine if not e.name.startswith(("_", ".")) and e.is_file())


class _StreamReader(_Reading, DataSourceStreamReader):
    """Offsets are numbers of commits. A key that several commits of a batch wrote is read once, as it is now."""

    def initialOffset(self) -> dict:
        return {"commit": -1}

    def latestOffset(self) -> dict:
        return {"commit": max((n for n, _ in commits(self.folder)), default=-1)}

    def partitions(self, start: dict, end: dict) -> list[_Files]:
        names: set[str] = set()
        for number, manifest in commits(self.folder):
            if start["commit"] < number <= end["commit"]:
                for part in os.listdir(f"{self.folder}/{_COMMITS}/{manifest}"):
                    with open(f"{self.folder}/{_COMMITS}/{manifest}/{part}", encoding="utf-8") as f:
                        names |= {n for n in json.load(f) if n.endswith(self.suffix)}
        return _split([(n, os.path.getsize(f"{self.folder}/{n}")) for n in sorted(names) if os.path.exists(f"{self.folder}/{n}")])


class _Writer(DataSourceWriter):
    """Each file is written beside its folder's files, closed, and moved to its name, so it is there whole or not at all. A
    task that runs again writes the same files again. What a task wrote is listed in the job's manifest; the commit names
    the manifest, and only then does a stream see its files. A job that fails leaves whole files, but no commit.
    """

    def __init__(self, options: dict, overwrite: bool):
        self.folder, self.suffix = local(options["path"]), options.get("suffix", "")
        self.existing, self.overwrite, self.job = options.get("existing", "replace"), overwrite, uuid.uuid4().hex
        if self.existing not in ("replace", "skip"):
            raise ValueError(f"existing is replace or skip, not {self.existing}")
        self.staging, self.manifest = f"{self.folder}/_staging-{self.job}", f"{self.folder}/{_COMMITS}/{self.job}"
        if overwrite and os.path.isdir(self.folder):
            for name in os.listdir(self.folder):
                if name == _COMMITS or (name.endswith(self.suffix) and not name.startswith(("_", "."))):
                    at = f"{self.folder}/{name}"
                    shutil.rmtree(at) if os.path.isdir(at) else os.unlink(at)

    def write(self, rows: Iterator) -> _Written:
        task = uuid.uuid4().hex
        os.makedirs(f"{self.staging}/{task}", exist_ok=True)
        os.makedirs(self.manifest, exist_ok=True)
        names: list[str] = []
        for row in rows:
            name = file_name(row[0], self.suffix)
            if self.existing == "skip" and os.path.exists(f"{self.folder}/{name}"):
                continue
            staged = f"{self.staging}/{task}/{len(names)}"
            with open(staged, "w", encoding="utf-8", newline="") as f:
                f.write(row[1] or "")
            os.replace(staged, f"{self.folder}/{name}")
            names.append(name)
        with open(f"{self.staging}/{task}/names", "w", encoding="utf-8") as f:
            json.dump(names, f)
        os.replace(f"{self.staging}/{task}/names", f"{self.manifest}/{task}")
        return _Written(len(names))

    def commit(self, messages: list[_Written | None]) -> None:
        os.makedirs(self.manifest, exist_ok=True)
        commit(self.folder, self.job, sum(m.files for m in messages if m is not None))
        shutil.rmtree(self.staging, ignore_errors=True)

    def abort(self, messages: list[_Written | None]) -> None:
        shutil.rmtree(self.staging, ignore_errors=True)
        shutil.rmtree(self.manifest, ignore_errors=True)


class KeyedFiles(DataSource):
    """Options: path, suffix (".json", ".txt", ".vtt"), for reading tasks, and for writing existing: replace or skip."""

    @classmethod
    def name(cls) -> str:
        return NAME

    def schema(self) -> str:
        return "key string, content string"

    def reader(self, schema) -> DataSourceReader:
        return _Reader(self.options)

    def streamReader(self, schema) -> DataSourceStreamReader:
        return _StreamReader(self.options)

    def writer(self, schema, overwrite: bool) -> DataSourceWriter:
        return _Writer(self.options, overwrite)


def register(spark: SparkSession) -> None:
    spark.dataSource.register(KeyedFiles)


def read(spark: SparkSession, path: str, suffix: str) -> DataFrame:
    """key, content of the files `<key><suffix>` directly in a folder, by as many tasks as there are cores; none if it isn't
    there. UTF-8 (other bytes are replaced), read whole.
    """
    register(spark)
    return spark.read.format(NAME).option("path", path).option("suffix", suffix).option("tasks", spark.sparkContext.defaultParallelism).load()


def read_stream(spark: SparkSession, path: str, suffix: str) -> DataFrame:
    """The same as a stream of what each commit of write() added or replaced; files that came otherwise aren't in it."""
    register(spark)
    return spark.readStream.format(NAME).option("path", path).option("suffix", suffix).load()


def write(rows: DataFrame, path: str, suffix: str, *, key: str, content: str, existing: str = "replace", overwrite: bool = False) -> None:
    """A file `<key><suffix>` in the folder for each row, UTF-8; a null content is an empty file. Of rows that share a key one
    stays, so keys should be unique; keys that can't be file names are an error. With existing="skip" files that are there
    stay; with overwrite all of that suffix go first. An empty table is an empty commit.
    """
    register(rows.sparkSession)
    out = rows.select(F.col(key).cast("string").alias("key"), F.col(content).alias("content"))
    out.write.format(NAME).option("path", path).option("suffix", suffix).option("existing", existing).mode("overwrite" if overwrite else "append").save()


def write_documents(rows: DataFrame, path: str, key: str = "video_id") -> None:
    """A JSON document `<key>.json` for each row, with all columns, nulls included; those that are there are replaced."""
    document = F.to_json(F.struct(*[F.col(f"`{c}`") for c in rows.columns]), {"ignoreNullFields": "false"})
    write(rows.select(F.col(key).alias("key"), document.alias("content")), path, ".json", key="key", content="content")
