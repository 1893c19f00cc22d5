"""What the training-data operators share: written tables in the shared folder, words, word hashes."""

from __future__ import annotations

import re
import tempfile
import uuid

import numpy as np
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Words of the contracts: runs of anything but the six ASCII white-space characters. bytes.split() splits at the same six.
WORD = r"[^\x20\x09-\x0D]+"


_LOCAL: dict[str, str] = {}


def shared_folder(spark: SparkSession) -> str:
    """The folder that the cluster names in spark.checkpoint.dir. Where that is unset, as in tests, a temporary folder if
    the session runs on one machine alone, else an error: executors wouldn't see the driver's folders.
    """
    context = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None)
    if not named:
        held = context._jsc.sc().getCheckpointDir()
        if held.isDefined():
            named = held.get()
        elif re.match(r"local(\[|$)", context.master):
            named = _LOCAL.setdefault(context.applicationId, "") or tempfile.mkdtemp(prefix="lectern-")
            _LOCAL[context.applicationId] = named
        else:
            raise ValueError("spark.checkpoint.dir names no folder that the driver and the executors share")
    return named.rstrip("/")


_MARKED: set[str] = set()


def shared_path(spark: SparkSession, what: str) -> str:
    """A new path in the application's own folder below the shared one, which goes when the driver ends."""
    own = f"{shared_folder(spark)}/lectern-{spark.sparkContext.applicationId}"
    if own not in _MARKED:
        at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(own)
        files = at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        files.mkdirs(at)
        files.deleteOnExit(at)
        _MARKED.add(own)
    return f"{own}/{what}-{uuid.uuid4().hex}"


def delete(spark: SparkSession, path: str) -> None:
    """Removes a folder from the file system that it belongs to; nothing if it isn't there."""
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)


#: Rows of texts that are handed to a Python worker at a time; ten thousand long ones would fill its memory.
BATCH_ROWS = 1000


def short_batches(spark: SparkSession) -> None:
    """Lowers the session's Arrow batches to BATCH_ROWS rows, unless they are as short already."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(name)) <= BATCH_ROWS:
        spark.conf.set(name, str(BATCH_ROWS))


#: Folders of tables that lazy results read, in the order in which they were written.
_KEPT: list[str] = []


def kept() -> int:
    """How many tables written() has made so far; release() takes it to know which came later."""
    return len(_KEPT)


def keep(path: str) -> str:
    """Notes a folder that a lazy result reads, for release()."""
    _KEPT.append(path)
    return path


def release(spark: SparkSession, since: int = 0) -> None:
    """Deletes what written() has made since then. To be called once the results that read it are written themselves."""
    while len(_KEPT) > since:
        delete(spark, _KEPT.pop())


def _write(df: DataFrame, path: str, **options: str) -> DataFrame:
    df.write.options(**{"compression": "zstd", **options}).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def written(df: DataFrame, what: str, **options: str) -> DataFrame:
    """df as a Parquet table in the shared folder: its lineage ends there, and lost executors don't lose it."""
    return _write(df, keep(shared_path(df.sparkSession, what)), **options)


class Scratch:
    """Written tables of one piece of work, deleted when it ends: `with Scratch(spark) as scratch: scratch.written(...)`."""

    def __init__(self, spark: SparkSession):
        self.spark, self.paths = spark, []

    def path(self, what: str) -> str:
        self.paths.append(shared_path(self.spark, what))
        return self.paths[-1]

    def written(self, df: DataFrame, what: str, **options: str) -> DataFrame:
        return _write(df, self.path(what), **options)

    def drop(self, first: int, last: int) -> None:
        """Deletes the tables written from the first up to the last, which is left."""
        for path in self.paths[first:last]:
            delete(self.spark, path)
        del self.paths[first:last]

    def __enter__(self) -> Scratch:
        return self

    def __exit__(self, *_) -> None:
        self.drop(0, len(self.paths))


#: Keys that are dealt out by salts: the most frequent ones, at most so many, of those with more rows than HOT_ROWS. Any
#: other key has less than a thousandth of all rows.
HOT_KEYS, HOT_ROWS, MAX_SALTS = 1000, 500, 1024


def hot_keys(counts: DataFrame, key: str, n: str = "n") -> DataFrame | None:
    """(key, _salts) of the frequent keys of counts (key, n), a row a key, at most HOT_KEYS rows; None if there are none."""
    top = counts.where((F.col(n) > HOT_ROWS) & F.col(key).isNotNull()).select(key, n).orderBy(F.desc(n)).limit(HOT_KEYS).collect()
    if not top:
        return None
    kind = counts.schema[key].dataType.simpleString()
    return counts.sparkSession.createDataFrame([(k, min(MAX_SALTS, -(-c // HOT_ROWS))) for k, c in top], f"`{key}` {kind}, _salts int")


def meet(many: DataFrame, one: DataFrame, key: str, hot: DataFrame | None, how: str = "inner") -> DataFrame:
    """many joined with `one`, which has one row per key. The rows of a hot key are dealt out by a hash of their other
    columns, and its one row is repeated for each part, so that a key with a third of all rows isn't one task.
    """
    if hot is None:
        return many.join(one, key, how)
    hot = F.broadcast(hot)  # at most HOT_KEYS rows
    others = [F.col(f"`{c}`") for c in many.columns if c != key]
    rest = F.xxhash64(*others) if others else F.lit(0)
    left = many.join(hot, key, "left").withColumn("_salt", F.coalesce(F.pmod(rest, F.col("_salts")).cast("int"), F.lit(0))).drop("_salts")
    right = one.join(hot, key, "left").withColumn("_salt", F.explode(F.sequence(F.lit(0), F.coalesce("_salts", F.lit(1)) - 1))).drop("_salts")
    return left.join(right, [key, "_salt"], how).drop("_salt")


#: Bits of a filter for each of its keys, about, and at most: 16 MB whatever the number of keys.
FILTER_BITS, MAX_FILTER_BITS = 32, 1 << 27


def may_hold(rows: DataFrame, keys: DataFrame, key: str, count: int) -> DataFrame:
    """The rows whose key may be among `keys` (about `count` of them): all that are, and a few others. A bitmap of key
    hashes, of bounded size, is sent to the executors, so that rows which meet nothing aren't shuffled for a join.
    """
    bits = FILTER_BITS
    while bits < min(MAX_FILTER_BITS, FILTER_BITS * count):
        bits *= 2
    code = F.pmod(F.xxhash64(key), F.lit(bits))
    maps = keys.select(code.alias("_c")).groupBy(F.expr("bitmap_bucket_number(_c)").alias("_b")).agg(F.expr("bitmap_construct_agg(bitmap_bit_position(_c))").alias("_bits"))
    coded = rows.withColumn("_c", code).withColumn("_b", F.expr("bitmap_bucket_number(_c)")).withColumn("_at", F.expr("bitmap_bit_position(_c)"))
    met = coded.join(F.broadcast(maps), "_b")  # at most MAX_FILTER_BITS
    byte = F.conv(F.hex(F.expr("substring(_bits, cast(_at div 8 as int) + 1, 1)")), 16, 10).cast("int")
    return met.where(F.expr("(1 << cast(_at % 8 as int))").bitwiseAND(byte) != 0).select(*rows.columns)


def word_count(text: Column) -> Column:
    """Words in a text, 0 for null; counted without an array of words."""
    joined = F.regexp_replace(F.coalesce(text, F.lit("")), WORD, "w")
    return F.length(F.regexp_replace(joined, r"[\x20\x09-\x0D]+", "")).cast("long")


def bound(value: Column, use) -> Column:
    """use(value) with the value computed once."""
    return F.transform(F.array(value), use)[0]


def text_key(text: Column) -> Column:
    """128 bits that equal texts share; null texts have the key of the empty text."""
    return F.unhex(F.md5(F.coalesce(text, F.lit("")).cast("binary")))


class WordHashes(dict):
    """word (bytes) -> 64-bit hash; forgets everything once it holds `limit` words, so memory is bounded."""

    def __init__(self, limit: int = 200_000):
        super().__init__()
        self.limit = limit

    def __missing__(self, word: bytes) -> int:
        if len(self) >= self.limit:
            self.clear()
        self[word] = value = xxhash.xxh3_64_intdigest(word)
        return value

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


_C1, _C2, _C3 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def mixed(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each ordered pair (left, right)."""
    x = left * _C1 + (right ^ (right >> np.uint64(29))) * _C2
    x ^= x >> np.uint64(32)
    x *= _C3
    x ^= x >> np.uint64(29)
    return x


def window_hashes(hashes: np.ndarray, length: int) -> np.ndarray:
    """Hashes of all windows of `length` words, by doubling: two halves that cover the window, the last pair overlapping."""
    n = len(hashes) - length + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    level, now = hashes, 1
    while 2 * now <= length:
        level = mixed(level[:-now], level[now:])
        now *= 2
    if now < length:
        level = mixed(level[: len(level) - (length - now)], level[length - now :])
    return level
