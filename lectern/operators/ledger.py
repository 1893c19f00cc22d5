"""Processing ledgers: migration, completion, what is still to do, run summaries."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# The columns of the ledgers.
DOWNLOAD = ("video_id", "title", "url", "mode", "status", "output_path", "error", "timestamp")
AUDIO = TRANSCRIPTION = ("video_id", "source_path", "status", "output_path", "error", "timestamp")
DIARIZATION = ("video_id", "source_audio", "status", "output_path", "error", "timestamp")
DEFAULTS = {"mode": "video"}


def migrate(ledger: DataFrame, columns: Sequence[str] = DOWNLOAD) -> DataFrame:
    """Exactly the given columns, in order: missing ones empty (mode: video), unknown ones dropped, nulls empty."""
    have = set(ledger.columns)
    return ledger.select(*[F.coalesce(F.col(c).cast("string") if c in have else F.lit(DEFAULTS.get(c, "")), F.lit("")).alias(c) for c in columns])


def completed(ledger: DataFrame, key: Sequence[str] = ("video_id",)) -> DataFrame:
    """Distinct keys with a success; a failed key alone is to be tried again."""
    rows = ledger.where((F.col("status") == "success") & (F.coalesce("video_id", F.lit("")) != ""))
    fields = [F.when(F.coalesce("mode", F.lit("")) == "", F.lit("video")).otherwise(F.col("mode")).alias("mode") if c == "mode" else F.col(c) for c in key]
    return rows.select(*fields).distinct()


def done(ledger: DataFrame, outputs: DataFrame, key: Sequence[str] = ("video_id",)) -> DataFrame:
    """What either the ledger or existing outputs show as done."""
    return completed(ledger, key).union(outputs.select(*key)).distinct()


def pending(items: DataFrame, finished: DataFrame, key: Sequence[str] = ("video_id",)) -> DataFrame:
    """Items without a finished key; write this before the expensive step, so that it sees nothing else."""
    return items.join(finished, list(key), "left_anti")


def first_of_stem(items: DataFrame, stem: str = "stem", order: str = "path") -> DataFrame:
    """Of items that share a stem, the first by path. A dry run counts them all; a real one skips the later ones."""
    return items.withColumn("_n", F.row_number().over(Window.partitionBy(stem).orderBy(order))).where("_n = 1").drop("_n")


def rounds(items: DataFrame, attempt: Callable[[DataFrame], DataFrame], work: str, *, key: Sequence[str] = ("stem",), order: Sequence[str] = ("path",), after: Callable[[DataFrame], None] = lambda done: None) -> DataFrame:
    """items with `status` and `error`: those of one key are tried in order until one succeeds, the rest are skipped.

    attempt() gives what it was given a string `error`, null where it succeeded, and other columns if it likes, the same
    in each round. Round n tries the n-th item of each key whose item before failed, so a round is a join with the round
    before, of whatever size, and there are as many as some key has failures in a row. Each round is written under `work`
    before after() sees it: what is tried is tried once. Items of equal order share a place and are told apart by nothing,
    so order should name each; null keys are one key. No items: no rows, no round.
    """
    spark, key = items.sparkSession, list(key)
    ranked = items.withColumn("_n", F.row_number().over(Window.partitionBy(*key).orderBy(*order)))
    ranked.write.parquet(f"{work}/items")
    ranked = spark.read.parquet(f"{work}/items")
    match = lambda a, b: reduce(Column.__and__, [a[c].eqNullSafe(b[c]) for c in key])
    todo, n, tried = ranked.where("_n = 1"), 1, []
    while not todo.isEmpty():
        attempt(todo.drop("_n")).withColumn("_n", F.lit(n)).write.parquet(f"{work}/round-{n}")
        done = spark.read.parquet(f"{work}/round-{n}")
        tried.append(done)
        after(done.drop("_n"))
        n += 1
        failed = done.where("error is not null").select(*key)
        following = ranked.where(F.col("_n") == n)
        todo = following.join(failed, match(following, failed), "left_semi")
    if not tried:
        return items.select("*", F.lit("skipped").alias("status"), F.lit(None).cast("string").alias("error")).limit(0)
    tried = reduce(DataFrame.unionByName, tried)
    rest = ranked.join(tried, match(ranked, tried) & (ranked["_n"] == tried["_n"]), "left_anti").withColumn("status", F.lit("skipped"))
    status = F.when(F.col("error").isNull(), F.lit("succeeded")).otherwise(F.lit("failed"))
    return tried.withColumn("status", status).unionByName(rest, allowMissingColumns=True).drop("_n")


def classify(items: DataFrame, finished: DataFrame, key: Sequence[str] = ("video_id",), *, required: DataFrame | None = None, dry_run: bool = True, verb: str = "process") -> DataFrame:
    """items with `status`: skipped if finished, then missing if what is required isn't there, else would_<verb> or pending.

    One left join per side, each on distinct keys, so no item is repeated.
    """
    key = list(key)
    rows = items.join(finished.select(*key).distinct().withColumn("_done", F.lit(True)), key, "left")
    missing: Column = F.lit(False)
    if required is not None:
        rows = rows.join(required.select(*key).distinct().withColumn("_there", F.lit(True)), key, "left")
        missing = F.col("_there").isNull()
    status = F.when(F.col("_done").isNotNull(), F.lit("skipped")).when(missing, F.lit("missing")).otherwise(F.lit(f"would_{verb}" if dry_run else "pending"))
    return rows.withColumn("status", status).drop("_done", "_there")


def summary(statuses: DataFrame, names: Sequence[str]) -> DataFrame:
    """One row: a count per status and their total."""
    counts = [F.count_if(F.col("status") == n).alias(n) for n in names]
    return statuses.agg(*counts, F.count_if(F.col("status").isin(*names)).alias("total"))


def first_with(items: DataFrame, present: DataFrame, key: Sequence[str] = ("video_id",), order: str = "video_id") -> DataFrame:
    """The first item, in order, whose key is present."""
    return items.join(present.select(*key).distinct(), list(key), "left_semi").orderBy(order).limit(1)


def compare(left: DataFrame, right: DataFrame, key: Sequence[str] = ("video_id",)) -> DataFrame:
    """One row: distinct keys in either table, in both, and in one alone."""
    a = left.select(*key).distinct().withColumn("_a", F.lit(True))
    b = right.select(*key).distinct().withColumn("_b", F.lit(True))
    both = a.join(b, list(key), "full_outer")
    has_a, has_b = F.col("_a").isNotNull(), F.col("_b").isNotNull()
    return both.agg(F.count_if(has_a).alias("n_left"), F.count_if(has_b).alias("n_right"), F.count_if(has_a & has_b).alias("n_both"), F.count_if(has_a & ~has_b).alias("only_left"), F.count_if(has_b & ~has_a).alias("only_right"))


#: Ranges of the order in which numbered() counts, and rows by which their bounds are found.
RANGES, SAMPLED = 256, 4096


def numbered(items: DataFrame, order: str, by: str | None = None) -> DataFrame:
    """items with `i` (from 1) and `n`, as progress lines show them; within each value of `by`, if given.

    Rows are numbered within ranges of the order, and each range begins after the rows of those before, so neither one
    source nor the whole is one task; the bounds are those of the SAMPLED rows of lowest hash. Nulls come first. Equal values
    share a range and go by a hash of their other columns, so that a rerun agrees. An empty table stays empty.
    """
    names = items.columns
    value = F.col(f"`{order}`")
    low = items.select(value.alias("v")).where("v is not null").orderBy(F.xxhash64("v"), "v").limit(SAMPLED)
    found = sorted({r.v for r in low.collect()})
    bounds = found[:: max(1, len(found) // RANGES)][1:]
    kind = items.schema[order].dataType
    place = F.size(F.filter(F.array(*[F.lit(b).cast(kind) for b in bounds]), lambda b: b <= value)) if bounds else F.lit(0)
    rows = items.select(F.struct(*[F.col(f"`{c}`") for c in names]).alias("_row"), value.alias("_v"), (F.col(f"`{by}`") if by else F.lit(0)).alias("_by"), F.when(value.isNull(), -1).otherwise(place).alias("_range"))
    counts = rows.groupBy("_by", "_range").agg(F.count("*").alias("_c"))
    own = Window.partitionBy("_by")
    before = own.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select(F.col("_by").alias("_b"), F.col("_range").alias("_r"), F.coalesce(F.sum("_c").over(before), F.lit(0)).alias("_start"), F.sum("_c").over(own).alias("n"))
    inside = rows.withColumn("_i", F.row_number().over(Window.partitionBy("_by", "_range").orderBy("_v", F.xxhash64("_row"), "_row")))
    met = inside.join(starts, F.col("_by").eqNullSafe(F.col("_b")) & (F.col("_range") == F.col("_r")))
    return met.select("_row.*", (F.col("_start") + F.col("_i")).cast("long").alias("i"), "n")
