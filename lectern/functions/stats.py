"""Corpus statistics with exact order statistics, without gathering a metric's values in one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Ranges of a metric's values in which only counts per distinct value meet: so many for each doubling of the value.
RANGES = 1024


def value_range(value: Column) -> Column:
    """The number of a value's range, in the order of the values, from the value alone: an outlier changes no other's."""
    size = F.floor(F.log2(F.abs(value)) * RANGES) + 2 * 1100 * RANGES  # above 0 for the least double there is
    return F.when(value > 0, size).when(value < 0, -size).otherwise(F.lit(0)).cast("long")


def _ranks(total: Column) -> dict[str, Column]:
    """1-based places of the order statistics that median and exclusive deciles need."""
    low = F.greatest(F.lit(1), F.least(F.floor((total + 1) / 10), total - 1))
    high = F.greatest(F.lit(1), F.least(F.floor(9 * (total + 1) / 10), total - 1))
    return {"m1": F.floor((total + 1) / 2), "m2": F.floor(total / 2) + 1, "l1": low, "l2": low + 1, "h1": high, "h2": high + 1}


def corpus_stats(rows: DataFrame, metrics: Sequence[str]) -> DataFrame:
    """metric, mean, median, min, max, p10, p90 of each metric's values that aren't null; metrics without values are left out.

    p10 and p90 are the exclusive quantiles (n = 10, cuts 1 and 9): with ten or fewer values they may lie outside min and
    max; a single value is its own quantile. Values are counted by value first, the counts ranked within ranges of the
    metric, so a task sees the distinct values of one range, not the corpus.
    """
    long = rows.select(F.stack(F.lit(len(metrics)), *[x for m in metrics for x in (F.lit(m), F.col(m).cast("double"))]).alias("metric", "value"))
    counts = long.where("value is not null").groupBy("metric", "value").agg(F.count("*").alias("n"))
    bounds = counts.groupBy("metric").agg(F.min("value").alias("min"), F.max("value").alias("max"), F.sum("n").alias("total"), (F.sum(F.col("value") * F.col("n")) / F.sum("n")).alias("mean"))
    ranged = counts.select("metric", "value", "n", value_range(F.col("value")).alias("range"))
    before = Window.partitionBy("metric").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    starts = ranged.groupBy("metric", "range").agg(F.sum("n").alias("in")).select("metric", "range", F.coalesce(F.sum("in").over(before), F.lit(0)).alias("start"))
    inside = Window.partitionBy("metric", "range").orderBy("value").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    placed = ranged.withColumn("upto", F.sum("n").over(inside)).join(starts, ["metric", "range"])
    placed = placed.select("metric", "value", (F.col("start") + F.col("upto")).alias("last"), (F.col("start") + F.col("upto") - F.col("n") + 1).alias("first"))
    ranks = _ranks(F.col("total"))
    picked = placed.join(bounds, "metric").groupBy("metric", "mean", "min", "max", "total").agg(
        *[F.max(F.when(r.between(F.col("first"), F.col("last")), F.col("value"))).alias(name) for name, r in ranks.items()]
    )

    def cut(i: int, a: str, b: str, j: Column) -> Column:
        d = i * (F.col("total") + 1) - 10 * j
        return F.when(F.col("total") < 2, F.col("min")).otherwise((F.col(a) * (10 - d) + F.col(b) * d) / 10)

    return picked.select(
        "metric", "mean", ((F.col("m1") + F.col("m2")) / 2).alias("median"), "min", "max",
        cut(1, "l1", "l2", ranks["l1"]).alias("p10"), cut(9, "h1", "h2", ranks["h1"]).alias("p90"),
    )


def stats_map(stats: DataFrame) -> DataFrame:
    """One row: corpus_stats as a map from metric to its numbers."""
    names = [c for c in stats.columns if c != "metric"]
    return stats.agg(F.map_from_entries(F.collect_list(F.struct("metric", F.struct(*names)))).alias("corpus_stats"))


def flag_counts(rows: DataFrame, key: str) -> DataFrame:
    """flag, n over the flag arrays of rows: most frequent first, ties by first appearance in the order of key, then place."""
    seen = rows.select(key, F.posexplode("flags").alias("pos", "flag")).groupBy("flag").agg(F.count("*").alias("n"), F.min(F.struct(key, "pos")).alias("first"))
    return seen.orderBy(F.desc("n"), "first").select("flag", "n")


def report_columns() -> list[Column]:
    return [F.count("*").alias("num_files"), F.count_if(F.size("flags") > 0).alias("num_flagged")]


def report_counts(rows: DataFrame) -> DataFrame:
    return rows.agg(*report_columns())


def worst_first(rows: DataFrame, by: Column, key: str, top_n: int) -> DataFrame:
    """Flagged rows, most flags first, then by `by` ascending, ties in the order of key; the first top_n."""
    return rows.where(F.size("flags") > 0).orderBy(F.desc(F.size("flags")), by, key).limit(top_n)


def total_duration(rows: DataFrame, duration: str = "duration", factor: float = 1.0) -> DataFrame:
    """Sum of durations, missing ones 0, and the time that work at a real-time factor takes."""
    total = F.sum(F.coalesce(F.col(duration), F.lit(0.0)))
    return rows.agg(F.coalesce(total, F.lit(0.0)).alias("total_duration"), F.coalesce(total * factor, F.lit(0.0)).alias("estimated_seconds"))


def real_time_factor(wall: Column, audio: Column) -> Column:
    return F.when(audio > 0, wall / audio)
