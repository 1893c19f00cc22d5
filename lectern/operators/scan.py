"""Running aggregates of long groups: a group with many rows is cut into buckets of its order, and each begins with what came before."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Row, Window
from pyspark.sql import functions as F

#: Rows of a key from which it is cut, and rows of a bucket, about.
BUCKET_ROWS = 1_000_000
#: Keys that are cut, the most frequent ones: any other has less than a thousandth of all rows. Rows by which bounds are found.
HOT_KEYS, SAMPLED = 1000, 65_536
#: Bounds of one key are searched in two steps of about so many comparisons.
STEP = 64


def _bounds(rows: DataFrame, key: str, order: Sequence[str], bucket_rows: int) -> DataFrame | None:
    """(_scan_k, _scan_coarse, _scan_fine): for each key of more than bucket_rows rows the places where its buckets begin; None if there is none."""
    counts = rows.where(F.col(key).isNotNull()).groupBy(key).agg(F.count("*").alias("_n")).where(F.col("_n") > bucket_rows)
    hot = counts.orderBy(F.desc("_n"), key).limit(HOT_KEYS).collect()
    if not hot:
        return None
    spark, kind = rows.sparkSession, rows.schema[key].dataType
    every = max(1, sum(r._n for r in hot) // SAMPLED)
    names = spark.createDataFrame([(r[key],) for r in hot], f"_scan_k {kind.simpleString()}")
    place = F.struct(*[F.col(c) for c in order])
    sample = rows.select(F.col(key).alias("_scan_k"), place.alias("_p")).join(F.broadcast(names), "_scan_k").where(F.pmod(F.xxhash64("_scan_k", "_p"), F.lit(every)) == 0)
    found: dict = {}
    for r in sample.distinct().collect():  # about SAMPLED rows
        found.setdefault(r._scan_k, []).append(r._p)
    made = []
    for r in hot:
        places = sorted(found.get(r[key], []), key=lambda p: tuple((v is not None, v) for v in p))
        n = min(STEP * STEP, -(-r._n // bucket_rows))
        cuts = sorted({len(places) * i // n for i in range(1, n)} - {0})
        begins = [places[i] for i in cuts]
        fine = [begins[i + 1 : i + STEP] for i in range(0, len(begins), STEP)]
        made.append(Row(_scan_k=r[key], _scan_coarse=begins[::STEP], _scan_fine=[[], *fine]))
    kinds = sample.schema["_p"].dataType.simpleString()
    return spark.createDataFrame(made, f"_scan_k {kind.simpleString()}, _scan_coarse array<{kinds}>, _scan_fine array<array<{kinds}>>")


def any_long(rows: DataFrame, key: str, bucket_rows: int | None = BUCKET_ROWS) -> bool:
    """Whether some key has more than bucket_rows rows; False for None."""
    if bucket_rows is None:
        return False
    counts = rows.where(F.col(key).isNotNull()).groupBy(key).agg(F.count("*").alias("_n"))
    return not counts.where(F.col("_n") > bucket_rows).limit(1).isEmpty()


def running(rows: DataFrame, key: str, order: Sequence[str], found: Mapping[str, tuple[str, Column]], *, bucket_rows: int | None = BUCKET_ROWS) -> DataFrame:
    """rows with a column for each of found, name -> (max or sum, value): the aggregate over the rows of its key up to this one,
    in the order of the columns `order` (nulls first), itself included.

    Keys of up to bucket_rows rows are one window each. Longer ones are cut where a sample says, a window a bucket, and
    every bucket takes over the aggregates of those before it, a row a bucket: so one key may hold all rows. Counting the
    keys is a pass of its own; None spares it where the caller knows that no key is long (any_long). Rows whose
    order is equal stay together, so order should tell rows apart where many could be equal. Null keys are a key like any
    other, but never cut. An empty table stays empty.
    """
    used = [n for n in rows.columns if n in found or n in ("_scan_bucket", "_scan_k", "_scan_coarse", "_scan_fine")]
    if used:
        raise ValueError(f"rows have columns of the result's names: {used}")
    whole = {"max": F.max, "sum": F.sum}
    place = F.struct(*[F.col(c) for c in order])
    bounds = None if bucket_rows is None else _bounds(rows, key, order, bucket_rows)
    if bounds is None:
        w = Window.partitionBy(key).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
        return rows.select("*", *[whole[how](value).over(w).alias(name) for name, (how, value) in found.items()])
    cut = rows.join(F.broadcast(bounds), F.col(key) == F.col("_scan_k"), "left")  # about SAMPLED bounds in all
    coarse = F.size(F.filter("_scan_coarse", lambda b: b <= place))
    fine = F.size(F.filter(F.get("_scan_fine", coarse), lambda b: b <= place))
    cut = cut.withColumn("_scan_bucket", F.when(F.col("_scan_k").isNotNull(), coarse * (STEP + 1) + fine).otherwise(0)).drop("_scan_coarse", "_scan_fine")
    heads = cut.where("_scan_k is not null").groupBy("_scan_k", "_scan_bucket").agg(*[whole[how](value).alias(f"_h{i}") for i, (how, value) in enumerate(found.values())])
    before = Window.partitionBy("_scan_k").orderBy("_scan_bucket").rowsBetween(Window.unboundedPreceding, -1)
    heads = heads.select(F.col("_scan_k").alias("_hk"), F.col("_scan_bucket").alias("_hb"), *[whole[how](f"_h{i}").over(before).alias(f"_h{i}") for i, (how, _) in enumerate(found.values())])
    w = Window.partitionBy(key, "_scan_bucket").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    inside = cut.select("*", *[whole[how](value).over(w).alias(name) for name, (how, value) in found.items()])
    met = inside.join(F.broadcast(heads), (F.col("_scan_k") == F.col("_hk")) & (F.col("_scan_bucket") == F.col("_hb")), "left")  # a row a bucket
    carried = {"max": F.greatest, "sum": lambda a, b: F.when(a.isNull(), b).when(b.isNull(), a).otherwise(a + b)}
    return met.select(*[F.col(f"`{c}`") for c in rows.columns], *[carried[how](F.col(name), F.col(f"_h{i}")).alias(name) for i, (name, (how, _)) in enumerate(found.items())])
