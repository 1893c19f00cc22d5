"""New files as they come: what the ledger hasn't as a success is processed, every outcome is recorded, once."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from ..functions.text import BACKOFF_BASE, BACKOFF_FACTOR
from ..operators import ledger
from ..sources import commit_log

LEDGER = "video_id string, status string, error string, timestamp string"
_STAMP = "yyyy-MM-dd'T'HH:mm:ss"


def read_outcomes(spark: SparkSession, path: str) -> DataFrame:
    return commit_log.read(spark, path, LEDGER)


def record(outcomes: DataFrame, path: str, batch: tuple[str, int] | None = None) -> bool:
    """Outcomes (video_id, status, error), stamped, as one commit of the ledger; False if that batch of a stream is there already."""
    stamped = outcomes.select("video_id", "status", F.coalesce("error", F.lit("")).alias("error"), F.date_format(F.current_timestamp(), _STAMP).alias("timestamp"))
    stream, number = batch or (None, None)
    return commit_log.append(stamped, path, stream=stream, batch=number)


def run_pending(items: DataFrame, ledger_path: str, process: Callable[[DataFrame], DataFrame], batch: tuple[str, int] | None = None) -> None:
    """One batch: the anti-join with the ledger's successes comes before `process`, which returns (video_id, status, error). A
    batch of a stream that the ledger has is passed over.
    """
    spark = items.sparkSession
    if batch is None or not commit_log.holds(spark, ledger_path, *batch):
        todo = ledger.pending(items, ledger.completed(read_outcomes(spark, ledger_path)))
        record(process(todo), ledger_path, batch)


def follow(spark: SparkSession, folder: str, schema: StructType, ledger_path: str, checkpoint: str, process: Callable[[DataFrame], DataFrame]) -> StreamingQuery:
    """Processes what has come to a folder of Parquet files since the last call, then stops.

    The checkpoint knows files, the ledger knows successes: what failed stays to be tried by run_pending() or run_due() over
    the folder. A batch is committed under the query's id, which the checkpoint keeps, and its own number: one that is
    replayed after its commit leaves the ledger as it is, one that is replayed before it is processed again.
    """
    stream = spark.readStream.schema(schema).parquet(folder)

    def one(batch: DataFrame, number: int) -> None:
        name = batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId") or checkpoint
        run_pending(batch, ledger_path, process, (name, number))

    return stream.writeStream.trigger(availableNow=True).option("checkpointLocation", checkpoint).foreachBatch(one).start()


def schedule(outcomes: DataFrame, *, wait: float = BACKOFF_BASE, factor: float = BACKOFF_FACTOR) -> DataFrame:
    """video_id, attempts, due of each key of a ledger without a success: how often it has failed, and when it may be tried
    again: after its last failure `wait` seconds, `factor` times as many for each further one.
    """
    when = F.to_timestamp("timestamp", _STAMP)
    keys = outcomes.groupBy("video_id").agg(F.count_if(F.col("status") == "success").alias("_ok"), F.count_if(F.col("status") == "failed").alias("attempts"), F.max(F.when(F.col("status") == "failed", when)).alias("_last"))
    seconds = F.lit(float(wait)) * F.pow(F.lit(float(factor)), F.col("attempts") - 1)
    due = F.timestamp_micros((F.unix_micros("_last") + seconds * 1_000_000).cast("long"))
    return keys.where("_ok = 0 and attempts > 0").select("video_id", "attempts", due.alias("due"))


def run_due(items: DataFrame, ledger_path: str, process: Callable[[DataFrame], DataFrame], *, attempts: int, now: Column | None = None, wait: float = BACKOFF_BASE, factor: float = BACKOFF_FACTOR) -> None:
    """Tries the items that aren't in the ledger, and those that have failed fewer than `attempts` times and are due. Nobody
    waits: state and due times are the ledger's, and what isn't due is left to a later call.
    """
    plan = schedule(read_outcomes(items.sparkSession, ledger_path), wait=wait, factor=factor)
    later = plan.where((F.col("attempts") >= attempts) | (F.col("due") > (F.current_timestamp() if now is None else now)))
    run_pending(ledger.pending(items, later.select("video_id")), ledger_path, process)
