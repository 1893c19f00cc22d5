"""External models as pluggable callables: loaded once a worker, failures kept per row."""

from __future__ import annotations

import json
import time
from collections.abc import Callable, Iterator
from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import BACKOFF_BASE, BACKOFF_FACTOR, strip, utc_now

_LOADED: dict[str, Callable] = {}


def apply_model(rows: DataFrame, name: str, load: Callable[[], Callable[[dict], dict]], result: str, *, key: str = "video_id", attempts: int = 1, wait: float = BACKOFF_BASE, factor: float = BACKOFF_FACTOR, sleep: Callable[[float], None] = time.sleep) -> DataFrame:
    """key, result (a struct of the given type), error for every row: the callable that `load` returns is applied to each row.

    It is loaded on first use in a worker and kept there. An exception makes a null result and its text, up to 500
    characters, after `attempts` tries; it never fails the task. Between tries it waits `wait` seconds, then `factor` times
    as long each time; not after the last. Filter what is finished before, so it isn't sent here.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for row in batch.to_dict("records"):
                found, error = None, None
                for attempt in range(attempts):
                    if attempt:
                        sleep(wait * factor ** (attempt - 1))
                    try:
                        if name not in _LOADED:
                            _LOADED[name] = load()
                        found, error = json.dumps(_LOADED[name](row)), None
                        break
                    except Exception as e:
                        error = str(e).strip()[-500:]
                out.append((row[key], found, error))
            yield pd.DataFrame(out, columns=[key, "_json", "error"])

    kind = rows.schema[key].dataType.simpleString()
    done = rows.mapInPandas(run, f"{key} {kind}, _json string, error string")
    return done.select(key, F.from_json("_json", result).alias("result"), "error")


def retried(rows: DataFrame, attempt: Callable[[DataFrame], DataFrame], work: str, *, key: str = "video_id", attempts: int = 1, wait: float = BACKOFF_BASE, factor: float = BACKOFF_FACTOR, sleep: Callable[[float], None] = time.sleep) -> DataFrame:
    """key, result, error of each row's last try: attempt() gives (key, result, error) of all rows, then of those that failed.

    Between tries the driver waits, `wait` seconds, then `factor` times as long each time, and no task does: no core is held.
    Tries are written under `work`, so a round reads the failures of the one before and what is tried is tried once. Keys
    should be unique.
    """
    todo, tried = rows, []
    for n in range(max(1, attempts)):
        if n:
            sleep(wait * factor ** (n - 1))
        attempt(todo).select(key, "result", "error").write.parquet(f"{work}/try-{n}")
        tried.append(rows.sparkSession.read.parquet(f"{work}/try-{n}"))
        failed = tried[-1].where("error is not null")
        if failed.isEmpty():
            break
        todo = rows.join(failed.select(key), key, "left_semi")
    return reduce(DataFrame.unionByName, [t.where("error is null") for t in tried[:-1]] + tried[-1:])


def outcomes(done: DataFrame, key: str = "video_id") -> DataFrame:
    """key, status, error: ledger rows of a model run."""
    return done.select(key, F.when(F.col("error").isNull(), F.lit("success")).otherwise(F.lit("failed")).alias("status"), F.coalesce("error", F.lit("")).alias("error"))


# What a speech-to-text model says of a recording, and a diarization model.
SPEECH = "language string, language_probability double, duration double, segments array<struct<id:int,start:double,end:double,text:string,words:array<struct<start:double,end:double,word:string,probability:double>>>>"
TURNS = "turns array<struct<speaker:string,start:double,end:double>>"


def transcript_documents(said: DataFrame, *, size: str, device: str, compute_type: str, key: str = "video_id") -> DataFrame:
    """Transcript documents from what a model said (key, source_audio, result of SPEECH): segment texts stripped, words as they
    are but null where there are none, the text the segments' joined by spaces.
    """
    def segment(s: Column) -> Column:
        words = F.when(F.size(F.coalesce(s["words"], F.array())) > 0, s["words"])
        return F.struct(s["id"].alias("id"), s["start"].alias("start"), s["end"].alias("end"), strip(F.coalesce(s["text"], F.lit(""))).alias("text"), words.alias("words"))

    segments = F.transform(F.coalesce("result.segments", F.array()), segment)
    model = F.struct(F.lit(size).alias("size"), F.lit(device).alias("device"), F.lit(compute_type).alias("compute_type"))
    rows = said.select(key, "source_audio", F.col("result.language").alias("language"), F.col("result.language_probability").alias("language_probability"), F.col("result.duration").alias("duration"), model.alias("model"), segments.alias("segments"))
    return rows.select("*", F.array_join(F.transform("segments", lambda s: s["text"]), " ").alias("text"), utc_now().alias("transcribed_at"))
