"""Text exports: topics from titles or text, blocks, report lines."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import strip, titled

RULE = "\n" + "-" * 80 + "\n\n"


def with_topics(rows: DataFrame, titles: DataFrame | None, key: str = "video_id") -> DataFrame:
    """key, topic, text, title_source of rows (key, text): cached (a known null title counts too), unknown, or derived.

    titles (key, title) has one row per key; without it all topics are derived.
    """
    text = strip(F.coalesce("text", F.lit("")))
    if titles is None:
        return rows.select(key, titled(F.lit(None).cast("string"), text).alias("topic"), text.alias("text"), F.lit("derived").alias("title_source"))
    joined = rows.select(key, text.alias("text")).join(titles.select(key, F.col("title").alias("_title"), F.lit(True).alias("_known")), key, "left")
    source = F.when(F.coalesce("_title", F.lit("")) != "", F.lit("title")).when(F.col("_known").isNotNull(), F.lit("known_failure")).otherwise(F.lit("unknown"))
    return joined.select(key, titled(F.col("_title"), F.col("text")).alias("topic"), "text", source.alias("title_source"))


def block_of(topic: Column, text: Column) -> Column:
    return F.concat(F.lit("Topic: "), topic, F.lit("\nText: "), text, F.lit("\n"))


def blocks(topics: DataFrame, key: str = "video_id") -> DataFrame:
    """key, block: the part of a combined file that belongs to a recording."""
    return topics.select(key, block_of(F.col("topic"), F.col("text")).alias("block"))


def combined(rows: DataFrame, key: str = "video_id") -> DataFrame:
    """One row: all blocks in the order of key, with a rule between. One text by nature; for large corpora write the
    blocks themselves, ordered, as a partitioned table.
    """
    return rows.agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(key, "block"))), lambda x: x["block"]), RULE).alias("text"))


def plain_texts(rows: DataFrame, key: str = "video_id") -> DataFrame:
    """key, value: stripped text and a line end, as one file per recording holds it."""
    return rows.select(key, F.concat(strip(F.coalesce("text", F.lit(""))), F.lit("\n")).alias("value"))


def stat_lines(stats: DataFrame, width: int = 28) -> DataFrame:
    parts = [F.col(c) for c in ("metric", "mean", "median", "p10", "p90", "min", "max")]
    return stats.select("metric", F.format_string(f"%-{width}s mean=%.3f median=%.3f p10=%.3f p90=%.3f min=%.3f max=%.3f", *parts).alias("line"))


def transcript_lines(flagged: DataFrame) -> DataFrame:
    conf = F.when(F.col("avg_word_confidence").isNull(), F.lit("n/a")).otherwise(F.format_string("%.2f", F.col("avg_word_confidence")))
    shown = F.format_string("%s | conf=%s wps=%.2f coverage=%.2f repetition=%.2f | %s", F.col("video_id"), conf, F.col("words_per_second"), F.col("speech_coverage_ratio"), F.col("repetition_score"), F.array_join("flags", ", "))
    return flagged.select("video_id", shown.alias("line"))


def diarization_lines(flagged: DataFrame) -> DataFrame:
    kept = F.when(F.col("target_text_retention_ratio").isNull(), F.lit("n/a")).otherwise(F.format_string("%.2f", F.col("target_text_retention_ratio")))
    shown = F.format_string("%s | speakers=%d share=%.2f retention=%s frag=%.2f rep=%.2f | %s", F.col("video_id"), F.col("num_speakers"), F.col("target_speaker_share"), kept, F.col("short_turn_ratio"), F.col("repetition_score"), F.array_join("flags", ", "))
    return flagged.select("video_id", shown.alias("line"))


def accuracy_lines(scores: DataFrame) -> DataFrame:
    shown = F.format_string("%s | wer=%.3f cer=%.3f ref_words=%d hyp_words=%d", F.col("video_id"), F.col("wer"), F.col("cer"), F.col("reference_word_count"), F.col("hypothesis_word_count"))
    return scores.select("video_id", shown.alias("line"))
