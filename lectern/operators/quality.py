"""Reference-free quality metrics and ordered threshold flags."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import once, repetition_of, words

# Thresholds and flag names; flags are listed in this order, all comparisons are strict.
LOW_WORD_CONFIDENCE = 0.5
LOW_AVG_CONFIDENCE = 0.7
MANY_LOW_CONFIDENCE = 0.15
SLOW, FAST = 1.0, 4.5
LOW_COVERAGE = 0.15
REPETITIVE = 0.3
SHORT_TURN_SECONDS = 0.3
MANY_SHORT_TURNS = 0.3
LOW_TARGET_SHARE = 0.15
MANY_SPEAKERS = 5
LOW_RETENTION = 0.05


def flags(*named: tuple[str, Column]) -> Column:
    """The names whose condition holds, in order."""
    return F.filter(F.array(*[F.when(c, F.lit(n)) for n, c in named]), lambda x: x.isNotNull())


def per_second(count: Column, seconds: Column) -> Column:
    return F.when(seconds > 0, count / seconds).otherwise(F.lit(0.0))


def coverage(segments: Column, duration: Column) -> Column:
    """Seconds of speech by duration, at most 1; 0 without a duration."""
    spoken = F.aggregate(segments, F.lit(0.0), lambda a, s: a + F.greatest(s["end"] - s["start"], F.lit(0.0)))
    return F.when(duration > 0, F.least(spoken / duration, F.lit(1.0))).otherwise(F.lit(0.0))


def pace_flags(rate: Column) -> tuple[tuple[str, Column], tuple[str, Column]]:
    return ("implausibly_slow", (rate > 0) & (rate < SLOW)), ("implausibly_fast", rate > FAST)


def transcript_flags(avg_confidence: Column, low_ratio: Column, rate: Column, covered: Column, repetition: Column, count: Column) -> Column:
    return flags(
        ("low_avg_confidence", avg_confidence < LOW_AVG_CONFIDENCE),
        ("many_low_confidence_words", low_ratio > MANY_LOW_CONFIDENCE),
        *pace_flags(rate),
        ("low_speech_coverage", covered < LOW_COVERAGE),
        ("possible_repetition_hallucination", repetition > REPETITIVE),
        ("empty_transcript", count == 0),
    )


TEXT_METRICS = ("word_count", "repetition_score")


def text_metrics(text: Column, wanted: Sequence[str] = TEXT_METRICS) -> Column:
    """An array of one struct for once(): those of TEXT_METRICS that are wanted. What once() computes isn't pruned later, so
    ask for what is used.
    """
    made = {"word_count": F.size, "repetition_score": repetition_of}
    return F.transform(F.array(words(text)), lambda w: F.struct(*[made[name](w).alias(name) for name in wanted]))


def average(values: Column) -> Column:
    """Of an array, its nulls left out; null if nothing is left."""
    return F.transform(F.array(F.filter(values, lambda v: v.isNotNull())), lambda a: F.when(F.size(a) > 0, F.aggregate(a, F.lit(0.0), lambda x, y: x + y) / F.size(a)))[0]


def low_share(values: Column, below: float = LOW_WORD_CONFIDENCE) -> Column:
    """The share of an array's values, its nulls left out, that are below a limit; null if nothing is left."""
    return F.transform(F.array(F.filter(values, lambda v: v.isNotNull())), lambda a: F.when(F.size(a) > 0, F.size(F.filter(a, lambda p: p < below)) / F.size(a)))[0]


def transcript_quality(transcripts: DataFrame) -> DataFrame:
    """The quality row of each transcript document; nested throughout, no shuffle, each metric computed once."""
    segments = F.coalesce("segments", F.array())
    probabilities = F.flatten(F.transform(segments, lambda s: F.transform(F.coalesce(s["words"], F.array()), lambda w: w["probability"])))
    parts = F.struct(words(F.col("text")).alias("w"), probabilities.alias("p"), segments.alias("s"), F.coalesce("duration", F.lit(0.0)).alias("d"))
    metrics = lambda x: F.struct(
        x["d"].alias("duration"), F.size(x["w"]).alias("word_count"), average(x["p"]).alias("avg_word_confidence"), low_share(x["p"]).alias("low_confidence_word_ratio"),
        per_second(F.size(x["w"]), x["d"]).alias("words_per_second"), coverage(x["s"], x["d"]).alias("speech_coverage_ratio"), repetition_of(x["w"]).alias("repetition_score"),
    )
    named = transcripts.select(F.coalesce("video_id", F.lit("")).alias("video_id"), "duration", "segments", "text")
    rows = once(named, ["video_id"], F.transform(F.array(parts), metrics))
    return rows.withColumn("flags", transcript_flags(*map(F.col, ("avg_word_confidence", "low_confidence_word_ratio", "words_per_second", "speech_coverage_ratio", "repetition_score", "word_count"))))


def diarization_flags(count: Column, speakers: Column, duration: Column, share: Column, short: Column, rate: Column, retention: Column, repetition: Column) -> Column:
    return flags(
        ("empty_target_text", count == 0),
        ("single_speaker_detected", speakers <= 1),
        ("many_speakers_detected", speakers > MANY_SPEAKERS),
        ("low_target_speaker_share", (duration > 0) & (share < LOW_TARGET_SHARE)),
        ("fragmented_turns", short > MANY_SHORT_TURNS),
        *pace_flags(rate),
        ("low_text_retention", retention < LOW_RETENTION),
        ("possible_repetition_artifact", repetition > REPETITIVE),
    )


def retention(target_words: Column, transcript_words: Column) -> Column:
    return target_words / F.nullif(transcript_words, F.lit(0))


def diarization_quality(diarized: DataFrame, transcript_words: DataFrame) -> DataFrame:
    """The quality row of each diarized document; transcript_words (video_id, full_transcript_word_count) may miss some."""
    own = F.col("speakers")[F.col("target_speaker")]
    length = lambda t: t["end"] - t["start"]
    segments, target = F.coalesce("target_speaker_segments", F.array()), F.filter(F.coalesce("turns", F.array()), lambda t: t["speaker"] == F.col("target_speaker"))
    parts = F.struct(
        F.coalesce("duration", F.lit(0.0)).alias("d"), F.coalesce(F.size("speakers"), F.lit(0)).alias("n"), F.coalesce(own["total_seconds"], F.lit(0.0)).alias("seconds"),
        F.coalesce(own["turn_count"], F.lit(0)).alias("turns"), segments.alias("s"), target.alias("t"), words(F.col("target_speaker_text")).alias("w"), F.col("full_transcript_word_count").alias("full"),
    )

    def metrics(x: Column) -> Column:
        spoken = F.aggregate(x["s"], F.lit(0.0), lambda a, s: a + F.greatest(length(s), F.lit(0.0)))
        return F.struct(
            x["d"].alias("duration"), x["n"].alias("num_speakers"), per_second(x["seconds"], x["d"]).alias("target_speaker_share"), x["turns"].alias("target_turn_count"),
            F.size(x["s"]).alias("num_target_segments"), F.when(F.size(x["s"]) > 0, spoken / F.size(x["s"])).otherwise(F.lit(0.0)).alias("avg_target_segment_seconds"),
            F.when(F.size(x["t"]) > 0, F.size(F.filter(x["t"], lambda t: length(t) < SHORT_TURN_SECONDS)) / F.size(x["t"])).otherwise(F.lit(0.0)).alias("short_turn_ratio"),
            F.size(x["w"]).alias("target_word_count"), per_second(F.size(x["w"]), x["seconds"]).alias("target_words_per_second"), x["full"].alias("full_transcript_word_count"),
            retention(F.size(x["w"]), x["full"]).alias("target_text_retention_ratio"), repetition_of(x["w"]).alias("repetition_score"),
        )

    joined = diarized.join(transcript_words, "video_id", "left")
    rows = once(joined, ["video_id", "target_speaker"], F.transform(F.array(parts), metrics))
    names = ("target_word_count", "num_speakers", "duration", "target_speaker_share", "short_turn_ratio", "target_words_per_second", "target_text_retention_ratio", "repetition_score")
    return rows.withColumn("flags", diarization_flags(*map(F.col, names)))
