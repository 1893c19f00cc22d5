"""Words to speaker turns: interval semi-join, dominant speaker, gaps and islands."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import strip
from . import scan


def ordered_turns(turns: Column) -> Column:
    """An array of (speaker, start, end) by start; equal starts keep their order."""
    placed = F.transform(turns, lambda t, i: F.struct(t["start"].alias("start"), i.alias("pos"), t.alias("turn")))
    return F.transform(F.array_sort(placed), lambda x: x["turn"])


def speaker_stats(turns: DataFrame, key: str, *, speaker: str = "speaker", seconds: Column | None = None, position: str = "start") -> DataFrame:
    """key, speaker, total_seconds, turn_count, first_pos: one row per speaker of a recording."""
    seconds = F.col("end") - F.col("start") if seconds is None else seconds
    return turns.groupBy(key, speaker).agg(F.sum(seconds).alias("total_seconds"), F.count("*").alias("turn_count"), F.min(position).alias("first_pos"))


def target_speaker(stats: DataFrame, key: str, *, speaker: str = "speaker", strategy: str = "longest_total_duration") -> DataFrame:
    """key, target_speaker: the speaker of the longest total; of equal ones the one whose first turn comes first."""
    if strategy != "longest_total_duration":
        raise ValueError(f"unknown strategy {strategy}")
    return stats.groupBy(key).agg(F.min_by(speaker, F.struct(-F.col("total_seconds"), F.col("first_pos"), F.col(speaker))).alias("target_speaker"))


def stats_maps(stats: DataFrame, key: str, *, speaker: str = "speaker") -> DataFrame:
    """key, speakers: map from speaker to (total_seconds, turn_count)."""
    entry = F.struct(F.col(speaker), F.struct("total_seconds", F.col("turn_count").cast("int").alias("turn_count")))
    return stats.groupBy(key).agg(F.map_from_entries(F.collect_list(entry)).alias("speakers"))


def flat_words(transcripts: DataFrame, key: str = "video_id") -> DataFrame:
    """key, seg_pos, word_pos, start, end, word in document order; a segment without words is one word with its text."""
    segments = transcripts.select(key, F.posexplode("segments").alias("seg_pos", "seg"))
    whole = F.array(F.struct(F.col("seg.start").alias("start"), F.col("seg.end").alias("end"), F.col("seg.text").alias("word")))
    given = F.transform("seg.words", lambda w: F.struct(w["start"].alias("start"), w["end"].alias("end"), w["word"].alias("word")))
    return segments.select(key, "seg_pos", F.posexplode(F.when(F.size(F.coalesce("seg.words", F.array())) > 0, given).otherwise(whole)).alias("word_pos", "w")).select(key, "seg_pos", "word_pos", "w.*")


def in_turns(words: DataFrame, turns: DataFrame, key: str, *, bucket_rows: int | None = scan.BUCKET_ROWS) -> DataFrame:
    """The words whose midpoint lies in some turn of the same recording, both ends included.

    That is so if the latest end of the turns that begin up to the midpoint isn't before it: one shuffle and one sort, not
    words times turns. A recording of more than bucket_rows rows is cut by time, and the latest end is carried from bucket
    to bucket. Words and turns without times, and null keys, match nothing; repeated words stay repeated.
    """
    mid = (F.col("start") + F.col("end")) / 2
    word = words.select(F.col(key).alias("_k"), mid.alias("_t"), F.lit(1).alias("_kind"), F.lit(None).cast("double").alias("_end"), F.struct(*[F.col(f"`{c}`") for c in words.columns]).alias("_word"))
    turn = turns.select(F.col(key).alias("_k"), F.col("start").cast("double").alias("_t"), F.lit(0).alias("_kind"), F.col("end").cast("double").alias("_end"), F.lit(None).cast(word.schema["_word"].dataType).alias("_word"))
    every = word.where("_k is not null and _t is not null").unionByName(turn.where("_k is not null and _t is not null and _end is not null"))
    every = every.withColumn("_tie", F.xxhash64("_word"))  # words of one time may be cut apart, all turns of it come first
    return scan.running(every, "_k", ["_t", "_kind", "_tie"], {"_last": ("max", F.col("_end"))}, bucket_rows=bucket_rows).where("_kind = 1 and _last >= _t").select("_word.*")


def in_turn_array(mid: Column, turns: Column) -> Column:
    """The same as a predicate over nested turns, for documents that hold their own; no shuffle."""
    return F.exists(turns, lambda t: mid.between(t["start"], t["end"]))


def islands(rows: DataFrame, key: str, order: Sequence[str], keep: Column, *, bucket_rows: int | None = scan.BUCKET_ROWS) -> DataFrame:
    """The rows where keep holds, with `island`: rows of a key with no dropped row between them share one. Long keys are cut
    by their order, and the count of dropped rows is carried on.
    """
    marked = rows.withColumn("_keep", F.coalesce(keep, F.lit(False)))
    dropped = F.when(F.col("_keep"), 0).otherwise(1)
    return scan.running(marked, key, order, {"island": ("sum", dropped)}, bucket_rows=bucket_rows).where("_keep").drop("_keep")


def segments(kept: DataFrame, key: str, order: Sequence[str], *, text: str = "word", separator: str = "", bucket_rows: int | None = scan.BUCKET_ROWS) -> DataFrame:
    """key, id (from 0), start, end, text of each island: first start, last word's end, texts joined in order and stripped.

    An island's text is one value by nature; the islands of a key are numbered bucket by bucket where they are many.
    """
    place = F.struct(*order)
    joined = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(*order, F.col(text).alias("_text")))), lambda x: x["_text"]), separator)
    grouped = kept.groupBy(key, "island").agg(F.min_by("start", place).alias("start"), F.max_by("end", place).alias("end"), strip(joined).alias("text"))
    numbered = scan.running(grouped, key, ["island"], {"_i": ("sum", F.lit(1))}, bucket_rows=bucket_rows)
    return numbered.select(key, (F.col("_i") - 1).cast("int").alias("id"), "start", "end", "text")


def joined_text(found: DataFrame, key: str) -> DataFrame:
    """key, text: the segments' texts in order, joined by a space."""
    return found.groupBy(key).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("id", "text"))), lambda s: s["text"]), " ").alias("text"))


def isolate(transcripts: DataFrame, turns: DataFrame, key: str = "video_id", *, strategy: str = "longest_total_duration", bucket_rows: int | None = scan.BUCKET_ROWS) -> DataFrame:
    """Diarized documents from transcripts (key, duration, segments) and turns (key, speaker, start, end).

    Recordings without a turn give no row (the caller records them as failed). Everything is keyed by recording; the
    words meet the target's turns in one semi-join and are put into segments by one window.
    """
    stats = speaker_stats(turns, key)
    chosen = target_speaker(stats, key, strategy=strategy)
    own = turns.join(chosen, key).where("speaker = target_speaker")
    words = flat_words(transcripts, key)
    bucket_rows = bucket_rows if scan.any_long(words.select(key).union(turns.select(key)), key, bucket_rows) else None
    order = ["seg_pos", "word_pos"]
    hit = in_turns(words, own, key, bucket_rows=bucket_rows).select(key, *order).withColumn("hit", F.lit(True))
    found = segments(islands(words.join(hit, [key, *order], "left"), key, order, F.col("hit"), bucket_rows=bucket_rows), key, order, bucket_rows=bucket_rows)
    nested = found.groupBy(key).agg(F.array_sort(F.collect_list(F.struct("id", "start", "end", "text"))).alias("target_speaker_segments"))
    texts = joined_text(found, key).withColumnRenamed("text", "target_speaker_text")
    lists = turns.groupBy(key).agg(ordered_turns(F.collect_list(F.struct("speaker", "start", "end"))).alias("turns"))
    head = transcripts.select(key, "duration").join(chosen, key).join(stats_maps(stats, key), key).join(lists, key)
    out = head.join(nested, key, "left").join(texts, key, "left")
    empty = F.array().cast("array<struct<id:int,start:double,end:double,text:string>>")
    return out.select(key, "duration", "speakers", "target_speaker", F.lit(strategy).alias("target_speaker_strategy"), "turns", F.coalesce("target_speaker_segments", empty).alias("target_speaker_segments"), F.coalesce("target_speaker_text", F.lit("")).alias("target_speaker_text"))
