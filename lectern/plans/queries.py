"""Queries that apply the operators to the driver's tables; each says what a table stands for."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import stats
from ..functions import text as tx
from ..operators import accuracy, acquisition, alignment, export, ledger, pairs, quality
from ..sources import writers

CHARS_PER_SECOND = 15.0
TOP_N = 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def r6(c: str | Column) -> Column:
    return F.round(F.col(c) if isinstance(c, str) else c, 6)


def word_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents are transcripts."""
    return table(spark, sf_dir, "documents").select("doc_id", tx.word_count(F.col("text")).alias("word_count"))


def repetition_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", tx.repetition_score(F.col("text")).alias("repetition_score"))


def _timed_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", "text", (F.col("n_chars") / CHARS_PER_SECOND).alias("duration"))


def _doc_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Transcript audit without confidences and segments; n_chars / 15 stands for seconds."""
    docs = _timed_documents(spark, sf_dir)
    rows = tx.once(docs, ["doc_id", "duration"], quality.text_metrics(F.col("text")))
    rows = rows.withColumn("words_per_second", quality.per_second(F.col("word_count"), F.col("duration")))
    none = F.lit(None).cast("double")
    return rows.withColumn("flags", quality.transcript_flags(none, none, F.col("words_per_second"), F.lit(1.0), F.col("repetition_score"), F.col("word_count")))


def doc_quality_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _doc_quality(spark, sf_dir).select("doc_id", r6("duration").alias("duration"), "word_count", r6("words_per_second").alias("words_per_second"), "repetition_score", F.array_join("flags", ",").alias("flags"))


def flagged_topn(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = stats.worst_first(_doc_quality(spark, sf_dir), F.col("words_per_second"), "doc_id", TOP_N)
    return rows.select("doc_id", F.size("flags").alias("n_flags"), F.array_join("flags", ",").alias("flags"))


def flag_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stats.flag_counts(_doc_quality(spark, sf_dir), "doc_id")


def report_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stats.report_counts(_doc_quality(spark, sf_dir))


_METRICS = ("duration", "word_count", "words_per_second", "repetition_score")


def corpus_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = stats.corpus_stats(_doc_quality(spark, sf_dir), _METRICS)
    return found.select("metric", *[r6(c).alias(c) for c in ("mean", "median", "min", "max", "p10", "p90")])


def stat_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The lines of two metrics; the others aren't computed."""
    docs = _timed_documents(spark, sf_dir)
    rows = tx.once(docs, ["doc_id", "duration"], quality.text_metrics(F.col("text"), ("word_count",)))
    return export.stat_lines(stats.corpus_stats(rows, _METRICS[:2]))


def _role_turns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversations are recordings, roles speakers, words of a turn its seconds."""
    return table(spark, sf_dir, "conversations").select("conv_id", "turn", F.col("role").alias("speaker"), "text", tx.word_count(F.col("text")).cast("double").alias("seconds"))


def _role_stats(turns: DataFrame) -> DataFrame:
    return alignment.speaker_stats(turns, "conv_id", seconds=F.col("seconds"), position="turn")


def speaker_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _role_stats(_role_turns(spark, sf_dir)).select("conv_id", "speaker", "total_seconds", "turn_count")


def speaker_maps(spark: SparkSession, sf_dir: str) -> DataFrame:
    maps = alignment.stats_maps(_role_stats(_role_turns(spark, sf_dir)), "conv_id")
    return maps.select("conv_id", F.size(F.map_keys("speakers")).alias("num_speakers"), F.array_join(F.array_sort(F.map_keys("speakers")), ",").alias("speakers"))


def target_speaker(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.target_speaker(_role_stats(_role_turns(spark, sf_dir)), "conv_id")


def target_distribution(spark: SparkSession, sf_dir: str) -> DataFrame:
    return target_speaker(spark, sf_dir).groupBy("target_speaker").agg(F.count("*").alias("n"))


def _role_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = _role_turns(spark, sf_dir)
    chosen = alignment.target_speaker(_role_stats(turns), "conv_id")
    rows = turns.join(chosen, "conv_id").select("conv_id", "turn", "text", "speaker", "target_speaker", F.col("turn").alias("start"), F.col("turn").alias("end"))
    kept = alignment.islands(rows, "conv_id", ["turn"], F.col("speaker") == F.col("target_speaker"))
    return alignment.segments(kept, "conv_id", ["turn"], text="text", separator=" ")


def target_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _role_segments(spark, sf_dir)


def target_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.joined_text(_role_segments(spark, sf_dir), "conv_id")


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A user is a recording. An event is a word of value * 60 seconds, and begins a turn of its type up to the next event."""
    us = F.unix_micros(F.col("ts").cast("timestamp"))
    own = Window.partitionBy("user_id")
    order = own.orderBy("us", "event_id")
    rows = table(spark, sf_dir, "events").select("user_id", "event_id", "event_type", "value", us.alias("us"))
    rows = rows.withColumn("first", F.min("us").over(own)).withColumn("pos", F.row_number().over(order) - 1).withColumn("next", F.lead("us").over(order))
    seconds = lambda c: (c - F.col("first")) / 1e6
    start = seconds(F.col("us"))
    return rows.select("user_id", "pos", F.col("event_type").alias("speaker"), "value", start.alias("start"), (start + F.floor(F.col("value") * 60)).alias("end"), seconds(F.coalesce("next", "us")).alias("turn_end"))


def _event_documents(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """The events as transcript documents of one segment each, and their turns."""
    rows = _events(spark, sf_dir)
    word = F.struct("pos", "start", "end", F.concat(F.lit(" "), "speaker").alias("word"))
    words = F.transform(F.array_sort(F.collect_list(word)), lambda w: F.struct(w["start"].alias("start"), w["end"].alias("end"), w["word"].alias("word")))
    docs = rows.groupBy("user_id").agg(words.alias("words"), F.max(F.greatest("end", "turn_end")).alias("duration"))
    segment = F.struct(F.lit(0.0).alias("start"), F.col("duration").alias("end"), F.lit("").alias("text"), "words")
    return docs.select("user_id", "duration", F.array(segment).alias("segments")), rows.select("user_id", "speaker", "start", F.col("turn_end").alias("end"))


def aligned_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = alignment.isolate(*_event_documents(spark, sf_dir), key="user_id")
    rows = docs.select("user_id", "target_speaker", F.inline("target_speaker_segments"))
    return rows.select("user_id", "target_speaker", F.col("id").cast("long").alias("id"), r6("start").alias("start"), r6("end").alias("end"), "text")


def kept_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The interval semi-join alone: words whose midpoint is in a turn of the user's purchases."""
    rows = _events(spark, sf_dir)
    turns = rows.where("speaker = 'purchase'").select("user_id", "start", F.col("turn_end").alias("end"))
    return alignment.in_turns(rows.select("user_id", "pos", "start", "end"), turns, "user_id").groupBy("user_id").agg(F.count("*").alias("n"))


def _diarization_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Users of even id have a transcript, whose words are all their events."""
    docs = alignment.isolate(*_event_documents(spark, sf_dir), key="user_id").withColumnRenamed("user_id", "video_id")
    counts = _events(spark, sf_dir).where("user_id % 2 = 0").groupBy(F.col("user_id").alias("video_id")).agg(F.count("*").cast("int").alias("full_transcript_word_count"))
    return quality.diarization_quality(docs, counts)


def diarization_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _diarization_rows(spark, sf_dir)
    numbers = ("duration", "target_speaker_share", "avg_target_segment_seconds", "short_turn_ratio", "target_words_per_second", "target_text_retention_ratio", "repetition_score")
    return rows.select("video_id", "num_speakers", "target_speaker", "target_turn_count", "num_target_segments", "target_word_count", *[r6(c).alias(c) for c in numbers], F.array_join("flags", ",").alias("flags"))


def worst_diarized(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flagged recordings, most flags first, then least target share, with their report lines."""
    rows = stats.worst_first(_diarization_rows(spark, sf_dir), F.col("target_speaker_share"), "video_id", TOP_N)
    return export.diarization_lines(rows)


def confidence_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """value modulo 1 stands for a word's probability; every eleventh event has none."""
    p = F.when(F.col("event_id") % 11 != 0, F.col("value") - F.floor("value"))
    rows = table(spark, sf_dir, "events").groupBy("user_id").agg(F.collect_list(F.struct("event_id", p.alias("p")))["p"].alias("p"))
    return rows.select("user_id", F.round(quality.average(F.col("p")), 9).alias("avg_word_confidence"), quality.low_share(F.col("p")).alias("low_confidence_word_ratio"))


def _transcripts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Users as transcripts: a segment of one word for each event, of its type, or of its type and number for odd users.

    Every fourth user repeats five words, every third user is spoken clearly, every fifth hardly speaks, every seventh has no text, every eighth no words in its segments, and the pace is 0.5 to
    5.5 words a second, so that every flag is met.
    """
    own = Window.partitionBy("user_id")
    rows = table(spark, sf_dir, "events").select("user_id", "event_id", "event_type", "value", F.row_number().over(own.orderBy("ts", "event_id")).alias("pos"), F.count("*").over(own).alias("n"))
    duration = F.col("n") / (0.5 + F.col("user_id") % 6)
    start = (F.col("pos") - 1) * duration / F.col("n")
    end = start + duration / F.col("n") * F.when(F.col("user_id") % 5 == 0, 0.1).otherwise(0.9)
    kind = F.when(F.col("user_id") % 4 == 0, F.concat(F.lit("w"), (F.col("pos") % 5).cast("string"))).otherwise(F.col("event_type"))
    word = F.concat(F.lit(" "), kind, F.when(F.col("user_id") % 2 == 1, F.col("pos").cast("string")).otherwise(F.lit("")))
    part = F.col("value") - F.floor("value")
    words = F.array(F.struct(start.alias("start"), end.alias("end"), word.alias("word"), F.when(F.col("user_id") % 3 == 0, 0.5 + part / 2).otherwise(part).alias("probability")))
    segment = F.struct(F.col("pos").alias("id"), start.alias("start"), end.alias("end"), F.ltrim(word).alias("text"), F.when(F.col("user_id") % 8 != 0, words).alias("words"))
    found = rows.select("user_id", "pos", duration.alias("duration"), segment.alias("segment")).groupBy("user_id", "duration").agg(F.array_sort(F.collect_list(F.struct("pos", "segment")))["segment"].alias("segments"))
    text = F.when(F.col("user_id") % 7 != 0, F.array_join(F.transform("segments", lambda s: s["text"]), " ")).otherwise(F.lit(""))
    return found.select(F.col("user_id").cast("string").alias("video_id"), "duration", "segments", text.alias("text"))


def _transcript_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.transcript_quality(_transcripts(spark, sf_dir))


def transcript_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    numbers = ("duration", "avg_word_confidence", "low_confidence_word_ratio", "words_per_second", "speech_coverage_ratio", "repetition_score")
    return _transcript_rows(spark, sf_dir).select("video_id", "word_count", *[r6(c).alias(c) for c in numbers], F.array_join("flags", ",").alias("flags"))


def transcript_flag_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stats.flag_counts(_transcript_rows(spark, sf_dir), "video_id")


def worst_transcripts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flagged transcripts, most flags first, then least confidence, none being 1, with their report lines."""
    rows = stats.worst_first(_transcript_rows(spark, sf_dir), F.coalesce("avg_word_confidence", F.lit(1.0)), "video_id", TOP_N)
    return export.transcript_lines(rows)


def speech_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _events(spark, sf_dir).groupBy("user_id").agg(F.array_sort(F.collect_list(F.struct("pos", "start", "end"))).alias("s"), F.max("turn_end").alias("duration"))
    return rows.select("user_id", r6(quality.coverage(F.col("s"), F.col("duration"))).alias("speech_coverage_ratio"))


def _ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labels are a ledger; quality 1 is a success."""
    status = F.when(F.col("quality") == 1, F.lit("success")).otherwise(F.lit("failed"))
    return table(spark, sf_dir, "labels").select(F.col("doc_id").cast("string").alias("video_id"), status.alias("status"))


def _items(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select(F.col("doc_id").cast("string").alias("video_id"), "lang", "source", "n_chars")


def pending_work(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents to do: no success in the ledger, and no output; those of src1 have one."""
    items = _items(spark, sf_dir)
    finished = ledger.done(_ledger(spark, sf_dir), items.where("source = 'src1'"))
    return ledger.pending(items, finished).select("video_id", "source")


def run_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A dry run; documents need a transcript, which English ones have."""
    items = _items(spark, sf_dir)
    rows = ledger.classify(items, ledger.completed(_ledger(spark, sf_dir)), required=items.where("lang = 'en'"), verb="diarize")
    return ledger.summary(rows, ("skipped", "missing", "would_diarize"))


def dedup_stem(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id / 3 is a stem, so that three files share it."""
    rows = _items(spark, sf_dir).select(F.concat(F.lit("f"), F.floor(F.col("video_id").cast("long") / 3).cast("string")).alias("stem"), F.concat(F.lit("f"), F.floor(F.col("video_id").cast("long") / 3).cast("string"), F.lit("."), "video_id").alias("path"))
    return ledger.first_of_stem(rows)


def ledger_migration(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = ledger.migrate(_ledger(spark, sf_dir).withColumn("stale", F.lit(1)))
    return rows.groupBy("mode", "status", "title", "error").agg(F.count("*").alias("n"))


def first_labelled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first document that has a label."""
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    return ledger.first_with(docs.select("doc_id", "lang"), labels, ("doc_id",), "doc_id")


def key_comparison(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents of src0 against labelled ones."""
    return ledger.compare(table(spark, sf_dir, "documents").where("source = 'src0'"), table(spark, sf_dir, "labels"), ("doc_id",))


def numbered_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as files of their source, numbered, with their folder and the path below the root."""
    path = F.concat(F.lit("/data/"), "source", F.lit("/"), F.col("doc_id").cast("string"), F.lit(".json"))
    rows = ledger.numbered(table(spark, sf_dir, "documents").select("doc_id", "source", path.alias("path")), "doc_id", "source")
    return rows.select("doc_id", "i", "n", tx.parent(F.col("path")).alias("folder"), tx.relative_to(F.col("path"), F.lit("/data/")).alias("below"))


def reference_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labelled documents have a reference, blank where toxic; documents of even id have a transcript."""
    refs = table(spark, sf_dir, "labels").select(F.col("doc_id").alias("video_id"), F.when(F.col("toxic") == 1, F.lit(" \t")).otherwise(F.lit("said")).alias("reference"))
    hyps = table(spark, sf_dir, "documents").where("doc_id % 2 = 0").select(F.col("doc_id").alias("video_id"), F.col("text").alias("hypothesis"))
    return accuracy.coverage_counts(accuracy.covered(refs, hyps))


def caption_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages are caption files."""
    return table(spark, sf_dir, "pages").select("page_id", tx.caption_text(F.col("html")).alias("text"))


def topic_line(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", tx.topic(F.col("text")).alias("topic"))


def export_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labels are a title cache: toxic ones a known failure, quality 1 a title."""
    title = F.when(F.col("toxic") == 1, F.lit(None)).when(F.col("quality") == 1, F.concat(F.lit("Title "), F.col("doc_id").cast("string"))).otherwise(F.lit(""))
    titles = table(spark, sf_dir, "labels").select("doc_id", title.alias("title"))
    topics = export.with_topics(table(spark, sf_dir, "documents"), titles, "doc_id")
    return topics.select("doc_id", "topic", "title_source", F.md5(export.block_of(F.col("topic"), F.col("text")).cast("binary")).alias("block_md5"))


def combined_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The benchmark items as one export."""
    rows = table(spark, sf_dir, "benchmark").select("item_id", "text")
    text = export.combined(export.blocks(export.with_topics(rows, None, "item_id"), "item_id"), "item_id")
    return text.select(F.md5(F.col("text").cast("binary")).alias("text_md5"), F.length("text").alias("n_chars"))


def normalise_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", F.md5(tx.normalised(F.col("text")).cast("binary")).alias("normalised_md5"))


def text_scalars(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Small text functions over whole texts."""
    text, name = F.col("text"), F.concat(F.col("source"), F.lit(".v"), F.col("doc_id").cast("string"), F.lit(".json"))
    return table(spark, sf_dir, "documents").select(
        "doc_id", tx.last_line(text).alias("last_line"), tx.tail(text, 50).alias("tail"), tx.preview(text, 30).alias("preview"), tx.stem(name).alias("stem"),
        tx.language(F.when(F.col("lang") == "es", F.lit(" AUTO ")).otherwise(F.col("lang"))).alias("language"),
        F.md5(tx.first_sentence(tx.strip(text)).cast("binary")).alias("first_sentence_md5"),
    )


def _document_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document against one benchmark item: its number modulo the count of items is the item's place by item_id.

    Documents without a number get the first item; without any items the references are null. Items are numbered in one task:
    the benchmark is small.
    """
    bench = table(spark, sf_dir, "benchmark").select("item_id", F.col("text").alias("reference"))
    bench = bench.select((F.row_number().over(Window.orderBy("item_id", "reference")) - 1).cast("long").alias("place"), "reference")
    place = F.coalesce(F.pmod(F.col("doc_id"), F.lit(max(1, bench.count()))), F.lit(0)).cast("long")
    docs = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("video_id"), place.alias("place"), F.col("text").alias("hypothesis"))
    return docs.join(bench, "place", "left").select("video_id", "reference", "hypothesis")


def word_counts_of_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of every document and of its benchmark item."""
    rows = _document_pairs(spark, sf_dir)
    return rows.select("video_id", tx.word_count(F.col("reference")).alias("reference_word_count"), tx.word_count(F.col("hypothesis")).alias("hypothesis_word_count"))


def document_error_rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Word, character, match and information rates of every document against its benchmark item, whole texts. No SQL."""
    return accuracy.score(_document_pairs(spark, sf_dir))


def error_rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Speaker turns against the next turn of the conversation: word, character, match and information rates, whole texts."""
    return accuracy.score(_turn_pairs(spark, sf_dir))


def word_error_rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The word error rates of error_rates alone, which SQL can say."""
    rows = _turn_pairs(spark, sf_dir)
    return rows.select("video_id", r6(accuracy.word_rates(F.col("reference"), F.col("hypothesis"))["wer"]).alias("wer"))


def document_word_error_rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The word error rates of document_error_rates by bit-parallel distances."""
    rows = accuracy.dealt(_document_pairs(spark, sf_dir))
    return rows.select("video_id", r6(accuracy.word_error_rate(F.col("reference"), F.col("hypothesis"))).alias("wer"))


def worst_error_rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The report lines of the turns of highest word error rate."""
    return export.accuracy_lines(accuracy.worst(accuracy.score(_turn_pairs(spark, sf_dir)), "video_id", TOP_N))


def _turn_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    w = Window.partitionBy("conv_id").orderBy("turn")
    rows = table(spark, sf_dir, "conversations").select((F.col("conv_id") * 1000 + F.col("turn")).alias("video_id"), F.col("text").alias("reference"), F.lead("text").over(w).alias("hypothesis"))
    return rows.where("hypothesis is not null")


def _cer(rows: DataFrame) -> DataFrame:
    return rows.select("video_id", r6(accuracy.character_error_rate(F.col("reference"), F.col("hypothesis"))).alias("cer"))


def _worst_cer(rows: DataFrame) -> DataFrame:
    return accuracy.worst(rows.withColumnRenamed("cer", "wer"), "video_id", TOP_N).select("video_id", F.col("wer").alias("cer"))


def cer_of_turns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Character error rate of every turn against the next turn, in code points."""
    return _cer(_turn_pairs(spark, sf_dir))


def worst_turns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The turns of highest character error rate, of all turns."""
    return _worst_cer(cer_of_turns(spark, sf_dir))


def metadata_project(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages are info records; every other one lacks a web address."""
    host = F.regexp_extract("url", "^https?://([^/]+)", 1)
    info = table(spark, sf_dir, "pages").select(F.col("page_id").cast("string").alias("id"), host.alias("title"), F.when(F.col("page_id") % 2 == 0, F.col("url")).otherwise(F.lit("")).alias("webpage_url"), F.lit(None).cast("string").alias("other"), F.length("html").cast("double").alias("duration"), F.lit("x").alias("unknown"))
    rows = acquisition.metadata(info).select("id", "title", "duration", "was_live", "view_count")
    urls = info.select("id", acquisition.entry_url(F.col("webpage_url"), F.col("other"), F.col("id")).alias("url"))
    return rows.join(urls, "id")


def listing_entries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A listing of pages; those whose number divides by 7 have no id. The limit comes before."""
    rows = table(spark, sf_dir, "pages").select(F.col("page_id").alias("position"), F.when(F.col("page_id") % 7 == 0, F.lit("")).otherwise(F.col("page_id").cast("string")).alias("id"), "url")
    return acquisition.entries(rows, 100).select("position", "id")


def total_duration(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "documents").select(F.when(F.col("doc_id") % 5 != 0, F.col("n_chars") / 10).alias("duration"))
    return stats.total_duration(rows, factor=0.25).select(r6("total_duration").alias("total_duration"), r6("estimated_seconds").alias("estimated_seconds"))


def rate_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Part sizes with a unit by key."""
    unit = F.element_at(F.array(F.lit("k"), F.lit("M"), F.lit(" G "), F.lit("")), (F.col("p_partkey") % 4 + 1).cast("int"))
    return table(spark, sf_dir, "part").select("p_partkey", tx.rate_limit(F.concat(F.col("p_size").cast("string"), F.lit(".5"), unit)).alias("bytes_per_second"))


def backoff(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "nation").select("n_nationkey", tx.backoff(F.lit(5.0), F.lit(2.0), (F.col("n_nationkey") % 5).cast("int")).alias("waits"))
    return rows.select("n_nationkey", F.size("waits").alias("n_waits"), F.aggregate("waits", F.lit(0.0), lambda a, x: a + x).alias("total_wait"))


def download_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Modes, selectors and paths for nations as items."""
    audio, key = F.col("n_regionkey") % 2 == 0, F.col("n_nationkey").cast("string")
    value = F.when(F.col("n_nationkey") % 3 == 0, F.lit("lowest")).otherwise(F.lit("720"))
    requested = F.when(F.col("n_nationkey") % 4 == 0, F.array(F.concat(F.lit("/got/"), key))).otherwise(F.array().cast("array<string>"))
    return table(spark, sf_dir, "nation").select(
        "n_nationkey", acquisition.mode(audio).alias("mode"), acquisition.format_selector(audio, value).alias("selector"),
        acquisition.output_path(requested, F.lit("/out"), key, F.lit("mp4")).alias("path"), acquisition.codec(F.when(audio, F.lit("wav")).otherwise(F.lit("FLAC"))).alias("codec"),
    )


def pair_generation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pairs.prompt_response(table(spark, sf_dir, "conversations"))


def quality_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The report of flagged documents as one row of JSON, read back: counts, then ids and flags."""
    flagged = F.size("flags") > 0
    value = writers.report(_doc_quality(spark, sf_dir), stats.report_columns(), ["doc_id", "flags"], name="flagged_files", listed=flagged)
    found = F.from_json("value", "num_files long, num_flagged long, flagged_files array<struct<doc_id:long,flags:array<string>>>")
    each = F.transform("r.flagged_files", lambda f: F.concat_ws(":", f["doc_id"].cast("string"), F.array_join(f["flags"], ",")))
    return value.select(found.alias("r")).select("r.num_files", "r.num_flagged", F.size("r.flagged_files").alias("n_listed"), F.md5(F.array_join(each, ";").cast("binary")).alias("listed_md5"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    found = (
        word_count, repetition_score, doc_quality_flags, flagged_topn, flag_counts, report_counts, corpus_stats, stat_lines, speaker_stats, speaker_maps,
        target_speaker, target_distribution, target_segments, target_text, aligned_segments, kept_words, diarization_quality, worst_diarized, confidence_stats, speech_coverage, transcript_audit, transcript_flag_counts, worst_transcripts,
        pending_work, run_summary, dedup_stem, ledger_migration, first_labelled, key_comparison, numbered_files, reference_coverage, caption_clean, topic_line, export_blocks, combined_text, normalise_text,
        text_scalars, word_counts_of_documents, document_error_rates, document_word_error_rates, error_rates, word_error_rates, worst_error_rates, cer_of_turns, worst_turns, metadata_project, listing_entries, total_duration, rate_parse, backoff,
        download_plan, pair_generation, quality_report,
    )
    return {f.__name__: f for f in found}
