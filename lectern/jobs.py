"""Whole jobs: list, leave out what is done, run the caller's model, write documents and ledger, count outcomes.

A job returns one row of counts. Models and encoders are the caller's callables (operators/models.py); a failed recording is
a ledger row and is tried again by the next run. What a model gave is written before it is used, so it runs once a recording.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .functions import stats
from .functions.text import caption_text, strip, utc_now
from .operators import accuracy, acquisition, alignment, export, ledger, models, quality
from .schemas import METADATA
from .sources import readers, settings, writers


def _ledger(spark: SparkSession, path: str, columns: Sequence[str]) -> DataFrame:
    return readers.read_ledger(spark, path, columns)


def _run(items: DataFrame, finished: DataFrame, done_by: Callable[[DataFrame], DataFrame], save: Callable[[DataFrame], None], book: str, columns: tuple[str, ...], work: str, verb: str, *, order: str, key: Sequence[str] = ("video_id",), required: DataFrame | None = None, dry_run: bool = False) -> DataFrame:
    """The frame of every job: done_by() gives items a result and an error, save() writes those without an error.

    Items that share a key are tried in their order, the next only if the one before failed; a success leaves the rest of
    its key skipped. A dry run counts them all.
    """
    spark = items.sparkSession
    rows = ledger.classify(items, finished, key, required=required, dry_run=dry_run, verb=verb)
    names = ("skipped", "missing", f"would_{verb}") if dry_run else ("skipped", "missing", "succeeded", "failed")
    if dry_run:
        return ledger.summary(rows, names)

    def after(done: DataFrame) -> None:
        save(done.where("error is null"))
        status = F.when(F.col("error").isNull(), F.lit("success")).otherwise(F.lit("failed"))
        writers.append_ledger(done.withColumn("status", status).withColumn("timestamp", utc_now()), book, columns)

    at = f"{work.rstrip('/')}/_run-{uuid.uuid4().hex}"
    try:
        rows.write.parquet(f"{at}/all")  # before anything is done that would change it
        rows = spark.read.parquet(f"{at}/all")
        tried = ledger.rounds(rows.where("status = 'pending'").drop("status"), done_by, at, key=key, order=(order,), after=after)
        counts = ledger.summary(rows.select("status").where("status <> 'pending'").union(tried.select("status")), names).first()
    finally:
        readers.delete(spark, at)
    return spark.createDataFrame([tuple(counts)], ", ".join(f"{c} long" for c in (*names, "total")))


def _outputs(spark: SparkSession, folder: str) -> DataFrame:
    """The keys that have a document in a folder, `<key>.json` or in a folder of the key."""
    if not readers.exists(spark, folder):
        return spark.createDataFrame([], "video_id string")
    return readers.files(spark, folder, "*.json").select(F.col("stem").alias("video_id")).union(readers.folders(spark, folder, "video_id"))


def _audio(spark: SparkSession, folder: str, source: str) -> DataFrame:
    """The files of a folder; those that share a stem are one recording, in the order of their paths."""
    return readers.files(spark, folder).select(F.col("stem").alias("video_id"), F.col("path").alias(source))


def transcribe(spark: SparkSession, config: settings.Transcription, load: Callable[[], Callable[[dict], dict]], *, dry_run: bool = False, attempts: int = 1) -> DataFrame:
    """Speech to text of every audio file that has no transcript: the model gets video_id and source_path and says SPEECH."""
    out, book, model = config.output.transcripts_dir, config.output.history_file, config.model
    items = _audio(spark, config.input.audio_dir, "source_path")
    finished = ledger.done(_ledger(spark, book, ledger.TRANSCRIPTION), _outputs(spark, out))

    def done_by(todo: DataFrame) -> DataFrame:
        said = models.apply_model(todo, "speech", load, f"struct<{_struct(models.SPEECH)}>", attempts=attempts, wait=0)
        return todo.join(said, "video_id").withColumn("output_path", F.when(F.col("error").isNull(), writers.document_path(out, F.col("video_id"))))

    def save(done: DataFrame) -> None:
        docs = models.transcript_documents(done.withColumnRenamed("source_path", "source_audio"), size=model.size, device=model.device, compute_type=model.compute_type)
        writers.write_documents(docs, out)

    return _run(items, finished, done_by, save, book, ledger.TRANSCRIPTION, out, "transcribe", order="source_path", dry_run=dry_run)


def _struct(ddl: str) -> str:
    """Columns as DDL to the fields of a struct."""
    from pyspark.sql.types import StructType

    return StructType.fromDDL(ddl).simpleString()[len("struct<") : -1]


def diarize(spark: SparkSession, config: settings.Diarization, load: Callable[[], Callable[[dict], dict]], *, dry_run: bool = False, attempts: int = 1) -> DataFrame:
    """Target speaker's words of every audio file that has a transcript: the model gets video_id and source_audio and gives
    TURNS; none is an error.
    """
    out, book = config.output.diarized_dir, config.output.history_file
    items = _audio(spark, config.input.audio_dir, "source_audio")
    texts = readers.transcripts(spark, config.input.transcripts_dir)
    finished = ledger.done(_ledger(spark, book, ledger.DIARIZATION), _outputs(spark, out))

    def done_by(todo: DataFrame) -> DataFrame:
        said = models.apply_model(todo, "speakers", load, f"struct<{_struct(models.TURNS)}>", attempts=attempts, wait=0)
        none = F.col("error").isNull() & (F.size(F.coalesce("result.turns", F.array())) == 0)
        said = said.withColumn("error", F.when(none, F.lit("no speech turns")).otherwise(F.col("error")))
        return todo.join(said, "video_id").withColumn("output_path", F.when(F.col("error").isNull(), writers.document_path(out, F.col("video_id"))))

    def save(done: DataFrame) -> None:
        turns = done.select("video_id", F.inline("result.turns"))
        docs = alignment.isolate(texts.select("video_id", "duration", "segments").join(done.select("video_id"), "video_id", "left_semi"), turns, strategy=config.target_speaker.strategy)
        writers.write_documents(docs.join(done.select("video_id", "source_audio"), "video_id").withColumn("diarized_at", utc_now()), out)

    return _run(items, finished, done_by, save, book, ledger.DIARIZATION, out, "diarize", order="source_audio", required=texts.select("video_id"), dry_run=dry_run)


def extract_audio(spark: SparkSession, config: settings.Audio, load: Callable[[], Callable[[dict], dict]], *, dry_run: bool = False) -> DataFrame:
    """Sound of every video without it: the encoder gets video_id, source_path, output_path, codec, sample_rate, channels and writes the file."""
    made, how, book = config.output.audio_dir, config.extract, config.output.history_file
    if how.format.lower() not in acquisition.CODECS:
        raise ValueError(f"unsupported audio format: {how.format}")
    items = _audio(spark, config.input.videos_dir, "source_path")
    finished = ledger.done(_ledger(spark, book, ledger.AUDIO), readers.files(spark, made).select(F.col("stem").alias("video_id")))

    def done_by(todo: DataFrame) -> DataFrame:
        path = F.concat(F.lit(f"{made}/"), "video_id", F.lit(f".{how.format}"))
        asked = todo.select("*", path.alias("output_path"), acquisition.codec(F.lit(how.format)).alias("codec"), F.lit(how.sample_rate).alias("sample_rate"), F.lit(how.channels).alias("channels"))
        return asked.join(models.apply_model(asked, "encoder", load, "struct<ok:boolean>"), "video_id")

    return _run(items, finished, done_by, lambda done: None, book, ledger.AUDIO, made, "extract", order="source_path", dry_run=dry_run)


def download(spark: SparkSession, config: settings.Acquisition, listing: DataFrame, load: Callable[[], Callable[[dict], dict]], *, dry_run: bool = False, sleep: Callable[[float], None] | None = None) -> DataFrame:
    """Every entry of a listing (position, id, title, webpage_url, url) that isn't there: the fetcher gets video_id, url, mode,
    selector and gives a metadata record. What failed is tried again after growing waits, in which no core is held.
    """
    how, out, book = config.download, config.output, config.output.history_file
    audio, folder = F.lit(how.audio_only), out.audio_dir if how.audio_only else out.videos_dir
    rows = acquisition.entries(listing, config.playlist.max_items)
    items = rows.select(
        F.col("id").alias("video_id"), F.coalesce(F.nullif("title", F.lit("")), "id").alias("title"), acquisition.entry_url(F.col("webpage_url"), F.col("url"), F.col("id")).alias("url"),
        acquisition.mode(audio).alias("mode"), acquisition.format_selector(audio, F.lit(how.quality)).alias("selector"), F.col("position"),
    )
    key = ("video_id", "mode")
    there = readers.files(spark, folder).select(F.col("stem").alias("video_id"), acquisition.mode(audio).alias("mode"))
    finished = ledger.done(_ledger(spark, book, ledger.DOWNLOAD), there, key)

    tries: list[str] = []

    def done_by(todo: DataFrame) -> DataFrame:
        waits = {} if sleep is None else {"sleep": sleep}
        tries.append(f"{out.metadata_dir.rstrip('/')}/_tries-{uuid.uuid4().hex}")
        once = lambda rows: models.apply_model(rows, "fetcher", load, f"struct<{_struct(METADATA)},requested:array<string>>")
        got = models.retried(todo, once, tries[-1], attempts=config.retry.max_retries, wait=config.retry.retry_delay_seconds, factor=config.retry.backoff_factor, **waits)
        path = acquisition.output_path(F.coalesce("result.requested", F.array().cast("array<string>")), F.lit(folder), F.col("video_id"), F.coalesce("result.ext", F.lit(how.format)))
        return todo.join(got, "video_id").withColumn("output_path", F.when(F.col("error").isNull(), path))

    def save(done: DataFrame) -> None:
        info = done.select("result.*", F.col("video_id").alias("_id"), F.col("url").alias("_url"))
        docs = acquisition.metadata(info.withColumn("id", F.coalesce("id", "_id")).withColumn("url", F.coalesce("url", "_url")).withColumn("downloaded_at", utc_now()))
        writers.write_documents(docs, out.metadata_dir, "id")

    try:
        return _run(items, finished, done_by, save, book, ledger.DOWNLOAD, out.metadata_dir, "download", order="position", key=key, dry_run=dry_run)
    finally:
        for at in tries:
            readers.delete(rows.sparkSession, at)


def fetch(items: DataFrame, existing: DataFrame, load: Callable[[], Callable[[dict], dict]], work: str, *, key: str = "video_id", attempts: int = 3) -> tuple[DataFrame, DataFrame]:
    """(key, text) that a fetcher found for the items that aren't among the existing ones, and one row of counts: existing,
    fetched, none, failed, total. For captions and titles; the fetcher gives {"text": ...}, null if there is none. What it
    gave stands in `work` as a table.
    """
    spark = items.sparkSession
    todo = items.join(existing.select(key).distinct(), key, "left_anti")
    models.apply_model(todo, f"fetch {work}", load, "struct<text:string>", key=key, attempts=attempts, wait=0).write.mode("overwrite").parquet(work)
    got = spark.read.parquet(work)
    outcome = F.when(F.col("error").isNotNull(), F.lit("failed")).when(F.col("result.text").isNull(), F.lit("none")).otherwise(F.lit("fetched"))
    old = items.join(existing.select(key).distinct(), key, "left_semi").select(F.lit("existing").alias("status"))
    return got.where("result.text is not null").select(key, "result.text"), ledger.summary(old.union(got.select(outcome.alias("status"))), ("existing", "fetched", "none", "failed"))


def fetch_references(items: DataFrame, folder: str, load: Callable[[], Callable[[dict], dict]], work: str) -> DataFrame:
    """Caption files of the items, `<video_id>.vtt` and parsed `<video_id>.txt`, in `folder`; the counts of fetch()."""
    existing = readers.files(items.sparkSession, folder, "*.txt").select(F.col("stem").alias("video_id"))
    found, counts = fetch(items, existing, load, work)
    writers.write_caption_files(found, folder)
    return counts


def _audit(rows: DataFrame, metrics: Sequence[str], path: str | None, order: Column, top_n: int, lines: Callable[[DataFrame], DataFrame]) -> dict[str, DataFrame]:
    if path:
        writers.write_report_table(rows, stats.report_columns(), path, order="video_id")
    return {
        "files": rows, "counts": stats.report_counts(rows), "stats": stats.corpus_stats(rows, metrics), "flag_counts": stats.flag_counts(rows, "video_id"),
        "worst": lines(stats.worst_first(rows, order, "video_id", top_n)),
    }


TRANSCRIPT_METRICS = ("avg_word_confidence", "low_confidence_word_ratio", "words_per_second", "speech_coverage_ratio", "repetition_score")
DIARIZATION_METRICS = ("num_speakers", "target_speaker_share", "target_turn_count", "num_target_segments", "avg_target_segment_seconds", "short_turn_ratio", "target_word_count", "target_words_per_second", "target_text_retention_ratio", "repetition_score")


def evaluate_transcripts(spark: SparkSession, folder: str, report: str | None = None, top_n: int = 20) -> dict[str, DataFrame]:
    """files, counts, stats, flag_counts and worst lines of the transcripts in a folder; the report is written if a path is given."""
    rows = quality.transcript_quality(readers.transcripts(spark, folder))
    return _audit(rows, TRANSCRIPT_METRICS, report, F.coalesce("avg_word_confidence", F.lit(1.0)), top_n, export.transcript_lines)


def evaluate_diarization(spark: SparkSession, folder: str, transcripts: str, report: str | None = None, top_n: int = 25) -> dict[str, DataFrame]:
    """The same of diarized documents, with the word counts of their transcripts."""
    counts = readers.transcripts(spark, transcripts).select("video_id", F.size(quality.words(F.col("text"))).alias("full_transcript_word_count"))
    rows = quality.diarization_quality(readers.diarized(spark, folder), counts)
    return _audit(rows, DIARIZATION_METRICS, report, F.col("target_speaker_share"), top_n, export.diarization_lines)


def score_transcripts(spark: SparkSession, references: str, transcripts: str, top_n: int = 20) -> dict[str, DataFrame]:
    """files, counts, stats and worst lines: error rates of transcripts against reference texts (a .txt file each)."""
    refs = readers.references(spark, references).withColumnRenamed("text", "reference")
    hyps = readers.transcripts(spark, transcripts).select("video_id", F.col("text").alias("hypothesis"))
    rows = accuracy.covered(refs, hyps)
    scores = accuracy.score(rows.where("bucket = 'scored'"))
    return {"files": scores, "counts": accuracy.coverage_counts(rows), "stats": stats.corpus_stats(scores, ("wer", "cer", "mer", "wil")), "worst": export.accuracy_lines(accuracy.worst(scores, top_n=top_n))}


def export_texts(spark: SparkSession, transcripts: str, folder: str, *, overwrite: bool = False) -> DataFrame:
    """A stripped text for each transcript; one row: exported, skipped."""
    return writers.write_texts(readers.transcripts(spark, transcripts).select("video_id", "text"), folder, overwrite=overwrite)


def export_target_texts(spark: SparkSession, diarized: str, folder: str, titles: DataFrame | None = None) -> DataFrame:
    """Topic and text blocks of the target speakers, in the order of their ids, as files of one folder; the rows written."""
    rows = readers.diarized(spark, diarized).select("video_id", strip(F.coalesce("target_speaker_text", F.lit(""))).alias("text"))
    blocks = export.blocks(export.with_topics(rows, titles))
    writers.write_blocks(blocks, folder)
    return blocks
