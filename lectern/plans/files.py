"""Queries that write the driver's tables as files, in the forms of sources and sinks, and read them back."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import stats
from ..functions import text as tx
from ..operators import alignment, export, ledger, models
from ..sources import keyed_files, readers, writers
from ..streaming import incremental
from . import queries as base

#: What a CSV field must survive.
ODD = 'a "quoted", part;\nnext \\ line é'


def _nations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return base.table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("key"), F.col("n_name").alias("name"), F.col("n_regionkey").alias("region"))


def listed_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as files of a key each, listed without their contents, numbered in the order of their names; empty ones aren't listed."""
    folder = writers.work_folder(spark, "media")
    name = F.concat("source", F.lit(" "), F.col("doc_id").cast("string"), F.lit(".v"), F.col("lang"))
    keyed_files.write(base.table(spark, sf_dir, "documents").select(name.alias("name"), "text"), folder, ".mp4", key="name", content="text")
    rows = ledger.numbered(readers.files(spark, folder).select("file_name", "stem", "length"), "file_name")
    return rows.select("file_name", "stem", "length", "i")


def json_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nations as transcript documents; those of region 0 are replaced by a second write, the others stay."""
    folder = writers.work_folder(spark, "documents")
    rows = _nations(spark, sf_dir)
    words = F.array(F.struct(F.lit(0.0).alias("start"), F.lit(1.0).alias("end"), F.col("name").alias("word"), F.lit(0.5).alias("probability")))
    segment = F.struct(F.lit(0).alias("id"), F.lit(0.0).alias("start"), F.col("key").cast("double").alias("end"), F.concat(F.lit("É "), "name").alias("text"), F.when(F.col("key") % 2 == 0, words).alias("words"))
    docs = rows.select("region", F.concat(F.lit("n "), F.col("key").cast("string")).alias("video_id"), F.col("key").cast("double").alias("duration"), F.array(segment).alias("segments"), F.lit("first").alias("text"))
    writers.write_documents(docs.drop("region"), folder)
    writers.write_documents(docs.where("region = 0").drop("region").withColumn("text", F.lit("second")), folder)
    got = readers.transcripts(spark, folder)
    return got.select("video_id", "duration", "text", F.col("segments")[0]["text"].alias("segment_text"), F.coalesce(F.size(F.col("segments")[0]["words"]), F.lit(0)).alias("n_words"), F.col("language").isNull().alias("no_language"))


def text_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark items as text files, the even ones first, then all: what is there already is skipped."""
    folder = writers.work_folder(spark, "texts")
    rows = base.table(spark, sf_dir, "benchmark").select(F.concat(F.lit("item "), F.col("item_id").cast("string")).alias("video_id"), "item_id", F.concat(F.lit(" "), "text", F.lit("\n\n")).alias("text"))
    writers.write_texts(rows.where("item_id % 2 = 0").select("video_id", "text"), folder)
    counts = writers.write_texts(rows.select("video_id", "text"), folder)
    read = readers.references(spark, folder).select("video_id", F.md5(F.col("text").cast("binary")).alias("text_md5"))
    return read.crossJoin(F.broadcast(counts))  # one row


def caption_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as caption files, read, and written again beside their parsed texts; both are read back."""
    raw, out = writers.work_folder(spark, "captions"), writers.work_folder(spark, "parsed")
    cue = F.concat(F.lit("WEBVTT\nKind: captions\n\n1\n00:01.000 --> 00:02.000\nHost A: <b>"), "source", F.lit("</b> (laughs\n\n2\n00:02.000 --> 00:03.000\nloud)  has "), F.col("doc_id").cast("string"), F.lit("\n"))
    rows = base.table(spark, sf_dir, "documents").select(F.concat(F.lit("doc "), F.col("doc_id").cast("string")).alias("video_id"), cue.alias("text"))
    keyed_files.write(rows, raw, ".vtt", key="video_id", content="text")
    writers.write_caption_files(readers.captions(spark, raw), out)
    return readers.captions(spark, out).withColumnRenamed("text", "raw").join(readers.references(spark, out).withColumnRenamed("text", "parsed"), "video_id").select("video_id", "parsed", F.length("raw").alias("raw_length"))


def written_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The combined export of all documents as files in order, read back: each block's place, and what it says."""
    folder = writers.work_folder(spark, "blocks")
    writers.write_blocks(export.blocks(export.with_topics(base.table(spark, sf_dir, "documents").select("doc_id", "text"), None, "doc_id"), "doc_id"), folder, "doc_id")
    parts = spark.read.text(folder, wholetext=True).select(F.col("_metadata.file_name").alias("file"), F.posexplode(F.split("value", export.RULE)).alias("pos", "block"))
    named = parts.where("block <> ''").select(F.concat("file", F.lpad(F.col("pos").cast("string"), 12, "0")).alias("place"), F.md5(F.col("block").cast("binary")).alias("block_md5"))
    return ledger.numbered(named, "place").select("i", "block_md5")


def ledger_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labels as a ledger that two runs append to, of the older layout without a mode; odd texts survive, read with the mode."""
    path = writers.work_folder(spark, "ledger")
    rows = base.table(spark, sf_dir, "labels").select(F.col("doc_id").cast("string").alias("video_id"), F.when(F.col("quality") == 1, F.lit("success")).otherwise(F.lit("failed")).alias("status"), F.when(F.col("toxic") == 1, F.lit(ODD)).alias("error"))
    for run in (rows.where("status = 'failed'"), rows):
        writers.append_ledger(run, path, ("video_id", "status", "error"))
    got = readers.read_ledger(spark, path)
    done = ledger.completed(got, ("video_id", "mode")).count()
    return got.groupBy("mode", "status", F.md5(F.col("error").cast("binary")).alias("error_md5")).agg(F.count("*").alias("n")).withColumn("n_done", F.lit(done).cast("long"))


def title_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as a title cache, with a known failure for those of src0."""
    path = writers.work_folder(spark, "titles")
    title = F.when(F.col("source") != "src0", F.concat("source", F.lit(' "of" '), F.col("doc_id").cast("string")))
    writers.write_titles(base.table(spark, sf_dir, "documents").select(F.col("doc_id").cast("string").alias("video_id"), title.alias("title")), path, entries=300)
    return readers.titles(spark, path)


def mirrored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers by nation copied twice, and mirrored: the copy keeps what the second source lacks, the mirror doesn't."""
    root = writers.work_folder(spark, "mirror")
    rows = base.table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    late = rows.where("c_nationkey < 5").select((F.col("c_custkey") + 1_000_000).alias("c_custkey"), "c_nationkey")
    for delete, name in ((False, "copy"), (True, "mirror")):
        for source in (rows, late):
            writers.mirror_targets({"copy": source, "mirror": source}, root, "c_nationkey", only=[name], delete=delete)
    read = lambda n: spark.read.parquet(f"{root}/{n}").select(F.lit(n).alias("target"), F.col("c_nationkey").cast("int").alias("c_nationkey"), "c_custkey")
    return read("copy").union(read("mirror")).groupBy("target", "c_nationkey").agg(F.count("*").alias("n"), F.max("c_custkey").alias("last"))


def report_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The audit of all documents as a report of any size, its lines in order; read back."""
    path = writers.work_folder(spark, "report")
    writers.write_report_table(base._doc_quality(spark, sf_dir).select("doc_id", "word_count", "flags"), stats.report_columns(), path, order="doc_id")
    counts = spark.read.json(f"{path}/summary")
    files = spark.read.schema("doc_id long, word_count int, flags array<string>").json(f"{path}/files")
    return files.select("doc_id", "word_count", F.array_join("flags", ",").alias("flags")).crossJoin(F.broadcast(counts))  # one row


def streamed_outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents in two deliveries through the stream, then a batch over all: one that failed is tried again, one that succeeded isn't."""
    folder, book, checkpoint = (writers.work_folder(spark, n) for n in ("in", "outcomes", "checkpoint"))
    rows = base.table(spark, sf_dir, "documents").select(F.col("doc_id").cast("string").alias("video_id"))

    def process(todo: DataFrame) -> DataFrame:
        failed = F.col("video_id").cast("long") % 10 == 3
        return todo.select("video_id", F.when(failed, F.lit("failed")).otherwise(F.lit("success")).alias("status"), F.when(failed, F.lit("no")).alias("error"))

    for part in (rows.where("video_id % 2 = 0"), rows):
        part.coalesce(1).write.mode("append").parquet(folder)
        incremental.follow(spark, folder, rows.schema, book, checkpoint, process).awaitTermination()
    incremental.run_pending(spark.read.schema(rows.schema).parquet(folder).distinct(), book, process)
    return incremental.read_outcomes(spark, book).groupBy("video_id", "status", "error").agg(F.count("*").alias("n"))


def _shouting():
    def model(row: dict) -> dict:
        if row["key"] % 7 == 3:
            raise RuntimeError(f"nation {row['key']} " + "x" * 600)
        words = [{"start": 0.0, "end": 1.0, "word": f" {row['name']}", "probability": 0.5}] if row["key"] % 2 else []
        return {"language": "en", "duration": 2.0, "segments": [{"id": 0, "start": 0.0, "end": 1.0, "text": f"  {row['name']} \n", "words": words}, {"id": 1, "start": 1.0, "end": 2.0, "text": "\tend"}]}

    return model


def retry_schedule(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents through a stream and two calls for what is due: the first at once, when nothing is, the second an hour on.
    One in ten always fails, one in twenty succeeds in the end; each key's tries, and the seconds that it waits for the next.
    """
    folder, book, checkpoint = (writers.work_folder(spark, n) for n in ("in", "outcomes", "checkpoint"))
    rows = base.table(spark, sf_dir, "documents").select(F.col("doc_id").cast("string").alias("video_id"))
    rows.write.parquet(folder)
    items = spark.read.schema(rows.schema).parquet(folder)

    def process(late: bool):
        number = F.col("video_id").cast("long")
        failed = (number % 10 == 3) & ~((number % 20 == 3) & F.lit(late))
        return lambda todo: todo.select("video_id", F.when(failed, F.lit("failed")).otherwise(F.lit("success")).alias("status"), F.when(failed, F.lit("no")).alias("error"))

    incremental.follow(spark, folder, rows.schema, book, checkpoint, process(False)).awaitTermination()
    incremental.run_due(items, book, process(True), attempts=3, wait=60.0)
    incremental.run_due(items, book, process(True), attempts=3, wait=60.0, now=F.current_timestamp() + F.expr("interval 1 hour"))
    found = incremental.read_outcomes(spark, book)
    last = found.where("status = 'failed'").groupBy("video_id").agg(F.max("timestamp").alias("_last"))
    waits = incremental.schedule(found, wait=60.0).join(last, "video_id").select("video_id", "attempts", (F.unix_seconds("due") - F.unix_seconds(F.to_timestamp("_last"))).alias("wait_seconds"))
    tries = found.groupBy("video_id").agg(F.count("*").alias("n_tries"), F.count_if(F.col("status") == "success").alias("n_success"))
    return tries.join(waits, "video_id", "left")


def stem_rounds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as files of which up to five share a stem; one in three can be read. A stem's files are tried in order until one can."""
    number = F.concat(F.lit("f"), F.floor(F.col("doc_id") / 5).cast("string"))
    items = base.table(spark, sf_dir, "documents").select(number.alias("stem"), F.concat(number, F.lit("."), (F.col("doc_id") % 5).cast("string")).alias("path"), "n_chars")
    failed = F.when(F.col("n_chars") % 3 != 0, F.concat(F.lit("cannot read "), "path"))
    return ledger.rounds(items, lambda todo: todo.withColumn("error", failed), writers.work_folder(spark, "rounds")).select("path", "status", "error")


def model_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nations through a model that fails for some: outcomes beside the assembled transcripts."""
    rows = _nations(spark, sf_dir).withColumn("video_id", F.col("key").cast("string"))
    path = writers.work_folder(spark, "said")
    models.apply_model(rows, "shouting", _shouting, f"struct<{_SPEECH}>", attempts=2, wait=0.0).write.parquet(path)  # once a row
    said = spark.read.parquet(path)
    docs = models.transcript_documents(said.where("error is null").withColumn("source_audio", F.lit("a")), size="s", device="d", compute_type="c")
    stamped = F.col("transcribed_at").rlike(r"^[0-9]{4}-[0-9]{2}-[0-9]{2}T[0-9:.]{15}\+00:00$")
    docs = docs.select("video_id", "text", F.transform("segments", lambda s: F.coalesce(F.size(s["words"]), F.lit(-1))).alias("w"), stamped.alias("stamped"))
    out = models.outcomes(said).join(docs, "video_id", "left")
    return out.select("video_id", "status", F.length("error").alias("error_length"), "text", F.array_join(F.transform("w", lambda x: x.cast("string")), ",").alias("words"), "stamped")


_SPEECH = "language:string,language_probability:double,duration:double,segments:array<struct<id:int,start:double,end:double,text:string,words:array<struct<start:double,end:double,word:string,probability:double>>>>"


def flat_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The transcripts' words in document order; a segment without words is one word, its text."""
    rows = alignment.flat_words(base._transcripts(spark, sf_dir))
    return rows.groupBy("video_id").agg(F.count("*").alias("n"), F.md5(F.array_join(F.array_sort(F.collect_list(F.struct("seg_pos", "word_pos", "word")))["word"], "").cast("binary")).alias("words_md5"))


def ordered_turns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each user's events as turns, handed in backwards, by start; equal starts keep the order they were handed in."""
    rows = base.table(spark, sf_dir, "events").select("user_id", "event_id", F.col("event_type").alias("speaker"), F.floor(F.col("value")).cast("double").alias("start"))
    turns = F.transform(F.array_sort(F.collect_list(F.struct((-F.col("event_id")).alias("o"), "speaker", "start"))), lambda t: F.struct(t["speaker"].alias("speaker"), t["start"].alias("start"), t["start"].alias("end"), (-t["o"]).alias("event_id")))
    found = rows.groupBy("user_id").agg(turns.alias("turns"))
    return found.select("user_id", F.md5(F.array_join(F.transform(alignment.ordered_turns(F.col("turns")), lambda t: t["event_id"].cast("string")), ",").cast("binary")).alias("order_md5"))


def nested_kept_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    """kept_words over nested turns, without a join."""
    rows = base._events(spark, sf_dir)
    word, turn = F.struct("start", "end"), F.struct("start", F.col("turn_end").alias("end"))
    docs = rows.groupBy("user_id").agg(F.collect_list(word).alias("words"), F.collect_list(F.when(F.col("speaker") == "purchase", turn)).alias("turns"))
    kept = F.size(F.filter("words", lambda w: alignment.in_turn_array((w["start"] + w["end"]) / 2, F.col("turns"))))
    return docs.select("user_id", kept.cast("long").alias("n")).where("n > 0")


def real_time_factors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nation keys as seconds of sound, 70 seconds of work."""
    factor = stats.real_time_factor(F.lit(70.0), F.col("key").cast("double"))
    return _nations(spark, sf_dir).select("key", base.r6(factor).alias("factor"), base.r6(1 / factor).alias("speed_up"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    found = (listed_files, json_documents, text_files, caption_files, written_blocks, ledger_files, title_file, mirrored, report_table, streamed_outcomes, retry_schedule, stem_rounds, model_documents, flat_words, ordered_turns, nested_kept_words, real_time_factors)
    return {f.__name__: f for f in found}


def oracle_sql() -> dict[str, str]:
    from . import oracle

    odd = "'" + ODD.replace("'", "''").replace("\n", "' || chr(10) || '") + "'"
    return {
        "listed_files": "select source || ' ' || doc_id || '.v' || lang || '.mp4' as file_name, source || ' ' || doc_id || '.v' || lang as stem, cast(strlen(text) as bigint) as length, row_number() over (order by source || ' ' || doc_id || '.v' || lang || '.mp4') as i from documents where strlen(text) > 0",
        "json_documents": "select 'n ' || n_nationkey as video_id, n_nationkey::double as duration, case when n_regionkey = 0 then 'second' else 'first' end as text, 'É ' || n_name as segment_text, case when n_nationkey % 2 = 0 then 1 else 0 end as n_words, true as no_language from nation",
        "text_files": f"""select 'item ' || item_id as video_id, md5({oracle.strip('text')} || chr(10)) as text_md5, cast((select count(*) from benchmark where item_id % 2 <> 0) as bigint) as exported,
            cast((select count(*) from benchmark where item_id % 2 = 0) as bigint) as skipped from benchmark""",
        "caption_files": "select 'doc ' || doc_id as video_id, source || ' has ' || doc_id as parsed, cast(length(source) + length(cast(doc_id as varchar)) + 112 as integer) as raw_length from documents",
        "written_blocks": f"""select row_number() over (order by doc_id) as i, md5('Topic: ' || {oracle.topic('text')} || chr(10) || 'Text: ' || {oracle.strip("coalesce(text, '')")} || chr(10)) as block_md5 from documents""",
        "ledger_files": f"""with r as (select *, case when quality = 1 then 'success' else 'failed' end as status from labels), a as (select * from r union all select * from r where status = 'failed')
            select 'video' as mode, status, md5(case when toxic = 1 then {odd} else '' end) as error_md5, count(*) as n, (select count(distinct doc_id) from r where status = 'success') as n_done from a group by all""",
        "title_file": """select cast(doc_id as varchar) as video_id, case when source <> 'src0' then source || ' "of" ' || doc_id end as title from documents""",
        "mirrored": """with l as (select c_custkey + 1000000 as c_custkey, c_nationkey from customer where c_nationkey < 5), c as (select 'copy' as target, * from l union all select 'copy', c_custkey, c_nationkey from customer where c_nationkey >= 5 union all select 'mirror', * from l)
            select target, cast(c_nationkey as integer) as c_nationkey, count(*) as n, max(c_custkey) as last from c group by all""",
        "report_table": f"with {oracle.DOC_QUALITY} select doc_id, word_count, array_to_string(flags, ',') as flags, (select count(*) from q) as num_files, (select count(*) from q where len(flags) > 0) as num_flagged from q",
        "streamed_outcomes": "select cast(doc_id as varchar) as video_id, case when doc_id % 10 = 3 then 'failed' else 'success' end as status, case when doc_id % 10 = 3 then 'no' else '' end as error, case when doc_id % 10 = 3 then 2 else 1 end::bigint as n from documents",
        "retry_schedule": """select cast(doc_id as varchar) as video_id, case when doc_id % 10 = 3 then 2 else 1 end::bigint as n_tries, case when doc_id % 10 = 3 and doc_id % 20 <> 3 then 0 else 1 end::bigint as n_success,
            case when doc_id % 10 = 3 and doc_id % 20 <> 3 then 2 end::bigint as attempts, case when doc_id % 10 = 3 and doc_id % 20 <> 3 then 120 end::bigint as wait_seconds from documents""",
        "stem_rounds": """with f as (select 'f' || (doc_id // 5) as stem, 'f' || (doc_id // 5) || '.' || (doc_id % 5) as path, n_chars % 3 = 0 as ok from documents),
            b as (select *, coalesce(bool_or(ok) over (partition by stem order by path rows between unbounded preceding and 1 preceding), false) as over from f)
            select path, case when over then 'skipped' when ok then 'succeeded' else 'failed' end as status, case when not over and not ok then 'cannot read ' || path end as error from b""",
        "model_documents": """select cast(n_nationkey as varchar) as video_id, case when n_nationkey % 7 = 3 then 'failed' else 'success' end as status, case when n_nationkey % 7 = 3 then 500 else 0 end as error_length,
            case when n_nationkey % 7 <> 3 then n_name || ' end' end as text, case when n_nationkey % 7 = 3 then null when n_nationkey % 2 = 1 then '1,-1' else '-1,-1' end as words, case when n_nationkey % 7 <> 3 then true end as stamped from nation""",
        "flat_words": f"with {oracle.TRANSCRIPTS} select cast(user_id as varchar) as video_id, count(*) as n, md5(string_agg(case when user_id % 8 <> 0 then ' ' else '' end || word, '' order by pos)) as words_md5 from v1 group by user_id",
        "ordered_turns": "select user_id, md5(string_agg(cast(event_id as varchar), ',' order by floor(value), event_id desc)) as order_md5 from events group by user_id",
        "nested_kept_words": oracle.oracle_sql()["kept_words"],
        "real_time_factors": "select n_nationkey as key, case when n_nationkey > 0 then round(70.0::double / n_nationkey, 6) end as factor, case when n_nationkey > 0 then round(n_nationkey / 70.0::double, 6) end as speed_up from nation",
    }
