"""Queries of cleaning, chunks, retrieval and answer metrics, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as tx
from ..operators import answers, chunking, vectors
from ..sources import writers
from . import oracle
from . import queries as base


def _spoken() -> Column:
    """Documents are given fillers: in front, and before each sentence."""
    return F.concat(F.lit("Um, uh "), F.regexp_replace("text", r"([.!?]) ", "$1  er, "))


def cleaned_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return base.table(spark, sf_dir, "documents").select("doc_id", F.md5(answers.clean(_spoken()).cast("binary")).alias("clean_md5"))


def sentence_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = answers.chunks(base.table(spark, sf_dir, "documents"), "doc_id", max_words=100)
    return rows.select("doc_id", "chunk", "n_words", F.md5(F.col("text").cast("binary")).alias("text_md5"))


def topic_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents in chunks that end where their words change. No SQL."""
    rows = chunking.topic_chunks(base.table(spark, sf_dir, "documents"), "doc_id", max_words=100)
    return rows.select("doc_id", "chunk", "n_words", F.md5(F.col("text").cast("binary")).alias("text_md5"))


def rouge_l(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Turns against the next turn, by their longest common subsequences of words."""
    rows = base._turn_pairs(spark, sf_dir)
    return rows.select("video_id", base.r6(answers.rouge_l(F.col("reference"), F.col("hypothesis"))).alias("rouge_l"))


def retrieved(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The vectors whose number divides by 50 ask all others and themselves."""
    rows = base.table(spark, sf_dir, "embeddings")
    rows = answers.retrieve(rows, _asked(rows))
    return rows.select("query_id", "rank", "vec_id", base.r6("score").alias("score"))


def _asked(rows: DataFrame) -> DataFrame:
    return rows.where("vec_id % 50 = 0").select(F.col("vec_id").alias("query_id"), "embedding")


def _indexed(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, str, DataFrame]:
    """The table, its index's folder, and what the queries of retrieved() find by it."""
    rows, path = base.table(spark, sf_dir, "embeddings"), writers.work_folder(spark, "index")
    model = vectors.fit(rows)
    vectors.write_index(rows, model, path)
    return rows, path, vectors.search(spark, path, model, _asked(rows)).withColumnRenamed("key", "vec_id")


def indexed_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """retrieved() by the index: about the ten nearest. No SQL; index_report() measures it."""
    return _indexed(spark, sf_dir)[2].select("query_id", "rank", "vec_id", base.r6("score").alias("score"))


def index_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The index against exact retrieval: its rows, the queries, whether 0.9 of the exact answers are among its own, and
    whether every score it returned is the pair's cosine.
    """
    rows, path, found = _indexed(spark, sf_dir)
    exact = vectors.nearest(rows, _asked(rows))
    both = exact.select("query_id", "vec_id").join(found.select("query_id", "vec_id", F.lit(1).alias("hit")), ["query_id", "vec_id"], "left")
    recall = both.agg((F.count("hit") / F.count("*")).alias("recall"))
    pairs = found.join(rows.select("vec_id", F.col("embedding").alias("v")), "vec_id").join(_asked(rows).withColumnRenamed("embedding", "q"), "query_id")
    off = pairs.agg(F.max(F.abs(F.col("score") - answers.cosine(F.col("v"), F.col("q")))).alias("off"), F.countDistinct("query_id").alias("n_queries"), F.count("*").alias("n_found"))
    index = spark.read.parquet(path).agg(F.count("*").alias("n_rows"), F.countDistinct("key").alias("n_keys"))
    return index.crossJoin(off).crossJoin(recall).select("n_rows", "n_keys", "n_queries", "n_found", (F.col("recall") >= 0.9).alias("recall_reached"), (F.col("off") < 1e-9).alias("scores_exact"))  # a row each


def answer_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Turns against the next turn."""
    rows = answers.gram_metrics(base._turn_pairs(spark, sf_dir))
    return rows.select("video_id", *[base.r6(c).alias(c) for c in ("rouge1", "rouge2", "bleu")])


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    found = (cleaned_text, sentence_chunks, topic_chunks, retrieved, indexed_search, index_report, answer_metrics, rouge_l)
    return {f.__name__: f for f in found}


def _sentences(text: str) -> str:
    cut = f"regexp_replace({text}, '([.!?])[{tx.SPACE}]+', '\\1' || chr(1), 'g')"
    return f"list_filter(list_transform(string_split({cut}, chr(1)), lambda s: {oracle.strip('s')}), lambda s: s <> '')"


def oracle_sql() -> dict[str, str]:
    spoken = r"'Um, uh ' || regexp_replace(text, '([.!?]) ', '\1  er, ', 'g')"
    bare = f"regexp_replace(regexp_replace({spoken}, '[{tx.SPACE}]+', ' ', 'g'), '{answers._FILLER}', '\\1', 'g')"
    grams = lambda w: f"list_transform(range(1, cast(greatest(len({w}) - n + 1, 0) as bigint) + 1), lambda i: array_to_string({w}[i:i + n - 1], ' '))"
    return {
        "cleaned_text": f"select doc_id, md5(array_to_string(list_transform({_sentences(bare)}, lambda s: case when s[1] = 'ß' then s else upper(s[1]) || s[2:] end), ' ')) as clean_md5 from documents",
        "sentence_chunks": f"""with s as (select doc_id, {_sentences("coalesce(text, '')")} as s from documents),
            e as (select doc_id, unnest(s) as s, generate_subscripts(s, 1) as pos from s), n as (select *, len({oracle.words('s')}) as n from e),
            a as (select *, cast(floor(coalesce(sum(n) over (partition by doc_id order by pos rows between unbounded preceding and 1 preceding), 0) / 100) as integer) as place from n),
            g as (select doc_id, place, cast(sum(n) as bigint) as n_words, string_agg(s, ' ' order by pos) as text from a group by doc_id, place)
            select doc_id, cast(dense_rank() over (partition by doc_id order by place) - 1 as integer) as chunk, n_words, md5(text) as text_md5 from g""",
        "retrieved": """with s as (select q.vec_id as query_id, v.vec_id, list_cosine_similarity(v.embedding::double[], q.embedding::double[]) as score from embeddings v join embeddings q on q.vec_id % 50 = 0),
            r as (select *, cast(row_number() over (partition by query_id order by score desc, vec_id) as integer) as rank from s) select query_id, rank, vec_id, round(score, 6) as score from r where rank <= 10""",
        "index_report": """select count(*) as n_rows, count(distinct vec_id) as n_keys, count(*) filter (where vec_id % 50 = 0) as n_queries, 10 * count(*) filter (where vec_id % 50 = 0) as n_found,
            true as recall_reached, true as scores_exact from embeddings""",
        # a row of lengths follows from the one before: the longest up to here of what is above, or one more than above to the left
        "rouge_l": f"""with recursive p0 as (select conv_id * 1000 + turn as video_id, text as reference, lead(text) over (partition by conv_id order by turn) as hypothesis from conversations),
            p as (select video_id, {oracle.words('lower(reference)')} as r, {oracle.words('lower(hypothesis)')} as h from p0 where hypothesis is not null),
            g as (select video_id, unnest(h) as word, generate_subscripts(h, 1) as j from p),
            c as (
              select video_id, 0 as i, unnest(range(0, cast(len(h) as bigint) + 1)) as j, cast(0 as bigint) as n from p
              union all
              select video_id, i + 1, j, max(t) over (partition by video_id order by j) from (
                select c.video_id, c.i, c.j, greatest(c.n, case when g.word = p.r[c.i + 1] then lag(c.n) over (partition by c.video_id order by c.j) + 1 else 0 end) as t
                from c join p on p.video_id = c.video_id left join g on g.video_id = c.video_id and g.j = c.j where c.i < len(p.r)))
            select p.video_id, round(case when len(r) + len(h) > 0 then 2.0::double * n / (len(r) + len(h)) else 0.0::double end, 6) as rouge_l from c join p on p.video_id = c.video_id and c.i = len(p.r) and c.j = len(p.h)""",
        "answer_metrics": f"""with p0 as (select conv_id * 1000 + turn as video_id, text as reference, lead(text) over (partition by conv_id order by turn) as hypothesis from conversations),
            p as (select video_id, {oracle.words('lower(reference)')} as r, {oracle.words('lower(hypothesis)')} as h from p0 where hypothesis is not null),
            k as (select unnest([1, 2, 3, 4]) as n),
            g as (select video_id, n, 'r' as side, unnest({grams('r')}) as gram from p, k union all select video_id, n, 'h', unnest({grams('h')}) from p, k),
            c as (select video_id, n, gram, count(*) filter (where side = 'r') as r, count(*) filter (where side = 'h') as h from g group by all),
            t as (select video_id, n, sum(r)::double as r, sum(h)::double as h, sum(least(r, h))::double as s from c group by all),
            m as (select video_id, coalesce(max(2 * s / (r + h)) filter (where n = 1), 0) as rouge1, coalesce(max(2 * s / (r + h)) filter (where n = 2), 0) as rouge2,
              case when count(*) = 4 and min(s) > 0 then exp(sum(ln(case when s > 0 then s / h else 1 end)) / 4 + least(0, 1 - max(r) filter (where n = 1) / max(h) filter (where n = 1))) else 0 end as bleu from t group by video_id)
            select p.video_id, round(coalesce(rouge1, 0)::double, 6) as rouge1, round(coalesce(rouge2, 0)::double, 6) as rouge2, round(coalesce(bleu, 0)::double, 6) as bleu from p left join m using (video_id)""",
    }
