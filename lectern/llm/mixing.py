"""Mixing sources to target weights: capped water-filling, then seeded whole and fractional repetitions. Native."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import WORD, word_count, written

#: Weights dealt to the sources by code point, repeating.
WEIGHTS = (5, 2, 1)
MAX_EPOCHS = 3
SEED = "mix-1"
#: Hash buckets within a source; the fraction's boundary falls in one of them, only that one is ordered row by row.
BUCKET_HEX = 3


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """Water-filling over (source, source_size): adds target.

    Every target is min(max_epochs * source_size, level * weight); the level is the one at which the targets sum to
    the sum of all sizes. That is the fixpoint of clamping and resharing the excess by weight. In the order of
    cap/weight the clamped sources come first, so running sums give the level without a loop: that of the first source
    which it doesn't clamp. The levels of later ones are lower.
    The windows see all sources in one task: a row for each source, which are few, whatever the number of documents.
    Sources rank by code point, null last. An empty table gives an empty table; a source of size 0 has target 0.
    """
    everything = Window.partitionBy().rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    by_name = Window.orderBy(F.col("source").isNull(), F.col("source"))
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.pmod(F.row_number().over(by_name) - 1, F.lit(len(weights))) + 1).cast("int"))
    ranked = sizes.select("source", "source_size", weight.alias("weight")).withColumn("cap", F.lit(float(max_epochs)) * F.col("source_size"))
    ranked = ranked.withColumn("full_at", F.col("cap") / F.col("weight"))
    before = Window.orderBy("full_at", F.col("source").isNull(), "source").rowsBetween(Window.unboundedPreceding, -1)
    running = ranked.select(
        "*",
        F.coalesce(F.sum("cap").over(before), F.lit(0.0)).alias("cap_before"),
        F.coalesce(F.sum("weight").over(before), F.lit(0.0)).alias("weight_before"),
        F.sum("weight").over(everything).alias("weight_all"),
        F.sum("source_size").over(everything).alias("total"),
    )
    here = (F.col("total") - F.col("cap_before")) / (F.col("weight_all") - F.col("weight_before"))
    level = F.max(F.when(here <= F.col("full_at"), here)).over(everything)
    filled = running.withColumn("level", level)
    return filled.select("source", "source_size", F.least("cap", F.col("level") * F.col("weight")).alias("target"))


def mix(docs: DataFrame, size: Column | None = None, *, carry: tuple[str, ...] = ("doc_id",), weights: tuple[int, ...] = WEIGHTS, max_epochs: int = MAX_EPOCHS, seed: str = SEED) -> DataFrame:
    """How much of each document a mix takes: the columns `carry`, then size, source, source_size, target, taken.

    docs needs doc_id, text and source. A document is taken floor(target/source_size) times as a whole; the rest of the
    target is filled with one more repetition of the documents of the source in the order of a seeded digest of doc_id,
    the last of them a fractional one. So a source's taken words are its target, rounded, and no document is taken more
    than max_epochs times. Reruns agree: ties in the digest are ordered by size and by the text's digest, rows that
    are alike in all of these are interchangeable. Null text: size 0, taken 0. Null source: a source of its own, last.
    Null doc_id: hashed as an empty id. Extra columns are ignored unless carried. Empty table: empty result.

    Plan: one shuffle by (source, bucket) for sums, which are written, one for the order inside buckets; a hot source is spread over
    its buckets, and what the window over a whole source sees is one row per bucket.
    """
    size = word_count(F.col("text")) if size is None else size
    digest = F.md5(F.concat(F.lit(seed + ":"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))).cast("binary"))
    name = F.when(F.col("source").isNull(), F.lit("n")).otherwise(F.concat(F.lit("s"), F.col("source")))
    rows = docs.select(F.struct(*carry).alias("_carry"), F.col("source"), name.alias("_s"), size.alias("size"), digest.alias("_h"), F.md5(F.coalesce(F.col("text"), F.lit("")).cast("binary")).alias("_t"))
    rows = rows.withColumn("_b", F.substring("_h", 1, BUCKET_HEX))
    buckets = written(rows.groupBy("_s", "_b").agg(F.first("source").alias("source"), F.sum("size").alias("_in")), "mix-buckets")
    sizes = buckets.groupBy("_s").agg(F.first("source").alias("source"), F.sum("_in").alias("source_size"))
    targets = source_targets(sizes, weights, max_epochs)
    targets = targets.select(F.when(F.col("source").isNull(), F.lit("n")).otherwise(F.concat(F.lit("s"), F.col("source"))).alias("_s"), "source_size", "target")
    up_to = Window.partitionBy("_s").orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    starts = buckets.select("_s", "_b", F.coalesce(F.sum("_in").over(up_to), F.lit(0)).alias("_start"))
    placed = starts.join(targets, "_s")
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0)).cast("long")
    placed = placed.withColumn("_whole", whole).withColumn("_need", F.round(F.col("target") - F.col("_whole") * F.col("source_size")).cast("long"))
    inside = Window.partitionBy("_s", "_b").orderBy("_h", "size", "_t").rowsBetween(Window.unboundedPreceding, -1)
    ordered = rows.drop("source").withColumn("_before", F.coalesce(F.sum("size").over(inside), F.lit(0)))
    part = F.greatest(F.lit(0).cast("long"), F.least(F.col("size"), F.col("_need") - F.col("_start") - F.col("_before")))
    out = ordered.join(placed, ["_s", "_b"]).withColumn("_part", part)
    return out.select("_carry.*", "size", "source_size", "target", "_whole", "_part", (F.col("_whole") * F.col("size") + F.col("_part")).alias("taken"))


def mix_report(docs: DataFrame, **options) -> DataFrame:
    """doc_id, size, source_size, target, taken of mix()."""
    return mix(docs, **options).select("doc_id", "size", "source_size", "target", "taken")


def mixed_documents(docs: DataFrame, **options) -> DataFrame:
    """The mix itself, with the columns of docs: each document as often as mix() takes it as a whole, and the document at
    a source's boundary once more, cut after the words that are still due. Documents without words, null texts among
    them, are not taken. Null sources are one source, the last. Columns may have any names; an empty table stays empty.
    """
    names = docs.columns
    boxed = docs.select(F.struct(*[F.col(f"`{c}`") for c in names]).alias("_row"), "doc_id", "text", "source")
    taken = mix(boxed, carry=("_row",), **options)
    full = F.when(F.col("_part") == F.col("size"), F.lit(1)).otherwise(F.lit(0))
    cut = F.when((F.col("_part") > 0) & (F.col("_part") < F.col("size")), F.array(F.lit(True))).otherwise(F.array().cast("array<boolean>"))
    due = F.concat(F.array_repeat(F.lit(False), (F.col("_whole") + full).cast("int")), cut)
    rows = taken.where("size > 0").select("_row", "_part", F.explode(due).alias("_cut"))
    first = F.array_join(F.slice(F.regexp_extract_all(F.col("_row.text"), F.lit(f"({WORD})"), F.lit(0)), F.lit(1), F.col("_part").cast("int")), " ")
    text = F.when(F.col("_cut"), first).otherwise(F.col("_row.text"))
    new = {"text": text, "n_chars": F.when(F.col("_cut"), F.length(text).cast("long")).otherwise(F.col("_row").getField("n_chars")) if "n_chars" in names else None}
    return rows.select(*[new.get(c, F.col("_row").getField(c)).alias(c) for c in names])


def _literal(values: tuple[int, ...]) -> str:
    return " ".join(f"when {i} then {float(v)}" for i, v in enumerate(values))


ORACLE = rf"""
with d as (
  select doc_id, source, text, cast(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) as bigint) as size,
         md5('{SEED}:' || coalesce(cast(doc_id as varchar), '')) as h, md5(coalesce(text, '')) as t
  from documents),
s as (select source, cast(sum(size) as bigint) as source_size from d group by source),
w as (select *, case (row_number() over (order by source nulls last) - 1) % {len(WEIGHTS)} {_literal(WEIGHTS)} end::double as weight, {MAX_EPOCHS}.0::double * source_size as cap from s),
r as (select *, cap / weight as full_at from w),
q as (select *, coalesce(sum(cap) over b, 0.0) as cap_before, coalesce(sum(weight) over b, 0.0) as weight_before,
             sum(weight) over () as weight_all, cast(sum(source_size) over () as bigint) as total
      from r window b as (order by full_at, source nulls last rows between unbounded preceding and 1 preceding)),
l as (select *, (total - cap_before) / (weight_all - weight_before) as here from q),
m as (select *, max(case when here <= full_at then here end) over () as level from l),
g as (select source, source_size, least(cap, level * weight) as target,
             case when source_size > 0 then cast(floor(least(cap, level * weight) / source_size) as bigint) else 0 end as whole from m),
o as (select d.doc_id, d.size, g.source_size, g.target, g.whole, cast(round(g.target - g.whole * g.source_size) as bigint) as need,
             cast(coalesce(sum(d.size) over (partition by d.source order by d.h, d.size, d.t rows between unbounded preceding and 1 preceding), 0) as bigint) as before
      from d join g on d.source is not distinct from g.source)
select doc_id, size, source_size, target, cast(whole * size + greatest(0, least(size, need - before)) as bigint) as taken from o
"""
