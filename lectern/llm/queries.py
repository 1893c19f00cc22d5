"""The registered queries of this subpackage and, where SQL can express them, their SQL."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import jaccard, langid, licenses, line_dedup, media, mixing, packing, pii, spelling, substring_dedup, token_codes, topk, whitening


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out, train = langid.in_training()
    dictionaries = langid.fit_dictionaries(docs, train)
    return langid.identify(docs.select("doc_id", "text", held_out.alias("held_out")), dictionaries, keep=("doc_id", "held_out"))


def op2_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.report(table(spark, sf_dir, "documents"))


def op3_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.similar(table(spark, sf_dir, "documents"))


def op4_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings").select("vec_id", topk.quantised(F.col("embedding")).alias("v"))
    return topk.top_k(rows, F.col("vec_id") % 20 == 0)


def op5_interleaved_media(spark: SparkSession, sf_dir: str) -> DataFrame:
    return media.text_payload_report(table(spark, sf_dir, "documents"))


def op6_pattern_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def op7_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_report(table(spark, sf_dir, "documents"))


def op8_addressable_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_codes.encode_and_read(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op9_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(table(spark, sf_dir, "documents"), licenses.known_licenses(spark), digests=licenses.common_licenses(spark))


def op10_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.remove_repeats(table(spark, sf_dir, "documents"))


def op11_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.drop_repeated_lines(table(spark, sf_dir, "documents"))


def op12_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten_embeddings(table(spark, sf_dir, "embeddings"))


def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants_of_documents(table(spark, sf_dir, "documents"))


def media_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The interleaved sequences of the web pages, by which SQL checks the parser."""
    return media.page_report(table(spark, sf_dir, "pages"))


def license_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The license scan over each line of the documents as a text: how often each known license stands alone in one."""
    lines = table(spark, sf_dir, "documents").select("doc_id", F.explode(F.split("text", "\n")).alias("text"))
    return licenses.matches(licenses.scan(lines, licenses.known_licenses(spark)))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    found = (op1_language_id, op2_personal_data, op3_jaccard_join, op4_exact_top_k, op5_interleaved_media, op6_pattern_packing, op7_mix_sources, op8_addressable_codes, op9_license_scan, op10_substring_dedup, op11_line_dedup, op12_embedding_whitening, op13_spelling_variants, media_pages, license_lines, pipeline)
    return {f.__name__: f for f in found}


def oracle_sql() -> dict[str, str]:
    return {"op4_exact_top_k": topk.ORACLE, "op7_mix_sources": mixing.ORACLE, "op9_license_scan": licenses.oracle(), "op11_line_dedup": line_dedup.ORACLE, "media_pages": media.PAGES_ORACLE, "license_lines": licenses.lines_oracle()}
