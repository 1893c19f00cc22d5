"""The corpus pipeline: language ID, near-duplicate join, personal data, mixing, packing; each stage on all its predecessor kept.

All stages take documents with nulls in any column, empty and very long texts, repeated rows, extra columns of any names
(kept by all but the last) and empty tables, which stay empty.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from lectern.llm import jaccard, langid, mixing, packing, pii
from lectern.llm.common import delete, keep, kept, release, shared_path


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents whose language can't be told: null texts, no letters, or a narrow margin; ties are narrow.

    Dictionaries are made of the documents that have a language. Without any nothing is kept. Repeated rows stay or go together.
    """
    return langid.keep_identified(docs, langid.fit_dictionaries(docs))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each near-duplicate class, the one of least doc_id, null ids last, then of least text key.

    Null and empty texts are copies of each other; of repeated rows one stays.
    """
    return jaccard.keep_one(docs)


def redact_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replaces personal data by its kind in brackets; drops nothing. Null and empty texts stay as they are.

    The models are fitted to all documents; equal texts are redacted alike, so repeated rows stay repeated.
    """
    model, _ = pii.fit(docs)
    return pii.redact(docs, model)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeats and samples documents so that each source's words are its target; null sources are one source, the last.

    Documents without words, null texts among them, have nothing to give and aren't taken. Ties in the seeded order go by
    size and text.
    """
    return mixing.mixed_documents(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row per piece of a document with its place in a training sequence; a document taken twice has its pieces twice.

    Null and empty texts are one piece, the end id. Extra columns end here.
    """
    return packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [
    ("language ID", identify_language),
    ("n-gram Jaccard join", drop_near_duplicates),
    ("personal data", redact_personal_data),
    ("mixing sources", mix_sources),
    ("best-fit packing", pack_sequences),
]

#: Compression, expectation-maximisation and tokenization aren't expressible in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; each result is written and read again as the next stage's documents.

    What a stage has written on its way is deleted once its result stands, and the result once the next stage's does; what
    the last one reads is left to release(), or to the end of the driver.
    """
    docs, before = spark.read.parquet(f"{sf_dir}/documents.parquet"), None
    for name, stage in STAGES[:-1]:
        path, since = shared_path(spark, "stage-" + name.replace(" ", "-")), kept()
        stage(spark, docs, sf_dir).write.parquet(path)
        release(spark, since)
        if before:
            delete(spark, before)
        docs, before = spark.read.parquet(path), path
    if before:
        keep(before)
    return STAGES[-1][1](spark, docs, sf_dir)
