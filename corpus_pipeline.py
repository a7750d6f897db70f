"""From raw documents to packed training windows: five stages, each one operator.

Every stage works on all rows its predecessor kept.  All but the last return the columns
of ``documents``; the last returns pieces of packed windows with their token ids.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from duologue.llm import mixing, packing, pii, repetition, simhash, workers


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that are short, repeat themselves, or are mostly symbols."""
    return repetition.keep_good(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the document with the smallest id of each group of near-equal texts."""
    return simhash.keep_first(docs)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replaces personal data by its kind."""
    return pii.mask_documents(docs)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeats and drops documents so that sources get their shares of words."""
    return mixing.mix(docs)


def windows(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Packs the token ids into windows; one row per piece of a document."""
    return packing.packed(docs, with_ids=True).withColumnRenamed("key", "doc_id")


STAGES = [
    ("quality rules", quality),
    ("near duplicates", near_duplicates),
    ("personal data", personal_data),
    ("mixing", mixture),
    ("packing", windows),
]

# Fingerprints, rounding and tokens are beyond SQL; tests hold the stages against plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in order; each one's rows are stored before the next begins."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = workers.stored(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
