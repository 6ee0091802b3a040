"""The training-corpus pipeline: from raw documents to packed training sequences.

Stages run in order, each on all rows that the one before kept; every stage's
result is written as Parquet in the shared folder and read again as the next
one's documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mishap.llm.common import store, table
from mishap.llm.decontamination import decontaminate
from mishap.llm.language_id import keep_identified
from mishap.llm.packing import packed_digest
from mishap.llm.simhash_dedup import keep_first
from mishap.llm.surrogates import with_surrogates


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is identified (null texts and texts without a letter go), a null ``lang`` predicted."""
    return keep_identified(docs)


def simhash_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group, that of the smallest id."""
    return keep_first(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no window of ten words of a benchmark item."""
    return decontaminate(docs, table(spark, sf_dir, "benchmark"))


def pii(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal data replaced in their texts (n_chars follows the text)."""
    length = F.coalesce(F.length("text").cast(docs.schema["n_chars"].dataType), F.col("n_chars"))
    return with_surrogates(docs).withColumn("n_chars", length)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents' token pieces with their places in training sequences."""
    return packed_digest(docs)


STAGES = [("language_id", language_id), ("simhash_dedup", simhash_dedup), ("decontamination", decontamination),
          ("pii", pii), ("packing", packing)]

# A trained network, XXH64 fingerprints and a tokenizer have no SQL; the tests use brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = store(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
