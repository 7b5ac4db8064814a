"""The corpus pipeline: stages that each take the documents the one before kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from topicflow.llm import decontaminate, langid, near_dup, packing, queries
from topicflow.storage import fresh_folder


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents of unknown or ambiguous language. Null and letterless texts go."""
    queries.small_batches(spark)
    return langid.accepted(docs, langid.train(queries.learnable(docs)))


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group stays (five-word shingles, similarity 0.8)."""
    queries.small_batches(spark)
    return near_dup.one_of_each(docs, percent=80)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that hold ten consecutive words of a benchmark item."""
    queries.small_batches(spark)
    return decontaminate.uncontaminated(docs, queries.table(spark, sf_dir, "benchmark"))


def without_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cut secrets out of the texts; ``n_chars`` follows."""
    queries.small_batches(spark)
    return queries.redacted(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token sequences of 1024."""
    queries.small_batches(spark)
    return packing.pack(docs, queries.encoder, size=1024, end_id=2)


STAGES = [
    ("language", known_language),
    ("near_duplicates", without_near_copies),
    ("decontamination", without_benchmark),
    ("secrets", without_secrets),
    ("packing", packed),
]
ORACLE_SQL = None  # learned models and tokens cannot be expressed in SQL


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = queries.table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        folder = fresh_folder(spark, f"stage-{name}")
        stage(spark, docs, sf_dir).write.parquet(folder)
        docs = spark.read.parquet(folder)
    return docs
