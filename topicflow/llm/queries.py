"""One query per operator of this subpackage, over the whole given tables."""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from topicflow.llm import (
    ball_search,
    decontaminate,
    langid,
    licenses,
    near_dup,
    neighbours,
    packing,
    pii,
    secrets,
    token_files,
    toxicity,
    url_filter,
    vector_codes,
)
from topicflow.storage import fresh_folder

Query = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, Query] = {}

URL_RULES = "values ('block', 'net', '/'), ('allow', 'example.net', '/en/'), ('block', 'example.com', '/de/'), ('allow', 'org', '/fr/')"
PII_KEY = "topicflow"
HELD_OUT = "crc32(cast(doc_id as string)) % 5 = 0"


ARROW_BATCH = "spark.sql.execution.arrow.maxBytesPerBatch"
BATCH_BYTES = "4m"


def small_batches(spark: SparkSession) -> None:
    """Hand texts to Python 4 MB at a time instead of 64 MB, unless the session says otherwise.

    A batch is copied several times, in the executor and in each worker, so this is what their memory depends on.
    """
    if spark.conf.get(ARROW_BATCH, None) in (None, "67108864b", "64m"):  # Spark's default
        spark.conf.set(ARROW_BATCH, BATCH_BYTES)


def query(function: Query) -> Query:
    @functools.wraps(function)
    def prepared(spark: SparkSession, sf_dir: str) -> DataFrame:
        small_batches(spark)
        return function(spark, sf_dir)

    _QUERIES[function.__name__] = prepared
    return prepared


def queries() -> dict[str, Query]:
    return dict(_QUERIES)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def learnable(docs: DataFrame) -> DataFrame:
    """The rows that may be learned from: all but the held-out fold (rows without id are held out)."""
    return docs.where(f"not coalesce({HELD_OUT}, true)")


def encoder():
    import public_tokenizers

    special = {"<|endoftext|>": 50256}  # fixed: the vocabulary's only special string
    return packing.byte_bpe_encoder(public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN, special)


def word_encoder():
    import public_tokenizers

    return token_files.spaced_encoder(public_tokenizers.path("word_bpe_49k.json"), folds=True)


@query
def op1_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.sql(f"select * from ({URL_RULES}) as t(verdict, host, path)")
    return url_filter.judge(table(spark, sf_dir, "pages"), rules)


def secret_scanner(docs: DataFrame):
    """Letter statistics of all documents, and a forest trained outside the held-out fold on rule-labelled findings."""
    known = secrets.dictionary(docs)
    return known, secrets.train(learnable(docs).withColumn("path", F.col("source")), known)


def redacted(docs: DataFrame) -> DataFrame:
    return secrets.redacted(docs, *secret_scanner(docs), path_column="source")


@query
def op2_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return secrets.scan(docs.withColumn("path", F.col("source")), *secret_scanner(docs))


@query
def op3_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dup.near_duplicates(table(spark, sf_dir, "documents"), percent=85)


@query
def op4_pii_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.pseudonymised(table(spark, sf_dir, "documents"), PII_KEY)


@query
def op5_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return neighbours.nearest(vectors, vectors.where("vec_id % 20 = 0"), k=20)


@query
def op6_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.decontamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.drop("items")


@query
def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = langid.predict(docs, langid.train(learnable(docs)))
    return found.select("doc_id", F.expr(f"coalesce({HELD_OUT}, true)").alias("held_out"), "lang_pred", "score", "ambiguous")


@query
def op8_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), encoder, size=1024, end_id=2)


@query
def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    labels = learnable(table(spark, sf_dir, "labels")).select("doc_id", "toxic")
    model = toxicity.train_by_id(docs, labels)
    found = toxicity.score(docs, model)
    return found.select("doc_id", F.expr(f"coalesce({HELD_OUT}, true)").alias("held_out"), "score", "predicted")


@query
def op10_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.licenses(
        table(spark, sf_dir, "documents"), licenses.known_sentences(spark), licenses.known_rules(spark)
    )


@query
def op11_ball_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ball_search.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), k=10)


@query
def op12_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = fresh_folder(spark, "token-files")
    token_files.write(table(spark, sf_dir, "documents"), word_encoder, folder, end_id=1)
    return token_files.read_documents(spark, folder)


@query
def op13_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    trained = vector_codes.train(table(spark, sf_dir, "embeddings"), parts=8, entries=16, rounds=6, scale=4096)
    return vector_codes.with_label_error(trained.codes).select(
        "vec_id",
        F.lower(F.hex("code")).alias("code"),
        "error",
        "label_error",
        F.lit(vector_codes.codebook_digest(trained.codebooks)).alias("codebooks_sha256"),
    )
