"""Read packets, of JSON lines or Arrow batches, that another site has delivered to a folder."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from topicflow.functions.binary import check_codec, decoded_shape, decoder
from topicflow.functions.codec import CORRUPT, accepted, parse, rejected, unpacked
from topicflow.operators.dedup import store_batch, stored_arrivals
from topicflow.sources.catalog import as_schema, check_name
from topicflow.sources.log import stamped_schema

BINARY_FILE = "path string, modificationTime timestamp, length bigint, content binary"  # fixed: Spark's columns of it
FOLLOW_ALL = {"maxFileAge": "36500d"}  # packets copied in with old times are not skipped
LISTING = "spark.sql.sources.parallelPartitionDiscovery.parallelism"


def few_listing_tasks(spark: SparkSession) -> None:
    """Look the packets of a micro-batch up in a few tasks for each core, unless the session says otherwise.

    Spark's default is a task for each packet (up to 10,000), and what a task reports to the driver is larger than what it finds.
    """
    if spark.conf.get(LISTING, None) is None:
        spark.conf.set(LISTING, str(max(64, 4 * spark.sparkContext.defaultParallelism)))


def read_packets(
    spark: SparkSession,
    landing: str,
    topic: str,
    schema: T.StructType | str,
    *,
    stream: bool = True,
    codec: str = "json",
    **options,
) -> DataFrame:
    """The user's columns, the sender's stamps, and ``tp_corrupt`` with the text of unreadable lines.

    ``codec`` is the sender's; of an unreadable ``arrow`` packet ``tp_corrupt`` has the path.
    Split with :func:`topicflow.functions.codec.accepted` and ``rejected``.
    """
    few_listing_tasks(spark)
    schema = as_schema(schema)
    if check_codec(codec) == "arrow":
        reader = spark.readStream.options(**FOLLOW_ALL) if stream else spark.read
        reader = reader.format("binaryFile").schema(BINARY_FILE).option("pathGlobFilter", "*.arrow").options(**options)
        files = reader.load(f"{landing}/{check_name('topic', topic)}").select("path", "content")
        rows = stamped_schema(schema)
        return files.mapInArrow(decoder(rows, "content", "path"), decoded_shape(rows))
    line = T.StructType(
        [
            T.StructField("p", T.StringType()),
            T.StructField("b", T.LongType()),
            T.StructField("o", T.LongType()),
            T.StructField("t", T.TimestampType()),
            T.StructField("r", schema),
        ]
    )
    reader = spark.readStream.options(**FOLLOW_ALL) if stream else spark.read
    lines = reader.options(**options).text(f"{landing}/{check_name('topic', topic)}")
    fields = lines.select("value", unpacked(parse(F.col("value"), line)))
    complete = F.col("p").isNotNull() & F.col("b").isNotNull() & F.col("o").isNotNull() & F.col("r").isNotNull()
    return fields.select(
        *(F.col("r").getField(name).alias(name) for name in schema.fieldNames()),
        F.col("p").alias("tp_producer"),
        F.col("b").alias("tp_batch_id"),
        F.col("o").alias("tp_offset"),
        F.col("t").alias("tp_ts"),
        F.coalesce(F.col(CORRUPT), F.when(~complete, F.col("value"))).alias(CORRUPT),
    )


def ingest(
    spark: SparkSession,
    landing: str,
    topic: str,
    schema: T.StructType | str,
    folder: str,
    *,
    checkpoint: str,
    trigger: dict | None = None,
    **options,
) -> StreamingQuery:
    """Start a query that takes in the packets of a topic and stores each row once, with the sender's stamps.

    Rows go to ``<folder>/rows``, to be read with :func:`ingested`. Unreadable lines go to ``<folder>/rejected`` as text,
    again when a micro-batch is repeated.
    """
    arrived = read_packets(spark, landing, topic, schema, **options)

    def take(batch: DataFrame, number: int) -> None:
        batch = batch.persist()
        try:
            store_batch(accepted(batch), f"{folder}/rows")
            rejected(batch).write.mode("overwrite").text(f"{folder}/rejected/{number}")
        finally:
            batch.unpersist()

    writer = arrived.writeStream.option("checkpointLocation", checkpoint).foreachBatch(take)
    return writer.trigger(**trigger).start() if trigger else writer.start()


def ingested(spark: SparkSession, folder: str, schema: T.StructType | str) -> DataFrame:
    """The rows :func:`ingest` has stored so far, with their stamps."""
    return stored_arrivals(spark.createDataFrame([], stamped_schema(as_schema(schema))), f"{folder}/rows")
