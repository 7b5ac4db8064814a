"""Streaming sink: every micro-batch of a query becomes one batch of a topic."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from topicflow.sources.catalog import check_name, check_rows, schemas
from topicflow.sources.log import Receipt, publish, read_batches

Listener = Callable[[str, DataFrame, int], None]


def notify(
    spark: SparkSession, root: str, topic: str, producer: str, batch_id: int, listeners: Sequence[Listener]
) -> None:
    """Call each listener with (topic, stored rows, batch id), in the order given."""
    if listeners:
        rows = read_batches(spark, root, topic, [(producer, batch_id)])
        for listener in listeners:
            listener(topic, rows, batch_id)


def publish_and_notify(
    spark: SparkSession,
    root: str,
    topic: str,
    rows: DataFrame,
    *,
    producer: str,
    batch_id: int,
    listeners: Sequence[Listener] = (),
    **options,
) -> Receipt:
    """Publish, then tell the listeners. A replayed batch tells them again; an empty one does not."""
    receipt = publish(spark, root, topic, rows, producer=producer, batch_id=batch_id, **options)
    if receipt.rows:
        notify(spark, root, topic, producer, batch_id, listeners)
    return receipt


def publish_stream(
    rows: DataFrame,
    root: str,
    topic: str,
    *,
    producer: str,
    checkpoint: str,
    listeners: Sequence[Listener] = (),
    output_mode: str = "append",
    order_by: Sequence[str | Column] = (),
    received_at: Column | None = None,
    trigger: dict | None = None,
) -> StreamingQuery:
    """Start a query that publishes its micro-batches. Spark's batch id is the batch id of the topic.

    A producer that loses its checkpoint must take a new name, or its first batches would count as replays.
    """
    spark = rows.sparkSession
    check_name("producer", producer)
    check_rows(rows.schema, schemas(spark, root, topic))

    def store(batch: DataFrame, batch_id: int) -> None:
        publish_and_notify(
            batch.sparkSession,
            root,
            topic,
            batch,
            producer=producer,
            batch_id=batch_id,
            listeners=listeners,
            order_by=order_by,
            received_at=received_at,
        )

    writer = rows.writeStream.outputMode(output_mode).option("checkpointLocation", checkpoint).foreachBatch(store)
    return writer.trigger(**trigger).start() if trigger else writer.start()
