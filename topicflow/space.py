"""One object with the everyday calls of a topic space."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from topicflow.functions.rows import original
from topicflow.operators import push as pushing
from topicflow.operators import upkeep
from topicflow.sources import catalog, log
from topicflow.streaming import sink, subscriptions


class TopicSpace:
    """Topics below a folder that all executors can reach. Listeners hear of every batch published through it."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")
        self.listeners: list[sink.Listener] = []

    def add_listener(self, listener: sink.Listener) -> TopicSpace:
        self.listeners.append(listener)
        return self

    # topics

    def create_topic(self, topic: str, schema: T.StructType | str) -> TopicSpace:
        catalog.create_topic(self.spark, self.root, topic, schema)
        return self

    def create_topic_like(self, topic: str, sample: DataFrame | Sequence) -> TopicSpace:
        catalog.create_topic_like(self.spark, self.root, topic, sample)
        return self

    def change_topic(self, topic: str, schema: T.StructType | str) -> TopicSpace:
        catalog.change_topic(self.spark, self.root, topic, schema)
        return self

    def fetch_schema(self, topic: str) -> T.StructType:
        return catalog.fetch_schema(self.spark, self.root, topic)

    def topics(self) -> list[str]:
        return catalog.list_topics(self.spark, self.root)

    # publishing

    def publish(self, topic: str, rows: DataFrame, *, producer: str, batch_id: int, **options) -> log.Receipt:
        return sink.publish_and_notify(
            self.spark,
            self.root,
            topic,
            rows,
            producer=producer,
            batch_id=batch_id,
            listeners=self.listeners,
            **options,
        )

    def publish_rows(self, topic: str, rows: Sequence, *, producer: str, batch_id: int, **options) -> log.Receipt:
        frame = log.local_frame(self.spark, self.fetch_schema(topic), rows)
        return self.publish(topic, frame, producer=producer, batch_id=batch_id, **options)

    def publish_stream(
        self, topic: str, rows: DataFrame, *, producer: str, checkpoint: str, **options
    ) -> StreamingQuery:
        return sink.publish_stream(
            rows, self.root, topic, producer=producer, checkpoint=checkpoint, listeners=self.listeners, **options
        )

    # reading

    def source(self, topic: str, **options) -> DataFrame:
        return log.topic_source(self.spark, self.root, topic, **options)

    def rows(self, topic: str) -> DataFrame:
        return log.read_topic(self.spark, self.root, topic)

    def rows_stream(self, topic: str, **options) -> DataFrame:
        return log.read_topic_stream(self.spark, self.root, topic, **options)

    def offset_range(self, topic: str, producer: str, end: int, start: int = -1) -> DataFrame:
        return log.offset_range(self.spark, self.root, topic, producer, end, start)

    # subscriptions

    def subscribe(self, topic: str, name: str | None = None) -> tuple[str, T.StructType]:
        subscription = subscriptions.subscribe(self.spark, self.root, topic, name)
        return subscription.name, self.fetch_schema(topic)

    def fetch(self, name: str) -> DataFrame:
        return subscriptions.fetch(self.spark, self.root, name)

    def fetch_original(self, name: str) -> DataFrame:
        return original(self.fetch(name))

    def drain(self, name: str, each: Callable[[DataFrame, int], None], max_batches: int | None = None) -> None:
        subscriptions.drain(self.spark, self.root, name, each, max_batches)

    def subscription_stream(self, name: str, **options) -> DataFrame:
        return subscriptions.subscription_stream(self.spark, self.root, name, **options)

    def unsubscribe(self, name: str) -> str:
        return subscriptions.unsubscribe(self.spark, self.root, name)

    # upkeep

    def compact(self, topic: str, **options) -> int:
        return upkeep.compact(self.spark, self.root, topic, **options)

    def release(self, topic: str, **options) -> int:
        return upkeep.release(self.spark, self.root, topic, **options)

    def clear(self, topic: str, **options) -> int:
        return upkeep.clear(self.spark, self.root, topic, **options)

    # other sites

    def push(self, topic: str, rows: DataFrame, destination: str, **options) -> DataFrame:
        return pushing.push(rows, topic, destination, **options)
