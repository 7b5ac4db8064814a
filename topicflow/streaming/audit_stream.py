"""The audit of a request log that is still being written: the answers of ``operators.audit``, micro-batch by micro-batch.

Requests come in order of ``seq`` from one micro-batch to the next; inside one any order will do. What has to be remembered is small
and lies in tables of the state folder: the subscriptions that are open, each with its last fetch, the number of subscribe attempts, and
the messages that an open subscription may still fetch. These are tables rather than keyed state, because one
topic may hold a third of all messages and would be a single key.

A micro-batch joins its own requests with these tables by the very functions of the batch form. It adds what it has settled:
copies that were fetched or lost at the end of their subscription, and messages that nobody can fetch any more. ``state.json`` is
replaced last, so a micro-batch that fails is as if it had not been, and one that is repeated gives the same files.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from topicflow.operators import audit
from topicflow.operators.asof import WIDTH, first_after, largest_before, ranked
from topicflow.storage import Store, fresh_folder, stored

OPEN = "subscriber_id string, topic string, start_seq bigint, since bigint"
PENDING = "seq bigint, topic string, fetched boolean"
ASSIGNED = "seq bigint, topic string, subscriber_id string, fetch_seq bigint"
UNDELIVERED = "seq bigint, topic string"
REQUESTS = "seq bigint, status string"
CLOSED = "subscriber_id string, topic string, start_seq bigint, end_seq bigint"


class AuditStream:
    """The state and the results in a folder. One query writes it at a time.

    ``topics``: the topics that exist. ``assigned``, ``undelivered``, ``requests`` and ``intervals`` give the same rows as the batch form over
    everything taken in so far.
    """

    def __init__(self, spark: SparkSession, folder: str, topics: DataFrame, width: int = WIDTH):
        self.spark, self.folder, self.width = spark, folder, width
        self.topics, self.store = topics.select("topic").distinct(), Store(spark, folder)
        self._load()

    def _load(self) -> None:
        known = json.loads(self.store.text_if_there(f"{self.folder}/state.json") or "{}")
        self.number: int = known.get("number", -1)
        self.attempts: int = known.get("attempts", 0)
        self.query_batch = known.get("query_batch")

    def _table(self, name: str, schema: str) -> DataFrame:
        """A table of the state."""
        if self.number < 0:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(f"{self.folder}/state/{self.number}/{name}")

    def _settled(self, name: str, schema: str) -> DataFrame:
        """What complete micro-batches have added to a result."""
        if self.number < 0:
            return self.spark.createDataFrame([], schema)
        rows = self.spark.read.schema(f"{schema}, tp_step bigint").parquet(f"{self.folder}/{name}")
        return rows.where(F.col("tp_step") <= self.number).drop("tp_step")

    # results

    @property
    def requests(self) -> DataFrame:
        return self._settled("requests", REQUESTS)

    @property
    def intervals(self) -> DataFrame:
        still = self._table("open", OPEN).select("subscriber_id", "topic", "start_seq", F.lit(None).cast("bigint").alias("end_seq"))
        return self._settled("closed", CLOSED).unionByName(still)

    @property
    def assigned(self) -> DataFrame:
        """Copies with the fetch that drained them; null for those not fetched (yet)."""
        waiting = audit.drain_assignment(self._table("pending", PENDING), self._open_spans())
        return self._settled("assigned", ASSIGNED).unionByName(waiting)

    @property
    def undelivered(self) -> DataFrame:
        """Messages that nobody has fetched (yet)."""
        return self._settled("undelivered", UNDELIVERED).unionByName(
            self._table("pending", PENDING).where("not fetched").select("seq", "topic")
        )

    def _open_spans(self) -> DataFrame:
        none = F.lit(None).cast("bigint")
        opened = self._table("open", OPEN).select("subscriber_id", "topic", F.col("since").alias("start_seq"))
        return opened.withColumns({"end_seq": none, "fetch_seq": none})

    # a micro-batch

    def _keep(self, frame: DataFrame, name: str, number: int) -> DataFrame:
        place = f"{self.folder}/{name}/tp_step={number}"
        return stored(frame, place)

    def take(self, actions: DataFrame, query_batch: int | None = None) -> None:
        """Take in further requests, all later than those before. A micro-batch of a query that is complete is passed over."""
        self._load()
        if query_batch is not None and self.query_batch is not None and query_batch <= self.query_batch:
            return
        spark, number = self.spark, self.number + 1
        scratch = fresh_folder(spark, "audit-step")
        actions = stored(actions.select("seq", "action", "topic", "subscriber_id", "batch_id", "has_rows"), f"{scratch}/actions")

        attempts = ranked(actions.where(F.col("action") == audit.SUBSCRIBE).select("seq", "topic"), "seq", out="tp_number")
        name = F.concat(F.lit("subscriber-"), (F.col("tp_number") + self.attempts).cast("string"))
        opened = attempts.join(self.topics, "topic", "left_semi").select(
            name.alias("subscriber_id"), "topic", F.col("seq").alias("start_seq"), F.col("seq").alias("since")
        )
        subscriptions = stored(self._table("open", OPEN).unionByName(opened), f"{scratch}/subscriptions")
        stops = actions.where((F.col("action") == audit.UNSUBSCRIBE) & F.col("subscriber_id").isNotNull())
        ended = first_after(
            subscriptions.withColumnRenamed("start_seq", "seq"), stops, key="subscriber_id", seq="seq", out="end_seq", width=self.width
        )
        ended = stored(ended.withColumnRenamed("seq", "start_seq"), f"{scratch}/ended")
        intervals = ended.select("subscriber_id", "topic", "start_seq", "end_seq")
        judged = audit.classify_requests(actions, self.topics, intervals=intervals, width=self.width)
        judged = stored(judged, f"{scratch}/judged")
        good = judged.where("status = 'ok'")
        fetches = good.where(F.col("action") == audit.FETCH)
        sends = good.where(F.col("action") == audit.SEND).select("seq", "topic", F.lit(False).alias("fetched"))
        current = ended.select("subscriber_id", "topic", F.col("since").alias("start_seq"), "end_seq")
        spans = stored(audit.fetch_spans(current, fetches, self.width), f"{scratch}/spans")
        pending = stored(self._table("pending", PENDING).unionByName(sends), f"{scratch}/pending")

        closed = spans.where("end_seq is not null")
        self._keep(audit.drain_assignment(pending, closed), "assigned", number)
        self._keep(judged.select("seq", "status"), "requests", number)
        self._keep(intervals.where("end_seq is not null"), "closed", number)

        # fetched by now: a span that began before and ends with a later fetch
        marks = closed.where("fetch_seq is not null").select("topic", F.col("start_seq").alias("seq"), "fetch_seq")
        seen = largest_before(pending, marks, key="topic", seq="seq", value="fetch_seq", width=self.width)
        seen = seen.withColumn("fetched", F.col("fetched") | F.coalesce(F.col("fetch_seq") > F.col("seq"), F.lit(False)))
        still = spans.where("end_seq is null")
        needed = still.groupBy("topic").agg(F.min("start_seq").alias("needed"))  # one line per topic
        seen = seen.select("seq", "topic", "fetched").join(needed, "topic", "left").withColumn("kept", F.coalesce(F.col("needed") < F.col("seq"), F.lit(False)))
        seen = stored(seen, f"{scratch}/seen")
        self._keep(seen.where("not kept and not fetched").select("seq", "topic"), "undelivered", number)
        stored(seen.where("kept").select("seq", "topic", "fetched"), f"{self.folder}/state/{number}/pending")
        begun = ended.where("end_seq is null").select("subscriber_id", "topic", "start_seq")
        since = still.select("subscriber_id", F.col("start_seq").alias("since"))
        stored(begun.join(since, "subscriber_id"), f"{self.folder}/state/{number}/open")

        tried = self.attempts + actions.where(F.col("action") == audit.SUBSCRIBE).count()
        state = {"number": number, "attempts": tried, "query_batch": query_batch if query_batch is not None else self.query_batch}
        self.store.replace_text(f"{self.folder}/state.json", json.dumps(state))
        if number:
            self.store.drop(f"{self.folder}/state/{number - 1}")
        self.store.drop(scratch)
        self._load()


def audit_stream(
    actions: DataFrame, topics: DataFrame, folder: str, *, checkpoint: str, trigger: dict | None = None, width: int = WIDTH
) -> StreamingQuery:
    """Start a query that audits a stream of requests into ``folder``; look at it with :class:`AuditStream`.

    A folder belongs to one checkpoint.
    """
    spark = actions.sparkSession

    def take(batch: DataFrame, number: int) -> None:
        AuditStream(spark, folder, topics, width).take(batch, number)

    writer = actions.writeStream.option("checkpointLocation", checkpoint).foreachBatch(take)
    return writer.trigger(**trigger).start() if trigger else writer.start()
