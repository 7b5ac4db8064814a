"""One query per operator, over the given tables. Every table is read whole."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from topicflow.errors import InvalidSubscription
from topicflow.functions import codec, rows, text
from topicflow.functions.codec import accepted
from topicflow.operators import audit, dedup, kafka, packets, push, upkeep
from topicflow.sources import catalog, log
from topicflow.sources.format import register
from topicflow.sources.packets import ingest, ingested, read_packets
from topicflow.storage import fresh_folder
from topicflow.streaming import sink, subscriptions
from topicflow.streaming.audit_stream import AuditStream, audit_stream
from topicflow.streaming.listeners import Collector, printed_lines

ONCE = {"availableNow": True}
FIXED_TIME = "2024-03-01 12:30:45.678"

Query = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, Query] = {}


def query(function: Query) -> Query:
    _QUERIES[function.__name__] = function
    return function


def queries() -> dict[str, Query]:
    return dict(_QUERIES)


# --- inputs ----------------------------------------------------------------------------------------------------------


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def table_stream(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table as a stream. The pattern matches just that table, be it one file or a folder of files."""
    return spark.readStream.schema(table(spark, sf_dir, name).schema).parquet(f"{sf_dir}/{name}.parque[t]")


def space_for(spark: SparkSession, topics: dict[str, DataFrame]) -> str:
    """A new, empty topic space with topics shaped like the given frames."""
    root = fresh_folder(spark, "space")
    for topic, frame in topics.items():
        catalog.create_topic(spark, root, topic, frame.schema)
    return root


def drained(stream: DataFrame) -> DataFrame:
    """A stream run to its end into files."""
    spark = stream.sparkSession
    folder = fresh_folder(spark, "drained")
    writer = stream.writeStream.format("parquet").option("checkpointLocation", f"{folder}/checkpoint")
    writer.trigger(**ONCE).start(f"{folder}/rows").awaitTermination()
    return spark.read.schema(stream.schema).parquet(f"{folder}/rows")


def events_topic(spark: SparkSession, sf_dir: str, batch_id: int = 7, **options) -> str:
    """Topic ``events`` holding the whole table as one batch, in order of ``event_id``."""
    events = table(spark, sf_dir, "events")
    root = space_for(spark, {"events": events})
    log.publish(
        spark, root, "events", events, producer="site-a", batch_id=batch_id, order_by=["event_id"], **options
    )
    return root


BROWSING = ("view", "click")


def in_two_parts(events: DataFrame) -> list[DataFrame]:
    """First the browsing events, then all others."""
    browsing = F.coalesce(F.col("event_type").isin(*BROWSING), F.lit(False))
    return [events.where(browsing), events.where(~browsing)]


def request_log(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """The events read as a log of requests, and the topics that exist.

    Subscribing and unsubscribing requests lack nothing, so numbers given to subscriptions and named later agree.
    """
    number = "cast(cast(floor(event_id / 50.0) as bigint) %s as varchar(9))"
    actions = table(spark, sf_dir, "events").selectExpr(
        "event_id as seq",
        """case when event_id % 50 = 0 then 'actionSubscribe'
                when event_id % 50 = 49 then 'actionUnsubscribe'
                when event_id % 103 = 9 then null
                when event_id % 10 = 5 then 'actionFetchStream'
                when event_id % 97 = 3 then 'actionFetchSchema'
                when event_id % 101 = 7 then 'actionBogus'
                else 'actionSendStream' end as action""",
        """case when event_id % 61 = 4 and event_id % 50 not in (0, 49) then null
                when event_id % 67 = 5 then 'topic-x'
                else concat('topic-', cast(user_id % 3 as varchar(9))) end as topic""",
        f"""case when event_id % 59 = 2 and event_id % 50 not in (0, 49) then null
                when event_id % 50 = 49 then concat('subscriber-', {number % '- 2'})
                else concat('subscriber-', {number % '+ 1 - user_id % 5'}) end as subscriber_id""",
        "case when event_id % 71 = 6 then null else event_id end as batch_id",
        "event_id % 73 <> 8 as has_rows",
    )
    topics = spark.sql("select * from (values ('topic-0'), ('topic-1'), ('topic-2')) t(topic)")
    return actions, topics


def audited(spark: SparkSession, sf_dir: str) -> audit.Audit:
    return audit.Audit(*request_log(spark, sf_dir), fresh_folder(spark, "audit"))


# --- publish and read ------------------------------------------------------------------------------------------------


@query
def topic_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A stream is published to a topic and read back from it as a stream."""
    source = table_stream(spark, sf_dir, "events")
    root = space_for(spark, {"events": source})
    sink.publish_stream(
        source, root, "events", producer="site-a", checkpoint=f"{root}/checkpoints/in", trigger=ONCE
    ).awaitTermination()
    return drained(log.topic_source(spark, root, "events"))


@query
def topic_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A published table read back as a table."""
    items = table(spark, sf_dir, "lineitem")
    root = space_for(spark, {"items": items})
    log.publish(spark, root, "items", items, producer="site-a", batch_id=0)
    return log.topic_source(spark, root, "items", stream=False)


@query
def topic_replay_idempotent(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same stream is published twice, the second time without its checkpoint; it is stored once."""
    root = space_for(spark, {"events": table(spark, sf_dir, "events")})
    for attempt in range(2):
        sink.publish_stream(
            table_stream(spark, sf_dir, "events"),
            root,
            "events",
            producer="site-a",
            checkpoint=f"{root}/checkpoints/{attempt}",
            trigger=ONCE,
        ).awaitTermination()
    return log.topic_source(spark, root, "events", stream=False)


@query
def with_receive_time(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows with their receive time last, given as a fixed time by the producer."""
    fixed = F.lit(FIXED_TIME).cast("timestamp")
    root = events_topic(spark, sf_dir, received_at=fixed)
    timed = drained(log.topic_source(spark, root, "events", includes_timestamp=True))
    return timed.select(
        *timed.columns[:-1], F.col(catalog.TIMESTAMP_COLUMN).cast("string").alias("received")
    )


@query
def row_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rows.with_id(log.read_topic(spark, events_topic(spark, sf_dir), "events"))


@query
def row_extra(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stamps as a struct, flattened."""
    root = events_topic(spark, sf_dir, received_at=F.lit(FIXED_TIME).cast("timestamp"))
    extra = rows.extra(log.read_topic(spark, root, "events")).select("extra.*")
    return extra.select(
        F.col("tp_batch_id").alias("batch_id"),
        F.col("tp_offset").alias("offset_in_batch"),
        F.col("tp_ts").cast("string").alias("received"),
    )


@query
def original_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rows.original(log.read_topic(spark, events_topic(spark, sf_dir), "events"))


@query
def offset_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The middle half of a producer's rows, by position over its three batches."""
    orders = table(spark, sf_dir, "orders")
    root = space_for(spark, {"orders": orders})
    part_of = F.when(F.col("o_orderstatus") == "F", 0).when(F.col("o_orderstatus") == "O", 1).otherwise(2)
    for batch_id in range(3):
        part = orders.where(part_of == batch_id)
        log.publish(spark, root, "orders", part, producer="site-a", batch_id=batch_id, order_by=["o_orderkey"])
    count = orders.count()
    found = log.offset_range(spark, root, "orders", "site-a", start=count // 4, end=3 * count // 4)
    return found.select(*orders.columns, F.col("tp_position").alias("position"))


@query
def batch_receipts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Receipts of two producers on one topic, one batch per return flag."""
    items = table(spark, sf_dir, "lineitem")
    root = space_for(spark, {"items": items})
    part_of = F.when(F.col("l_returnflag") == "A", 0).when(F.col("l_returnflag") == "N", 1).otherwise(2)
    filled = F.coalesce(F.col("l_linestatus") == "F", F.lit(False))
    for batch_id in range(3):
        for producer, chosen in (("site-f", filled), ("site-o", ~filled)):
            part = items.where((part_of == batch_id) & chosen)
            log.publish(spark, root, "items", part, producer=producer, batch_id=batch_id)
    return log.receipts(log.read_topic(spark, root, "items"), size=F.length(F.col("l_orderkey").cast("string")))


@query
def topic_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as messages, the event type being the topic: what a subscription to one topic gets."""
    messages = table(spark, sf_dir, "events").withColumnRenamed("event_type", "topic")
    return audit.for_topic(messages, "purchase")


# --- the topicflow format, upkeep, schema changes -------------------------------------------------------------------


def run_once(stream: DataFrame, folder: str) -> DataFrame:
    """A stream run to its end with the checkpoint in ``folder``; everything it has given so far."""
    writer = stream.writeStream.format("parquet").option("checkpointLocation", f"{folder}/checkpoint")
    writer.trigger(**ONCE).start(f"{folder}/rows").awaitTermination()
    return stream.sparkSession.read.schema(stream.schema).parquet(f"{folder}/rows")


@query
def format_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A stream written to a topic and read back from it under the format's name."""
    source = table_stream(spark, sf_dir, "events")
    root = space_for(spark, {"events": source})
    register(spark)
    named = {"root": root, "topic": "events"}
    writer = source.writeStream.format("topicflow").options(**named, producer="site-a").trigger(**ONCE)
    writer.option("checkpointLocation", f"{root}/checkpoints/in").start().awaitTermination()
    return drained(spark.readStream.format("topicflow").options(**named).load())


@query
def format_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table written to a topic and read back under the format's name, with its stamps."""
    vectors = table(spark, sf_dir, "embeddings")
    root = space_for(spark, {"vectors": vectors})
    register(spark)
    named = {"root": root, "topic": "vectors"}
    ordered = vectors.repartitionByRange("vec_id").sortWithinPartitions("vec_id")
    ordered.write.format("topicflow").options(**named, producer="site-a", batchId="4").mode("append").save()
    found = spark.read.format("topicflow").options(**named, stamps="true").load()
    return found.select("vec_id", "tp_producer", "tp_batch_id", "tp_offset", F.posexplode("embedding").alias("place", "x")).withColumn(
        "x", F.col("x").cast("double")
    )


@query
def manifest_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A range of one producer's positions over five batches, some of them compacted, among those of another producer."""
    orders = table(spark, sf_dir, "orders")
    root = space_for(spark, {"orders": orders})
    for batch_id in range(5):
        mine = F.col("o_orderkey") % 5 == batch_id
        for producer, chosen in (("site-a", mine & (F.col("o_custkey") % 2 == 0)), ("site-b", mine & (F.col("o_custkey") % 2 == 1))):
            log.publish(spark, root, "orders", orders.where(chosen), producer=producer, batch_id=batch_id, order_by=["o_orderkey"])
        if batch_id == 2:
            upkeep.compact(spark, root, "orders")
    count = orders.where("o_custkey % 2 = 0").count()
    found = log.offset_range(spark, root, "orders", "site-a", start=count // 3, end=4 * count // 5)
    return found.select(*orders.columns, F.col("tp_position").alias("position"))


@query
def topic_compaction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A stream is stopped, the topic compacted and continued, and the stream started again; all its rows with their ids."""
    events = table(spark, sf_dir, "events")
    root = space_for(spark, {"events": events})
    for batch_id in range(4):
        part = events.where(F.col("event_id") % 4 == batch_id)
        log.publish(spark, root, "events", part, producer="site-a", batch_id=batch_id, order_by=["event_id"])
        if batch_id % 2 == 0:
            rows_so_far = run_once(log.read_topic_stream(spark, root, "events"), f"{root}/out")
        else:
            upkeep.compact(spark, root, "events", again=batch_id == 3)
    upkeep.clear(spark, root, "events", older_than=0)
    rows_so_far = run_once(log.read_topic_stream(spark, root, "events"), f"{root}/out")
    return rows_so_far.drop("tp_ts")


@query
def topic_release(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What two readers have both fetched is released and cleared; the slow one still gets the rest, and that is what is left."""
    events = table(spark, sf_dir, "events")
    root = space_for(spark, {"events": events})
    for name in ("fast", "slow"):
        subscriptions.subscribe(spark, root, "events", name)
    got = []
    for batch_id in range(4):
        part = events.where(F.col("event_id") % 4 == batch_id)
        log.publish(spark, root, "events", part, producer="site-a", batch_id=batch_id, order_by=["event_id"])
        if batch_id in (1, 3):
            got.append(subscriptions.fetch(spark, root, "fast").withColumn("reader", F.lit("fast")))
        if batch_id == 1:
            subscriptions.fetch(spark, root, "slow")
    upkeep.release(spark, root, "events")
    left = log.read_topic(spark, root, "events").withColumn("reader", F.lit("left"))
    slow = subscriptions.fetch(spark, root, "slow").withColumn("reader", F.lit("slow"))
    return left.unionByName(slow).unionByName(got[1]).drop("tp_ts")


@query
def schema_change(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders in two schemas, the later one wider and with more columns, read as one table, half of it compacted."""
    orders = table(spark, sf_dir, "orders")
    old = orders.selectExpr("cast(o_orderkey as int) as o_orderkey", "cast(o_totalprice as float) as o_totalprice", "o_orderstatus")
    new = orders.selectExpr("o_orderkey", "o_totalprice", "o_orderstatus", "o_orderpriority", "array(o_custkey) as customers")
    root = space_for(spark, {"orders": old})
    early, odd = F.col("o_orderkey") % 3 > 0, F.col("o_orderkey") % 2 == 1
    for batch_id, part in enumerate((old.where(early & odd), old.where(early & ~odd))):
        log.publish(spark, root, "orders", part, producer="site-a", batch_id=batch_id)
    catalog.change_topic(spark, root, "orders", new.schema)
    log.publish(spark, root, "orders", new.where(~early & odd), producer="site-a", batch_id=2)
    upkeep.compact(spark, root, "orders")
    log.publish(spark, root, "orders", new.where(~early & ~odd), producer="site-a", batch_id=3)
    found = drained(log.topic_source(spark, root, "orders"))
    return found.withColumn("customers", F.col("customers")[0])


# --- subscriptions ---------------------------------------------------------------------------------------------------


@query
def subscribe_from_now(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two subscribers, one from the beginning and one from between two batches."""
    events = table(spark, sf_dir, "events")
    root = space_for(spark, {"events": events})
    subscriptions.subscribe(spark, root, "events", "early")
    for batch_id, part in enumerate(in_two_parts(events)):
        log.publish(spark, root, "events", part, producer="site-a", batch_id=batch_id)
        if batch_id == 0:
            subscriptions.subscribe(spark, root, "events", "late")
    early, late = (
        subscriptions.fetch(spark, root, name).select(F.lit(name).alias("subscriber"), *events.columns)
        for name in ("early", "late")
    )
    return early.unionByName(late)


@query
def fetch_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fetch after each batch, and once more when there is nothing new."""
    events = table(spark, sf_dir, "events")
    root = space_for(spark, {"events": events})
    subscriptions.subscribe(spark, root, "events", "reader")
    fetched = []
    for batch_id, part in enumerate([*in_two_parts(events), None]):
        if part is not None:
            log.publish(spark, root, "events", part, producer="site-a", batch_id=batch_id)
        got = subscriptions.fetch(spark, root, "reader")
        fetched.append(got.select(F.lit(batch_id + 1).alias("fetch_no"), *events.columns))
    return fetched[0].unionByName(fetched[1]).unionByName(fetched[2])


@query
def unsubscribe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One of two subscriptions ends between two batches: its name gives nothing any more, the other one goes on."""
    events = table(spark, sf_dir, "events")
    root = space_for(spark, {"events": events})
    got = []
    for name in ("leaves", "stays"):
        subscriptions.subscribe(spark, root, "events", name)
    for batch_id, part in enumerate(in_two_parts(events)):
        log.publish(spark, root, "events", part, producer="site-a", batch_id=batch_id)
        for name in ("leaves", "stays"):
            try:
                fresh = subscriptions.fetch(spark, root, name)
            except InvalidSubscription:
                continue
            got.append(fresh.select(F.lit(name).alias("subscriber"), *events.columns))
        if batch_id == 0:
            subscriptions.unsubscribe(spark, root, "leaves")
    return reduce(DataFrame.unionByName, got)


@query
def source_from_now(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A stream source that begins between two batches, with the receive time."""
    events = table(spark, sf_dir, "events")
    root = space_for(spark, {"events": events})
    before, after = in_two_parts(events)
    log.publish(spark, root, "events", before, producer="site-a", batch_id=0)
    stream = subscriptions.source_from_now(spark, root, "events", includes_timestamp=True)
    fixed = F.lit(FIXED_TIME).cast("timestamp")
    log.publish(spark, root, "events", after, producer="site-a", batch_id=1, received_at=fixed)
    return drained(stream).withColumn(catalog.TIMESTAMP_COLUMN, F.col(catalog.TIMESTAMP_COLUMN).cast("string"))


@query
def topic_schema(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A topic made from a sample: names and types as looked up, and how many values each column got."""
    events = table(spark, sf_dir, "events")
    root = fresh_folder(spark, "space")
    catalog.create_topic_like(spark, root, "events", events.limit(1))
    log.publish(spark, root, "events", events, producer="site-a", batch_id=0)
    known = catalog.source_schema(catalog.fetch_schema(spark, root, "events"), includes_timestamp=True)
    found = log.topic_source(spark, root, "events", stream=False, includes_timestamp=True)
    counts = found.agg(*[F.count(rows.quoted(field.name)).alias(field.name) for field in known])
    shown = [
        F.struct(
            F.lit(place).alias("place"),
            F.lit(field.name).alias("name"),
            F.lit(field.dataType.simpleString()).alias("type"),
            rows.quoted(field.name).alias("values"),
        )
        for place, field in enumerate(known)
    ]
    return counts.select(F.inline(F.array(*shown)))


# --- text ------------------------------------------------------------------------------------------------------------


@query
def word_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return text.word_count(table(spark, sf_dir, "documents"), "text")


@query
def word_count_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents go through a topic; a running count in complete mode is stored after each micro-batch."""
    lines = table_stream(spark, sf_dir, "documents").select(F.col("text").alias("value"))
    root = space_for(spark, {"lines": lines})
    sink.publish_stream(
        lines, root, "lines", producer="site-a", checkpoint=f"{root}/checkpoints/in", trigger=ONCE
    ).awaitTermination()
    counts = text.word_count(log.topic_source(spark, root, "lines"))

    def store(batch: DataFrame, _: int) -> None:
        batch.write.mode("overwrite").parquet(f"{root}/counts")

    writer = counts.writeStream.outputMode("complete").foreachBatch(store)
    writer.option("checkpointLocation", f"{root}/checkpoints/out").trigger(**ONCE).start().awaitTermination()
    return spark.read.schema(counts.schema).parquet(f"{root}/counts")


@query
def split_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The words of every turn of every conversation, with their places."""
    turns = table(spark, sf_dir, "conversations")
    return turns.select("conv_id", "turn", F.posexplode(text.split_words(F.col("text"))).alias("place", "word"))


# --- listeners -------------------------------------------------------------------------------------------------------


@query
def printed_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The lines a printer shows for the conversations, received at a fixed time."""
    turns = table(spark, sf_dir, "conversations")
    root = space_for(spark, {"turns": turns})
    log.publish(
        spark,
        root,
        "turns",
        turns,
        producer="site-a",
        batch_id=3,
        order_by=["conv_id", "turn"],
        received_at=F.lit(FIXED_TIME).cast("timestamp"),
    )
    return printed_lines("turns", log.read_topic(spark, root, "turns")).select("line_no", "line")


@query
def collector_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Everything a collector listening to a publishing stream has kept."""
    source = table_stream(spark, sf_dir, "events")
    root = space_for(spark, {"events": source})
    collector = Collector(f"{root}/collected")
    sink.publish_stream(
        source,
        root,
        "events",
        producer="site-a",
        checkpoint=f"{root}/checkpoints/in",
        listeners=[collector],
        order_by=["event_id"],
        trigger=ONCE,
    ).awaitTermination()
    return collector.get(spark, "events", source.schema).drop("tp_ts")


@query
def collector_producers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A collector keeps apart what two producers with names like numbers sent under the same batch id."""
    events = table(spark, sf_dir, "events")
    root = space_for(spark, {"events": events})
    collector = Collector(f"{root}/collected")
    for producer, part in zip(("007", "7"), in_two_parts(events), strict=True):
        options = dict(producer=producer, batch_id=5, order_by=["event_id"], listeners=[collector])
        sink.publish_and_notify(spark, root, "events", part, **options)
    return collector.get(spark, "events", events.schema).drop("tp_ts")


# --- packets ---------------------------------------------------------------------------------------------------------

PACKET_LIMIT = 200
PUSH_LIMIT = 64 * 1024
SHARD = 1000


def sized_packets(spark: SparkSession, sf_dir: str, shard: str) -> DataFrame:
    events = table(spark, sf_dir, "events")
    size = F.lit(16) + F.octet_length("event_type") + F.octet_length("props")
    cut = packets.packetize(events, shard=[shard], order=["event_id"], size=size, limit=PACKET_LIMIT)
    return cut.withColumnsRenamed({"tp_size": "size", "tp_packet": "packet", "tp_packet_offset": "packet_offset"})


@query
def packetize(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Packets of each user's events."""
    return sized_packets(spark, sf_dir, "user_id").drop("packet_offset")


@query
def packetize_large_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Packets of each type of event: a few shards, each over many partitions."""
    return sized_packets(spark, sf_dir, "event_type").drop("packet_offset")


@query
def packet_offsets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Places of rows within their packets."""
    return sized_packets(spark, sf_dir, "user_id").drop("size")


@query
def json_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events")
    return codec.accepted(codec.decode(codec.encode(events), events.schema))


@query
def json_roundtrip_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = table(spark, sf_dir, "lineitem")
    return codec.accepted(codec.decode(codec.encode(items), items.schema))


@query
def json_roundtrip_arrays(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Vectors through a topic and through JSON, then one row per element."""
    vectors = table(spark, sf_dir, "embeddings")
    root = space_for(spark, {"vectors": vectors})
    log.publish(spark, root, "vectors", vectors, producer="site-a", batch_id=0)
    lines = codec.encode(log.topic_source(spark, root, "vectors", stream=False))
    back = codec.accepted(codec.decode(lines, vectors.schema))
    return back.select("vec_id", "label", F.posexplode("embedding").alias("place", "element")).withColumn(
        "element", F.col("element").cast("double")
    )


def pushed(spark: SparkSession, sf_dir: str, times: int, codec: str = "json") -> DataFrame:
    """The events, pushed as packets ``times`` times to a landing folder and taken in again as a stream."""
    events = table(spark, sf_dir, "events")
    root = events_topic(spark, sf_dir)
    landing = f"{root}/landing"
    stored_rows = log.read_topic(spark, root, "events")
    for copy in range(times):
        # each round has a folder of its own, as if another link had delivered it
        url = as_url(f"{landing}/events/link={copy}")
        push.push(stored_rows, "events", url, limit=PUSH_LIMIT, shard_rows=SHARD, codec=codec)
    arrived = read_packets(spark, f"{landing}", "events", events.schema, codec=codec, recursiveFileLookup="true")
    arrived = accepted(arrived)
    return arrived if times == 1 else dedup.drop_redelivered(arrived)


def as_url(path: str) -> str:
    return path if "://" in path else f"file://{path}"


@query
def packet_push_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return drained(pushed(spark, sf_dir, 1)).drop("tp_ts")


@query
def arrow_push_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same with binary packets, all of them delivered twice."""
    return drained(pushed(spark, sf_dir, 2, "arrow")).drop("tp_ts")


@query
def dedup_redelivery(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every packet arrives twice; each row is kept once."""
    return drained(pushed(spark, sf_dir, 2)).drop("tp_ts")


def link_sends(spark: SparkSession, sf_dir: str, parts: list[str], together: bool) -> DataFrame:
    """Parts of the stored events are pushed one after the other and taken in, each at once or all at the end."""
    events = table(spark, sf_dir, "events")
    fixed = F.lit(FIXED_TIME).cast("timestamp") + F.make_dt_interval(secs=F.col("event_id"))
    root = space_for(spark, {"events": events})
    log.publish(
        spark, root, "events", events, producer="site-a", batch_id=7, order_by=["event_id"], received_at=fixed
    )
    stored_rows = log.read_topic(spark, root, "events")
    for link, part in enumerate(parts):
        landing = as_url(f"{root}/landing/events/link={link}")
        push.push(stored_rows.where(part), "events", landing, limit=PUSH_LIMIT, shard_rows=SHARD)
        if not together or link == len(parts) - 1:
            options = dict(checkpoint=f"{root}/checkpoints/in", trigger=ONCE, recursiveFileLookup="true")
            ingest(spark, f"{root}/landing", "events", events.schema, f"{root}/in", **options).awaitTermination()
    return ingested(spark, f"{root}/in", events.schema).drop("tp_ts")


@query
def dedup_late_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Newer rows arrive first, older ones in a later trigger, then all of them again: each is kept once."""
    return link_sends(spark, sf_dir, ["tp_offset % 3 > 0", "tp_offset % 3 = 0", "true"], together=False)


@query
def ingest_topic(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two deliveries that overlap, taken in with one trigger."""
    return link_sends(spark, sf_dir, ["tp_offset % 2 = 0", "true"], together=True)


@query
def delivered_ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is known as delivered after two deliveries with gaps that overlap."""
    stored_rows = log.read_topic(spark, events_topic(spark, sf_dir), "events")
    folder = fresh_folder(spark, "arrivals")
    for part in ("tp_offset % 5 <> 2", "tp_offset % 10 <> 7 and tp_offset % 1000 < 600"):
        dedup.store_batch(stored_rows.where(part), folder)
    return dedup.Delivered(spark, folder).ranges().drop("tp_block")


@query
def dedup_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same on a table."""
    stored_rows = log.read_topic(spark, events_topic(spark, sf_dir), "events")
    return dedup.drop_redelivered(stored_rows.unionAll(stored_rows)).drop("tp_ts")


@query
def push_receipts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the receipts of a push add up to, per shard of a thousand rows."""
    root = events_topic(spark, sf_dir)
    sent = push.push(
        log.read_topic(spark, root, "events"), "events", as_url(f"{root}/landing"), limit=PUSH_LIMIT, shard_rows=SHARD
    )
    return sent.groupBy(F.col("tp_shard").alias("shard")).agg(
        F.sum("rows").alias("rows"), F.max("attempts").alias("attempts")
    )


@query
def kafka_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return kafka.kafka_records(log.read_topic(spark, events_topic(spark, sf_dir), "events"), "events")


@query
def kafka_records_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records that carry the whole row."""
    turns = table(spark, sf_dir, "conversations")
    root = space_for(spark, {"turns": turns})
    log.publish(spark, root, "turns", turns, producer="site-a", batch_id=3, order_by=["conv_id", "turn"])
    return kafka.kafka_records(log.read_topic(spark, root, "turns"), "turns", "json")


# --- audit -----------------------------------------------------------------------------------------------------------


@query
def classify_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    steps = audited(spark, sf_dir)
    return audit.classify_requests(steps.actions, steps.topics, intervals=steps.intervals).select("seq", "status")


@query
def classify_requests_kafka(spark: SparkSession, sf_dir: str) -> DataFrame:
    actions, _ = request_log(spark, sf_dir)
    return audit.classify_requests(actions, mode="kafka").select("seq", "status")


@query
def subscription_intervals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit.subscription_intervals(*request_log(spark, sf_dir))


@query
def fan_out(spark: SparkSession, sf_dir: str) -> DataFrame:
    steps = audited(spark, sf_dir)
    return audit.fan_out(steps.sends, steps.intervals)


@query
def drain_assignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    steps = audited(spark, sf_dir)
    return audit.drain_assignment(steps.sends, steps.spans)


def audited_in_parts(spark: SparkSession, sf_dir: str) -> AuditStream:
    """The request log published in two parts, each taken in by a stream over the topic that is started again."""
    actions, topics = request_log(spark, sf_dir)
    root = space_for(spark, {"requests": actions})
    half = (actions.agg(F.max("seq")).first()[0] or 0) // 2 + 1
    for part in range(2):
        rows = actions.where(F.expr(f"seq div {half}") == part)
        log.publish(spark, root, "requests", rows, producer="hub", batch_id=part)
        stream = log.topic_source(spark, root, "requests")
        audit_stream(stream, topics, f"{root}/audit", checkpoint=f"{root}/checkpoints/audit", trigger=ONCE).awaitTermination()
    return AuditStream(spark, f"{root}/audit", topics)


@query
def drain_assignment_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audited_in_parts(spark, sf_dir).assigned


@query
def undelivered_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audited_in_parts(spark, sf_dir).undelivered


@query
def undelivered(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audited(spark, sf_dir).undelivered


@query
def lost_copies(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audited(spark, sf_dir).lost_copies
