"""Who received what, when, and what was refused: answers worked out from a log of requests.

``actions``: ``seq`` (unique, increasing), ``action``, ``topic``, ``subscriber_id``, ``batch_id``, ``has_rows``.
``topics``: ``topic``. Only column ``seq`` gives order.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from topicflow.operators.asof import WIDTH, first_after, largest_before, ranked, running_count
from topicflow.storage import Store, fresh_folder, stored

# Action names of the request protocol.
SEND = "actionSendStream"
FETCH = "actionFetchStream"
SUBSCRIBE = "actionSubscribe"
UNSUBSCRIBE = "actionUnsubscribe"
FETCH_SCHEMA = "actionFetchSchema"

# What each kind of hub accepts.
MODES = {
    "buffer": (SEND, FETCH, SUBSCRIBE, UNSUBSCRIBE, FETCH_SCHEMA),
    "kafka": (SEND,),
    "null": (),
}
FAN_OUT_WIDTH = 256
CROWD = 100_000  # spans of a stretch that are joined with its messages by one task
END, MESSAGE, START = 0, 1, 2  # in this order at one number: a span holds what is strictly inside
SPREAD = 4096


def for_topic(messages: DataFrame, topic: str) -> DataFrame:
    """The messages of one topic."""
    return messages.where(F.col("topic") == topic)


def subscription_intervals(actions: DataFrame, topics: DataFrame, width: int = WIDTH) -> DataFrame:
    """``subscriber_id``, ``topic``, ``start_seq``, ``end_seq`` (null while open) of every successful subscribe.

    Numbers count all attempts, failed ones too.
    """
    attempts = ranked(actions.where(F.col("action") == SUBSCRIBE).select("seq", "topic"), "seq", out="tp_number")
    opened = attempts.join(topics.select("topic"), "topic", "left_semi").select(
        F.concat(F.lit("subscriber-"), F.col("tp_number").cast("string")).alias("subscriber_id"), "topic", "seq"
    )
    opened = stored(opened, fresh_folder(actions.sparkSession, "opened"))  # the next step reads it twice
    stops = actions.where((F.col("action") == UNSUBSCRIBE) & F.col("subscriber_id").isNotNull())
    closed = first_after(opened, stops, key="subscriber_id", seq="seq", out="end_seq", width=width)
    return closed.select("subscriber_id", "topic", F.col("seq").alias("start_seq"), "end_seq")


def classify_requests(
    actions: DataFrame,
    topics: DataFrame | None = None,
    mode: str = "buffer",
    intervals: DataFrame | None = None,
    width: int = WIDTH,
) -> DataFrame:
    """Add ``status``: ``ok`` or the first check the request fails."""
    action, accepted = F.col("action"), MODES[mode]
    supported = action.isin(*accepted) if accepted else F.lit(False)
    by_topic = action.isin(SEND, SUBSCRIBE, FETCH_SCHEMA)
    by_subscriber = action.isin(FETCH, UNSUBSCRIBE)
    is_send = action == SEND
    checks = [
        F.when(action.isNull(), "missing action"),
        F.when(~supported, "unsupported action"),
        F.when(by_topic & F.col("topic").isNull(), "missing topic"),
        F.when(is_send & F.col("batch_id").isNull(), "missing batchId"),
        F.when(is_send & ~F.coalesce("has_rows", F.lit(False)), "missing rows"),
        F.when(by_subscriber & F.col("subscriber_id").isNull(), "missing subscriberId"),
    ]
    rows = actions
    if mode == "buffer":
        if intervals is None:
            intervals = subscription_intervals(actions, topics, width)
        known = topics.select("topic").distinct().withColumn("tp_known", F.lit(True))
        valid = intervals.select(F.col("subscriber_id").alias("tp_wanted"), "start_seq", "end_seq")
        # requests without a subscriber to look up get keys of their own, so that they do not meet in one partition
        nobody = F.concat(F.lit("#"), F.pmod(F.col("seq"), F.lit(SPREAD)).cast("string"))
        wanted = F.coalesce(F.when(by_subscriber, F.col("subscriber_id")), nobody)
        rows = rows.withColumns({"tp_wanted": wanted, "tp_topic": F.coalesce("topic", nobody)})
        known = known.withColumnRenamed("topic", "tp_topic")
        rows = rows.join(known, "tp_topic", "left").join(valid, "tp_wanted", "left")
        during = (F.col("seq") > F.col("start_seq")) & (F.col("end_seq").isNull() | (F.col("seq") <= F.col("end_seq")))
        checks += [
            F.when(by_topic & F.col("tp_known").isNull(), "unknown topic"),
            F.when(by_subscriber & ~F.coalesce(during, F.lit(False)), "invalid subscriber"),
        ]
    return rows.select(*actions.columns, F.coalesce(*checks, F.lit("ok")).alias("status"))


def spans_joined(sends: DataFrame, spans: DataFrame, width: int = FAN_OUT_WIDTH) -> DataFrame:
    """Each message with each span open on its topic: ``span`` columns and ``seq`` with start_seq < seq < end_seq.

    ``spans``: ``topic``, ``start_seq``, ``end_seq`` (null: open to the end) and more. One sweep over messages and span ends,
    in order of topic and number, counts the messages before each end. So a span becomes a range of message ranks; spans that
    meet no message end here. The others are repeated for each stretch of ``width`` ranks of their range and joined with the
    messages of that stretch. All inner stretches are full of messages of the span's topic, so no more than two rows a span
    and one for every ``width`` rows of the result are shuffled, whatever the number of topics. Where very many spans
    meet in one stretch they are dealt into shares of about ``CROWD``, and the stretch's messages are repeated for each.
    """
    spark = sends.sparkSession
    usable = spans.where("topic is not null and start_seq is not null")
    usable = stored(usable.withColumn("tp_span", F.monotonically_increasing_id()), fresh_folder(spark, "spans"))
    nobody, no = F.lit(None).cast("bigint"), F.lit(False)
    messages = sends.where("topic is not null and seq is not null").select(
        "topic", "seq", F.lit(MESSAGE).alias("tp_kind"), nobody.alias("tp_span"), no.alias("tp_open")
    )
    starts = usable.select("topic", "start_seq", F.lit(START), "tp_span", no)
    ends = usable.select("topic", "end_seq", F.lit(END), "tp_span", F.col("end_seq").isNull())
    is_message = F.col("tp_kind") == MESSAGE
    swept = running_count(
        messages.union(starts).union(ends), "topic", "tp_open", "seq", "tp_kind", what=is_message, out="tp_rank"
    )
    first = F.max(F.when(F.col("tp_kind") == START, F.col("tp_rank") + 1)).alias("tp_from")
    last = F.max(F.when(F.col("tp_kind") == END, F.col("tp_rank"))).alias("tp_to")
    reach = swept.where(~is_message).groupBy("tp_span").agg(first, last).where("tp_from <= tp_to")
    stretches = F.sequence(F.expr(f"tp_from div {int(width)}L"), F.expr(f"tp_to div {int(width)}L"))
    touched = usable.drop("topic", "seq").join(reach, "tp_span").withColumn("tp_bucket", F.explode(stretches))
    touched = stored(touched, fresh_folder(spark, "touched"))
    crowded = touched.groupBy("tp_bucket").agg(F.expr(f"1 + count(1) div {CROWD}L").alias("tp_shares")).where("tp_shares > 1")
    shares = F.coalesce("tp_shares", F.lit(1))
    dealt = touched.join(crowded, "tp_bucket", "left").withColumn("tp_share", F.pmod(F.xxhash64("tp_span"), shares))
    placed = swept.where(is_message).select("seq", "topic", "tp_rank", F.expr(f"tp_rank div {int(width)}L").alias("tp_bucket"))
    placed = placed.join(crowded, "tp_bucket", "left").withColumn("tp_share", F.explode(F.sequence(F.lit(0).cast("bigint"), shares - 1)))
    # the join multiplies rows: spread the messages first, over a fixed number of partitions that stay apart
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    met = placed.drop("tp_shares").repartition(parts, "tp_bucket", "tp_share")
    met = met.join(dealt.drop("tp_shares").hint("merge"), ["tp_bucket", "tp_share"])
    return met.where("tp_rank between tp_from and tp_to").select(
        "seq", "topic", *(name for name in spans.columns if name not in ("topic", "seq"))
    )


def fan_out(sends: DataFrame, intervals: DataFrame, width: int = FAN_OUT_WIDTH) -> DataFrame:
    """One row per message and subscription open on its topic at that moment: ``seq``, ``topic``, ``subscriber_id``."""
    return spans_joined(sends, intervals, width).select("seq", "topic", "subscriber_id")


def fetch_spans(intervals: DataFrame, fetches: DataFrame, width: int = WIDTH) -> DataFrame:
    """Each subscription cut at its fetches: ``start_seq``, ``end_seq`` and ``fetch_seq``, the fetch that ends the span.

    Messages sent within a span are drained by its fetch; those of the last span, whose ``fetch_seq`` is null, by none.
    ``fetches`` are successful ones, so they lie within their subscription.
    """
    starts = intervals.select("subscriber_id", "topic", F.col("start_seq").alias("seq"), "end_seq")
    cuts = fetches.select("subscriber_id", "seq").join(
        intervals.select("subscriber_id", "topic", "end_seq"), "subscriber_id"
    )
    begun = starts.unionByName(cuts.select(starts.columns))
    ended = first_after(begun, fetches, key="subscriber_id", seq="seq", out="fetch_seq", width=width)
    return ended.select(
        "subscriber_id", "topic", F.col("seq").alias("start_seq"), F.coalesce("fetch_seq", "end_seq").alias("end_seq"), "fetch_seq"
    )


def drain_assignment(sends: DataFrame, spans: DataFrame, width: int = FAN_OUT_WIDTH) -> DataFrame:
    """The deliveries with ``fetch_seq``: the subscriber's first fetch after the message, null when there was none."""
    return spans_joined(sends, spans, width).select("seq", "topic", "subscriber_id", "fetch_seq")


def undelivered(sends: DataFrame, intervals: DataFrame, fetches: DataFrame, width: int = WIDTH) -> DataFrame:
    """Messages nobody ever fetched: no open subscription, or none that fetched in time.

    A message was fetched when a subscription of its topic had begun before it and has its last fetch after it. So the
    largest last fetch among the subscriptions begun before is enough; no copies are made.
    """
    last = fetches.groupBy("subscriber_id").agg(F.max("seq").alias("last_fetch"))
    begun = intervals.join(last, "subscriber_id").select("topic", F.col("start_seq").alias("seq"), "last_fetch")
    judged = largest_before(sends.select("seq", "topic"), begun, key="topic", seq="seq", value="last_fetch", width=width)
    return judged.where("last_fetch is null or last_fetch < seq").select("seq", "topic")


def lost_copies(sends: DataFrame, spans: DataFrame, width: int = FAN_OUT_WIDTH) -> DataFrame:
    """Copies that were put aside for a subscription and never fetched: those of the spans that no fetch ends."""
    return spans_joined(sends, spans.where("fetch_seq is null"), width).select("seq", "topic", "subscriber_id")


class Audit:
    """All of the above over one log. Each step is stored in ``folder`` when first asked for and read by later ones.

    As a context manager it removes what it has stored at the end.
    """

    def __init__(
        self,
        actions: DataFrame,
        topics: DataFrame,
        folder: str,
        width: int = WIDTH,
        fan_width: int = FAN_OUT_WIDTH,
    ):
        self.actions, self.topics, self.folder = actions, topics, folder
        self.width, self.fan_width = width, fan_width

    def _stored(self, frame: DataFrame, step: str) -> DataFrame:
        return stored(frame, f"{self.folder}/{step}")

    @cached_property
    def intervals(self) -> DataFrame:
        return self._stored(subscription_intervals(self.actions, self.topics, self.width), "intervals")

    @cached_property
    def requests(self) -> DataFrame:
        return self._stored(classify_requests(self.actions, self.topics, intervals=self.intervals), "requests")

    def _passed(self, action: str) -> DataFrame:
        return self.requests.where((F.col("status") == "ok") & (F.col("action") == action))

    @property
    def sends(self) -> DataFrame:
        return self._passed(SEND)

    @property
    def fetches(self) -> DataFrame:
        return self._passed(FETCH)

    @cached_property
    def deliveries(self) -> DataFrame:
        return self._stored(fan_out(self.sends, self.intervals, self.fan_width), "deliveries")

    @cached_property
    def spans(self) -> DataFrame:
        return self._stored(fetch_spans(self.intervals, self.fetches, self.width), "spans")

    @cached_property
    def assigned(self) -> DataFrame:
        return self._stored(drain_assignment(self.sends, self.spans, self.fan_width), "assigned")

    @property
    def undelivered(self) -> DataFrame:
        return undelivered(self.sends, self.intervals, self.fetches, self.width)

    @property
    def lost_copies(self) -> DataFrame:
        return lost_copies(self.sends, self.spans, self.fan_width)

    def __enter__(self) -> Audit:
        return self

    def __exit__(self, *_) -> None:
        Store(self.actions.sparkSession, self.folder).drop(self.folder)
