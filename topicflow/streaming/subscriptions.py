"""Subscriptions: a start in a topic's manifest and a cursor, both just a version number.

A fetch reads the commits after the cursor and then the files they name. Nothing is listed, and the cost does not
depend on how much the topic holds.
"""

from __future__ import annotations

import json
from collections.abc import Callable
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession

from topicflow.errors import InvalidSubscription
from topicflow.sources.catalog import TIMESTAMP_COLUMN, check_name, fetch_schema
from topicflow.sources.log import manifest, read_topic_stream, read_versions, topic_source
from topicflow.storage import Store


class Subscription(NamedTuple):
    name: str
    topic: str
    version: int
    """Version of the topic at the time of subscribing; what comes later belongs to the subscription."""


class Cursor(NamedTuple):
    version: int
    """Everything up to this version has been fetched."""
    number: int
    """Calls of ``drain`` so far."""
    until: int | None
    """The version a call that has not come back was given rows up to."""


def _folder(root: str, name: str) -> str:
    return f"{root}/subscriptions/{name}"


def subscribe(spark: SparkSession, root: str, topic: str, name: str | None = None) -> Subscription:
    """Open a subscription that sees what is published from now on. Unnamed ones become ``subscriber-<n>``."""
    fetch_schema(spark, root, topic)
    store, version = Store(spark, root), manifest(spark, root, topic).state().version
    text = json.dumps({"topic": topic, "version": version})
    if name is not None:
        store.mkdirs(_folder(root, check_name("subscription", name)))
        if not store.commit_text(f"{_folder(root, name)}/spec.json", text):
            raise InvalidSubscription(f"subscription {name!r} exists")
        return Subscription(name, topic, version)
    number = 1 + sum(taken.startswith("subscriber-") for taken in store.names(f"{root}/subscriptions"))
    while True:
        name = f"subscriber-{number}"
        store.mkdirs(_folder(root, name))
        if store.commit_text(f"{_folder(root, name)}/spec.json", text):
            return Subscription(name, topic, version)
        number += 1


def open_subscription(spark: SparkSession, root: str, name: str) -> Subscription:
    """Look up a subscription; fails when it is unknown or has ended."""
    store, folder = Store(spark, root), _folder(root, check_name("subscription", name))
    text = store.text_if_there(f"{folder}/spec.json")
    if text is None or store.exists(f"{folder}/ended"):
        raise InvalidSubscription(f"invalid subscription: {name}")
    spec = json.loads(text)
    return Subscription(name, spec["topic"], spec["version"])


def unsubscribe(spark: SparkSession, root: str, name: str) -> str:
    """End a subscription. What it has not fetched can no longer be fetched under this name."""
    open_subscription(spark, root, name)
    Store(spark, root).commit_text(f"{_folder(root, name)}/ended", "")
    return name


def cursor(store: Store, root: str, subscription: Subscription) -> Cursor:
    """How far fetching and draining have come."""
    text = store.text_if_there(f"{_folder(root, subscription.name)}/cursor.json")
    return Cursor(*json.loads(text)) if text else Cursor(subscription.version, 0, None)


def _keep(store: Store, root: str, subscription: Subscription, place: Cursor) -> None:
    store.replace_text(f"{_folder(root, subscription.name)}/cursor.json", json.dumps(place))


def done_by_stream(store: Store, root: str, subscription: Subscription) -> int | None:
    """How far a stream with this subscription has come, None if there is none."""
    text = store.text_if_there(f"{_folder(root, subscription.name)}/stream.json")
    return json.loads(text)["version"] if text else None


def unread_from(store: Store, root: str, subscription: Subscription) -> int:
    """The first version that this subscription may still need."""
    streamed, place = done_by_stream(store, root, subscription), cursor(store, root, subscription)
    if streamed is None:
        return place.version + 1
    touched = place != Cursor(subscription.version, 0, None)  # fetched from as well
    return 1 + (min(streamed, place.version) if touched else streamed)


def subscription_stream(spark: SparkSession, root: str, name: str, **options) -> DataFrame:
    """The subscription's rows as a stream, for a consumer that keeps its own checkpoint.

    The subscription's cursor follows the stream, for :func:`topicflow.operators.upkeep.release`.
    """
    subscription = open_subscription(spark, root, name)
    return read_topic_stream(spark, root, subscription.topic, subscription=name, **options)


def source_from_now(
    spark: SparkSession,
    root: str,
    topic: str,
    name: str | None = None,
    *,
    includes_timestamp: bool = False,
    timestamp_column: str = TIMESTAMP_COLUMN,
    **options,
) -> DataFrame:
    """The topic as a stream of what is published from now on: its columns and, when asked for, the receive time last.

    A subscription is opened for it. With the ``name`` of an open subscription the stream begins where that one did, so
    a restarted program goes on with its checkpoint.
    """
    if name is None or not Store(spark, root).exists(f"{_folder(root, check_name('subscription', name))}/spec.json"):
        name = subscribe(spark, root, topic, name).name
    name = open_subscription(spark, root, name).name
    told = {"includes_timestamp": includes_timestamp, "timestamp_column": timestamp_column}
    return topic_source(spark, root, topic, subscription=name, **told, **options)


def fetch(spark: SparkSession, root: str, name: str) -> DataFrame:
    """Everything not fetched yet, as a table over the log; afterwards it counts as fetched.

    If the caller fails while using the table, its rows are not given again; :func:`drain` gives them again.
    """
    subscription, store = open_subscription(spark, root, name), Store(spark, root)
    place, newest = cursor(store, root, subscription), manifest(spark, root, subscription.topic).state().version
    rows = read_versions(spark, root, subscription.topic, place.version + 1, newest + 1)
    _keep(store, root, subscription, Cursor(newest, place.number, None))
    return rows


def drain(
    spark: SparkSession, root: str, name: str, each: Callable[[DataFrame, int], None], max_batches: int | None = None
) -> None:
    """Give everything not fetched yet to ``each``, at most ``max_batches`` published batches at a time.

    The second argument numbers the calls. After a failure the same rows come again under the same number.
    """
    subscription, store = open_subscription(spark, root, name), Store(spark, root)
    known, place = manifest(spark, root, subscription.topic), cursor(store, root, subscription)
    state = known.state()
    while True:
        until = place.until
        if until is None:
            waiting = known.batches(state, place.version + 1)[:max_batches]
            if not waiting:
                return
            until = waiting[-1][0]
            _keep(store, root, subscription, place._replace(until=until))
        each(read_versions(spark, root, subscription.topic, place.version + 1, until + 1), place.number)
        place = Cursor(until, place.number + 1, None)
        _keep(store, root, subscription, place)
