"""Keep a topic small: compact many small batches, release what everybody has read, clear files nobody needs.

All three are commits to the topic's manifest, made by whoever calls them; readers and writers need not stop. Compaction and
release change what later readers read. Files go only with :func:`clear`, and only those whose commit is older than
the time a reader may still be using them.
"""

from __future__ import annotations

import json
import time
import uuid
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from topicflow.sources.catalog import fetch_schema
from topicflow.sources.log import compacted_schema, manifest, own_files, placed, split_compacted
from topicflow.functions.rows import quoted
from topicflow.sources.manifest import Commit, State, log_folder
from topicflow.storage import Store
from topicflow.streaming.subscriptions import Subscription, unread_from

ROWS_PER_FILE = 2_000_000
HOUR = 3600.0


def compact(
    spark: SparkSession, root: str, topic: str, *, rows_per_file: int = ROWS_PER_FILE, again: bool = False
) -> int:
    """Store the rows of all batches that lie in files of their own anew, in few files sorted by commit and offset.

    With ``again`` earlier compactions are taken in too. Ids, receive times and positions are columns of the new files, so they
    stay as they are, and a stream goes on from its version wherever it was. Returns the number of batches moved; fewer than two
    are left alone. If somebody else's compaction or release gets in between, nothing is changed.
    """
    known, store = manifest(spark, root, topic), Store(spark, root)
    state, schema = known.state(), fetch_schema(spark, root, topic)
    done = max([one["to"] for one in state.compacted], default=0)
    low = state.below if again else max(done, state.below)
    batches = known.batches(state, low)
    own, moved = split_compacted(state, batches)
    if len(own) + len(moved) < 2:
        return 0
    columns = compacted_schema(schema).fieldNames()
    parts = []
    if own:
        parts.append(placed(spark, own_files(spark, root, topic, schema, own), own))
    for one, versions in moved:
        paths = [f"{root}/{one['folder']}/{file[0]}" for file in one["files"]]
        rows = spark.read.schema(compacted_schema(schema)).parquet(*paths)
        parts.append(rows.where(F.col("tp_version") >= min(versions)))
    rows = reduce(DataFrame.unionByName, [part.select(*map(quoted, columns)) for part in parts])
    folder = f"{log_folder(topic)}/compacted/{uuid.uuid4().hex}"
    total = sum(commit["rows"] for _, commit in batches)
    order = ["tp_version", "tp_offset"]
    rows.repartitionByRange(max(1, -(-total // rows_per_file)), *order).sortWithinPartitions(*order).write.parquet(
        f"{root}/{folder}"
    )
    files = (
        spark.read.schema("tp_version bigint")
        .parquet(f"{root}/{folder}")
        .groupBy(F.col("_metadata.file_name").alias("name"))
        .agg(F.min("tp_version").alias("first"), F.max("tp_version").alias("last"), F.count(F.lit(1)).alias("rows"))
        .collect()
    )
    listed = sorted(([file.name, file["first"], file["last"], file.rows] for file in files), key=lambda file: file[1:])
    begin = min([low, *(one["from"] for one, _ in moved)])

    def moved_to(newer: State) -> Commit | None:
        if newer.compacted != state.compacted or newer.below != state.below:
            return None
        return {"do": "compact", "from": begin, "to": state.version + 1, "folder": folder, "files": listed}

    if known.append(moved_to)[1] is None:
        store.drop(f"{root}/{folder}")
        return 0
    return len(batches)


def unread_version(spark: SparkSession, root: str, topic: str) -> int | None:
    """The first version that an open subscription of the topic may still need; None without open subscriptions."""
    store, needed = Store(spark, root), []
    for name in store.names(f"{root}/subscriptions"):
        folder = f"{root}/subscriptions/{name}"
        text = store.text_if_there(f"{folder}/spec.json")
        if text is None or store.exists(f"{folder}/ended"):
            continue
        spec = json.loads(text)
        if spec["topic"] == topic:
            needed.append(unread_from(store, root, Subscription(name, topic, spec["version"])))
    return min(needed, default=None)


def release(spark: SparkSession, root: str, topic: str, *, keep_below: int | None = None) -> int:
    """Give up the batches that every open subscription of the topic has fetched. Returns their number.

    Their rows are no longer read by anybody who begins now; positions of later rows stay. A topic without open subscriptions keeps everything.
    ``keep_below`` holds back versions from there on, for streams that read without a subscription.
    """
    known, needed = manifest(spark, root, topic), unread_version(spark, root, topic)
    if needed is None:
        return 0
    needed = needed if keep_below is None else min(needed, keep_below)
    before = known.state().below

    def released(state: State) -> Commit | None:
        below = min(needed, state.version + 1)
        return {"do": "release", "below": below} if below > state.below else None

    state, commit = known.append(released)
    if commit is None:
        return 0
    return sum(one["do"] == "add" for _, one in known.commits(state, before, state.below))


def clear(spark: SparkSession, root: str, topic: str, *, older_than: float = HOUR) -> int:
    """Remove files of batches that were released, or stored anew, more than ``older_than`` seconds ago. Returns the folders removed.

    Tables and micro-batches that were planned before then must have ended.
    """
    known, store = manifest(spark, root, topic), Store(spark, root)
    state, until = known.state(), time.time() - older_than
    below = max([state.cleaned, *(version for version, at in state.released if at <= until)])
    stale = [folder for folder, at in state.stale if at <= until]
    compacted = [one for one in state.compacted if one["at"] <= until and not one["cleaned"]]
    spans = [(state.cleaned, below), *((max(one["from"], below), one["to"]) for one in compacted)]
    batches = [commit["folder"] for low, high in spans for _, commit in known.commits(state, low, high) if commit["do"] == "add"]
    there = [folder for folder in [*batches, *stale] if store.exists(f"{root}/{folder}")]
    for folder in there:
        store.drop(f"{root}/{folder}")
    if stale or compacted or below > state.cleaned:
        gone = {"do": "clean", "below": below, "stale": stale, "compacted": [one["version"] for one in compacted]}
        known.append(lambda _: gone)
    return len(there)
