"""The log: publish rows to a topic, read them back as a table or as a stream.

Spark writes the files of a batch straight to where they stay,

    <root>/log/<topic>/tp_producer=<p>/tp_batch_id=<n>/<attempt>/part-*.parquet

with the user's columns plus ``tp_seq`` (task number and row number within the task, as Spark numbers rows) and ``tp_ts`` (receive
time). Then the files are counted, and one commit to the topic's :mod:`~topicflow.sources.manifest` makes the batch visible: it names
the files and the offset each begins with. A row's offset in its batch is that number plus its row number in the file.
So rows are written once, in parallel, without a shuffle, and no file is ever renamed.

Readers take their files from the manifest; nothing lists a topic's folders. Compacted batches
(:mod:`~topicflow.operators.upkeep`) lie in files that hold all stamps as columns.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Sequence
from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from topicflow.errors import StaleBatch
from topicflow.functions.rows import STAMPS, quoted
from topicflow.sources.catalog import (
    TIMESTAMP_COLUMN,
    check_name,
    check_rows,
    fetch_schema,
    schemas,
    source_schema,
)
from topicflow.sources.manifest import Commit, Manifest, State, batch_folder, log_folder
from topicflow.storage import Store

BROADCAST_FILES = 100_000  # names and first offsets of so many files are sent to every task, about 10 MB

Batches = Sequence[tuple[int, Commit]]


class Receipt(NamedTuple):
    """What a publish answers with."""

    topic: str
    producer: str
    batch_id: int
    rows: int
    replayed: bool


def manifest(spark: SparkSession, root: str, topic: str) -> Manifest:
    return Manifest(Store(spark, root), root, topic)


def heads(spark: SparkSession, root: str, topic: str) -> dict[str, int]:
    """Newest batch id of every producer of a topic."""
    return {producer: head[0] for producer, head in manifest(spark, root, topic).state().heads.items()}


# --- writing ---------------------------------------------------------------------------------------------------------


def _in_order(rows: DataFrame, order_by: Sequence, draft: str) -> DataFrame:
    """Rows in global order over range partitions.

    The rows are stored first, so that the frame is computed once and row ids cannot change between the sampling job
    and the sort, even after a lost executor. The id spreads rows with equal keys over several partitions.
    """
    spark = rows.sparkSession
    rows.write.parquet(draft)
    stored = spark.read.schema(rows.schema).parquet(draft)
    tied = stored.withColumn("tp_tie", F.xxhash64(F.monotonically_increasing_id()))
    return tied.repartitionByRange(*order_by, "tp_tie").sortWithinPartitions(*order_by, "tp_tie").drop("tp_tie")


def _counted(spark: SparkSession, folder: str) -> list[list]:
    """[name, first row number, offset of the first row, rows] of the files of a finished write, in order."""
    files = (
        spark.read.schema("tp_seq bigint")
        .parquet(folder)
        .groupBy(F.col("_metadata.file_name").alias("name"))
        .agg(F.min("tp_seq").alias("seq"), F.count(F.lit(1)).alias("rows"))
        .collect()
    )
    found, offset = [], 0
    for file in sorted(files, key=lambda file: file.seq):
        found.append([file.name, file.seq, offset, file.rows])
        offset += file.rows
    return found


def added(producer: str, batch_id: int, folder: str, files: list[list], schema: int, head: Sequence[int] | None) -> Commit:
    """The commit of a batch whose files are in place. ``schema`` is the number of the schema they are in."""
    where = {"do": "add", "producer": producer, "batch_id": batch_id, "folder": folder, "files": files, "schema": schema}
    return where | {"rows": sum(file[3] for file in files), "first": head[1] if head else 0}


def known_batch(known: Manifest, state: State, topic: str, producer: str, batch_id: int) -> Receipt | None:
    """Receipt of a batch that is there already, None for a new one; an id that comes too late is an error."""
    head = state.heads.get(producer)
    if head is None or batch_id > head[0]:
        return None
    found = known.batch(state, producer, batch_id)
    if found is None:
        raise StaleBatch(f"{producer}: batch {batch_id} after batch {head[0]}")
    return Receipt(topic, producer, batch_id, found[1]["rows"], True)


def publish(
    spark: SparkSession,
    root: str,
    topic: str,
    rows: DataFrame,
    *,
    producer: str,
    batch_id: int,
    order_by: Sequence[str | Column] = (),
    received_at: Column | None = None,
) -> Receipt:
    """Append ``rows`` to a topic as one batch.

    A batch id that is already stored is a replay: nothing is written and the first receipt comes back. New ids of a
    producer must increase. An empty frame stores nothing. Without ``order_by`` offsets follow the frame's partitions.
    Of several writers of one batch the first to commit wins.
    """
    number = check_rows(rows.schema, schemas(spark, root, topic))
    check_name("producer", producer)
    store, known, attempt = Store(spark, root), manifest(spark, root, topic), uuid.uuid4().hex
    receipt = known_batch(known, known.state(), topic, producer, batch_id)
    if receipt:
        return receipt
    folder, draft, committed = batch_folder(topic, producer, batch_id, attempt), f"{root}/staging/{attempt}", False
    try:
        if order_by:
            rows = _in_order(rows, order_by, draft)
        stamp = F.current_timestamp() if received_at is None else received_at.cast("timestamp")
        rows.select(
            *map(quoted, rows.columns),
            F.monotonically_increasing_id().alias("tp_seq"),
            stamp.alias("tp_ts"),
        ).write.parquet(f"{root}/{folder}")
        files = _counted(spark, f"{root}/{folder}")
        if not files:
            return Receipt(topic, producer, batch_id, 0, False)

        def batch(state: State) -> Commit | None:
            if known_batch(known, state, topic, producer, batch_id):
                return None
            return added(producer, batch_id, folder, files, number, state.heads.get(producer))

        state, commit = known.append(batch)
        committed = commit is not None
        if not committed:
            return known_batch(known, state, topic, producer, batch_id)
        return Receipt(topic, producer, batch_id, commit["rows"], False)
    finally:
        if order_by:
            store.drop(draft)
        if not committed:
            store.drop(f"{root}/{folder}")


def local_frame(spark: SparkSession, schema: T.StructType, rows: Sequence) -> DataFrame:
    """A few local rows: tuples, Rows or, for a one-column topic, plain values."""
    if len(schema) == 1:
        rows = [row if isinstance(row, (tuple, dict)) else (row,) for row in rows]
    return spark.createDataFrame(rows, schema)


def publish_rows(
    spark: SparkSession, root: str, topic: str, rows: Sequence, *, producer: str, batch_id: int, **options
) -> Receipt:
    """Publish a few local rows."""
    frame = local_frame(spark, fetch_schema(spark, root, topic), rows)
    return publish(spark, root, topic, frame, producer=producer, batch_id=batch_id, **options)


# --- reading ---------------------------------------------------------------------------------------------------------


def file_schema(schema: T.StructType) -> T.StructType:
    """What the files of a batch hold, and their partition columns."""
    return T.StructType(
        schema.fields
        + [
            T.StructField("tp_seq", T.LongType()),
            T.StructField("tp_ts", T.TimestampType()),
            T.StructField("tp_producer", T.StringType()),
            T.StructField("tp_batch_id", T.LongType()),
        ]
    )


def stamped_schema(schema: T.StructType) -> T.StructType:
    """The topic's columns and the stamps, as reading a topic gives them."""
    kinds = {"tp_producer": T.StringType(), "tp_ts": T.TimestampType()}
    return T.StructType(schema.fields + [T.StructField(name, kinds.get(name, T.LongType())) for name in STAMPS])


def compacted_schema(schema: T.StructType) -> T.StructType:
    """What compacted files hold."""
    more = [T.StructField("tp_position", T.LongType()), T.StructField("tp_version", T.LongType())]
    return T.StructType(stamped_schema(schema).fields + more)


def split_compacted(state: State, batches: Batches) -> tuple[list[tuple[int, Commit]], list[tuple[dict, list[int]]]]:
    """The batches that lie in files of their own, and for each compaction the versions that lie in its files."""
    own, moved = [], {}
    for version, commit in batches:
        one = state.compaction_of(version)
        if one is None:
            own.append((version, commit))
        else:
            moved.setdefault(one["version"], (one, []))[1].append(version)
    return own, list(moved.values())


def own_files(spark: SparkSession, root: str, topic: str, schema: T.StructType, batches: Batches) -> DataFrame:
    reader = spark.read.schema(file_schema(schema)).option("basePath", f"{root}/{log_folder(topic)}")
    return reader.parquet(*(f"{root}/{commit['folder']}/{file[0]}" for _, commit in batches for file in commit["files"]))


def placed(spark: SparkSession, files: DataFrame, batches: Batches) -> DataFrame:
    """``files`` with tp_offset, tp_position and tp_version, by what the manifest says of each file."""
    firsts = [
        (name, offset - seq, commit["first"], version)
        for version, commit in batches
        for name, seq, offset, _ in commit["files"]
    ]
    known = spark.createDataFrame(firsts, "tp_file string, tp_base bigint, tp_first bigint, tp_version bigint")
    if len(firsts) <= BROADCAST_FILES:
        known = F.broadcast(known)
    offset = F.col("tp_base") + F.col("tp_seq")
    met = files.withColumn("tp_file", F.col("_metadata.file_name")).join(known, "tp_file")
    return met.withColumns({"tp_offset": offset, "tp_position": F.col("tp_first") + offset})


def _compacted_files(
    spark: SparkSession, root: str, schema: T.StructType, one: dict, versions: Sequence[int], exactly: bool
) -> DataFrame:
    """The rows of some versions in the files of a compaction; of all between the first and the last if not ``exactly``."""
    low, high = min(versions), max(versions)
    paths = [f"{root}/{one['folder']}/{name}" for name, first, last, _ in one["files"] if first <= high and last >= low]
    rows = spark.read.schema(compacted_schema(schema)).parquet(*paths).where(F.col("tp_version").between(low, high))
    return rows.where(F.col("tp_version").isin(list(versions))) if exactly else rows


def _rows(
    spark: SparkSession,
    root: str,
    topic: str,
    state: State,
    batches: Batches,
    columns: Iterable[str],
    stamped: bool = True,
    exactly: bool = False,
) -> DataFrame:
    """Some batches of a topic. Offsets and positions are worked out only if ``stamped``.

    Batches that follow each other in the manifest need no ``exactly``.
    """
    schema, columns = fetch_schema(spark, root, topic), list(columns)
    own, moved = split_compacted(state, batches)
    parts = []
    if own:
        files = own_files(spark, root, topic, schema, own)
        parts.append(placed(spark, files, own) if stamped else files)
    parts += [_compacted_files(spark, root, schema, one, versions, exactly) for one, versions in moved]
    if not parts:
        parts = [spark.createDataFrame([], compacted_schema(schema))]
    return reduce(DataFrame.unionByName, [part.select(*map(quoted, columns)) for part in parts])


def _stamped_columns(spark: SparkSession, root: str, topic: str) -> list[str]:
    return stamped_schema(fetch_schema(spark, root, topic)).fieldNames()


def read_versions(spark: SparkSession, root: str, topic: str, low: int = 0, high: int | None = None) -> DataFrame:
    """Rows with their stamps of the batches committed in versions from ``low`` up to ``high``, excluded."""
    columns, known = _stamped_columns(spark, root, topic), manifest(spark, root, topic)
    state = known.state()
    return _rows(spark, root, topic, state, known.batches(state, low, high), columns)


def read_topic(spark: SparkSession, root: str, topic: str) -> DataFrame:
    """All rows of a topic that are not released, with their stamps."""
    return read_versions(spark, root, topic)


def read_batches(spark: SparkSession, root: str, topic: str, batches: Sequence[tuple[str, int]]) -> DataFrame:
    """The rows of given (producer, batch id) pairs. Only their files are read."""
    columns, known = _stamped_columns(spark, root, topic), manifest(spark, root, topic)
    state = known.state()
    found = [known.batch(state, producer, batch_id) for producer, batch_id in batches]
    live = [one for one in found if one is not None and one[0] >= state.below]
    return _rows(spark, root, topic, state, live, columns, exactly=True)


def _stream(spark: SparkSession, root: str, topic: str, **options) -> DataFrame:
    from topicflow.sources.format import register

    fetch_schema(spark, root, topic)
    register(spark)
    reader = spark.readStream.format("topicflow").option("root", root).option("topic", topic)
    return reader.options(**options).load()


def read_topic_stream(spark: SparkSession, root: str, topic: str, **options) -> DataFrame:
    """The topic as a stream, rows with their stamps. Options are those of the ``topicflow`` format."""
    return _stream(spark, root, topic, stamps="true", **options)


def topic_source(
    spark: SparkSession,
    root: str,
    topic: str,
    *,
    stream: bool = True,
    includes_timestamp: bool = False,
    timestamp_column: str = TIMESTAMP_COLUMN,
    **options,
) -> DataFrame:
    """What a consumer reads: the topic's own columns and, when asked for, the receive time last."""
    schema = fetch_schema(spark, root, topic)
    source_schema(schema, includes_timestamp, timestamp_column)
    if stream:
        told = {"includesTimestamp": str(includes_timestamp).lower(), "timestampColumnName": timestamp_column}
        return _stream(spark, root, topic, **told, **options)
    known = manifest(spark, root, topic)
    state = known.state()
    names = schema.fieldNames()
    rows = _rows(spark, root, topic, state, known.batches(state), [*names, "tp_ts"], stamped=False)
    columns = [quoted(name) for name in names]
    if includes_timestamp:
        columns.append(F.col("tp_ts").alias(timestamp_column))
    return rows.select(*columns)


# --- counting --------------------------------------------------------------------------------------------------------


def receipts(rows: DataFrame, *more: str, size: Column | None = None) -> DataFrame:
    """Rows, last offset and, given a size per row, bytes of each batch (and of ``more`` columns within it)."""
    measures = [F.count(F.lit(1)).alias("rows"), F.max("tp_offset").alias("last_offset")]
    if size is not None:
        measures.append(F.sum(size.cast("bigint")).alias("bytes"))
    return rows.groupBy("tp_producer", "tp_batch_id", *more).agg(*measures)


def offset_range(spark: SparkSession, root: str, topic: str, producer: str, end: int, start: int = -1) -> DataFrame:
    """Rows of a producer at positions in (start, end], counted over all its batches, as ``tp_position``.

    The batches are found by binary search in the manifest, and only files that hold positions of the range are read. Released
    rows keep their positions and are not returned.
    """
    columns, known = _stamped_columns(spark, root, topic), manifest(spark, root, topic)
    state = known.state()
    touched = []
    for version, commit in known.positions(state, producer, start + 1, end):
        low, high = start + 1 - commit["first"], end - commit["first"]
        files = [file for file in commit["files"] if file[2] <= high and file[2] + file[3] > low]
        touched.append((version, commit | {"files": files}))
    rows = _rows(spark, root, topic, state, touched, [*columns, "tp_position"])
    return rows.where((F.col("tp_producer") == producer) & F.col("tp_position").between(start + 1, end))
