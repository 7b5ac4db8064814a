"""Topics under a format name.

    spark.dataSource.register(TopicFormat)        # or topicflow.sources.format.register(spark)
    spark.readStream.format("topicflow").option("root", ...).option("topic", ...).load()
    spark.read.format("topicflow")...
    stream.writeStream.format("topicflow").option("root", ...).option("topic", ...).option("producer", ...).start()
    frame.write.format("topicflow").option("batchId", 7).mode("append")...

A stream's offset is one number, the version of the topic's manifest it has come to; that is all its checkpoint and the driver keep.
Each micro-batch is planned from the commits after it. Tasks read files as Arrow batches and write one file each;
a writer's commit moves the folder of a batch into place and adds it to the manifest, and a repeated micro-batch changes nothing.

Options for reading: ``includesTimestamp`` and ``timestampColumnName`` (the receive time as last column), ``stamps`` (all stamps), ``startingVersion``
(read what is committed after it), ``subscription`` (begin where it did, and keep its cursor: what is behind the cursors of all
subscriptions can be released), ``failOnDataLoss`` (false: go on where released batches are missing), ``rowsPerTask``.
Options for writing: ``producer``, for tables ``batchId``.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator, Sequence
from datetime import UTC, datetime
from typing import NamedTuple

import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.parquet as pq
from pyspark import TaskContext
from pyspark.sql import SparkSession
from pyspark.sql import datasource as D
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from topicflow.errors import InvalidName, InvalidSubscription, ReleasedBatches, UnknownTopic
from topicflow.mounted import MountedFiles
from topicflow.sources import catalog
from topicflow.sources.log import added, known_batch, split_compacted, stamped_schema
from topicflow.sources.manifest import Manifest, batch_folder, log_folder

ROWS_PER_TASK = 1_000_000
TASK_BITS = 33
TS = pa.timestamp("us", tz="UTC")


class Piece(NamedTuple):
    """A file to read: all of a batch's file, or the rows of some versions of a compacted one."""

    path: str
    producer: str | None
    batch_id: int | None
    base: int
    versions: tuple[int, int] | None


class Pieces(D.InputPartition):
    def __init__(self, pieces: list[Piece]):
        super().__init__(pieces)


def _flag(options: dict, name: str, default: str = "false") -> bool:
    return str(options.get(name, default)).lower() == "true"


def _needed(options: dict, name: str) -> str:
    if not options.get(name):
        raise InvalidName(f"option {name!r} is missing")
    return options[name]


class Topic:
    """What the options name."""

    def __init__(self, options: dict):
        self.root = _needed(options, "root").rstrip("/")
        self.topic = catalog.check_name("topic", _needed(options, "topic"))
        self.files = MountedFiles(self.root)
        texts = catalog.schema_texts(self.files, self.root, self.topic)
        if not texts:
            raise UnknownTopic(f"topic {self.topic!r} does not exist")
        self.schemas = [T.StructType.fromJson(json.loads(text)) for text in texts]
        self.schema = self.schemas[-1]
        self.manifest = Manifest(self.files, self.root, self.topic)


class Reading:
    """Plans tasks and reads files; used for tables and streams."""

    def __init__(self, options: dict, schema: T.StructType):
        self.topic, self.schema = Topic(options), schema
        self.rows_per_task = int(options.get("rowsPerTask", ROWS_PER_TASK))
        self.renamed = {options.get("timestampColumnName", catalog.TIMESTAMP_COLUMN): "tp_ts"}
        if not _flag(options, "includesTimestamp"):
            self.renamed = {}

    def plan(self, state, batches) -> list[Pieces]:
        """Tasks of about ``rowsPerTask`` rows, in the order of the commits."""
        own, moved = split_compacted(state, batches)
        root, found = self.topic.root, []
        for _, commit in own:
            for name, seq, offset, rows in commit["files"]:
                place = f"{root}/{commit['folder']}/{name}"
                found.append((rows, Piece(place, commit["producer"], commit["batch_id"], offset - seq, None)))
        for one, versions in moved:
            low, high = min(versions), max(versions)
            for name, first, last, rows in one["files"]:
                if first <= high and last >= low:
                    found.append((rows, Piece(f"{root}/{one['folder']}/{name}", None, None, 0, (low, high))))
        tasks, waiting, total = [], [], 0
        for rows, piece in found:
            if waiting and total + rows > self.rows_per_task:
                tasks.append(Pieces(waiting))
                waiting, total = [], 0
            waiting.append(piece)
            total += rows
        return [*tasks, Pieces(waiting)] if waiting else tasks

    def read(self, pieces: list[Piece]) -> Iterator[pa.RecordBatch]:
        target = to_arrow_schema(self.schema)
        for piece in pieces:
            with self.topic.files.system.open_input_file(self.topic.files.path(piece.path)) as opened:
                file = pq.ParquetFile(opened, coerce_int96_timestamp_unit="us")
                wanted = {self.renamed.get(name, name) for name in target.names} | {"tp_seq", "tp_version"}
                there = [name for name in file.schema_arrow.names if name in wanted]
                for batch in file.iter_batches(columns=there):
                    if piece.versions:
                        version = batch.column("tp_version")
                        low, high = piece.versions
                        batch = batch.filter(pc.and_(pc.greater_equal(version, low), pc.less_equal(version, high)))
                    yield pa.RecordBatch.from_arrays([self._column(batch, field, piece) for field in target], schema=target)

    def _column(self, batch: pa.RecordBatch, field: pa.Field, piece: Piece) -> pa.Array:
        name = self.renamed.get(field.name, field.name)
        if piece.versions is None and name == "tp_producer":
            return pa.array([piece.producer] * len(batch), field.type)
        if piece.versions is None and name == "tp_batch_id":
            return pa.array([piece.batch_id] * len(batch), field.type)
        if piece.versions is None and name == "tp_offset":
            return pc.add(batch.column("tp_seq"), piece.base)
        if name not in batch.schema.names:  # a column the topic got later
            return pa.nulls(len(batch), field.type)
        column = batch.column(name)
        return column if column.type == field.type else column.cast(field.type)


class TableReader(D.DataSourceReader):
    def __init__(self, options: dict, schema: T.StructType):
        self.reading = Reading(options, schema)

    def partitions(self) -> Sequence[Pieces]:
        known = self.reading.topic.manifest
        state = known.state()
        return self.reading.plan(state, known.batches(state)) or [Pieces([])]

    def read(self, partition: Pieces) -> Iterator[pa.RecordBatch]:
        return self.reading.read(partition.value)


class StreamReader(D.DataSourceStreamReader):
    def __init__(self, options: dict, schema: T.StructType):
        self.reading = Reading(options, schema)
        self.strict = _flag(options, "failOnDataLoss", "true")
        self.start = int(options.get("startingVersion", -1))
        self.cursor = None
        if options.get("subscription"):
            self.cursor = f"{self.reading.topic.root}/subscriptions/{options['subscription']}/stream.json"
            spec = self.reading.topic.files.text_if_there(self.cursor.replace("stream.json", "spec.json"))
            if spec is None or json.loads(spec)["topic"] != self.reading.topic.topic:
                raise InvalidSubscription(f"invalid subscription: {options['subscription']}")
            self.start = json.loads(spec)["version"]

    def initialOffset(self) -> dict:
        return {"version": self.start}

    def latestOffset(self) -> dict:
        return {"version": max(self.start, self.reading.topic.manifest.state().newest)}

    def partitions(self, start: dict, end: dict) -> Sequence[Pieces]:
        known, low = self.reading.topic.manifest, start["version"] + 1
        state = known.state()
        if self.strict and low < state.below:
            gone = [v for v, commit in known.commits(state, low, min(state.below, end["version"] + 1)) if commit["do"] == "add"]
            if gone:
                raise ReleasedBatches(f"{len(gone)} batches after version {low - 1} were released before they were read")
        return self.reading.plan(state, known.batches(state, low, end["version"] + 1)) or [Pieces([])]

    def read(self, partition: Pieces) -> Iterator[pa.RecordBatch]:
        return self.reading.read(partition.value)

    def commit(self, end: dict) -> None:
        """The micro-batch is done; the subscription's cursor follows."""
        if self.cursor:
            self.reading.topic.files.replace_text(self.cursor, json.dumps({"version": end["version"]}))


class Written(D.WriterCommitMessage):
    def __init__(self, attempt: str, name: str, seq: int, rows: int):
        self.attempt, self.name, self.seq, self.rows = attempt, name, seq, rows


class Writing:
    """Files of one batch, written by tasks below a folder of this attempt, then moved into place and committed.

    Spark makes one object for the tasks and another one for the commit, so the attempt travels in the messages.
    """

    def __init__(self, options: dict, schema: T.StructType):
        self.topic = Topic(options)
        self.number = catalog.check_rows(schema, self.topic.schemas)
        self.producer = catalog.check_name("producer", _needed(options, "producer"))
        self.attempt, self.now = uuid.uuid4().hex, datetime.now(UTC)

    def incoming(self, attempt: str) -> str:
        return f"{self.topic.root}/{log_folder(self.topic.topic)}/incoming/{attempt}"

    def write(self, batches: Iterator[pa.RecordBatch]) -> Written:
        system, task = self.topic.files.system, TaskContext.get().partitionId()
        name, rows, writer = f"part-{task:06d}-{uuid.uuid4().hex}.parquet", 0, None
        place = f"{self.topic.files.path(self.incoming(self.attempt))}/{name}"
        try:
            for batch in batches:
                if not len(batch):
                    continue
                seq = pa.array(range((task << TASK_BITS) + rows, (task << TASK_BITS) + rows + len(batch)), pa.int64())
                stamped = batch.append_column("tp_seq", seq).append_column("tp_ts", pa.array([self.now] * len(batch), TS))
                if writer is None:
                    system.create_dir(place.rpartition("/")[0], recursive=True)
                    writer = pq.ParquetWriter(place, stamped.schema, filesystem=system)
                writer.write_batch(stamped)
                rows += len(batch)
        finally:
            if writer is not None:
                writer.close()
        return Written(self.attempt, name, task << TASK_BITS, rows)

    def commit(self, messages: list[Written | None], batch_id: int) -> None:
        known, topic = self.topic.manifest, self.topic.topic
        written = sorted((one for one in messages if one and one.rows), key=lambda one: one.seq)
        if not written:
            return
        if known_batch(known, known.state(), topic, self.producer, batch_id):
            self.abort(messages)
            return
        files, offset = [], 0
        for one in written:
            files.append([one.name, one.seq, offset, one.rows])
            offset += one.rows
        folder = batch_folder(topic, self.producer, batch_id, written[0].attempt)
        self.topic.files.move_folder(self.incoming(written[0].attempt), f"{self.topic.root}/{folder}")

        def batch(state):
            if known_batch(known, state, topic, self.producer, batch_id):
                return None
            return added(self.producer, batch_id, folder, files, self.number, state.heads.get(self.producer))

        known.append(batch)

    def abort(self, messages: list[Written | None]) -> None:
        for attempt in {one.attempt for one in messages if one}:
            self.topic.files.drop(self.incoming(attempt))


class StreamWriter(D.DataSourceStreamArrowWriter):
    def __init__(self, options: dict, schema: T.StructType):
        self.writing = Writing(options, schema)

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        return self.writing.write(iterator)

    def commit(self, messages: list, batchId: int) -> None:
        self.writing.commit(messages, batchId)

    def abort(self, messages: list, batchId: int) -> None:
        self.writing.abort(messages)


class TableWriter(D.DataSourceArrowWriter):
    def __init__(self, options: dict, schema: T.StructType):
        self.writing, self.batch_id = Writing(options, schema), int(_needed(options, "batchId"))

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        return self.writing.write(iterator)

    def commit(self, messages: list) -> None:
        self.writing.commit(messages, self.batch_id)

    def abort(self, messages: list) -> None:
        self.writing.abort(messages)


class TopicFormat(D.DataSource):
    @classmethod
    def name(cls) -> str:
        return "topicflow"

    def schema(self) -> T.StructType:
        schema = catalog.nullable(Topic(self.options).schema)
        if _flag(self.options, "stamps"):
            return stamped_schema(schema)
        column = self.options.get("timestampColumnName", catalog.TIMESTAMP_COLUMN)
        return catalog.source_schema(schema, _flag(self.options, "includesTimestamp"), column)

    def reader(self, schema: T.StructType) -> TableReader:
        return TableReader(self.options, schema)

    def streamReader(self, schema: T.StructType) -> StreamReader:
        return StreamReader(self.options, schema)

    def writer(self, schema: T.StructType, overwrite: bool) -> TableWriter:
        if overwrite:
            raise InvalidName("a topic is appended to, not overwritten")
        return TableWriter(self.options, schema)

    def streamWriter(self, schema: T.StructType, overwrite: bool) -> StreamWriter:
        return StreamWriter(self.options, schema)


def register(spark: SparkSession) -> None:
    """Make the format known to a session."""
    spark.dataSource.register(TopicFormat)
