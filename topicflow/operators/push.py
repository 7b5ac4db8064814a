"""Send stored rows to another site as packets of JSON lines, or of compressed Arrow batches.

Packets are cut from shards of consecutive offsets of one batch, so no shard is larger than ``shard_rows`` and the
work spreads evenly. The name of a packet follows from its content: a repeated task writes the same packets again.
"""

from __future__ import annotations

import time
import urllib.request
import uuid
from collections.abc import Callable, Iterable
from urllib.error import HTTPError

import numpy as np
import pyarrow as pa
import pyarrow.fs
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from topicflow.errors import PushFailed
from topicflow.functions.binary import check_codec, packed
from topicflow.functions.codec import check_encodable, to_line
from topicflow.functions.rows import STAMPS, quoted, user_columns
from topicflow.operators.packets import MAX_PACKET_SIZE, Cutter, _numbers, _runs
from topicflow.sources.catalog import check_name
from topicflow.storage import written_once

ATTEMPTS = 5
TIMEOUT = 60.0  # seconds a receiver may take to answer
PAUSE = 0.1  # seconds, times the number of attempts so far
SHARD_ROWS = 1_000_000

Deliver = Callable[[str, bytes], None]

_RECEIPT = (
    "tp_producer string, tp_batch_id bigint, tp_shard bigint, tp_packet bigint, "
    "packet_id string, rows bigint, bytes bigint, attempts int"
)


def envelope(rows: DataFrame) -> Column:
    """One line per row: producer, batch, offset, time and the row itself."""
    return to_line(
        F.struct(
            F.col("tp_producer").alias("p"),
            F.col("tp_batch_id").alias("b"),
            F.col("tp_offset").alias("o"),
            F.col("tp_ts").alias("t"),
            F.struct(*map(quoted, user_columns(rows))).alias("r"),
        )
    )


def file_delivery(destination: str) -> Deliver:
    """Write packets as files below a URL: a mounted ``file://`` folder or any scheme Arrow knows."""

    def deliver(packet_id: str, body: bytes) -> None:
        system, base = pyarrow.fs.FileSystem.from_uri(destination)
        folder, _, name = f"{base.rstrip('/')}/{packet_id}".rpartition("/")
        system.create_dir(folder, recursive=True)
        draft = f"{folder}/.{name}.{uuid.uuid4().hex}"  # hidden from readers until complete
        with system.open_output_stream(draft) as out:
            out.write(body)
        system.move(draft, f"{folder}/{name}")

    return deliver


def http_delivery(
    destination: str, opener: Callable = urllib.request.urlopen, timeout: float = TIMEOUT
) -> Deliver:
    """POST packets to a URL. Any answer but 200 is a failure, as is none within ``timeout`` seconds."""

    def deliver(packet_id: str, body: bytes) -> None:
        kind = "application/vnd.apache.arrow.stream" if packet_id.endswith(".arrow") else "application/x-ndjson"
        headers = {"Content-Type": kind, "X-Packet-Id": packet_id}
        request = urllib.request.Request(destination, data=body, headers=headers, method="POST")
        with opener(request, timeout=timeout) as answer:
            if answer.status != 200:
                raise OSError(f"{destination} answered {answer.status}")

    return deliver


def delivery(destination: str) -> Deliver:
    return http_delivery(destination) if destination.startswith(("http://", "https://")) else file_delivery(destination)


def with_retry(deliver: Deliver, packet_id: str, body: bytes, pause: float = PAUSE) -> int:
    """Deliver, trying again after a growing pause. Returns the number of attempts.

    Only what may pass is tried again: errors of input and output, but not an answer that blames the request.
    """
    attempt = 1
    while True:
        try:
            deliver(packet_id, body)
            return attempt
        except OSError as error:
            refused = isinstance(error, HTTPError) and 400 <= error.code < 500 and error.code not in (408, 429)
            if refused or attempt == ATTEMPTS:
                raise PushFailed(f"{packet_id}: {attempt} attempts failed, last with {error!r}") from error
        time.sleep(pause * attempt)
        attempt += 1


def _text_slicer(column: pa.Array) -> Callable[[int, int], bytes]:
    """The bytes of rows ``begin`` to ``end`` of a text column, which lie side by side in memory."""
    kind = np.int64 if pa.types.is_large_string(column.type) else np.int32
    _, ends, data = column.buffers()
    borders = np.frombuffer(ends, kind)[column.offset : column.offset + len(column) + 1]
    return lambda begin, end: data.slice(borders[begin], borders[end] - borders[begin]).to_pybytes()


def _receipts(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.int32()]
    names = [part.split()[0] for part in _RECEIPT.split(", ")]
    columns = [pa.array(column, kind) for column, kind in zip(zip(*rows), kinds)]
    return pa.RecordBatch.from_arrays(columns, names=names)


def _pusher(topic: str, deliver: Deliver, limit: int, pause: float):
    def send(shard: tuple, packet: int, first: int, rows: int, parts: list[bytes]) -> tuple:
        body = b"".join(parts)
        packet_id = f"{topic}/{shard[0]}-{shard[1]}-{shard[2]}-{packet}-{first}.jsonl"
        attempts = with_retry(deliver, packet_id, body, pause)
        return (*shard, packet, packet_id, rows, len(body), attempts)

    def run(batches: Iterable[pa.RecordBatch]):
        shard = cutter = None
        packet, first, rows, parts = 0, 0, 0, []  # the open packet
        for batch in batches:
            sent = []
            keys, sizes, offsets = batch.column("tp_key"), _numbers(batch, "tp_size"), _numbers(batch, "tp_offset")
            text = _text_slicer(batch.column("tp_line"))
            for begin, end in _runs(keys) if batch.num_rows else ():
                here = tuple(batch.column(name)[begin].as_py() for name in ("tp_producer", "tp_batch_id", "tp_shard"))
                if here != shard:
                    if parts:
                        sent.append(send(shard, packet, first, rows, parts))
                    shard, cutter, parts = here, Cutter(limit), []
                packets, _ = cutter.number(sizes[begin:end])
                for left, right in _runs(pa.array(packets)):
                    if parts and packets[left] != packet:
                        sent.append(send(shard, packet, first, rows, parts))
                        parts = []
                    if not parts:
                        packet, first, rows = int(packets[left]), int(offsets[begin + left]), 0
                    parts.append(text(begin + left, begin + right))
                    rows += right - left
            if sent:
                yield _receipts(sent)
        if parts:
            yield _receipts([send(shard, packet, first, rows, parts)])

    return run


def _batch_pusher(topic: str, deliver: Deliver, limit: int, pause: float):
    """Sends sorted rows as Arrow packets. One ends with the rows that bring its columns to ``limit`` bytes in memory.

    Where it ends follows from the rows and Spark's batch size, so a repeated task writes the same packets again.
    """

    def send(shard: tuple, packet: int, parts: list[pa.RecordBatch]) -> tuple:
        body, first = packed(parts), parts[0].column("tp_offset")[0].as_py()
        packet_id = f"{topic}/{shard[0]}-{shard[1]}-{shard[2]}-{packet}-{first}.arrow"
        attempts = with_retry(deliver, packet_id, body, pause)
        return (*shard, packet, packet_id, sum(map(len, parts)), len(body), attempts)

    def run(batches: Iterable[pa.RecordBatch]):
        shard, packet, parts, filled = None, 0, [], 0
        for batch in batches:
            sent = []
            for begin, end in _runs(batch.column("tp_key")) if batch.num_rows else ():
                here = tuple(batch.column(name)[begin].as_py() for name in ("tp_producer", "tp_batch_id", "tp_shard"))
                if here != shard:
                    if parts:
                        sent.append(send(shard, packet, parts))
                    shard, packet, parts, filled = here, 0, [], 0
                rows = batch.drop_columns(["tp_key", "tp_shard"])
                each = max(1, rows.nbytes // len(rows))
                while begin < end:
                    stop = min(end, begin + max(1, -(-(limit - filled) // each)))
                    parts.append(rows.slice(begin, stop - begin))
                    filled, begin = filled + (stop - begin) * each, stop
                    if filled >= limit:
                        sent.append(send(shard, packet, parts))
                        packet, parts, filled = packet + 1, [], 0
            if sent:
                yield _receipts(sent)
        if parts:
            yield _receipts([send(shard, packet, parts)])

    return run


def push(
    rows: DataFrame,
    topic: str,
    destination: str | None = None,
    *,
    limit: int = MAX_PACKET_SIZE,
    shard_rows: int = SHARD_ROWS,
    deliver: Deliver | None = None,
    pause: float = PAUSE,
    codec: str = "json",
) -> DataFrame:
    """Deliver stored rows now, from the executors, and return one receipt per packet.

    ``codec``: ``json`` for packets of JSON lines, ``arrow`` for compressed Arrow batches, which carry any type.

    Delivery is at least once; :func:`topicflow.operators.dedup.drop_redelivered` makes it once on the other side.
    """
    check_name("topic", topic)
    if check_codec(codec) == "json":
        check_encodable(rows.select(*map(quoted, user_columns(rows))).schema)
    deliver = deliver or delivery(destination)
    shard = [F.col("tp_producer"), F.col("tp_batch_id"), F.col("tp_shard")]
    # columns are shuffled, not their text
    dealt = rows.withColumn("tp_shard", F.expr(f"tp_offset div {int(shard_rows)}"))
    dealt = dealt.repartition(*shard).sortWithinPartitions(*shard, "tp_offset")
    if codec == "arrow":
        columns = [*map(quoted, [*user_columns(rows), *STAMPS]), F.col("tp_shard")]
        keyed = dealt.select(*columns, F.concat_ws("/", *shard).alias("tp_key"))
        return written_once(keyed.mapInArrow(_batch_pusher(topic, deliver, limit, pause), _RECEIPT))
    lines = dealt.select(*shard, "tp_offset", F.concat(envelope(rows), F.lit("\n")).alias("tp_line"))
    lines = lines.withColumn("tp_size", F.octet_length("tp_line").cast("bigint"))
    sorted_lines = lines.withColumn("tp_key", F.concat_ws("/", *shard))
    return written_once(sorted_lines.mapInArrow(_pusher(topic, deliver, limit, pause), _RECEIPT))


def push_stream(
    rows: DataFrame, topic: str, destination: str, *, checkpoint: str, trigger: dict | None = None, **options
) -> StreamingQuery:
    """Start a query that pushes the rows of a topic stream as they arrive."""

    def send(batch: DataFrame, _: int) -> None:
        push(batch, topic, destination, **options)

    writer = rows.writeStream.option("checkpointLocation", checkpoint).foreachBatch(send)
    return writer.trigger(**trigger).start() if trigger else writer.start()
