"""Rows as binary packets and back: compressed Arrow streams that carry their schema. Any type, also maps with any key.

Next to JSON (:mod:`topicflow.functions.codec`), for senders and receivers that both read Arrow: columns stay columns, so packets are a
fraction of the size and are neither parsed nor printed row by row. Codecs are chosen by name, ``json`` or ``arrow``.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import from_arrow_schema, to_arrow_schema

from topicflow.functions.codec import CORRUPT

CODECS = ("json", "arrow")
COMPRESSION = "zstd"


def check_codec(name: str) -> str:
    if name not in CODECS:
        raise ValueError(f"codec must be one of {', '.join(CODECS)}, not {name!r}")
    return name


def packed(batches: list[pa.RecordBatch]) -> bytes:
    """Record batches of one schema as the bytes of a packet."""
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, batches[0].schema, options=pa.ipc.IpcWriteOptions(compression=COMPRESSION)) as writer:
        for batch in batches:
            writer.write_batch(batch)
    return sink.getvalue().to_pybytes()


def packet_schema(packet: bytes) -> T.StructType:
    """The schema a packet says its rows have."""
    with pa.ipc.open_stream(pa.py_buffer(packet)) as reader:
        return from_arrow_schema(reader.schema, prefer_timestamp_ntz=True)


def unpacked_batches(packet: pa.Buffer, target: pa.Schema) -> list[pa.RecordBatch]:
    """The rows of a packet in the columns of ``target``, by name. An error if the packet is damaged or has other columns."""
    found = []
    with pa.ipc.open_stream(packet) as reader:
        if reader.schema.names != target.names:
            raise pa.ArrowInvalid(f"the packet has columns {reader.schema.names}")
        for batch in reader:
            batch.validate(full=True)
            columns = [column if column.type == f.type else column.cast(f.type) for column, f in zip(batch.columns, target, strict=True)]
            found.append(pa.RecordBatch.from_arrays(columns, schema=target))
    return found


def decoder(schema: T.StructType, body: str, name: str):
    """A task that turns rows with a packet in column ``body`` into the packet's rows, and unreadable ones into their ``name``."""
    target = to_arrow_schema(schema)
    whole = target.append(pa.field(CORRUPT, pa.string()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for packet, what in zip(batch.column(body), batch.column(name).to_pylist(), strict=True):
                try:
                    rows = unpacked_batches(packet.as_buffer(), target)
                except (pa.ArrowException, OSError, AttributeError):
                    nothing = [pa.nulls(1, field.type) for field in target]
                    yield pa.RecordBatch.from_arrays([*nothing, pa.array([what], pa.string())], schema=whole)
                    continue
                for found in rows:
                    yield pa.RecordBatch.from_arrays([*found.columns, pa.nulls(len(found), pa.string())], schema=whole)

    return run


def decoded_shape(schema: T.StructType) -> T.StructType:
    return T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])


def encode_packets(rows: DataFrame) -> DataFrame:
    """(packet, rows): the frame's Arrow batches as packets, a batch each."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if len(batch):
                values = [pa.array([packed([batch])], pa.binary()), pa.array([len(batch)], pa.int64())]
                yield pa.RecordBatch.from_arrays(values, ["packet", "rows"])

    return rows.mapInArrow(run, "packet binary, rows bigint")


def decode_packets(packets: DataFrame, schema: T.StructType) -> DataFrame:
    """Inverse of :func:`encode_packets`. An unreadable packet gives one row with its SHA-256 in ``tp_corrupt``.

    Split with :func:`topicflow.functions.codec.accepted` and ``rejected``.
    """
    named = packets.select("packet", F.coalesce(F.sha2("packet", 256), F.lit("null")).alias("name"))
    return named.mapInArrow(decoder(schema, "packet", "name"), decoded_shape(schema))
