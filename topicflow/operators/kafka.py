"""Topic rows as Kafka records, and forwarding them with Spark's own connector.

With a *ledger*, a folder that remembers what has been sent, a forward that is repeated sends only what is missing. It counts in pieces, stretches
of offsets of a (producer, batch); a piece is entered after its records were written. So of a send that fails midway only
the pieces of the last, unfinished write come again.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from topicflow.functions.codec import check_encodable, to_line
from topicflow.functions.rows import quoted, row_id, user_columns
from topicflow.storage import Store

RECORDS_PER_SEND = 1_000_000
PIECES_PER_SEND = 500
PIECE = ["tp_producer", "tp_batch_id", "tp_piece"]
SENT = "tp_producer string, tp_batch_id bigint, tp_piece bigint, records bigint"

Write = Callable[[DataFrame], None]


def kafka_records(rows: DataFrame, topic: str, value: str = "first") -> DataFrame:
    """Key ``<batch id>-<offset>``; value the first column as text, or with ``value="json"`` the whole row."""
    columns = user_columns(rows)
    if value == "first":
        text = quoted(columns[0]).cast("string")
    elif value == "json":
        check_encodable(rows.select(*map(quoted, columns)).schema)
        text = to_line(F.struct(*map(quoted, columns)))
    else:
        raise ValueError(f"value must be 'first' or 'json', not {value!r}")
    return rows.select(row_id().alias("key"), text.alias("value"), F.lit(topic).alias("topic"))


def sent_records(spark: SparkSession, ledger: str) -> DataFrame:
    """The receipts of a ledger: producer, batch, piece, records."""
    if not Store(spark, ledger).exists(f"{ledger}/sent"):
        return spark.createDataFrame([], SENT)
    return spark.read.schema(SENT).json(f"{ledger}/sent")


def _sends(pieces: list, limit: int) -> Iterator[list]:
    """Pieces in order, as many at a time as have ``limit`` records together."""
    waiting, records = [], 0
    for piece in pieces:
        if waiting and (records + piece["records"] > limit or len(waiting) == PIECES_PER_SEND):
            yield waiting
            waiting, records = [], 0
        waiting.append(piece)
        records += piece["records"]
    if waiting:
        yield waiting


def forward_once(
    rows: DataFrame,
    topic: str,
    ledger: str,
    write: Write,
    value: str = "first",
    records_per_send: int = RECORDS_PER_SEND,
) -> int:
    """Hand the records of ``rows`` to ``write`` that the ledger doesn't have, at most about ``records_per_send`` at a time.

    Returns the records sent. Pieces are counted by Spark, and one line per piece comes to the driver. ``rows`` must hold whole
    batches of producers, as topics and their streams give them. One forward per ledger at a time.
    """
    spark, store = rows.sparkSession, Store(rows.sparkSession, ledger)
    text = json.dumps({"topic": topic, "value": value, "records_per_send": records_per_send})
    store.mkdirs(ledger)
    if not store.commit_text(f"{ledger}/forward.json", text) and store.read_text(f"{ledger}/forward.json") != text:
        raise ValueError(f"{ledger} belongs to another forward: {store.read_text(f'{ledger}/forward.json')}")
    piece = F.expr(f"tp_offset div {int(records_per_send)}L").alias("tp_piece")
    counted = rows.select("tp_producer", "tp_batch_id", piece).groupBy(*PIECE).agg(F.count(F.lit(1)).alias("records"))
    missing = counted.join(sent_records(spark, ledger), PIECE, "left_anti").orderBy(*PIECE).collect()
    total = 0
    for group in _sends(missing, records_per_send):
        chosen = F.broadcast(spark.createDataFrame([(*one[:3],) for one in group], SENT.rpartition(",")[0]))
        mine = rows.withColumn("tp_piece", piece).join(chosen, PIECE).select(*map(quoted, rows.columns))
        write(kafka_records(mine, topic, value))
        lines = [json.dumps(one.asDict()) for one in group]
        store.commit_text(f"{ledger}/sent/{uuid.uuid4().hex}.json", "\n".join(lines))
        total += sum(one.records for one in group)
    return total


def forward_to_kafka(
    rows: DataFrame,
    topic: str,
    servers: str,
    value: str = "first",
    checkpoint: str | None = None,
    trigger: dict | None = None,
    ledger: str | None = None,
    **options,
) -> StreamingQuery | None:
    """Write the records with the Kafka connector (needed on the class path). A failed send fails the batch.

    ``trigger`` says when a stream runs, as for ``DataStreamWriter.trigger``; without it as soon as it can. With a ``ledger`` nothing that was sent
    is sent again, also by a stream whose micro-batch is repeated or whose checkpoint is lost.
    """
    settings = {"kafka.bootstrap.servers": servers, **options}
    if rows.isStreaming and checkpoint is None:
        raise ValueError("a stream needs a checkpoint")

    def write(records: DataFrame) -> None:
        records.write.format("kafka").options(**settings).save()

    if not rows.isStreaming:
        if ledger is None:
            write(kafka_records(rows, topic, value))
        else:
            forward_once(rows, topic, ledger, write, value)
        return None
    if ledger is None:
        writer = kafka_records(rows, topic, value).writeStream.format("kafka").options(**settings)
    else:
        def send(batch: DataFrame, _: int) -> None:
            forward_once(batch, topic, ledger, write, value)

        writer = rows.writeStream.foreachBatch(send)
    writer = writer.option("checkpointLocation", checkpoint)
    return writer.trigger(**trigger).start() if trigger else writer.start()
