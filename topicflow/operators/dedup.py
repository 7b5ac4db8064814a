"""Remove rows that were delivered more than once.

What has been delivered is remembered as ranges of offsets, (producer, batch id, first, until), one for each run without a
gap. Ranges are cut at every ``BLOCK`` offsets, so that a batch with a third of all rows is many small groups, and lie
in a fixed number of buckets by hash of (producer, batch, block). A micro-batch reads and rewrites the buckets it touches, so
what it costs depends on its own rows and on the gaps around them, not on what has arrived before.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from topicflow.storage import Store

KEYS = ["tp_producer", "tp_batch_id", "tp_offset"]
BLOCK = 1 << 22
STRETCH = 1 << 12  # rows are compared with the ranges of their own stretch
BUCKETS = 64
PLACE = ["tp_producer", "tp_batch_id", "tp_block"]
RANGES = "tp_producer string, tp_batch_id bigint, tp_block bigint, first bigint, until bigint"


def drop_redelivered(rows: DataFrame) -> DataFrame:
    """One copy of each (producer, batch id, offset), however late a copy comes.

    On a stream Spark keeps every key as state, for ever; :func:`store_arrivals` keeps ranges.
    """
    return rows.dropDuplicates(KEYS)


def ranges_of(rows: DataFrame) -> DataFrame:
    """The ranges of offsets that ``rows`` cover without a gap, cut at blocks. No row may come twice."""
    placed = rows.dropna(subset=KEYS).select(*KEYS, F.expr(f"tp_offset div {BLOCK}L").alias("tp_block"))
    spans = placed.select(*PLACE, F.col("tp_offset").alias("first"), F.col("tp_offset").alias("until"))
    return merged(spans.withColumn("tp_part", F.expr(f"first div {STRETCH}L")), "tp_part")


def merged(ranges: DataFrame, *more: str) -> DataFrame:
    """Ranges of the same block (and of the same ``more``) that touch or overlap made one."""
    group = Window.partitionBy(*PLACE, *more).orderBy("first", "until")
    before = F.max("until").over(group.rowsBetween(Window.unboundedPreceding, -1))
    begins = F.when(before.isNull() | (F.col("first") > before + 1), 1).otherwise(0)
    runs = ranges.withColumn("tp_begins", begins)
    runs = runs.withColumn("tp_run", F.sum("tp_begins").over(group.rowsBetween(Window.unboundedPreceding, 0)))
    together = runs.groupBy(*PLACE, *more, "tp_run").agg(F.min("first").alias("first"), F.max("until").alias("until"))
    return together.select(*PLACE, "first", "until")


class Delivered:
    """The ranges stored in a folder, and which of its parts are in force.

    ``delivered.json`` names the last micro-batch that is complete, and for each bucket the one that wrote it last. It is
    replaced at the end of a micro-batch, in one step: one that fails before is as if it had not been.
    """

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder, self.store = spark, folder, Store(spark, folder)
        known = json.loads(self.store.text_if_there(self._pointer) or "{}")
        self.number: int = known.get("number", -1)
        self.buckets: dict[str, int] = known.get("buckets", {})

    @property
    def _pointer(self) -> str:
        return f"{self.folder}/delivered.json"

    def _place(self, bucket: str) -> str:
        return f"{self.folder}/ranges/{self.buckets[bucket]}/tp_bucket={bucket}"

    def ranges(self, buckets: list[str] | None = None) -> DataFrame:
        """All ranges, or those in some buckets."""
        chosen = [bucket for bucket in self.buckets if buckets is None or bucket in buckets]
        if not chosen:
            return self.spark.createDataFrame([], RANGES)
        return self.spark.read.schema(RANGES).parquet(*map(self._place, chosen))

    def rows(self, shape: DataFrame) -> DataFrame:
        """The rows stored so far, with the columns of ``shape``."""
        if self.number < 0:
            return self.spark.createDataFrame([], shape.schema)
        schema = T.StructType([*shape.schema.fields, T.StructField("tp_arrival", T.LongType())])
        rows = self.spark.read.schema(schema).parquet(f"{self.folder}/rows")
        return rows.where(F.col("tp_arrival") <= self.number).select(shape.columns)

    def take(self, batch: DataFrame) -> None:
        """Store the rows of ``batch`` that have not been delivered before, each once.

        Rows without producer, batch id or offset cannot be recognised and are stored whenever they come.
        """
        bucket = F.pmod(F.xxhash64(*PLACE), F.lit(BUCKETS)).alias("tp_bucket")
        block, stretch = F.expr(f"tp_offset div {BLOCK}L"), F.expr(f"tp_offset div {STRETCH}L")
        placed = batch.withColumns({"tp_block": block, "tp_stretch": stretch})
        places = placed.dropna(subset=KEYS).select(bucket).distinct()
        touched = [str(row.tp_bucket) for row in places.collect()]  # BUCKETS at most
        known, number = self.ranges(touched), self.number + 1
        here = placed.select(*PLACE, "tp_stretch").distinct()
        parts = F.sequence(F.expr(f"first div {STRETCH}L"), F.expr(f"until div {STRETCH}L"))
        near = known.withColumn("tp_stretch", F.explode(parts)).join(here, [*PLACE, "tp_stretch"], "left_semi")
        near = near.groupBy(*PLACE, "tp_stretch").agg(F.collect_list(F.struct("first", "until")).alias("tp_known"))
        seen = F.exists("tp_known", lambda one: F.col("tp_offset").between(one["first"], one["until"]))
        # the join spreads rows by stretch, and equal rows are in the same one
        fresh = placed.join(near, [*PLACE, "tp_stretch"], "left").where(~F.coalesce(seen, F.lit(False)))
        fresh = fresh.dropDuplicates([*PLACE, "tp_stretch", "tp_offset"])
        arrived = f"{self.folder}/rows/tp_arrival={number}"
        fresh.select(batch.columns).write.mode("overwrite").parquet(arrived)
        stored = self.spark.read.schema(batch.schema).parquet(arrived)
        after = merged(known.unionByName(ranges_of(stored))).withColumn("tp_bucket", bucket)
        after.write.mode("overwrite").partitionBy("tp_bucket").parquet(f"{self.folder}/ranges/{number}")
        older, self.number = set(self.buckets.values()), number
        self.buckets = self.buckets | dict.fromkeys(touched, number)
        self.store.replace_text(self._pointer, json.dumps({"number": number, "buckets": self.buckets}))
        for gone in older - set(self.buckets.values()):
            self.store.drop(f"{self.folder}/ranges/{gone}")


def stored_arrivals(rows: DataFrame, folder: str) -> DataFrame:
    """What :func:`store_arrivals` has stored so far of rows like these, with their columns."""
    return Delivered(rows.sparkSession, folder).rows(rows)


def store_batch(batch: DataFrame, folder: str) -> None:
    """Add the rows that ``folder`` doesn't have yet. One writer per folder at a time."""
    Delivered(batch.sparkSession, folder).take(batch)


def store_arrivals(
    rows: DataFrame, folder: str, *, checkpoint: str, trigger: dict | None = None
) -> StreamingQuery:
    """Start a query that stores each row of a stream once.

    Nothing is discarded for being late, and a repeated micro-batch stores nothing twice, also in a query with another checkpoint.
    """
    writer = rows.writeStream.option("checkpointLocation", checkpoint).foreachBatch(
        lambda batch, _: store_batch(batch, folder)
    )
    return writer.trigger(**trigger).start() if trigger else writer.start()
