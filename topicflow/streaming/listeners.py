"""Listeners for arriving batches: collect them, print them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from topicflow.functions.rows import quoted, user_columns
from topicflow.sources.catalog import as_schema
from topicflow.sources.log import stamped_schema
from topicflow.storage import Store


class Collector:
    """Keeps every arrival as Parquet, one folder per (topic, producer, batch). A replay overwrites its folder."""

    def __init__(self, folder: str):
        self.folder = folder

    def __call__(self, topic: str, rows: DataFrame, batch_id: int) -> None:
        rows.write.mode("overwrite").parquet(_arrival(self.folder, topic, rows, batch_id))

    def get(self, spark: SparkSession, topic: str, schema: T.StructType | str) -> DataFrame:
        """All arrivals so far of a topic with columns ``schema``, with their stamps. Empty before the first arrival."""
        schema = stamped_schema(as_schema(schema))
        folder = f"{self.folder}/{topic}"
        if not Store(spark, self.folder).exists(folder):
            return spark.createDataFrame([], schema)
        return spark.read.schema(schema).option("recursiveFileLookup", "true").parquet(folder)


def _arrival(folder: str, topic: str, rows: DataFrame, batch_id: int) -> str:
    # rows are one stored batch, so the producer is the same in all of them
    return f"{folder}/{topic}/{rows.select('tp_producer').first()[0]}/{batch_id}"


def _shown(column: Column) -> Column:
    return F.coalesce(column.cast("string"), F.lit("null"))


def _shown_time(column: Column) -> Column:
    """Time with at least one digit after the second."""
    text = column.cast("string")
    return F.when(text.contains("."), text).otherwise(F.concat(text, F.lit(".0")))


def printed_lines(topic: str, rows: DataFrame) -> DataFrame:
    """The text a printer shows: a title per batch (``line_no`` -1), then one line per row at its offset."""
    title = F.lit(f"++++++++topic={topic}++++++++")  # fixed format
    values = F.concat_ws(",", *(_shown(quoted(name)) for name in user_columns(rows)))
    stamps = F.concat_ws(",", "tp_batch_id", "tp_offset", _shown_time(F.col("tp_ts")))
    line = F.concat(F.lit("RowEx(["), values, F.lit("],"), stamps, F.lit(")"))  # fixed format
    batch = [F.col("tp_producer"), F.col("tp_batch_id")]
    before = F.lit(-1).cast("bigint").alias("line_no")
    titles = rows.select(*batch).distinct().select(*batch, before, title.alias("line"))
    return titles.unionByName(rows.select(*batch, F.col("tp_offset").alias("line_no"), line.alias("line")))


class Printer:
    """Writes the lines of every arrival as text, in order, one folder per (topic, producer, batch).

    A replay overwrites its folder. To look at a few lines, ``show`` the text or :func:`printed_lines`.
    """

    def __init__(self, folder: str):
        self.folder = folder

    def __call__(self, topic: str, rows: DataFrame, batch_id: int) -> None:
        lines = printed_lines(topic, rows).orderBy("line_no").select("line")
        lines.write.mode("overwrite").text(_arrival(self.folder, topic, rows, batch_id))
