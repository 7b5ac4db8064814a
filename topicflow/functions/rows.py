"""Views of stored rows: the plain row, the row with receive time, with its id, and the stamps alone.

Stored rows carry the user's columns and four stamps: tp_producer, tp_batch_id, tp_offset, tp_ts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from topicflow.errors import InvalidName
from topicflow.sources.catalog import SYSTEM_PREFIX, TIMESTAMP_COLUMN

STAMPS = ("tp_producer", "tp_batch_id", "tp_offset", "tp_ts")


def quoted(name: str) -> Column:
    """The column with exactly this name, dots included."""
    return F.col("`" + name.replace("`", "``") + "`")


def user_columns(rows: DataFrame) -> list[str]:
    return [name for name in rows.columns if not name.startswith(SYSTEM_PREFIX)]


def row_id() -> Column:
    """``<batch id>-<offset in batch>``"""
    return F.concat_ws("-", "tp_batch_id", "tp_offset")


def original(rows: DataFrame) -> DataFrame:
    return rows.select(*map(quoted, user_columns(rows)))


def _with_last(rows: DataFrame, name: str, value: Column) -> DataFrame:
    columns = user_columns(rows)
    if name.lower() in (column.lower() for column in columns):
        raise InvalidName(f"column {name!r} is already in the topic")
    return rows.select(*map(quoted, columns), value.alias(name))


def with_timestamp(rows: DataFrame, name: str = TIMESTAMP_COLUMN) -> DataFrame:
    return _with_last(rows, name, F.col("tp_ts"))


def with_id(rows: DataFrame, name: str = "id") -> DataFrame:
    return _with_last(rows, name, row_id())


def extra(rows: DataFrame, name: str = "extra") -> DataFrame:
    """Batch id, offset and receive time as one struct."""
    return rows.select(F.struct("tp_batch_id", "tp_offset", "tp_ts").alias(name))
