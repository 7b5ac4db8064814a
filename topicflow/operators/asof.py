"""Order-based building blocks that no key can overload: global rank, running count, buckets of equal size, the next
event after a row.

Rows are put in order by range partitions, so a bucket is a stretch of ranks and holds the same number of rows whatever
the numbers are: dense, sparse, or times in nanoseconds. Inside a bucket a window finds the answer; between buckets one
line per bucket (and key) is carried across.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from topicflow.storage import fresh_folder, stored

WIDTH = 1_000_000
TASK_BITS = 33  # Spark's row ids: partition number above, row number within the partition below


def ranked(rows: DataFrame, *order: str, out: str = "tp_rank") -> DataFrame:
    """Add the 1-based rank of each row by ``order``, over all rows; nulls come first, ties in any order.

    The rows are stored in order, so that their numbers stay the same when something is computed again.
    """
    ordered = rows.withColumn("tp_tie", F.xxhash64(F.monotonically_increasing_id()))
    ordered = ordered.repartitionByRange(*order, "tp_tie").sortWithinPartitions(*order, "tp_tie").drop("tp_tie")
    placed = stored(
        ordered.withColumn("tp_id", F.monotonically_increasing_id()), fresh_folder(rows.sparkSession, "ranked")
    ).withColumn("tp_part", F.expr(f"shiftright(tp_id, {TASK_BITS})"))
    counts = placed.groupBy("tp_part").agg(F.count(F.lit(1)).alias("tp_rows"))
    # one line per partition reaches this window, not the rows
    earlier = Window.orderBy("tp_part").rowsBetween(Window.unboundedPreceding, -1)
    before = counts.select("tp_part", F.coalesce(F.sum("tp_rows").over(earlier), F.lit(0)).alias("tp_before"))
    inside = F.expr(f"tp_id & {(1 << TASK_BITS) - 1}L")
    return placed.join(before, "tp_part").select(*rows.columns, (F.col("tp_before") + inside + 1).alias(out))


def _cumulated(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Replace the last column, 0 or 1, by its running sum within the partition, and add the partition's number."""
    total, part = 0, TaskContext.get().partitionId()
    for batch in batches:
        sums = total + np.cumsum(batch.column(batch.num_columns - 1).to_numpy(), dtype=np.int64)
        total = int(sums[-1]) if len(sums) else total
        columns = [*batch.columns[:-1], pa.array(sums), pa.array(np.full(len(batch), part, np.int64))]
        yield pa.RecordBatch.from_arrays(columns, [*batch.schema.names, "tp_part"])


def running_count(rows: DataFrame, *order: str, what: Column, out: str) -> DataFrame:
    """Add to each row how many rows, up to and with itself in the given order, ``what`` holds for; ties in any order.

    One sort over range partitions; only a line per partition is carried across them. The result starts from stored rows.
    """
    ordered = rows.withColumn("tp_tie", F.xxhash64(F.monotonically_increasing_id()))
    ordered = ordered.repartitionByRange(*order, "tp_tie").sortWithinPartitions(*order, "tp_tie").drop("tp_tie")
    counted = ordered.withColumn(out, F.coalesce(what, F.lit(False)).cast("bigint"))
    shape = T.StructType([*counted.schema.fields, T.StructField("tp_part", T.LongType())])
    placed = stored(counted.mapInArrow(_cumulated, shape), fresh_folder(rows.sparkSession, "counted"))
    sums = placed.groupBy("tp_part").agg(F.max(out).alias("tp_sum"))
    earlier = Window.orderBy("tp_part").rowsBetween(Window.unboundedPreceding, -1)
    before = sums.select("tp_part", F.coalesce(F.sum("tp_sum").over(earlier), F.lit(0)).alias("tp_before"))
    return placed.join(before, "tp_part").select(*rows.columns, (F.col(out) + F.col("tp_before")).alias(out))


def bucketed(rows: DataFrame, *order: str, width: int = WIDTH) -> DataFrame:
    """Add ``tp_bucket``: stretches of ``width`` rows in the given order."""
    numbered = ranked(rows, *order)
    return numbered.withColumn("tp_bucket", F.expr(f"tp_rank div {int(width)}L")).drop("tp_rank")


def first_after(
    left: DataFrame, right: DataFrame, *, key: str, seq: str, out: str, width: int = WIDTH
) -> DataFrame:
    """Add to each left row the smallest ``seq`` above its own among the right rows of the same key (null if none).

    Every left row stays, also one with a null key or number: it has no next event.
    """
    marks = right.where(F.col(key).isNotNull() & F.col(seq).isNotNull())
    marks = marks.select(key, seq, F.col(seq).alias(out), F.lit(False).alias("tp_left"))
    rows = left.withColumns({out: F.lit(None).cast(right.schema[seq].dataType), "tp_left": F.lit(True)})
    # of equal numbers marks come first, so what follows a left row, in its bucket or a later one, is above it
    both = bucketed(rows.unionByName(marks, allowMissingColumns=True), seq, "tp_left", width=width)

    # backwards, so that the smallest mark so far is the next one
    backwards = Window.partitionBy(key, "tp_bucket").orderBy(F.desc(seq), F.asc_nulls_first(out))
    in_bucket = F.min(out).over(backwards.rowsBetween(Window.unboundedPreceding, 0))
    near = both.withColumn("tp_near", in_bucket).where("tp_left")

    per_bucket = both.groupBy(key, "tp_bucket").agg(F.min(out).alias("tp_first"))
    following = Window.partitionBy(key).orderBy(F.desc("tp_bucket")).rowsBetween(Window.unboundedPreceding, -1)
    far = per_bucket.select(key, "tp_bucket", F.min("tp_first").over(following).alias("tp_far"))

    found = near.join(far, [key, "tp_bucket"], "left").withColumn("tp_next", F.coalesce("tp_near", "tp_far"))
    answer = F.when(F.col(key).isNotNull() & F.col(seq).isNotNull(), F.col("tp_next"))
    return found.select(*left.columns, answer.alias(out))


def largest_before(left: DataFrame, right: DataFrame, *, key: str, seq: str, value: str, width: int = WIDTH) -> DataFrame:
    """Add to each left row the largest ``value`` among the right rows of the same key with a smaller ``seq``."""
    marks = right.select(key, seq, value, F.lit(True).alias("tp_mark"))
    rows = left.withColumns({value: F.lit(None).cast(right.schema[value].dataType), "tp_mark": F.lit(False)})
    # of equal numbers left rows come first, so marks before a left row are below it
    both = bucketed(rows.unionByName(marks, allowMissingColumns=True), seq, "tp_mark", width=width)
    forwards = Window.partitionBy(key, "tp_bucket").orderBy(F.asc(seq), F.asc("tp_mark"))
    near = both.withColumn("tp_near", F.max(value).over(forwards.rowsBetween(Window.unboundedPreceding, 0)))
    per_bucket = both.groupBy(key, "tp_bucket").agg(F.max(value).alias("tp_top"))
    earlier = Window.partitionBy(key).orderBy("tp_bucket").rowsBetween(Window.unboundedPreceding, -1)
    far = per_bucket.select(key, "tp_bucket", F.max("tp_top").over(earlier).alias("tp_far"))
    found = near.where("not tp_mark").join(far, [key, "tp_bucket"], "left")
    return found.select(*left.columns, F.greatest("tp_near", "tp_far").alias(value))
