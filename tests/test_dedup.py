import os
import random

import pytest
from pyspark.sql import functions as F

from topicflow.operators import dedup
from topicflow.storage import Store

SCHEMA = "v string, tp_producer string, tp_batch_id bigint, tp_offset bigint, tp_ts timestamp"


def arrived(spark, keys):
    return spark.createDataFrame([(f"{p}{b}-{o}", p, b, o, None) for p, b, o in keys], SCHEMA)


def kept(spark, folder):
    return sorted((r.tp_producer, r.tp_batch_id, r.tp_offset) for r in dedup.stored_arrivals(arrived(spark, []), folder).collect())


def islands(keys, block):
    """Maximal runs of offsets, cut at blocks."""
    found = []
    for p, b, o in sorted(set(keys)):
        if found and found[-1][:2] == [p, b] and found[-1][3] == o - 1 and o % block:
            found[-1][3] = o
        else:
            found.append([p, b, o, o])
    return sorted(map(tuple, found))


@pytest.mark.parametrize("block, stretch, buckets", [(1 << 22, 1 << 12, 64), (8, 4, 3), (4, 1, 1)])
def test_any_order_of_arrival(spark, tmp_path, monkeypatch, block, stretch, buckets):
    for name, value in (("BLOCK", block), ("STRETCH", stretch), ("BUCKETS", buckets)):
        monkeypatch.setattr(dedup, name, value)
    rng, folder, told = random.Random(block), str(tmp_path / "in"), []
    for _ in range(5):
        keys = []
        for _ in range(rng.randrange(1, 12)):
            begin = rng.randrange(0, 60)
            keys += [(rng.choice("pq"), rng.choice([-1, 7]), o) for o in range(begin, begin + rng.randrange(1, 15))]
        keys += rng.choices(keys, k=5)
        dedup.store_batch(arrived(spark, keys), folder)
        told += keys
        assert kept(spark, folder) == sorted(set(told))
        ranges = dedup.Delivered(spark, folder).ranges().select("tp_producer", "tp_batch_id", "first", "until")
        assert sorted(map(tuple, ranges.collect())) == islands(told, block)
    dedup.store_batch(arrived(spark, told), folder)
    dedup.store_batch(arrived(spark, []), folder)
    assert kept(spark, folder) == sorted(set(told))


def test_ranges_follow_gaps_not_rows(spark, tmp_path):
    folder = str(tmp_path / "in")
    rows = spark.range(0, 50_000, 1, 4).select(
        F.lit("x").alias("v"), F.lit("p").alias("tp_producer"), F.lit(1).cast("bigint").alias("tp_batch_id"),
        F.col("id").alias("tp_offset"), F.lit(None).cast("timestamp").alias("tp_ts"),
    )
    dedup.store_batch(rows.where("tp_offset % 10000 <> 5"), folder)
    assert dedup.Delivered(spark, folder).ranges().count() == 6
    dedup.store_batch(rows, folder)
    known = dedup.Delivered(spark, folder)
    assert known.ranges().count() == 1 and known.rows(rows).count() == 50_000
    assert len(os.listdir(f"{folder}/ranges")) == 1  # older ones are gone


def test_only_touched_buckets_are_read(spark, tmp_path):
    folder = str(tmp_path / "in")
    dedup.store_batch(arrived(spark, [("p", b, 0) for b in range(200)]), folder)
    read = []

    class Watched(dedup.Delivered):
        def ranges(self, buckets=None):
            read.append(super().ranges(buckets).inputFiles())
            return super().ranges(buckets)

    Watched(spark, folder).take(arrived(spark, [("p", 3, 0), ("p", 3, 1)]))
    assert len({file.rsplit("/", 2)[1] for file in read[0]}) == 1
    assert len(kept(spark, folder)) == 201


def test_a_failure_before_the_end_changes_nothing(spark, tmp_path, monkeypatch):
    folder = str(tmp_path / "in")
    dedup.store_batch(arrived(spark, [("p", 1, 0)]), folder)
    with monkeypatch.context() as patch:
        patch.setattr(Store, "replace_text", lambda *_: (_ for _ in ()).throw(OSError("gone")))
        with pytest.raises(OSError):
            dedup.store_batch(arrived(spark, [("p", 1, 0), ("p", 1, 1), ("p", 2, 5)]), folder)
    assert kept(spark, folder) == [("p", 1, 0)]
    dedup.store_batch(arrived(spark, [("p", 1, 1)]), folder)
    assert kept(spark, folder) == [("p", 1, 0), ("p", 1, 1)]


def test_streams_with_different_checkpoints(spark, tmp_path):
    folder, inbox = str(tmp_path / "in"), str(tmp_path / "inbox")
    arrived(spark, [("p", 1, o) for o in range(5)]).write.parquet(inbox)
    for name in ("a", "b"):
        stream = spark.readStream.schema(SCHEMA).parquet(inbox)
        dedup.store_arrivals(stream, folder, checkpoint=str(tmp_path / name), trigger={"availableNow": True}).awaitTermination()
    assert kept(spark, folder) == [("p", 1, o) for o in range(5)]


def test_rows_that_cannot_be_recognised_stay(spark, tmp_path):
    folder = str(tmp_path / "in")
    for _ in range(2):
        dedup.store_batch(arrived(spark, [("p", 1, 1)]).union(spark.createDataFrame([("?", None, 1, None, None)], SCHEMA)), folder)
    found = dedup.stored_arrivals(arrived(spark, []), folder)
    assert found.where("tp_offset = 1").count() == 1 and found.where("v = '?'").count() == 2
