import os
import random

import pytest
from pyspark.sql import functions as F

from topicflow import TopicSpace
from topicflow.operators import upkeep
from topicflow.sources import log
from topicflow.sources.format import register

ONCE = {"availableNow": True}


@pytest.fixture
def space(spark, root):
    register(spark)
    return TopicSpace(spark, root).create_topic("t", "n bigint")


def filled(spark, space, count, begin=0, rows=5):
    for batch_id in range(begin, begin + count):
        part = spark.range(batch_id * rows, (batch_id + 1) * rows, 1, 2).select(F.col("id").alias("n"))
        space.publish("t", part, producer="pq"[batch_id % 2], batch_id=batch_id, order_by=["n"])


def everything(space):
    return sorted(map(tuple, space.rows("t").collect()))


def parquet_files(root):
    return sum(name.endswith(".parquet") for _, _, names in os.walk(f"{root}/log") for name in names)


def run(stream, tmp_path, name="out"):
    writer = stream.writeStream.format("parquet").option("checkpointLocation", str(tmp_path / f"{name}-cp"))
    writer.trigger(**ONCE).start(str(tmp_path / name)).awaitTermination()
    return sorted(map(tuple, stream.sparkSession.read.schema(stream.schema).parquet(str(tmp_path / name)).collect()))


def ranges(space):
    rng = random.Random(1)
    pairs = [(rng.randrange(-1, 30), rng.randrange(0, 40)) for _ in range(8)]
    return [
        sorted((r.tp_position, r.n) for r in space.offset_range("t", producer, end=b, start=a).collect())
        for a, b in pairs
        for producer in "pq"
    ]


def test_compaction_changes_nothing_that_is_read(spark, space, root, tmp_path):
    filled(spark, space, 8)
    before, wanted, files = everything(space), ranges(space), parquet_files(root)
    stream = log.read_topic_stream(spark, root, "t")
    name, _ = space.subscribe("t", "reader")
    filled(spark, space, 2, begin=8)
    assert len(run(stream, tmp_path)) == 50
    assert space.compact("t") == 10
    after = everything(space)
    assert set(before) <= set(after) and len(after) == 50
    assert [[pair for pair in one if pair[0] < 20] for one in ranges(space)] == [[pair for pair in one if pair[0] < 20] for one in wanted]
    assert sorted(space.fetch(name).select("n").collect()) == [(n,) for n in range(40, 50)]
    assert sorted(map(tuple, log.read_batches(spark, root, "t", [("p", 2), ("q", 9)]).select("n").collect())) == [(n,) for n in [*range(10, 15), *range(45, 50)]]
    filled(spark, space, 3, begin=10)  # own files and compacted ones together
    assert len(run(stream, tmp_path)) == 65 and run(stream, tmp_path) == everything(space)  # the same stream, started again
    assert run(log.read_topic_stream(spark, root, "t"), tmp_path, "new") == everything(space)
    assert run(log.read_topic_stream(spark, root, "t", startingVersion="8"), tmp_path, "late") == [r for r in everything(space) if r[2] > 8]
    assert parquet_files(root) > files
    assert space.clear("t") == 0  # somebody may still be reading
    assert space.clear("t", older_than=0) == 10
    assert run(log.read_topic_stream(spark, root, "t"), tmp_path, "newest") == everything(space)
    assert log.receipts(space.rows("t")).count() == 13


def test_compacting_again(spark, space, root, tmp_path):
    assert space.compact("t") == 0
    filled(spark, space, 1)
    assert space.compact("t") == 0
    filled(spark, space, 3, begin=1)
    wanted = everything(space)
    assert space.compact("t", rows_per_file=7) == 4 and space.compact("t") == 0
    filled(spark, space, 2, begin=4)
    assert space.compact("t") == 2
    filled(spark, space, 1, begin=6)
    assert space.compact("t", again=True) == 7
    assert set(wanted) <= set(everything(space)) and len(everything(space)) == 35
    state = log.manifest(spark, root, "t").state()
    assert len(state.compacted) == 1 and len(state.stale) == 2
    assert space.clear("t", older_than=0) == 9  # seven batches and two older compactions
    assert len(everything(space)) == 35 and space.clear("t", older_than=0) == 0
    assert [r.tp_position for r in space.offset_range("t", "p", end=12, start=2).orderBy("tp_position").collect()] == list(range(3, 13))


def test_a_slow_reader_loses_nothing(spark, space, root):
    slow, fast = space.subscribe("t", "slow")[0], space.subscribe("t", "fast")[0]
    filled(spark, space, 4)
    assert space.fetch(fast).count() == 20
    assert space.release("t") == 0 and space.rows("t").count() == 20
    got = []
    space.drain(slow, lambda rows, _: got.extend(r.n for r in rows.collect()), max_batches=2)
    assert sorted(got) == list(range(20))
    filled(spark, space, 2, begin=4)
    assert space.release("t") == 4
    assert sorted(r.n for r in space.rows("t").collect()) == list(range(20, 30))
    with_files = parquet_files(root)
    assert space.clear("t") == 0 and parquet_files(root) == with_files
    assert space.clear("t", older_than=0) == 4 and parquet_files(root) < with_files
    assert sorted(r.n for r in space.fetch(slow).collect()) == sorted(r.n for r in space.fetch(fast).collect()) == list(range(20, 30))
    positions = space.offset_range("t", "p", end=100).collect()
    assert sorted(r.tp_position for r in positions) == list(range(10, 15))  # as they were
    space.unsubscribe(slow)
    filled(spark, space, 1, begin=6)
    assert space.release("t") == 2 and space.rows("t").count() == 5


def test_a_failed_drain_holds_its_rows(spark, space):
    name, _ = space.subscribe("t")
    filled(spark, space, 2)
    with pytest.raises(RuntimeError):
        space.drain(name, lambda *_: (_ for _ in ()).throw(RuntimeError()))
    assert space.release("t") == 0
    assert space.fetch(name).count() == 10 and space.release("t") == 2


def test_nobody_subscribed_keeps_everything(spark, space):
    filled(spark, space, 2)
    assert space.release("t") == 0
    space.subscribe("t")  # sees nothing of these
    assert space.release("t", keep_below=1) == 1 and space.rows("t").count() == 5
    assert space.release("t") == 1 and space.rows("t").count() == 0


def test_streams_hold_what_they_have_not_read(spark, space, root, tmp_path):
    name, _ = space.subscribe("t", "streamed")
    filled(spark, space, 2)
    assert len(run(space.subscription_stream(name), tmp_path)) == 10
    filled(spark, space, 2, begin=2)
    assert space.release("t") <= 2
    assert len(run(space.subscription_stream(name), tmp_path)) == 20  # nothing lost
    filled(spark, space, 1, begin=4)
    assert len(run(space.subscription_stream(name), tmp_path)) == 25
    assert space.release("t") >= 2


def test_a_stream_without_subscription_is_told(spark, space, root, tmp_path):
    stream = log.read_topic_stream(spark, root, "t")
    filled(spark, space, 1)
    assert len(run(stream, tmp_path)) == 5
    filled(spark, space, 3, begin=1)
    space.subscribe("t")
    assert space.release("t", keep_below=3) == 3
    with pytest.raises(Exception, match="ReleasedBatches: 2 batches after version 0 were released"):
        run(stream, tmp_path)
    assert len(run(log.read_topic_stream(spark, root, "t", failOnDataLoss="false"), tmp_path)) == 10


def test_release_inside_a_compaction(spark, space, root, tmp_path):
    filled(spark, space, 6)
    space.compact("t")
    reader, _ = space.subscribe("t")
    assert space.release("t", keep_below=3) == 3
    assert sorted(r.n for r in space.rows("t").collect()) == list(range(15, 30))
    assert sorted(r[0] for r in run(log.read_topic_stream(spark, root, "t", failOnDataLoss="false"), tmp_path)) == list(range(15, 30))
    filled(spark, space, 1, begin=6)
    assert space.compact("t", again=True) == 4
    space.clear("t", older_than=0)
    assert sorted(r.n for r in space.rows("t").collect()) == list(range(15, 35))
    assert space.fetch(reader).count() == 5 and space.release("t") == 4
    space.clear("t", older_than=0)
    assert parquet_files(root) == 0 and everything(space) == []


def test_losing_to_another_compaction_changes_nothing(spark, space, root, monkeypatch):
    filled(spark, space, 3)
    append, inner = upkeep.manifest, []

    def known(*args):
        if not inner:
            inner.append(True)
            found = append(*args)
            state = found.state()
            monkeypatch.setattr(upkeep, "manifest", append)
            space.compact("t")
            monkeypatch.setattr(type(found), "state", lambda self, s=[state], real=type(found).state: s.pop() if s else real(self))
            return found
        return append(*args)

    monkeypatch.setattr(upkeep, "manifest", known)
    assert space.compact("t") == 0
    monkeypatch.undo()
    assert len(everything(space)) == 15 and len(log.manifest(spark, root, "t").state().compacted) == 1
