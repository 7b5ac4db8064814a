import pytest
from conftest import ROWS2, SEVEN
from pyspark.sql import functions as F

from topicflow import TopicSpace
from topicflow.errors import InvalidSubscription, UnknownTopic
from topicflow.storage import Store
from topicflow.streaming import subscriptions


@pytest.fixture
def space(spark, root):
    return TopicSpace(spark, root).create_topic("topic-1", SEVEN).create_topic("topic-2", "value string")


def plain(space, name):
    return sorted(map(tuple, space.fetch_original(name).collect()))


def test_each_subscription_gets_its_own_part(space):
    """Three subscriptions opened at different times on one topic, one on another; ends don't touch the others."""
    first, schema = space.subscribe("topic-2", "first")
    assert schema.simpleString() == "struct<value:string>"
    space.publish_rows("topic-2", ["one"], producer="p", batch_id=1)
    second, _ = space.subscribe("topic-2")
    other, _ = space.subscribe("topic-1")
    assert (first, second, other) == ("first", "subscriber-1", "subscriber-2")
    space.publish_rows("topic-2", ["two", "two"], producer="q", batch_id=9)
    third, _ = space.subscribe("topic-2", "third")
    assert plain(space, second) == [("two",), ("two",)]
    space.publish_rows("topic-2", ["three"], producer="p", batch_id=2)
    space.unsubscribe(second)
    assert plain(space, first) == [("one",), ("three",), ("two",), ("two",)]
    assert plain(space, third) == [("three",)] and plain(space, other) == []
    assert plain(space, first) == plain(space, third) == []
    for call in (space.fetch, space.unsubscribe, space.subscription_stream):
        with pytest.raises(InvalidSubscription):
            call(second)


def test_unknown_names(space):
    with pytest.raises(UnknownTopic):
        space.subscribe("nothing")
    with pytest.raises(InvalidSubscription):
        space.fetch("nobody")
    space.subscribe("topic-2", "me")
    with pytest.raises(InvalidSubscription):
        space.subscribe("topic-2", "me")


def test_fetched_tables_stay_valid(space):
    name, _ = space.subscribe("topic-2")
    space.publish_rows("topic-2", ROWS2, producer="p", batch_id=1)
    first = space.fetch(name)
    space.publish_rows("topic-2", ["new"], producer="p", batch_id=2)
    second = space.fetch(name)
    assert first.count() == 5 and [row.value for row in second.collect()] == ["new"]


def test_late_subscriber_and_new_producers(space):
    space.publish_rows("topic-2", ["old"], producer="p", batch_id=5)
    name, _ = space.subscribe("topic-2")
    space.publish_rows("topic-2", ["p6"], producer="p", batch_id=6)
    space.publish_rows("topic-2", ["q1"], producer="q", batch_id=1)  # a producer unknown at the start
    assert plain(space, name) == [("p6",), ("q1",)]


def test_only_files_of_later_batches_are_read(spark, space):
    space.publish_rows("topic-2", ["old"], producer="a.b-c", batch_id=-5)
    name, _ = space.subscribe("topic-2")
    space.publish_rows("topic-2", ["new"], producer="a.b-c", batch_id=-4)
    files = space.fetch(name).inputFiles()
    assert len(files) == 1 and "tp_producer=a.b-c/tp_batch_id=-4/" in files[0]


def test_fetching_lists_nothing(spark, space, monkeypatch):
    name, _ = space.subscribe("topic-2")
    for batch_id in range(3):
        space.publish_rows("topic-2", ["v"], producer="p", batch_id=batch_id)
    listed = []
    monkeypatch.setattr(Store, "names", lambda self, path: listed.append(path) or [])
    assert space.fetch(name).count() == 3 and listed == []


def test_drain_in_portions(space):
    name, _ = space.subscribe("topic-2")
    for batch_id in range(3):
        space.publish_rows("topic-2", [f"v{batch_id}"], producer="p", batch_id=batch_id)
    got = []
    space.drain(name, lambda rows, number: got.append((number, [row.value for row in rows.collect()])), max_batches=1)
    assert sorted(value for _, values in got for value in values) == ["v0", "v1", "v2"]
    assert len({number for number, _ in got}) == 3


def test_drain_gives_a_failed_batch_again(space):
    name, _ = space.subscribe("topic-2")
    space.publish_rows("topic-2", ROWS2, producer="p", batch_id=1)
    with pytest.raises(Exception, match="not now"):
        space.drain(name, lambda batch, number: (_ for _ in ()).throw(RuntimeError("not now")))
    got = []
    space.drain(name, lambda batch, number: got.extend(row.value for row in batch.collect()))
    assert sorted(got) == sorted(ROWS2)
    space.drain(name, lambda batch, number: got.append("again"))
    assert len(got) == 5


def test_stream_with_its_own_checkpoint(spark, space, tmp_path):
    space.publish_rows("topic-2", ["old"], producer="p", batch_id=1)
    name, _ = space.subscribe("topic-2")
    space.publish_rows("topic-2", ROWS2, producer="p", batch_id=2)
    stream = space.subscription_stream(name, rowsPerTask=2)
    query = stream.groupBy("value").agg(F.count("*").alias("n")).writeStream.format("memory").queryName("counted")
    query = query.outputMode("complete").option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True)
    query.start().awaitTermination()
    found = {row.value: row.n for row in spark.table("counted").collect()}
    assert found == {"oak": 2, "elm": 1, "ash": 1, "": 1}


def test_source_from_now_with_receive_time(spark, space, tmp_path):
    space.publish_rows("topic-2", ["old"], producer="p", batch_id=1)
    for values in (["new"], ["newer"]):  # the second time the program is started again
        stream = subscriptions.source_from_now(spark, space.root, "topic-2", "mine", includes_timestamp=True)
        assert stream.columns == ["value", "_TIMESTAMP_"]
        space.publish_rows("topic-2", values, producer="p", batch_id=len(values[0]))
        query = stream.writeStream.format("parquet").option("checkpointLocation", str(tmp_path / "cp"))
        query.trigger(availableNow=True).start(str(tmp_path / "rows")).awaitTermination()
    found = spark.read.parquet(str(tmp_path / "rows")).collect()
    assert sorted(row.value for row in found) == ["new", "newer"] and all(row["_TIMESTAMP_"] for row in found)
