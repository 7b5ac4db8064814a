import datetime
import decimal
import json
import os

import pytest
from conftest import ROWS1, ROWS2, SEVEN
from pyspark.sql import functions as F

from topicflow import TopicSpace
from topicflow.sources import catalog, log
from topicflow.sources.format import register

ONCE = {"availableNow": True}


@pytest.fixture
def space(spark, root):
    register(spark)
    return TopicSpace(spark, root).create_topic("t", SEVEN).create_topic("v", "value string")


def opened(spark, root, topic, **options):
    return spark.readStream.format("topicflow").options(root=root, topic=topic, **options).load()


def run(stream, tmp_path, name="out"):
    """A stream run to its end with the checkpoint of that name; all rows it has given so far."""
    writer = stream.writeStream.format("parquet").option("checkpointLocation", str(tmp_path / f"{name}-cp"))
    writer.trigger(**ONCE).start(str(tmp_path / name)).awaitTermination()
    return stream.sparkSession.read.schema(stream.schema).parquet(str(tmp_path / name))


def as_set(rows):
    return sorted(map(str, map(tuple, rows)))


def test_table_reader(spark, space, root):
    space.publish_rows("t", ROWS1, producer="p", batch_id=1)
    plain = spark.read.format("topicflow").option("root", root).option("topic", "t").load()
    wanted = spark.createDataFrame(ROWS1, SEVEN)
    assert plain.schema.simpleString() == wanted.schema.simpleString()
    assert as_set(plain.collect()) == as_set(wanted.collect())
    stamped = spark.read.format("topicflow").options(root=root, topic="t", stamps="true").load()
    assert as_set(stamped.collect()) == as_set(log.read_topic(spark, root, "t").collect())
    timed = spark.read.format("topicflow").options(root=root, topic="t", includesTimestamp="true", timestampColumnName="at")
    assert timed.load().columns[-1] == "at" and timed.load().where("at is null").count() == 0
    empty = spark.read.format("topicflow").options(root=root, topic="v").load()
    assert empty.collect() == []


def test_round_trip_and_restart(spark, space, root, tmp_path):
    inbox = str(tmp_path / "inbox")
    for number, rows in enumerate((ROWS1, [], [("fig", 10, True, 0.5, 0.25, 4, 5)])):
        spark.createDataFrame(rows, SEVEN).coalesce(1).write.mode("append").parquet(inbox)
        source = spark.readStream.schema(SEVEN).parquet(inbox)
        writer = source.writeStream.format("topicflow").options(root=root, topic="t", producer="p")
        writer.option("checkpointLocation", str(tmp_path / "in")).trigger(**ONCE).start().awaitTermination()
        back = run(opened(spark, root, "t"), tmp_path)
        assert as_set(back.collect()) == as_set(spark.read.schema(SEVEN).parquet(inbox).collect()), number
    stored = log.read_topic(spark, root, "t").collect()
    assert {(r.tp_producer, r.tp_offset) for r in stored if r._1 == "fig"} == {("p", 0)}
    assert {r.tp_offset for r in stored if r._1 != "fig"} == {0, 1, 2}


def test_a_repeated_micro_batch_changes_nothing(spark, space, root, tmp_path):
    spark.createDataFrame([(v,) for v in ROWS2], "value string").write.parquet(str(tmp_path / "inbox"))
    source = spark.readStream.schema("value string").parquet(str(tmp_path / "inbox"))
    for checkpoint in ("one", "two"):  # the second time without its checkpoint
        writer = source.writeStream.format("topicflow").options(root=root, topic="v", producer="p")
        writer.option("checkpointLocation", str(tmp_path / checkpoint)).trigger(**ONCE).start().awaitTermination()
    assert sorted(r.value for r in space.rows("v").collect()) == sorted(ROWS2)
    incoming = f"{root}/log/v/incoming"
    assert not os.path.exists(incoming) or os.listdir(incoming) == []


def test_table_writer_and_offsets(spark, space, root):
    frame = spark.range(0, 1000, 1, 4).select(F.concat(F.lit("v"), F.format_string("%04d", "id")).alias("value"))
    for _ in range(2):
        frame.write.format("topicflow").options(root=root, topic="v", producer="p", batchId="3").mode("append").save()
    found = space.rows("v").orderBy("tp_offset").collect()
    assert [(r.tp_offset, r.value) for r in found] == [(n, f"v{n:04d}") for n in range(1000)]
    assert {(r.tp_producer, r.tp_batch_id) for r in found} == {("p", 3)}
    assert space.publish("v", frame.limit(5), producer="p", batch_id=4).rows == 5  # both ways of publishing go on from each other
    assert space.offset_range("v", "p", end=1001, start=998).count() == 3


def test_every_type(spark, root, tmp_path):
    register(spark)
    schema = (
        "a array<int>, m map<string,bigint>, s struct<x:int,y:string>, d decimal(10,4), b binary, t timestamp, n timestamp_ntz,"
        " day date, deep array<struct<k:string,v:array<double>>>, f float, y tinyint, `odd name.x` string"
    )
    at = datetime.datetime(1812, 3, 4, 5, 6, 7, 123456)
    rows = [
        ([1, None], {"k": 1, "l": None}, (1, None), decimal.Decimal("1.2345"), b"\x00\xff", at, at, at.date(), [("k", [1.5, None])], float("nan"), -1, "é\n"),
        ([], {}, None, None, b"", None, None, None, [], float("-inf"), None, ""),
        (None,) * 12,
    ]
    frame = spark.createDataFrame(rows, schema)
    space = TopicSpace(spark, root).create_topic("x", schema)
    frame.write.format("topicflow").options(root=root, topic="x", producer="f", batchId="0").mode("append").save()
    space.publish("x", frame, producer="s", batch_id=0)
    wanted = sorted(map(repr, frame.collect()))
    for found in (
        spark.read.format("topicflow").options(root=root, topic="x").load(),
        run(opened(spark, root, "x"), tmp_path),
        space.source("x", stream=False),
    ):
        assert found.schema.simpleString() == frame.schema.simpleString()
        assert sorted(map(repr, found.collect())) == sorted(wanted * 2)


def test_a_stream_keeps_one_number(spark, space, root, tmp_path):
    for batch_id in range(7):
        space.publish_rows("v", [f"v{batch_id}"], producer="p", batch_id=batch_id)
    assert run(opened(spark, root, "v"), tmp_path).count() == 7
    last = (tmp_path / "out-cp" / "offsets" / "0").read_text().splitlines()[-1]
    assert json.loads(last) == {"version": 6}
    assert run(opened(spark, root, "v", startingVersion="4"), tmp_path, "late").count() == 2


def test_options_are_checked(spark, space, root, tmp_path):
    for options, what in (
        ({"topic": "v"}, "root"),
        ({"root": root}, "topic"),
        ({"root": root, "topic": "nothing"}, "does not exist"),
        ({"root": root, "topic": "../v"}, "use letters"),
    ):
        with pytest.raises(Exception, match=what):
            spark.read.format("topicflow").options(**options).load()
    wrong, right = spark.createDataFrame([(1,)], "value int"), spark.createDataFrame([("a",)], "value string")
    for frame, options, what in (
        (wrong, {"producer": "p", "batchId": "1"}, "rows are struct<value:int>"),
        (right, {"batchId": "1"}, "producer"),
        (right, {"producer": "p"}, "batchId"),
    ):
        with pytest.raises(Exception, match=what):
            frame.write.format("topicflow").options(root=root, topic="v", **options).mode("append").save()
    with pytest.raises(Exception, match="overwritten"):
        space.source("v", stream=False).write.format("topicflow").options(root=root, topic="v", producer="p", batchId="1").mode("overwrite").save()
    with pytest.raises(Exception, match="invalid subscription"):
        run(opened(spark, root, "v", subscription="nobody"), tmp_path)


def test_a_failing_task_leaves_nothing_behind(spark, space, root):
    bad = spark.range(0, 10, 1, 2).select(F.when(F.col("id") < 9, "x").otherwise(F.raise_error(F.lit("bad"))).alias("value"))
    with pytest.raises(Exception, match="bad"):
        bad.write.format("topicflow").options(root=root, topic="v", producer="p", batchId="0").mode("append").save()
    assert space.rows("v").count() == 0
    assert log.heads(spark, root, "v") == {}


def test_wider_and_further_columns(spark, space, root, tmp_path):
    """Old and new batches are one table and one stream, also after compaction."""
    from topicflow.errors import SchemaMismatch
    from topicflow.operators import upkeep

    space.create_topic("w", "a int, b float, c decimal(5,2)")
    old = spark.createDataFrame([(1, 0.5, decimal.Decimal("1.25")), (None, None, None)], "a int, b float, c decimal(5,2)")
    space.publish("w", old, producer="p", batch_id=1)
    wide = "a bigint, b double, c decimal(9,2), d string not null, e array<int> not null"
    assert space.change_topic("w", wide).fetch_schema("w").simpleString() == catalog.as_schema(wide).simpleString()
    space.publish("w", spark.createDataFrame([(2**40, 1e300, decimal.Decimal("7.00"), "x", [1])], wide), producer="p", batch_id=2)
    space.publish("w", old.limit(1), producer="old", batch_id=1)  # a producer that has not changed yet
    wanted = sorted(map(repr, [(1, 0.5, decimal.Decimal("1.25"), None, None)] * 2 + [(None,) * 5, (2**40, 1e300, decimal.Decimal("7.00"), "x", [1])]))

    def checked(name):
        for found in (
            space.source("w", stream=False),
            spark.read.format("topicflow").options(root=root, topic="w").load(),
            run(opened(spark, root, "w"), tmp_path, name),
        ):
            assert found.schema.simpleString() == catalog.as_schema(wide).simpleString()
            assert sorted(repr(tuple(row)) for row in found.collect()) == wanted

    checked("before")
    known = log.manifest(spark, root, "w")
    assert [commit["schema"] for _, commit in known.batches(known.state())] == [0, 1, 0]
    upkeep.compact(spark, root, "w")
    checked("after")
    for change in ("a int, b double, c decimal(9,2), d string, e array<int>", "a bigint, b double", "b double, a bigint, c decimal(9,2), d string, e array<int>", "a bigint, b double, c decimal(9,3), d string, e array<int>", "a bigint, b double, c decimal(9,2), d string, e array<bigint>", "a bigint, b double, c decimal(9,2), d string, e array<int>, tp_x int"):
        with pytest.raises((SchemaMismatch, catalog.InvalidName)):
            space.change_topic("w", change)
    assert space.change_topic("w", wide).fetch_schema("w").simpleString() == catalog.as_schema(wide).simpleString()
    with pytest.raises(SchemaMismatch):
        space.publish("w", spark.createDataFrame([(1,)], "a int"), producer="p", batch_id=9)
    assert len(catalog.schemas(spark, root, "w")) == 2
