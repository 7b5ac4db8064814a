import pytest
from conftest import ROWS1, ROWS2, SEVEN
from pyspark.sql import functions as F

from topicflow import TopicSpace
from topicflow.errors import SchemaMismatch, UnknownTopic
from topicflow.functions.text import word_count
from topicflow.streaming.listeners import Collector, Printer, printed_lines

ONCE = {"availableNow": True}


@pytest.fixture
def inbox(spark, tmp_path):
    """A folder that is read as a stream, and a function that adds rows to it."""
    folder = str(tmp_path / "inbox")

    def add(rows, schema="value string"):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(folder)

    return folder, add


def test_stream_to_topic_to_stream(spark, root, inbox, tmp_path):
    folder, add = inbox
    add(ROWS1, SEVEN)
    space = TopicSpace(spark, root).create_topic("in", SEVEN)
    collector = Collector(str(tmp_path / "kept"))
    space.add_listener(collector)
    source = spark.readStream.schema(SEVEN).parquet(folder)
    options = dict(producer="p", checkpoint=str(tmp_path / "cp"), order_by=["_2"], trigger=ONCE)
    space.publish_stream("in", source, **options).awaitTermination()

    wanted = spark.createDataFrame(ROWS1, SEVEN).collect()
    kept = collector.get(spark, "in", SEVEN)
    assert [tuple(row)[:7] for row in kept.orderBy("tp_offset").collect()] == list(map(tuple, wanted))

    query = space.source("in").writeStream.format("memory").queryName("back").trigger(**ONCE)
    query.option("checkpointLocation", str(tmp_path / "cp2")).start().awaitTermination()
    assert sorted(spark.table("back").collect(), key=str) == sorted(wanted, key=str)

    # a restart goes on where it stopped
    add([("fig", 10, True, 0.5, 0.25, 4, 5)], SEVEN)
    space.publish_stream("in", source, **options).awaitTermination()
    assert [(r._2, r.tp_batch_id) for r in space.rows("in").orderBy("_2").collect()] == [(7, 0), (8, 0), (9, 0), (10, 1)]


def test_source_with_timestamp(spark, root, tmp_path):
    space = TopicSpace(spark, root).create_topic("t", SEVEN)
    stream = space.source("t", includes_timestamp=True)  # nothing published yet
    assert stream.columns[-1] == "_TIMESTAMP_" and stream.schema[-1].dataType.simpleString() == "timestamp"
    space.publish_rows("t", ROWS1, producer="p", batch_id=1)
    query = stream.writeStream.format("memory").queryName("timed").trigger(**ONCE)
    query.option("checkpointLocation", str(tmp_path / "cp")).start().awaitTermination()
    found = spark.table("timed").collect()
    assert len(found) == 3 and all(row["_TIMESTAMP_"] is not None for row in found)
    wanted = map(tuple, spark.createDataFrame(ROWS1, SEVEN).collect())
    assert sorted((tuple(row)[:7] for row in found), key=str) == sorted(wanted, key=str)


def test_complete_mode_and_running_count(spark, root, inbox, tmp_path):
    """Each micro-batch of a running count becomes a batch of its own."""
    folder, add = inbox
    add([("a b",), ("b",)])
    space = TopicSpace(spark, root).create_topic("counts", "value string, count bigint")
    counts = word_count(spark.readStream.schema("value string").parquet(folder))
    for more in ([], [("b a  c ",)]):
        if more:
            add(more)
        space.publish_stream(
            "counts", counts, producer="p", checkpoint=str(tmp_path / "cp"), output_mode="complete", trigger=ONCE
        ).awaitTermination()
    found = {}
    for row in space.rows("counts").collect():
        found.setdefault(row.tp_batch_id, {})[row["value"]] = row["count"]
    first, second = (found[key] for key in sorted(found))
    assert first == {"a": 1, "b": 2}
    assert second == {"a": 2, "b": 3, "c": 1, "": 1}


def test_checks_come_before_the_query_starts(spark, root, inbox, tmp_path):
    folder, add = inbox
    add([("x",)])
    stream = spark.readStream.schema("value string").parquet(folder)
    space = TopicSpace(spark, root).create_topic("t", "value int")
    with pytest.raises(UnknownTopic):
        space.publish_stream("nothing", stream, producer="p", checkpoint=str(tmp_path / "cp"))
    with pytest.raises(SchemaMismatch):
        space.publish_stream("t", stream, producer="p", checkpoint=str(tmp_path / "cp"))


def test_listeners_in_order_with_stored_stamps(spark, root):
    heard = []
    space = TopicSpace(spark, root).create_topic("t", "value string")
    space.add_listener(lambda topic, rows, batch: heard.append(("first", topic, batch, rows.count())))
    space.add_listener(lambda topic, rows, batch: heard.append(("second", topic, batch, rows.first().tp_ts)))
    space.publish_rows("t", ROWS2, producer="p", batch_id=1)
    stamp = space.rows("t").first().tp_ts
    assert heard == [("first", "t", 1, 5), ("second", "t", 1, stamp)]
    space.publish_rows("t", ["other"], producer="p", batch_id=1)  # a replay is heard again, as stored
    assert heard[2:] == heard[:2]
    with pytest.raises(UnknownTopic):
        space.publish_rows("nothing", ["x"], producer="p", batch_id=2)
    space.publish_rows("t", [], producer="p", batch_id=2)
    assert len(heard) == 4


def test_a_failing_listener_hears_the_batch_again(spark, root, inbox, tmp_path):
    folder, add = inbox
    add([(value,) for value in ROWS2])
    heard = []

    def listener(topic, rows, batch_id):
        heard.append((batch_id, rows.count()))
        if len(heard) == 1:
            raise RuntimeError("not now")

    space = TopicSpace(spark, root).create_topic("t", "value string").add_listener(listener)
    stream = spark.readStream.schema("value string").parquet(folder)
    options = dict(producer="p", checkpoint=str(tmp_path / "cp"), trigger=ONCE)
    with pytest.raises(Exception, match="not now"):
        space.publish_stream("t", stream, **options).awaitTermination()
    space.publish_stream("t", stream, **options).awaitTermination()
    assert heard == [(0, 5), (0, 5)]
    assert space.rows("t").count() == 5


def test_collector_overwrites_on_replay(spark, root, tmp_path):
    collector = Collector(str(tmp_path / "kept"))
    space = TopicSpace(spark, root).create_topic("t", "value string").add_listener(collector)
    for batch_id in (1, 1, 2):
        space.publish_rows("t", ROWS2, producer="p", batch_id=batch_id)
    space.publish_rows("t", ROWS2, producer="q", batch_id=1)
    found = collector.get(spark, "t", "value string").groupBy("tp_producer", "tp_batch_id").count().collect()
    assert sorted(map(tuple, found)) == [("p", 1, 5), ("p", 2, 5), ("q", 1, 5)]


def test_collector_keeps_producers_apart(spark, root, tmp_path):
    """Producers whose names are numbers, and a topic nothing arrived for."""
    collector = Collector(str(tmp_path / "kept"))
    space = TopicSpace(spark, root).create_topic("t", "value string").add_listener(collector)
    assert collector.get(spark, "t", "value string").count() == 0
    for producer in ("7", "007"):
        space.publish_rows("t", [producer], producer=producer, batch_id=1)
    found = collector.get(spark, "t", "value string")
    assert found.schema["tp_producer"].dataType.simpleString() == "string"
    assert found.schema["tp_batch_id"].dataType.simpleString() == "bigint"
    assert sorted((r.value, r.tp_producer, r.tp_batch_id, r.tp_offset) for r in found.collect()) == [
        ("007", "007", 1, 0), ("7", "7", 1, 0)
    ]


def printed(spark, folder):
    files = sorted(folder.glob("part-*"))
    return [line for file in files for line in file.read_text().splitlines()]


def test_printer(spark, root, tmp_path):
    space = TopicSpace(spark, root).create_topic("trees", SEVEN).add_listener(Printer(str(tmp_path / "out")))
    at = F.lit("2024-05-06 07:08:09.125").cast("timestamp")
    rows = [("plum", 1, True, 0.5, 0.25, 1, 49), (None, 2, False, 0.5, 1e10, None, 50)]
    frame = spark.createDataFrame(rows, SEVEN)
    space.publish("trees", frame, producer="p", batch_id=1, order_by=["_2"], received_at=at)
    assert printed(spark, tmp_path / "out" / "trees" / "p" / "1") == [
        "++++++++topic=trees++++++++",
        "RowEx([plum,1,true,0.5,0.25,1,49],1,0,2024-05-06 07:08:09.125)",
        "RowEx([null,2,false,0.5,1.0E10,null,50],1,1,2024-05-06 07:08:09.125)",
    ]


def test_printer_writes_every_row(spark, root, tmp_path):
    space = TopicSpace(spark, root).create_topic("t", "value string").add_listener(Printer(str(tmp_path / "out")))
    space.publish_rows("t", [f"v{i:03d}" for i in range(250)], producer="p", batch_id=4)
    lines = printed(spark, tmp_path / "out" / "t" / "p" / "4")
    assert len(lines) == 251 and [int(line.split(",")[2]) for line in lines[1:]] == list(range(250))


def test_printed_time_always_has_a_fraction(spark, root):
    space = TopicSpace(spark, root).create_topic("t", "value string")
    at = F.lit("2024-05-06 07:08:09").cast("timestamp")
    space.publish("t", spark.createDataFrame([("a",)], "value string"), producer="p", batch_id=1, received_at=at)
    last = printed_lines("t", space.rows("t")).orderBy("line_no").collect()[-1]
    assert last.line == "RowEx([a],1,0,2024-05-06 07:08:09.0)"


def test_console_sink(root, spark, tmp_path):
    space = TopicSpace(spark, root).create_topic("t", "value string")
    space.publish_rows("t", ROWS2, producer="p", batch_id=1)
    query = space.source("t").writeStream.format("console").trigger(**ONCE)
    query = query.option("checkpointLocation", str(tmp_path / "cp")).start()
    query.awaitTermination()
    assert sum(progress["numInputRows"] for progress in query.recentProgress) == 5
