import pytest
from conftest import ROWS2
from pyspark.sql import DataFrameWriter

from topicflow import TopicSpace
from topicflow.operators import kafka
from topicflow.operators.kafka import forward_to_kafka, kafka_records


@pytest.fixture
def space(spark, root):
    return TopicSpace(spark, root).create_topic("v", "value string")


@pytest.fixture
def stored(spark, root):
    space = TopicSpace(spark, root).create_topic("topic-2", "value string, n bigint")
    frame = spark.createDataFrame([*zip(ROWS2, range(5)), (None, None)], "value string, n bigint")
    space.publish("topic-2", frame, producer="p", batch_id=3, order_by=["n"])
    return space.rows("topic-2")


def test_records(stored):
    found = {row.key: (row.value, row.topic) for row in kafka_records(stored, "out").collect()}
    assert found == {
        "3-0": (None, "out"),
        "3-1": ("oak", "out"),
        "3-2": ("elm", "out"),
        "3-3": ("ash", "out"),
        "3-4": ("oak", "out"),
        "3-5": ("", "out"),
    }


def test_whole_rows(stored):
    found = {row.key: row.value for row in kafka_records(stored, "out", "json").collect()}
    assert found["3-0"] == '{"value":null,"n":null}' and found["3-1"] == '{"value":"oak","n":0}'
    with pytest.raises(ValueError):
        kafka_records(stored, "out", "xml")


def test_first_column_is_written_as_text(spark, root):
    space = TopicSpace(spark, root).create_topic("t", "n double, s string")
    space.publish_rows("t", [(1.5, "x")], producer="p", batch_id=0)
    assert kafka_records(space.rows("t"), "t").first().value == "1.5"


def test_forwarding(stored, monkeypatch):
    """The connector is not on the class path here, so only what is handed to it is checked."""
    calls = {}
    monkeypatch.setattr(DataFrameWriter, "format", lambda self, name: calls.update(format=name) or self)
    monkeypatch.setattr(DataFrameWriter, "options", lambda self, **options: calls.update(options=options) or self)
    monkeypatch.setattr(DataFrameWriter, "save", lambda self: calls.update(columns=self._df.columns))
    forward_to_kafka(stored, "out", "host-1:9092,host-2:9092", includeHeaders="false")
    assert calls == {
        "format": "kafka",
        "options": {"kafka.bootstrap.servers": "host-1:9092,host-2:9092", "includeHeaders": "false"},
        "columns": ["key", "value", "topic"],
    }


def test_a_failed_send_is_not_hidden(stored):
    with pytest.raises(Exception):
        forward_to_kafka(stored, "out", "nowhere:1")


def test_a_repeated_forward_sends_the_rest_only(spark, space, tmp_path):
    """The writer fails midway; the second run sends what is missing, the third nothing."""
    for batch_id in range(4):
        rows = [(f"b{batch_id}r{n}",) for n in range(10)]
        space.publish("v", spark.createDataFrame(rows, "value string"), producer="p-1", batch_id=batch_id)
    space.publish_rows("v", ["q"], producer="q.2", batch_id=-3)
    ledger, sent, broken = str(tmp_path / "ledger"), [], [True]

    def write(records):
        if len(sent) == 3 and broken.pop():
            raise OSError("no broker")
        sent.append(sorted(r.key for r in records.collect()))

    rows = space.rows("v")
    with pytest.raises(OSError):
        kafka.forward_once(rows, "t", ledger, write, records_per_send=4)
    before = [list(group) for group in sent]
    assert len(before) == 3 and all(len(group) <= 4 for group in before)
    broken.append(False)
    assert kafka.forward_once(rows, "t", ledger, write, records_per_send=4) == 41 - sum(map(len, before))
    assert sorted(key for group in sent for key in group) == sorted([*(f"{b}-{o}" for b in range(4) for o in range(10)), "-3-0"])
    assert len([key for group in sent for key in group]) == 41 == len({key for group in sent for key in group})
    assert kafka.forward_once(rows, "t", ledger, write, records_per_send=4) == 0
    space.publish_rows("v", ["new"], producer="q.2", batch_id=4)
    assert kafka.forward_once(space.rows("v"), "t", ledger, write, records_per_send=4) == 1 and sent[-1] == ["4-0"]
    receipts = kafka.sent_records(spark, ledger)
    assert receipts.agg({"records": "sum"}).first()[0] == 42 and receipts.where("tp_producer = 'p-1'").count() == 12
    with pytest.raises(ValueError, match="another forward"):
        kafka.forward_once(rows, "t", ledger, write, records_per_send=5)


def test_a_stream_without_its_checkpoint_sends_nothing_twice(spark, space, tmp_path, monkeypatch):
    space.publish_rows("v", ["a", "b"], producer="p", batch_id=0)
    sent = []
    original = kafka.forward_once
    monkeypatch.setattr(
        kafka, "forward_once", lambda rows, topic, ledger, _, value: original(rows, topic, ledger, lambda r: sent.extend(x.value for x in r.collect()), value)
    )
    for checkpoint in ("one", "two"):
        stream = space.rows_stream("v")
        query = kafka.forward_to_kafka(stream, "t", "none:1", checkpoint=str(tmp_path / checkpoint), trigger={"availableNow": True}, ledger=str(tmp_path / "ledger"))
        query.awaitTermination()
        space.publish_rows("v", [checkpoint], producer="p", batch_id=len(sent))
    assert sorted(sent) == ["a", "b", "one"]
