import os

import pytest
from conftest import ROWS1, ROWS2, SEVEN
from pyspark.sql import functions as F

from topicflow.errors import InvalidName, StaleBatch, UnknownTopic
from topicflow.functions import rows as views
from topicflow.sources import catalog, log
from topicflow.storage import Store


def files_under(folder):
    return sorted(
        os.path.relpath(os.path.join(at, name), folder)
        for at, _, names in os.walk(folder)
        for name in names
        if not name.startswith(".")
    )


def numbers(spark, count, partitions):
    return spark.range(0, count, 1, partitions).select(F.col("id").alias("n"))


@pytest.fixture
def topic(spark, root):
    catalog.create_topic(spark, root, "t", "n bigint")
    return "t"


def test_seven_types(spark, root):
    catalog.create_topic(spark, root, "topic-1", SEVEN)
    receipt = log.publish_rows(spark, root, "topic-1", ROWS1, producer="p", batch_id=1)
    assert receipt == ("topic-1", "p", 1, 3, False)
    expected = spark.createDataFrame(ROWS1, SEVEN).collect()
    assert sorted(log.topic_source(spark, root, "topic-1", stream=False).collect(), key=str) == sorted(expected, key=str)


def test_plain_values(spark, root):
    catalog.create_topic(spark, root, "topic-2", "value string")
    log.publish_rows(spark, root, "topic-2", ROWS2, producer="p", batch_id=-1)
    stored = log.read_topic(spark, root, "topic-2")
    assert sorted(row.value for row in stored.collect()) == sorted(ROWS2)
    assert {row.tp_batch_id for row in stored.collect()} == {-1}


@pytest.mark.parametrize("partitions", [1, 3, 7])
def test_offsets_have_no_gaps(spark, root, topic, partitions):
    frame = numbers(spark, 100, partitions).where("n % 10 <> 3")  # uneven partitions
    log.publish(spark, root, topic, frame, producer="p", batch_id=0)
    found = log.read_topic(spark, root, topic).orderBy("tp_offset").collect()
    assert [row.tp_offset for row in found] == list(range(90))
    assert [row.n for row in found] == [n for n in range(100) if n % 10 != 3]  # partition order is kept
    assert len({row.tp_ts for row in found}) == 1 and found[0].tp_ts is not None


def test_offsets_with_empty_partitions_and_split_files(spark, root, topic):
    spark.conf.set("spark.sql.files.maxRecordsPerFile", "7")
    try:
        frame = numbers(spark, 100, 5).where("n >= 40")
        log.publish(spark, root, topic, frame, producer="p", batch_id=0)
    finally:
        spark.conf.unset("spark.sql.files.maxRecordsPerFile")
    found = log.read_topic(spark, root, topic).orderBy("tp_offset").collect()
    assert [(row.tp_offset, row.n) for row in found] == [(n - 40, n) for n in range(40, 100)]


def test_order_by(spark, root, topic):
    frame = numbers(spark, 1000, 4).select(F.expr("(n * 7919) % 1000").alias("n"))
    log.publish(spark, root, topic, frame, producer="p", batch_id=0, order_by=[F.desc("n")])
    found = log.read_topic(spark, root, topic).collect()
    assert {row.tp_offset: row.n for row in found} == {999 - n: n for n in range(1000)}


def test_order_by_with_one_heavy_key_spreads(spark, root, topic):
    frame = numbers(spark, 20_000, 4).select(F.when(F.col("n") < 15_000, 5).otherwise(F.col("n")).alias("n"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        log.publish(spark, root, topic, frame, producer="p", batch_id=0, order_by=["n"])
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    found = log.read_topic(spark, root, topic)
    assert [row.n for row in found.orderBy("tp_offset").collect()] == sorted(row.n for row in frame.collect())
    heavy = found.where("n = 5").groupBy(F.input_file_name()).count()
    assert heavy.count() > 1


def test_replay_returns_the_first_receipt(spark, root, topic):
    log.publish(spark, root, topic, numbers(spark, 10, 2), producer="p", batch_id=4)
    again = log.publish(spark, root, topic, numbers(spark, 99, 2), producer="p", batch_id=4)
    assert again == (topic, "p", 4, 10, True)
    assert log.read_topic(spark, root, topic).count() == 10


def test_batch_ids_increase_per_producer(spark, root, topic):
    log.publish(spark, root, topic, numbers(spark, 1, 1), producer="p", batch_id=4)
    log.publish(spark, root, topic, numbers(spark, 1, 1), producer="q", batch_id=2)
    with pytest.raises(StaleBatch):
        log.publish(spark, root, topic, numbers(spark, 1, 1), producer="p", batch_id=3)
    assert log.heads(spark, root, topic) == {"p": 4, "q": 2}


def test_producer_names_stay_text(spark, root, topic):
    log.publish(spark, root, topic, numbers(spark, 1, 1), producer="007", batch_id=0)
    assert log.read_topic(spark, root, topic).first().tp_producer == "007"
    with pytest.raises(InvalidName):
        log.publish(spark, root, topic, numbers(spark, 1, 1), producer="a/b", batch_id=0)


def test_empty_batch_stores_nothing(spark, root, topic):
    assert log.publish(spark, root, topic, numbers(spark, 0, 1), producer="p", batch_id=0).rows == 0
    assert files_under(f"{root}/log") == []
    assert log.read_topic(spark, root, topic).count() == 0


def test_unknown_topic(spark, root):
    with pytest.raises(UnknownTopic):
        log.publish(spark, root, "x", numbers(spark, 1, 1), producer="p", batch_id=0)
    with pytest.raises(UnknownTopic):
        log.read_topic(spark, root, "x")


def test_failure_before_the_commit_leaves_the_topic_untouched(spark, root, topic, monkeypatch):
    def broken(self, source, target):
        raise OSError("lost the connection")

    with monkeypatch.context() as patch:
        patch.setattr(Store, "commit", broken)
        with pytest.raises(OSError):
            log.publish(spark, root, topic, numbers(spark, 10, 2), producer="p", batch_id=0)
    assert log.read_topic(spark, root, topic).count() == 0 and files_under(f"{root}/log") == []
    assert not log.publish(spark, root, topic, numbers(spark, 10, 2), producer="p", batch_id=0).replayed
    assert log.read_topic(spark, root, topic).count() == 10


def test_death_before_the_commit_leaves_files_nobody_reads(spark, root, topic, monkeypatch):
    with monkeypatch.context() as patch:
        patch.setattr(Store, "commit", lambda *_: (_ for _ in ()).throw(OSError("gone")))
        patch.setattr(Store, "drop", lambda *_: None)
        with pytest.raises(OSError):
            log.publish(spark, root, topic, numbers(spark, 10, 2), producer="p", batch_id=0)
    assert len(files_under(f"{root}/log")) > 0
    log.publish(spark, root, topic, numbers(spark, 7, 2), producer="p", batch_id=0)
    assert log.read_topic(spark, root, topic).count() == 7


def test_losing_the_race_for_a_batch_keeps_the_first(spark, root, topic, monkeypatch):
    """Somebody commits the same batch while this one is being written."""
    counted = log._counted

    def late(session, folder):
        monkeypatch.setattr(log, "_counted", counted)
        log.publish(spark, root, topic, numbers(spark, 10, 2), producer="p", batch_id=0)
        return counted(session, folder)

    monkeypatch.setattr(log, "_counted", late)
    receipt = log.publish(spark, root, topic, numbers(spark, 99, 2), producer="p", batch_id=0)
    assert receipt == (topic, "p", 0, 10, True)
    assert log.read_topic(spark, root, topic).count() == 10
    assert len([name for name in files_under(f"{root}/log") if name.endswith(".parquet")]) == 2


def test_other_producers_commit_in_between(spark, root, topic, monkeypatch):
    counted = log._counted

    def late(session, folder):
        monkeypatch.setattr(log, "_counted", counted)
        log.publish(spark, root, topic, numbers(spark, 10, 2), producer="q", batch_id=0)
        return counted(session, folder)

    monkeypatch.setattr(log, "_counted", late)
    log.publish(spark, root, topic, numbers(spark, 5, 2), producer="p", batch_id=0)
    found = log.receipts(log.read_topic(spark, root, topic)).collect()
    assert sorted(map(tuple, found)) == [("p", 0, 5, 4), ("q", 0, 10, 9)]


@pytest.mark.parametrize("order_by", [[], ["n"]])
def test_a_task_that_fails_half_way_is_repeated(spark, root, topic, tmp_path, order_by):
    flag = tmp_path / "failed"

    def stumble(batches):
        for batch in batches:
            yield batch
            if not flag.exists():
                flag.write_text("")
                raise OSError("worker lost")

    frame = numbers(spark, 1000, 4).mapInArrow(stumble, "n bigint")
    assert log.publish(spark, root, topic, frame, producer="p", batch_id=0, order_by=order_by).rows == 1000
    assert flag.exists()
    found = log.read_topic(spark, root, topic).orderBy("tp_offset").collect()
    assert [(row.tp_offset, row.n) for row in found] == [(n, n) for n in range(1000)]


@pytest.mark.parametrize("order_by", [[], ["n"]])
def test_failing_rows_leave_nothing(spark, root, topic, order_by):
    frame = numbers(spark, 10, 2).select(F.raise_error("bad").cast("bigint").alias("n"))
    with pytest.raises(Exception, match="bad"):
        log.publish(spark, root, topic, frame, producer="p", batch_id=0, order_by=order_by)
    assert files_under(f"{root}/log") == files_under(f"{root}/staging") == []


def test_receive_time_can_be_given(spark, root, topic):
    at = F.lit("2024-01-02 03:04:05.123456").cast("timestamp")
    log.publish(spark, root, topic, numbers(spark, 2, 1), producer="p", batch_id=0, received_at=at)
    found = log.topic_source(spark, root, topic, stream=False, includes_timestamp=True, timestamp_column="at")
    assert found.columns == ["n", "at"]
    assert {str(row["at"]) for row in found.select(F.col("at").cast("string").alias("at")).collect()} == {
        "2024-01-02 03:04:05.123456"
    }


def test_offset_range_over_batches_and_producers(spark, root, topic):
    for batch_id, (low, high) in enumerate([(0, 10), (10, 25), (25, 30)]):
        part = numbers(spark, 30, 3).where((F.col("n") >= low) & (F.col("n") < high))
        log.publish(spark, root, topic, part, producer="p", batch_id=batch_id * 10, order_by=["n"])
    log.publish(spark, root, topic, numbers(spark, 50, 3), producer="q", batch_id=0)
    found = log.offset_range(spark, root, topic, "p", end=26, start=8)
    assert sorted((row.tp_position, row.n) for row in found.collect()) == [(n, n) for n in range(9, 27)]
    assert log.offset_range(spark, root, topic, "p", end=9).count() == 10
    assert log.offset_range(spark, root, topic, "p", end=500, start=29).count() == 0
    assert log.offset_range(spark, root, topic, "nobody", end=500).count() == 0
    assert all("tp_batch_id=0" in file for file in log.offset_range(spark, root, topic, "p", end=5).inputFiles())


def test_a_narrow_range_reads_few_files(spark, root, topic):
    for batch_id in range(3):
        log.publish(spark, root, topic, numbers(spark, 400, 8), producer="p", batch_id=batch_id)
    found = log.offset_range(spark, root, topic, "p", start=399, end=420)
    assert [row.tp_position for row in found.orderBy("tp_position").collect()] == list(range(400, 421))
    assert len(found.inputFiles()) == 1
    assert len(log.offset_range(spark, root, topic, "p", start=340, end=420).inputFiles()) == 3


def test_receipts(spark, root, topic):
    log.publish(spark, root, topic, numbers(spark, 10, 3), producer="p", batch_id=0)
    log.publish(spark, root, topic, numbers(spark, 5, 1), producer="q", batch_id=3)
    found = log.receipts(log.read_topic(spark, root, topic), size=F.lit(8))
    assert sorted(map(tuple, found.collect())) == [("p", 0, 10, 9, 80), ("q", 3, 5, 4, 40)]


def test_only_wanted_columns_are_read(spark, root):
    catalog.create_topic(spark, root, "t", "a bigint, b string")
    frame = spark.range(10).select(F.col("id").alias("a"), F.lit("x").alias("b"))
    log.publish(spark, root, "t", frame, producer="p", batch_id=0)
    plan = log.topic_source(spark, root, "t", stream=False).where("a > 3").select("a")
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<a:bigint>" in text and "GreaterThan(a,3)" in text


def test_views(spark, root, topic):
    log.publish(spark, root, topic, numbers(spark, 3, 1), producer="p", batch_id=1)
    stored = log.read_topic(spark, root, topic)
    assert views.original(stored).columns == ["n"]
    assert [tuple(row) for row in views.with_id(stored).orderBy("n").collect()] == [(0, "1-0"), (1, "1-1"), (2, "1-2")]
    assert views.with_timestamp(stored).schema.simpleString() == "struct<n:bigint,_TIMESTAMP_:timestamp>"
    extra = views.extra(stored).first()[0]
    assert (extra.tp_batch_id, extra.tp_offset) == (1, 0) and extra.tp_ts is not None
    with pytest.raises(InvalidName):
        views.with_id(stored, "N")


def test_columns_with_dots_and_spaces(spark, root):
    frame = spark.createDataFrame([(1, "x")], "`a.b` int, `c d` string")
    catalog.create_topic(spark, root, "t", frame.schema)
    log.publish(spark, root, "t", frame, producer="p", batch_id=0)
    assert log.topic_source(spark, root, "t", stream=False).collect() == frame.collect()
    assert views.with_id(log.read_topic(spark, root, "t")).columns == ["a.b", "c d", "id"]


def test_publishing_does_not_list_earlier_batches(spark, root, topic, monkeypatch):
    for batch_id in range(3):
        log.publish(spark, root, topic, numbers(spark, 4, 1), producer="p", batch_id=batch_id)
    listed = []
    original = Store.names
    monkeypatch.setattr(Store, "names", lambda self, path: listed.append(path) or original(self, path))
    log.publish(spark, root, topic, numbers(spark, 4, 1), producer="p", batch_id=3)
    log.offset_range(spark, root, topic, "p", end=3)
    assert listed == [] and log.heads(spark, root, topic) == {"p": 3}


def test_a_damaged_hint_is_made_up_for(spark, root, topic):
    store = Store(spark, root)
    for batch_id in (1, 2):
        log.publish(spark, root, topic, numbers(spark, 4, 1), producer="p", batch_id=batch_id)
    store.write_text(log.manifest(spark, root, topic).hint_path, '{"new')
    with pytest.raises(StaleBatch):
        log.publish(spark, root, topic, numbers(spark, 4, 1), producer="p", batch_id=0)
    assert log.heads(spark, root, topic) == {"p": 2}
