import json
import os

from urllib.error import HTTPError

import pytest
from pyspark.sql import functions as F

from topicflow import TopicSpace
from topicflow.errors import PushFailed
from topicflow.functions.codec import accepted, rejected
from topicflow.operators import push as pushing
from topicflow.operators.dedup import drop_redelivered
from topicflow.sources.packets import LISTING, ingest, ingested, read_packets

ONCE = {"availableNow": True}
SCHEMA = "n bigint, s string, t timestamp_ntz, a array<double>"


@pytest.fixture
def space(spark, root):
    space = TopicSpace(spark, root).create_topic("t", SCHEMA)
    frame = spark.range(0, 500, 1, 4).select(
        F.col("id").alias("n"),
        F.when(F.col("id") % 7 > 0, F.concat(F.lit("line\n ü "), F.col("id"))).alias("s"),
        F.expr("timestamp_ntz'2024-01-01 00:00:00.000001' + make_interval(0, 0, 0, 0, 0, 0, id)").alias("t"),
        F.array(F.col("id") / 3, F.lit(float("nan"))).alias("a"),
    )
    space.publish("t", frame, producer="p", batch_id=5)
    return space


def run(stream, name, tmp_path):
    query = stream.writeStream.format("memory").queryName(name).trigger(**ONCE)
    query.option("checkpointLocation", str(tmp_path / f"cp-{name}")).start().awaitTermination()
    return stream.sparkSession.table(name)


def texts(frame):
    return sorted(map(repr, frame.collect()))


def packet_files(folder):
    return sorted(name for name in os.listdir(folder) if name.endswith(".jsonl"))


def test_push_and_ingest(spark, space, tmp_path):
    landing = str(tmp_path / "landing")
    receipts = space.push("t", space.rows("t"), f"file://{landing}", limit=2000, shard_rows=100)
    assert {row.packet_id.split("/")[1] for row in receipts.collect()} == set(packet_files(f"{landing}/t"))
    assert receipts.agg(F.sum("rows"), F.max("attempts")).first()[:] == (500, 1)
    for receipt in receipts.collect():
        body = open(f"{landing}/{receipt.packet_id}", "rb").read()
        lines = body.decode().splitlines()
        offsets = [json.loads(line)["o"] for line in lines]
        assert (len(body), len(lines)) == (receipt.bytes, receipt.rows)
        assert offsets == list(range(offsets[0], offsets[0] + len(lines)))
        assert {offset // 100 for offset in offsets} == {receipt.tp_shard}
        assert len(body) - len(lines[-1].encode()) - 1 < 2000
        assert receipt.packet_id == f"t/p-5-{receipt.tp_shard}-{receipt.tp_packet}-{offsets[0]}.jsonl"
        if (receipt.tp_shard, receipt.tp_packet + 1) in {(r.tp_shard, r.tp_packet) for r in receipts.collect()}:
            assert len(body) >= 2000
    got = run(accepted(read_packets(spark, landing, "t", SCHEMA)), "ingested", tmp_path)
    assert texts(got) == texts(space.rows("t").select(*got.columns))


def test_packets_do_not_depend_on_partitions(space, tmp_path):
    names = []
    for parts in (1, 9):
        landing = str(tmp_path / f"landing{parts}")
        rows = space.rows("t").repartition(parts)
        space.push("t", rows, f"file://{landing}", limit=3000, shard_rows=120)
        names.append({name: open(f"{landing}/t/{name}").read() for name in packet_files(f"{landing}/t")})
    assert names[0] == names[1]


@pytest.mark.parametrize("large", ["true", "false"])
def test_packets_do_not_depend_on_arrow_batches(spark, space, tmp_path, large):
    bodies = []
    for number, size in enumerate(("37", "10000")):
        landing = str(tmp_path / f"landing{number}")
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", size)
        spark.conf.set("spark.sql.execution.arrow.useLargeVarTypes", large)
        try:
            receipts = space.push("t", space.rows("t"), f"file://{landing}", limit=3000, shard_rows=120)
            assert receipts.agg(F.sum("rows")).first()[0] == 500
        finally:
            spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
            spark.conf.unset("spark.sql.execution.arrow.useLargeVarTypes")
        bodies.append({name: open(f"{landing}/t/{name}").read() for name in packet_files(f"{landing}/t")})
    assert bodies[0] == bodies[1]


def test_a_second_push_changes_nothing(spark, space, tmp_path):
    landing = str(tmp_path / "landing")
    for _ in range(2):
        space.push("t", space.rows("t"), f"file://{landing}", limit=2000, shard_rows=100)
    assert accepted(read_packets(spark, landing, "t", SCHEMA, stream=False)).count() == 500


def test_redelivered_rows_are_dropped(spark, space, tmp_path):
    landing = str(tmp_path / "landing")
    for link in ("one", "two"):
        space.push("t", space.rows("t"), f"file://{landing}/t/{link}", limit=2000, shard_rows=100)
    options = {"recursiveFileLookup": "true", "maxFilesPerTrigger": 4}
    arrived = accepted(read_packets(spark, landing, "t", SCHEMA, **options))
    once = run(drop_redelivered(arrived), "once", tmp_path)
    assert texts(once) == texts(space.rows("t").select(*once.columns))
    table = accepted(read_packets(spark, landing, "t", SCHEMA, stream=False, recursiveFileLookup="true"))
    assert table.count() == 1000 and drop_redelivered(table).count() == 500


def test_late_and_old_packets_are_stored_once(spark, space, tmp_path):
    """Rows sent long ago come after newer ones, in files with old times, and again later: none is lost or doubled."""
    landing, folder = tmp_path / "landing", str(tmp_path / "in")
    sent = space.rows("t").withColumn("tp_ts", F.expr("timestamp'2024-01-01' + make_dt_interval(0, 0, 0, tp_offset)"))

    def take(rows, link):
        space.push("t", rows, f"file://{landing}/t/{link}", limit=2000, shard_rows=100)
        for file in (landing / "t" / link).rglob("*.jsonl"):
            os.utime(file, (1e9, 1e9) if link == "old" else None)
        options = dict(checkpoint=str(tmp_path / "cp"), trigger=ONCE, recursiveFileLookup="true")
        ingest(spark, str(landing), "t", SCHEMA, folder, **options).awaitTermination()
        return ingested(spark, folder, SCHEMA)

    assert ingested(spark, folder, SCHEMA).count() == 0
    assert take(sent.where("tp_offset >= 400"), "new").count() == 100
    assert take(sent.where("tp_offset < 450"), "old").count() == 500
    found = take(sent, "all")
    assert texts(found) == texts(sent.select(*found.columns))


def test_many_packets_are_looked_up_in_few_tasks(spark, space, tmp_path):
    """What tasks report to the driver must not grow with a task for each packet."""
    landing, tracker = tmp_path / "landing", spark.sparkContext.statusTracker()
    space.push("t", space.rows("t"), f"file://{landing}/t", limit=1)
    options = dict(checkpoint=str(tmp_path / "cp"), trigger=ONCE, recursiveFileLookup="true")
    spark.conf.unset(LISTING)
    query = ingest(spark, str(landing), "t", SCHEMA, str(tmp_path / "in"), **options)
    query.awaitTermination()
    jobs = [tracker.getJobInfo(job) for job in tracker.getJobIdsForGroup(str(query.runId))]
    stages = [tracker.getStageInfo(stage) for job in jobs for stage in job.stageIds]
    assert 0 < max(stage.numTasks for stage in stages if stage) <= 64
    assert ingested(spark, str(tmp_path / "in"), SCHEMA).count() == 500
    spark.conf.set(LISTING, "7")
    read_packets(spark, str(landing), "t", SCHEMA)
    assert spark.conf.get(LISTING) == "7"
    spark.conf.unset(LISTING)


def test_damaged_lines_are_set_aside(spark, space, tmp_path):
    landing = tmp_path / "landing"
    space.push("t", space.rows("t"), f"file://{landing}")
    bad = ["{", "[]", "{}", '{"p":"p","b":1,"o":"x"}', '{"p":"p","b":1,"o":2,"t":null}']
    (landing / "t" / "damaged.jsonl").write_text("\n".join(bad))
    rows = read_packets(spark, str(landing), "t", SCHEMA, stream=False)
    assert accepted(rows).count() == 500
    assert sorted(r.line for r in rejected(rows).collect()) == sorted(bad)


def test_ingested_rows_can_be_published_onward(spark, space, tmp_path):
    landing = str(tmp_path / "landing")
    space.push("t", space.rows("t"), f"file://{landing}")
    other = TopicSpace(spark, str(tmp_path / "other")).create_topic("t", SCHEMA)
    arrived = drop_redelivered(accepted(read_packets(spark, landing, "t", SCHEMA))).select("n", "s", "t", "a")
    other.publish_stream("t", arrived, producer="link", checkpoint=str(tmp_path / "cp"), trigger=ONCE).awaitTermination()
    assert texts(other.source("t", stream=False)) == texts(space.source("t", stream=False))


def test_push_stream(spark, space, tmp_path):
    landing = str(tmp_path / "landing")
    for batch_id in (6, 7):
        space.publish("t", space.source("t", stream=False).where(f"n < {batch_id}"), producer="p", batch_id=batch_id)
    pushing.push_stream(
        space.rows_stream("t", maxFilesPerTrigger=1),  # cuts batches apart
        "t",
        f"file://{landing}",
        checkpoint=str(tmp_path / "cp"),
        trigger=ONCE,
        limit=2000,
    ).awaitTermination()
    got = accepted(read_packets(spark, landing, "t", SCHEMA, stream=False))
    assert texts(got) == texts(space.rows("t").select(*got.columns))


class Flaky:
    """Fails the first ``failures`` times."""

    def __init__(self, failures):
        self.failures, self.calls = failures, 0

    def __call__(self, packet_id, body):
        self.calls += 1
        if self.calls <= self.failures:
            raise OSError("down")


@pytest.mark.parametrize("failures", range(5))
def test_retry(failures, monkeypatch):
    pauses = []
    monkeypatch.setattr(pushing.time, "sleep", pauses.append)
    assert pushing.with_retry(Flaky(failures), "id", b"") == failures + 1
    assert pauses == pytest.approx([0.1, 0.2, 0.3, 0.4][:failures])


def test_giving_up(monkeypatch):
    monkeypatch.setattr(pushing.time, "sleep", lambda _: None)
    flaky = Flaky(99)
    with pytest.raises(PushFailed, match="down"):
        pushing.with_retry(flaky, "id", b"")
    assert flaky.calls == 5


def test_only_passing_errors_are_tried_again(monkeypatch):
    monkeypatch.setattr(pushing.time, "sleep", lambda _: None)

    def failing(error):
        calls = []

        def deliver(packet_id, body):
            calls.append(packet_id)
            raise error

        with pytest.raises((PushFailed, type(error))):
            pushing.with_retry(deliver, "id", b"")
        return len(calls)

    answer = lambda code: HTTPError("http://example.org", code, "no", {}, None)
    assert failing(answer(400)) == failing(answer(404)) == failing(TypeError("mistake")) == 1
    assert failing(answer(503)) == failing(answer(429)) == failing(TimeoutError()) == 5


def test_attempts_are_reported_per_packet(space):
    seen = {}

    def deliver(packet_id, body):  # each packet fails once in its worker
        seen[packet_id] = seen.get(packet_id, 0) + 1
        if seen[packet_id] == 1:
            raise OSError("down")

    receipts = pushing.push(space.rows("t"), "t", deliver=deliver, limit=5000, shard_rows=100, pause=0.001)
    assert {row.attempts for row in receipts.collect()} == {2}


def test_every_packet_is_sent_once(space, tmp_path):
    sent = tmp_path / "sent"

    def deliver(packet_id, body):
        with open(sent, "a") as out:
            out.write(packet_id + "\n")

    receipts = pushing.push(space.rows("t"), "t", deliver=deliver, limit=2000, shard_rows=100)
    receipts.count()
    assert sorted(sent.read_text().split()) == sorted(row.packet_id for row in receipts.collect())


def test_failed_push_fails_the_job(space):
    def deliver(packet_id, body):
        raise OSError("down")

    with pytest.raises(Exception, match="5 attempts failed"):
        pushing.push(space.rows("t"), "t", deliver=deliver, pause=0.001)


def test_a_repeated_task_sends_the_same_packets(spark, space, tmp_path):
    """A task gives up in the middle; its second run writes the packets again, under the same names."""
    landing, flag = str(tmp_path / "landing"), tmp_path / "down"
    write = pushing.file_delivery(f"file://{landing}")

    def deliver(packet_id, body):
        if packet_id.startswith("t/p-5-0-2-") and (not flag.exists() or flag.read_text() != "....."):
            flag.write_text((flag.read_text() if flag.exists() else "") + ".")
            raise OSError("down")
        write(packet_id, body)

    receipts = pushing.push(space.rows("t"), "t", deliver=deliver, limit=2000, shard_rows=250, pause=0.001)
    assert flag.read_text() == "....."
    assert receipts.count() == len(packet_files(f"{landing}/t"))
    assert accepted(read_packets(spark, landing, "t", SCHEMA, stream=False)).count() == 500


class Answer:
    def __init__(self, status):
        self.status = status

    def __enter__(self):
        return self

    def __exit__(self, *_):
        return None


def test_http_delivery():
    requests = []

    def opener(request, timeout):
        assert timeout == pushing.TIMEOUT
        requests.append(request)
        return Answer(200 if len(requests) > 1 else 503)

    deliver = pushing.http_delivery("http://example.org/in", opener)
    with pytest.raises(OSError, match="503"):
        deliver("t/p-0-0-0-0.jsonl", b"{}\n")
    deliver("t/p-0-0-0-0.jsonl", b"{}\n")
    assert requests[1].data == b"{}\n" and requests[1].get_method() == "POST"
    assert requests[1].get_header("X-packet-id") == "t/p-0-0-0-0.jsonl"
