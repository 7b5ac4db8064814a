"""Incremental results against a hub played step by step, for several cuts into micro-batches."""

import random

import pytest
from test_audit import SCHEMA, play, random_actions

from topicflow.operators import audit
from topicflow.storage import Store
from topicflow.streaming.audit_stream import AuditStream, audit_stream


def checked(found, actions):
    status, intervals, deliveries, fetched = play(actions, {"a", "b"})
    assert {r.seq: r.status for r in found.requests.collect()} == status
    assert {r.subscriber_id: (r.topic, r.start_seq, r.end_seq) for r in found.intervals.collect()} == intervals
    assigned = [(r.seq, r.topic, r.subscriber_id, r.fetch_seq) for r in found.assigned.collect()]
    assert sorted(assigned, key=str) == sorted(((s, t, w, fetched.get((s, w))) for s, t, w in deliveries), key=str)
    sends = {row[0] for row in actions if row[1] == audit.SEND and status[row[0]] == "ok"}
    assert sorted(r.seq for r in found.undelivered.collect()) == sorted(sends - {seq for seq, _ in fetched})


@pytest.mark.parametrize("seed, cuts", [(1, [0, 250]), (2, [40, 41, 150])])
def test_any_cut_into_micro_batches(spark, tmp_path, seed, cuts):
    actions = random_actions(seed, 260)
    topics = spark.createDataFrame([("a",), ("b",), ("b",)], "topic string")
    borders = [0, *cuts, len(actions)]
    for k, (begin, end) in enumerate(zip(borders, borders[1:], strict=False)):
        part = random.Random(k).sample(actions[begin:end], end - begin)
        found = AuditStream(spark, str(tmp_path / "audit"), topics, width=64)
        found.take(spark.createDataFrame(part, SCHEMA))
    checked(found, actions)
    state = found._table("pending", "seq bigint").count()
    assert state < len(actions) / 2


def test_a_failed_micro_batch_is_repeated(spark, tmp_path, monkeypatch):
    actions = random_actions(7, 160)
    topics = spark.createDataFrame([("a",), ("b",)], "topic string")
    inbox = str(tmp_path / "inbox")
    run = dict(checkpoint=str(tmp_path / "cp"), trigger={"availableNow": True}, width=64)
    for k, (begin, end) in enumerate([(0, 90), (90, 160)]):
        spark.createDataFrame(actions[begin:end], SCHEMA).coalesce(1).write.mode("append").parquet(inbox)
        stream = spark.readStream.schema(SCHEMA).parquet(inbox)
        if k == 1:
            with monkeypatch.context() as patch:
                patch.setattr(Store, "replace_text", lambda *_: (_ for _ in ()).throw(OSError("gone")))
                with pytest.raises(Exception, match="gone"):
                    audit_stream(stream, topics, str(tmp_path / "audit"), **run).awaitTermination()
            assert AuditStream(spark, str(tmp_path / "audit"), topics).number == 0
        audit_stream(stream, topics, str(tmp_path / "audit"), **run).awaitTermination()
    found = AuditStream(spark, str(tmp_path / "audit"), topics)
    checked(found, actions)
    found.take(spark.createDataFrame(actions[:5], SCHEMA), query_batch=1)  # complete already
    assert found.number == 1


def test_nothing_taken_yet(spark, tmp_path):
    found = AuditStream(spark, str(tmp_path / "audit"), spark.createDataFrame([("a",)], "topic string"))
    assert [frame.count() for frame in (found.requests, found.intervals, found.assigned, found.undelivered)] == [0] * 4
