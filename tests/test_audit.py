"""The audit operators against a hub played step by step."""

import random

import pytest
from pyspark.sql import functions as F

from topicflow.operators import audit
from topicflow.operators.asof import first_after, largest_before, ranked

SCHEMA = "seq bigint, action string, topic string, subscriber_id string, batch_id bigint, has_rows boolean"


def play(actions, topics):
    """What a hub answers and delivers, one request after the other."""
    status, opened, waiting, intervals = {}, {}, {}, {}
    deliveries, fetched, tried = set(), {}, 0
    for seq, action, topic, subscriber, batch, has_rows in actions:
        known = topic in topics
        if action is None:
            answer = "missing action"
        elif action == audit.SEND:
            answer = (
                "missing topic" if topic is None
                else "missing batchId" if batch is None
                else "missing rows" if not has_rows
                else "ok" if known else "unknown topic"
            )
            if answer == "ok":
                for who, what in opened.items():
                    if what == topic:
                        waiting[who].append(seq)
                        deliveries.add((seq, topic, who))
        elif action == audit.SUBSCRIBE:
            tried += 1
            answer = "missing topic" if topic is None else "ok" if known else "unknown topic"
            if answer == "ok":
                who = f"subscriber-{tried}"
                opened[who], waiting[who], intervals[who] = topic, [], (topic, seq, None)
        elif action == audit.FETCH_SCHEMA:
            answer = "missing topic" if topic is None else "ok" if known else "unknown topic"
        elif action in (audit.FETCH, audit.UNSUBSCRIBE):
            answer = (
                "missing subscriberId" if subscriber is None
                else "ok" if subscriber in opened else "invalid subscriber"
            )
            if answer == "ok" and action == audit.FETCH:
                for sent in waiting[subscriber]:
                    fetched[sent, subscriber] = seq
                waiting[subscriber] = []
            elif answer == "ok":
                intervals[subscriber] = (*intervals[subscriber][:2], seq)
                del opened[subscriber], waiting[subscriber]
        else:
            answer = "unsupported action"
        status[seq] = answer
    return status, intervals, deliveries, fetched


def random_actions(seed, count):
    chance = random.Random(seed)
    kinds = [audit.SEND, audit.FETCH, audit.SUBSCRIBE, audit.UNSUBSCRIBE, audit.FETCH_SCHEMA, "actionOther", None]
    seq, out = -50, []
    for _ in range(count):
        seq += chance.choice([1, 1, 1, 2, 40])
        out.append(
            (
                seq,
                chance.choices(kinds, [40, 15, 6, 5, 2, 1, 1])[0],
                chance.choices(["a", "b", "c", None], [70, 10, 5, 3])[0],  # c does not exist
                chance.choices([f"subscriber-{chance.randrange(1, 15)}", "subscriber-1", None], [60, 30, 5])[0],
                chance.choice([seq] * 20 + [None]),
                chance.choice([True] * 20 + [False, None]),
            )
        )
    return out


@pytest.mark.parametrize("seed, width, fan_width", [(1, 10**6, 10**4), (2, 64, 16), (3, 500, 1)])
def test_against_a_hub(spark, tmp_path, seed, width, fan_width):
    actions = random_actions(seed, 600)
    status, intervals, deliveries, fetched = play(actions, {"a", "b"})
    frame = spark.createDataFrame(random.Random(seed).sample(actions, len(actions)), SCHEMA)
    topics = spark.createDataFrame([("a",), ("b",), ("b",)], "topic string")
    found = audit.Audit(frame, topics, str(tmp_path), width, fan_width)

    assert {r.seq: r.status for r in found.requests.collect()} == status
    assert {r.subscriber_id: (r.topic, r.start_seq, r.end_seq) for r in found.intervals.collect()} == intervals
    assert sorted(map(tuple, found.deliveries.select("seq", "topic", "subscriber_id").collect())) == sorted(deliveries)
    assigned = found.assigned.collect()
    assert len(assigned) == len(deliveries)
    assert {(r.seq, r.subscriber_id): r.fetch_seq for r in assigned if r.fetch_seq is not None} == fetched
    lost = {(r.seq, r.subscriber_id) for r in found.lost_copies.collect()}
    assert lost == {(seq, who) for seq, _, who in deliveries} - set(fetched)
    sends = {row[0] for row in actions if row[1] == audit.SEND and status[row[0]] == "ok"}
    assert {r.seq for r in found.undelivered.collect()} == sends - {seq for seq, _ in fetched}


@pytest.mark.parametrize("width, crowd", [(4, 3), (1, 100), (256, 2)])
def test_spans_meet_messages(spark, monkeypatch, width, crowd):
    """Many topics, sparse numbers, equal numbers, spans open at both sides, crowded stretches."""
    monkeypatch.setattr(audit, "CROWD", crowd)
    chance = random.Random(width)
    sends = [(chance.randrange(0, 400) * 10**12, chance.choice("abcdefgh")) for _ in range(300)] + [(None, "a"), (5, None)]
    spans = []
    for n in range(150):
        start = chance.randrange(-20, 420) * 10**12
        end = chance.choice([None, start, start + 1, start + chance.randrange(1, 300) * 10**12])
        spans.append((chance.choice("abcdxy"), start, end, n))
    spans += [("a", None, 3, 900), (None, 1, 3, 901), ("a", 10**12, None, 902), ("a", 10**12, None, 902)]
    found = audit.spans_joined(
        spark.createDataFrame(sends, "seq bigint, topic string"),
        spark.createDataFrame(spans, "topic string, start_seq bigint, end_seq bigint, name int"),
        width,
    )
    assert found.columns == ["seq", "topic", "start_seq", "end_seq", "name"]
    wanted = [
        (seq, topic, start, end, name) for seq, topic in sends for on, start, end, name in spans
        if topic is not None and topic == on and None not in (seq, start) and start < seq and (end is None or seq < end)
    ]
    assert sorted(map(repr, map(tuple, found.collect()))) == sorted(map(repr, wanted))


def test_spans_are_not_repeated_where_nothing_is_sent(spark, monkeypatch):
    """Ten thousand topics, one busy: the rows that are joined follow the result."""
    sizes, plain = {}, audit.stored

    def measured(frame, folder):
        kept = plain(frame, folder)
        sizes[folder.rsplit("/", 1)[1].split("-")[0]] = kept.count()
        return kept

    monkeypatch.setattr(audit, "stored", measured)
    sends = spark.range(20_000).selectExpr("id * 1000 as seq", "if(id % 2 = 0, 'busy', concat('t', id)) as topic")
    spans = spark.range(5000).selectExpr("concat('t', 2 * id + 1) as topic", "0L as start_seq", "cast(null as bigint) as end_seq")
    spans = spans.union(spark.sql("select 'busy', 10L, 5000000L")).union(spark.sql("select 'idle', 10L, cast(null as bigint)"))
    result = audit.spans_joined(sends, spans).count()
    assert result == 5000 + 2499
    assert sizes["touched"] <= 2 * 5002 + result / audit.FAN_OUT_WIDTH


@pytest.mark.parametrize("threshold", ["-1", "10485760"])
def test_same_with_and_without_broadcast(spark, tmp_path, threshold):
    actions = random_actions(4, 300)
    _, _, deliveries, fetched = play(actions, {"a", "b"})
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    try:
        topics = spark.createDataFrame([("a",), ("b",)], "topic string")
        found = audit.Audit(spark.createDataFrame(actions, SCHEMA), topics, str(tmp_path), 128, 32)
        assert found.deliveries.count() == len(deliveries)
        assert found.assigned.where("fetch_seq is not null").count() == len(fetched)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_other_hubs(spark):
    rows = [
        (1, audit.SEND, "anything", None, 1, True),
        (2, audit.SEND, "anything", None, None, True),
        (3, audit.SUBSCRIBE, "anything", None, None, None),
        (4, None, None, None, None, None),
    ]
    frame = spark.createDataFrame(rows, SCHEMA)
    answers = lambda mode: {r.seq: r.status for r in audit.classify_requests(frame, mode=mode).collect()}
    assert answers("kafka") == {1: "ok", 2: "missing batchId", 3: "unsupported action", 4: "missing action"}
    assert answers("null") == {**dict.fromkeys((1, 2, 3), "unsupported action"), 4: "missing action"}


def test_nothing_happened(spark, tmp_path):
    topics = spark.createDataFrame([("a",)], "topic string")
    found = audit.Audit(spark.createDataFrame([], SCHEMA), topics, str(tmp_path))
    steps = ("intervals", "requests", "sends", "fetches", "deliveries", "assigned", "undelivered", "lost_copies")
    assert [getattr(found, step).count() for step in steps] == [0] * 8


def test_topic_filter(spark):
    frame = spark.createDataFrame([("a", 1), ("b", 2), (None, 3)], "topic string, n int")
    assert [row.n for row in audit.for_topic(frame, "b").collect()] == [2]


@pytest.mark.parametrize("width", [1, 3, 7])
def test_rank(spark, width):
    values = random.Random(width).sample(range(-500, 500), 200)
    frame = spark.createDataFrame([(value, f"x{value}") for value in values], "seq bigint, x string")
    found = {row.seq: row.tp_rank for row in ranked(frame.repartition(width), "seq").collect()}
    assert found == {value: rank for rank, value in enumerate(sorted(values), 1)}


@pytest.mark.parametrize("width", [1, 9, 10**6])
def test_first_after(spark, width):
    chance = random.Random(width)
    left = [(chance.choice("aab"), seq, f"l{seq}") for seq in chance.sample(range(-100, 300), 150)]
    right = [(chance.choice("aabc"), seq) for seq in chance.sample(range(-100, 300), 60)]  # some at the same number
    wanted = {
        (key, seq): min((at for other, at in right if other == key and at > seq), default=None) for key, seq, _ in left
    }
    found = first_after(
        spark.createDataFrame(left, "k string, seq bigint, x string"),
        spark.createDataFrame(right, "k string, seq bigint"),
        key="k",
        seq="seq",
        out="next",
        width=width,
    )
    assert {(row.k, row.seq): row.next for row in found.collect()} == wanted
    assert found.where(F.col("x") != F.concat(F.lit("l"), F.col("seq"))).count() == 0


def test_first_after_keeps_every_left_row(spark):
    left = spark.createDataFrame([(1, None), (2, "a"), (None, "a"), (3, "a")], "seq bigint, k string")
    right = spark.createDataFrame([(3, "a"), (9, None), (None, "a")], "seq bigint, k string")
    for width in (1, 100):
        found = first_after(left, right, key="k", seq="seq", out="next", width=width).collect()
        assert sorted(map(tuple, found), key=str) == sorted(
            [(1, None, None), (2, "a", 3), (None, "a", None), (3, "a", None)], key=str
        )


@pytest.mark.parametrize("width", [1, 5, 10**6])
def test_largest_before(spark, width):
    chance = random.Random(width)
    left = [(chance.choice("ab"), seq) for seq in chance.sample(range(200), 80)]
    right = [(chance.choice("abc"), chance.randrange(200), chance.randrange(1000)) for _ in range(60)]
    found = largest_before(
        spark.createDataFrame(left, "k string, seq bigint"),
        spark.createDataFrame(right, "k string, seq bigint, v bigint"),
        key="k",
        seq="seq",
        value="v",
        width=width,
    )
    wanted = {(k, s): max((v for other, at, v in right if other == k and at < s), default=None) for k, s in left}
    assert {(row.k, row.seq): row.v for row in found.collect()} == wanted


def test_numbers_in_nanoseconds(spark, tmp_path):
    """A day of nanoseconds between neighbours: nothing may depend on the distance of numbers."""
    step = 86_400 * 10**9 // 50
    actions = [(seq * step, *rest) for seq, *rest in random_actions(7, 200)]
    _, intervals, deliveries, fetched = play(actions, {"a", "b"})
    topics = spark.createDataFrame([("a",), ("b",)], "topic string")
    found = audit.Audit(spark.createDataFrame(actions, SCHEMA), topics, str(tmp_path), 50, 20)
    assert {r.subscriber_id: (r.topic, r.start_seq, r.end_seq) for r in found.intervals.collect()} == intervals
    assigned = found.assigned.collect()
    assert {(r.seq, r.topic, r.subscriber_id) for r in assigned} == deliveries
    assert {(r.seq, r.subscriber_id): r.fetch_seq for r in assigned if r.fetch_seq is not None} == fetched


def test_a_finished_audit_leaves_nothing_behind(spark, tmp_path):
    folder = tmp_path / "audit"
    topics = spark.createDataFrame([("a",), ("b",)], "topic string")
    with audit.Audit(spark.createDataFrame(random_actions(8, 50), SCHEMA), topics, str(folder)) as found:
        found.assigned.count()
        assert folder.exists()
    assert not folder.exists()
