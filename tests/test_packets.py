import random

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from topicflow.operators import packets
from topicflow.operators.packets import Cutter, _Described, _describer, _exits, packetize


def naive(sizes, limit):
    """Packet and place of each row, one by one."""
    out, packet, place, filled = [], 0, 0, 0
    for size in sizes:
        out.append((packet, place))
        filled, place = filled + size, place + 1
        if filled >= limit:
            packet, place, filled = packet + 1, 0, 0
    return out


@settings(max_examples=300, deadline=None)
@given(st.lists(st.integers(0, 12)), st.integers(1, 30), st.lists(st.integers(0, 40), max_size=4))
def test_cutting_in_pieces(sizes, limit, cuts):
    cutter, out = Cutter(limit), []
    borders = [0, *sorted(min(cut, len(sizes)) for cut in cuts), len(sizes)]
    for begin, end in zip(borders, borders[1:]):
        packets, places = cutter.number(np.array(sizes[begin:end], np.int64))
        out += zip(packets.tolist(), places.tolist())
    assert out == naive(sizes, limit)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.integers(0, 12), min_size=1), st.integers(1, 30), st.integers(0, 29), st.integers(0, 5))
def test_exits_foresee_every_entry(sizes, limit, filled, rows):
    filled = min(filled, limit - 1)
    cutter = Cutter(limit, 7, filled, rows)
    cutter.number(np.array(sizes, np.int64))
    table = _exits(np.array(sizes, np.int64), limit)
    at = int(np.searchsorted(table["need"], limit - filled))
    if at < len(table["need"]):
        left = (7 + table["packets"][at], table["filled"][at], table["rows"][at])
    else:
        left = (7, filled + sum(sizes), rows + len(sizes))
    assert left == (cutter.packet, cutter.filled, cutter.rows)


@settings(max_examples=300, deadline=None)
@given(
    st.lists(st.lists(st.tuples(st.sampled_from("aab"), st.integers(0, 12)), min_size=1, max_size=12), min_size=1, max_size=5),
    st.integers(1, 30),
    st.integers(0, 29),
)
def test_described_together_like_one_after_the_other(blocks, limit, filled):
    """Blocks in order of their keys: entering them together leaves the same state as entering each in turn."""
    rows = sorted((key, at, size) for at, (key, size) in enumerate(row for block in blocks for row in block))
    cuts = np.cumsum([len(block) for block in blocks])[:-1]
    described = []
    for number, part in enumerate(np.split(np.array(rows, dtype=object), cuts)):
        batch = pa.RecordBatch.from_arrays(
            [pa.array([r[0] for r in part]), pa.array([number] * len(part), pa.int32()), pa.array([r[2] for r in part], pa.int64())],
            ["tp_key", "tp_block", "tp_size"],
        )
        described.append(_Described(pa.Table.from_batches(list(_describer(limit)(iter([batch]))))))
    state = (3, min(filled, limit - 1), 2)
    wanted, last = state, described[0].first_key
    for block in described:
        wanted = block.leave(wanted if block.first_key == last else (0, 0, 0), limit)
        last = block.last_key
    whole = described[0]
    for block in described[1:]:
        whole.followed_by(block, limit)
    again = _Described(whole.lines(0))  # through the lines it is sent as
    assert whole.leave(state, limit) == again.leave(state, limit) == wanted and whole.last_key == last


@pytest.mark.parametrize("group, broadcast", [(2, 10**6), (2, 0), (64, 10**6)])
@pytest.mark.parametrize("seed", range(2))
@pytest.mark.parametrize("constant", [False, True])
def test_agrees_with_counting_by_hand(spark, monkeypatch, seed, constant, group, broadcast):
    """One shard holds most rows; every size class of packets is tried."""
    monkeypatch.setattr(packets, "GROUP_BLOCKS", group)
    monkeypatch.setattr(packets, "BROADCAST_BLOCKS", broadcast)
    if group == 2:  # several levels
        monkeypatch.setattr(packets.DataFrame, "repartitionByRange", lambda self, *by, f=packets.DataFrame.repartitionByRange: f(self, 7, *by))
    chance = random.Random(seed)
    data = [
        (None if shard == 9 else f"s{shard}", at, 7 if constant else chance.randrange(0, 40))
        for at, shard in enumerate(chance.choices(range(10), [90, 1, 1, 1, 1, 1, 1, 1, 1, 2], k=4000))
    ]
    frame = spark.createDataFrame(data, "shard string, at bigint, size int").repartition(5)
    for limit in (1, 50, 1000, 10**9):
        wanted = {}
        for shard in {row[0] for row in data}:
            rows = [row for row in data if row[0] == shard]
            for row, place in zip(rows, naive([row[2] for row in rows], limit)):
                wanted[row] = place
        found = packetize(frame, shard=["shard"], order=["at"], size=F.col("size"), limit=limit)
        assert {(r.shard, r.at, r["size"]): (r.tp_packet, r.tp_packet_offset) for r in found.collect()} == wanted


def test_arrow_batches_do_not_matter(spark):
    chance = random.Random(5)
    data = [(chance.choice([0, 0, 0, 1, 2]), at, chance.randrange(1, 30)) for at in range(1500)]
    frame = spark.createDataFrame(data, "shard int, at bigint, size int")
    found = []
    for size in ("17", "10000"):
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", size)
        spark.conf.set("spark.sql.execution.arrow.useLargeVarTypes", str(size == "17").lower())
        try:
            packets = packetize(
                frame, shard=["shard"], order=["at"], size=F.col("size"), limit=99
            )
            found.append(sorted(map(tuple, packets.collect())))
        finally:
            spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
            spark.conf.unset("spark.sql.execution.arrow.useLargeVarTypes")
    assert found[0] == found[1] and len(found[0]) == 1500


def test_large_shards_are_spread(spark):
    frame = spark.range(0, 100_000, 1, 4).select(F.lit(1).alias("shard"), "id")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        found = packetize(frame, shard=["shard"], order=["id"], size=F.lit(10), limit=95)
        parts = found.withColumn("part", F.spark_partition_id()).groupBy("part").count().collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert len(parts) == 4 and max(row["count"] for row in parts) < 40_000
    assert found.where("tp_packet <> id div 10 or tp_packet_offset <> id % 10").count() == 0


def test_default_size_is_the_json_line(spark):
    frame = spark.createDataFrame([("a", 1), ("ü", None)], "s string, n int")
    found = packetize(frame, shard=["s"], order=["n"])
    assert {r.s: r.tp_size for r in found.collect()} == {
        "a": len(b'{"s":"a","n":1}') + 1,
        "ü": len('{"s":"ü","n":null}'.encode()) + 1,
    }


def test_payload_is_untouched(spark):
    frame = spark.sql(
        """select 1 as shard, 1 as at, cast(null as bigint) as l, array(1.5F, null) as a, timestamp_ntz'2024-01-01' as n,
                  named_struct('x', cast(null as int)) as r, 1.25BD as d, x'00ff' as z
           union all select 1, 2, 9007199254740993, null, null, null, null, null"""
    )
    found = packetize(frame, shard=["shard"], order=["at"])
    assert found.select(*frame.columns).orderBy("at").collect() == frame.orderBy("at").collect()


def test_nothing_in_nothing_out(spark):
    frame = spark.createDataFrame([], "shard int, at int")
    assert packetize(frame, shard=["shard"], order=["at"]).collect() == []
    with pytest.raises(ValueError):
        packetize(frame, shard=["shard"], order=["at"], limit=0)
