"""Cut the rows of each shard, in order, into packets of bounded size.

A packet ends with the first row that brings it to the limit, so it may pass the limit by one row. Where a packet ends
depends on where the one before it ended, which makes the cut sequential within a shard. So rows are range-partitioned by
(shard, order), and a large shard covers many partitions (blocks). Each block describes, in a small table, how it would
leave the packet state for every state it could be entered with. Descriptions of neighbouring blocks are composed, these again, and
so on, in as many levels as the number of blocks has digits. Then the state each group is entered with is handed down
level by level. Every step runs over all groups of its level at once, what is found is a table, and the rows of a
block meet their entry state by a join.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from topicflow.functions.codec import to_line
from topicflow.functions.rows import quoted
from topicflow.storage import fresh_folder, stored, written_once

GROUP_BLOCKS = 64  # neighbouring blocks that are described as one
BROADCAST_BLOCKS = 200_000  # entry states, of some 30 bytes, that are sent to every task
ENTRY = [("tp_in_packet", "bigint"), ("tp_in_filled", "bigint"), ("tp_in_rows", "bigint")]
MAX_PACKET_SIZE = 10 * 1024 * 1024  # fixed value: the default limit of a packet


class Cutter:
    """Numbers the rows of one shard as they come: packet, and place within the packet."""

    def __init__(self, limit: int, packet: int = 0, filled: int = 0, rows: int = 0):
        self.limit, self.packet, self.filled, self.rows = limit, packet, filled, rows

    def number(self, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        ends = np.cumsum(sizes)
        packets, places = np.empty(len(ends), np.int64), np.empty(len(ends), np.int64)
        at, before = 0, -self.filled
        while at < len(ends):
            stop = int(np.searchsorted(ends, before + self.limit))
            upto = min(stop + 1, len(ends))
            packets[at:upto] = self.packet
            places[at:upto] = np.arange(self.rows, self.rows + upto - at)
            if stop == len(ends):
                self.rows += upto - at
                break
            self.packet, self.rows, before, at = self.packet + 1, 0, int(ends[stop]), upto
        if len(ends):
            self.filled = int(ends[-1]) - before
        return packets, places


def default_size(rows: DataFrame) -> Column:
    """Bytes of the row as a line of JSON."""
    return F.octet_length(to_line(F.struct(*map(quoted, rows.columns)))) + 1


def _runs(keys: pa.Array) -> Iterator[tuple[int, int]]:
    """Borders of the stretches of equal neighbours."""
    if len(keys) > 1:
        changes = pc.not_equal(keys.slice(1), keys.slice(0, len(keys) - 1)).to_numpy(zero_copy_only=False)
        borders = [0, *(np.flatnonzero(changes) + 1).tolist(), len(keys)]
    else:
        borders = [0, len(keys)]
    return zip(borders[:-1], borders[1:])


def _numbers(batch: pa.RecordBatch, name: str) -> np.ndarray:
    return batch.column(name).to_numpy(zero_copy_only=False).astype(np.int64, copy=False)


def _numberer(limit: int):
    """Adds packet and place to sorted rows. Rows of a block say the state it is entered with, the same in each."""
    entry = [name for name, _ in ENTRY]

    def run(batches):
        cutter, last, inside = None, None, None
        for batch in batches:
            if not batch.num_rows:
                continue
            sizes, blocks = _numbers(batch, "tp_size"), batch.column("tp_block")
            packets, places = np.empty(len(sizes), np.int64), np.empty(len(sizes), np.int64)
            for left, right in _runs(blocks):
                keys = batch.column("tp_key").slice(left, right - left)
                for begin, end in _runs(keys):
                    key, block, at = keys[begin].as_py(), blocks[left].as_py(), left + begin
                    if block != inside:
                        cutter = Cutter(limit, *(batch.column(name)[at].as_py() for name in entry))
                    elif key != last:
                        cutter = Cutter(limit)
                    last, inside, until = key, block, left + end
                    packets[at:until], places[at:until] = cutter.number(sizes[at:until])
            kept = batch.drop_columns([name for name in ("tp_key", "tp_block", *entry) if name in batch.schema.names])
            yield kept.append_column("tp_packet", pa.array(packets)).append_column("tp_packet_offset", pa.array(places))

    return run


# --- blocks ----------------------------------------------------------------------------------------------------

_BLOCK = (
    "tp_block int, tp_step bigint, first_key string, last_key string, single boolean, "
    "need bigint, packets bigint, filled bigint, rows bigint"
)
_ENTRY = "tp_block int, " + ", ".join(f"{name} {kind}" for name, kind in ENTRY)


def _exits(sizes: np.ndarray, limit: int) -> dict[str, np.ndarray]:
    """How a stretch of one shard leaves the packet state, for each row that may be the first to end a packet.

    Entered with ``f`` bytes in the open packet, the first end is the first row with ``need >= limit - f``, where
    ``need`` is the bytes up to and including that row. Only rows within the first ``limit`` bytes qualify.
    """
    ends = np.cumsum(sizes)
    first = np.arange(min(int(np.searchsorted(ends, limit)) + 1, len(ends)))
    cut, packets, active = first.copy(), np.ones(len(first), np.int64), first
    while active.size:
        stop = np.searchsorted(ends, ends[cut[active]] + limit)
        active, stop = active[stop < len(ends)], stop[stop < len(ends)]
        cut[active] = stop
        packets[active] += 1
    table = {"need": ends[first], "packets": packets, "filled": ends[-1] - ends[cut], "rows": len(ends) - 1 - cut}
    # neighbours with the same outcome: the last one stands for all
    outcome = np.stack([table["packets"], table["filled"], table["rows"]])
    kept = np.append((outcome[:, 1:] != outcome[:, :-1]).any(axis=0), True)
    return {name: column[kept] for name, column in table.items()}


def _describer(limit: int):
    """One line per block (step -1), and for blocks inside a single shard one line per possible exit."""

    def run(batches):
        block = first = last = None
        sizes: list[np.ndarray] = []
        cutter = None  # set once a second shard begins: then the exit no longer depends on the entry
        for batch in batches:
            keys, size = batch.column("tp_key"), _numbers(batch, "tp_size")
            for begin, end in _runs(keys) if batch.num_rows else ():
                key = keys[begin].as_py()
                if last is None:
                    block, first = batch.column("tp_block")[begin].as_py(), key
                elif key != last:
                    cutter, sizes = Cutter(limit), []
                last = key
                if cutter is None:
                    sizes.append(size[begin:end])
                else:
                    cutter.number(size[begin:end])
        if last is None:
            return
        if cutter is None:
            whole = np.concatenate(sizes)
            head = {"packets": [0], "filled": [int(whole.sum())], "rows": [len(whole)]}
            exits = _exits(whole, limit)
        else:
            head = {"packets": [cutter.packet], "filled": [cutter.filled], "rows": [cutter.rows]}
            exits = {name: np.empty(0, np.int64) for name in ("need", "packets", "filled", "rows")}
        lines = 1 + len(exits["need"])
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([block] * lines, pa.int32()),
                pa.array(range(-1, lines - 1), pa.int64()),
                pa.array([first] + [None] * (lines - 1), pa.string()),
                pa.array([last] + [None] * (lines - 1), pa.string()),
                pa.array([cutter is None] + [None] * (lines - 1), pa.bool_()),
                pa.array([None, *exits["need"].tolist()], pa.int64()),
                *(pa.array([*head[name], *exits[name].tolist()], pa.int64()) for name in ("packets", "filled", "rows")),
            ],
            names=["tp_block", "tp_step", "first_key", "last_key", "single", "need", "packets", "filled", "rows"],
        )

    return run


class _Described:
    """A block, or several in a row, by how it would leave the packet state."""

    def __init__(self, table: pa.Table):
        head = table.slice(0, 1).to_pylist()[0]
        self.first_key, self.last_key, self.single = head["first_key"], head["last_key"], head["single"]
        self.left = (head["packets"], head["filled"], head["rows"])
        names = ("need", "packets", "filled", "rows")
        self.exits = {name: table.column(name).slice(1).to_numpy().astype(np.int64) for name in names}

    def leave(self, state: tuple[int, int, int], limit: int) -> tuple[int, int, int]:
        """The state after it, entered in the same shard with ``state``."""
        if not self.single:
            return self.left
        packet, filled, rows = state
        found = int(np.searchsorted(self.exits["need"], limit - filled))
        if found == len(self.exits["need"]):
            return packet, filled + self.left[1], rows + self.left[2]
        return packet + int(self.exits["packets"][found]), *(int(self.exits[name][found]) for name in ("filled", "rows"))

    def followed_by(self, other: _Described, limit: int) -> None:
        """Become both together."""
        same = other.first_key == self.last_key
        if self.single and same and other.single:
            mine, theirs = self.exits, other.exits
            at = np.searchsorted(theirs["need"], limit - mine["filled"])
            ends = at < len(theirs["need"])
            after = {
                "packets": mine["packets"].copy(),
                "filled": mine["filled"] + other.left[1],
                "rows": mine["rows"] + other.left[2],
            }
            after["packets"][ends] += theirs["packets"][at[ends]]
            for name in ("filled", "rows"):
                after[name][ends] = theirs[name][at[ends]]
            # entries that pass all of this one: the other ends them, with more bytes missing
            later = np.concatenate([[0], theirs["need"][:-1]])[: len(theirs["need"])] + self.left[1] < limit
            after["need"] = mine["need"]
            theirs = theirs | {"need": theirs["need"] + self.left[1]}
            self.exits = {name: np.concatenate([after[name], theirs[name][later]]) for name in theirs}
            self.left = (0, self.left[1] + other.left[1], self.left[2] + other.left[2])
        elif self.single and same:
            self.left = other.left
        else:
            self.left = other.leave(self.left if same else (0, 0, 0), limit)
        if not (self.single and same and other.single):
            self.single, self.exits = False, {name: column[:0] for name, column in self.exits.items()}
        self.last_key = other.last_key

    def lines(self, number: int) -> pa.Table:
        count = 1 + len(self.exits["need"])
        rest = [None] * (count - 1)
        numbers = zip(("packets", "filled", "rows"), self.left, strict=True)
        columns = {
            "tp_block": pa.array([number] * count, pa.int32()),
            "tp_step": pa.array(range(-1, count - 1), pa.int64()),
            "first_key": pa.array([self.first_key, *rest], pa.string()),
            "last_key": pa.array([self.last_key, *rest], pa.string()),
            "single": pa.array([self.single, *rest], pa.bool_()),
            "need": pa.array([None, *self.exits["need"].tolist()], pa.int64()),
        }
        columns |= {n: pa.array([head, *self.exits[n].tolist()], pa.int64()) for n, head in numbers}
        return pa.table(columns)


def _in_order(lines: pa.Table) -> Iterator[tuple[int, _Described]]:
    """The blocks among lines of block descriptions."""
    lines = lines.sort_by([("tp_block", "ascending"), ("tp_step", "ascending")]).combine_chunks()
    for begin, end in _runs(lines.column("tp_block").combine_chunks()):
        yield lines.column("tp_block")[begin].as_py(), _Described(lines.slice(begin, end - begin))


def _joiner(limit: int, size: int):
    """Describe a group of neighbouring blocks as one."""

    def run(lines: pa.Table) -> pa.Table:
        (first, whole), *others = _in_order(lines.drop_columns(["tp_group"]))
        for _, block in others:
            whole.followed_by(block, limit)
        return whole.lines(first // size)

    return run


def _walker(limit: int):
    """The states the blocks of a group are entered with, from the state the group is entered with."""

    def run(lines: pa.Table, entered: pa.Table) -> pa.Table:
        entries, state, last = [], None, None
        for number, block in _in_order(lines.drop_columns(["tp_group"])) if lines.num_rows else ():
            if state is None:
                state = tuple(entered.column(name)[0].as_py() for name, _ in ENTRY)
            elif block.first_key != last:
                state = (0, 0, 0)
            entries.append((number, *state))
            state, last = block.leave(state, limit), block.last_key
        names = ("tp_block", *(name for name, _ in ENTRY))
        columns = zip(*entries, strict=True) if entries else [()] * len(names)
        return pa.table({n: pa.array(c, pa.int32() if n == "tp_block" else pa.int64()) for n, c in zip(names, columns, strict=True)})

    return run


def _entry_states(blocks: DataFrame, limit: int, count: int) -> DataFrame:
    """The state each of ``count`` blocks is entered with, as a stored table of one line per block."""
    spark = blocks.sparkSession
    described = blocks.select("tp_key", "tp_block", "tp_size").mapInArrow(_describer(limit), _BLOCK)
    levels, width = [stored(described, fresh_folder(spark, "blocks"))], count
    group = F.expr(f"tp_block div {GROUP_BLOCKS}").cast("int").alias("tp_group")
    while width > GROUP_BLOCKS:
        joined = levels[-1].select("*", group).groupBy("tp_group").applyInArrow(_joiner(limit, GROUP_BLOCKS), _BLOCK)
        levels.append(stored(joined, fresh_folder(spark, "blocks")))
        width = -(-width // GROUP_BLOCKS)
    entered = spark.range(1).selectExpr("cast(id as int) as tp_block", *(f"0L as {name}" for name, _ in ENTRY))
    for level in reversed(levels):  # from at most GROUP_BLOCKS descriptions down to all blocks
        lines = level.select("*", group).groupBy("tp_group")
        walked = lines.cogroup(entered.withColumnRenamed("tp_block", "tp_group").groupBy("tp_group"))
        entered = stored(walked.applyInArrow(_walker(limit), _ENTRY), fresh_folder(spark, "entries"))
    return entered


def packetize(
    rows: DataFrame,
    *,
    shard: Sequence[str],
    order: Sequence[str],
    size: Column | None = None,
    limit: int = MAX_PACKET_SIZE,
) -> DataFrame:
    """Add ``tp_size``, ``tp_packet`` and ``tp_packet_offset`` (both from 0) to each row.

    ``order`` must put the rows of a shard in one definite order.
    """
    if limit < 1:
        raise ValueError("the limit must be positive")
    kept = T.StructType(
        rows.schema.fields
        + [T.StructField(name, T.LongType()) for name in ("tp_size", "tp_packet", "tp_packet_offset")]
    )
    size = default_size(rows) if size is None else size
    sized = rows.select(
        "*",
        F.coalesce(size.cast("bigint"), F.lit(0)).alias("tp_size"),
        to_line(F.struct(*map(quoted, shard))).alias("tp_key"),
    )
    sort = [quoted(name) for name in (*shard, *order)]
    # the entry states hold only for these very partitions, so they must not be computed anew
    ranged = sized.repartitionByRange(*sort).sortWithinPartitions(*sort)
    blocks = written_once(ranged.withColumn("tp_block", F.spark_partition_id()))
    count = blocks.rdd.getNumPartitions()
    entered = _entry_states(blocks, limit, count)
    if count <= BROADCAST_BLOCKS:
        met = blocks.join(F.broadcast(entered), "tp_block")  # rows stay where and in the order they are
    else:
        met = blocks.join(entered.hint("merge"), "tp_block").sortWithinPartitions("tp_block", *sort)
    columns = [*map(quoted, [*rows.columns, "tp_size", "tp_key"]), "tp_block", *(name for name, _ in ENTRY)]
    return met.select(*columns).mapInArrow(_numberer(limit), kept)
