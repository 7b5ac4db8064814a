"""Pack token sequences into fixed-size bins by hierarchical best fit.

Every document becomes pieces of at most ``size`` tokens. Full pieces are sequences of their own. The others are packed
where they lie: each partition runs best fit over its pieces, longest first, a batch of them at a time. Bins filled to ``nearly`` are done; the
rest, the underfull bins, are items themselves and are packed again in groups that merge the partitions, round after
round, until one group is left or a round has little to gain. If groups are left then, one last round merges all of them at
once: bins of equal fill are interchangeable, so best fit over the numbers of bins of each fill, of which there are no more than
the size of a bin, says which go together. Only piece lengths are packed, never texts or tokens.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from topicflow.operators.asof import ranked
from topicflow.storage import fresh_folder, stored

GROUP = 200_000  # underfull bins packed by one task in a later round
GAIN = 0.02  # a round that closes a smaller share of its bins is the last one in groups


def end_marked_ids(encode, text: str | None, end_id: int) -> np.ndarray:
    ids = encode(text) if text else []
    return np.array([*ids, end_id], "<u4")


def byte_bpe_encoder(path: str, pattern: str, special: dict[str, int]) -> Callable[[str], list[int]]:
    """The byte-level BPE of a rank file: same ids as the ``tokenizers`` file of that vocabulary, where the strings in ``special``
    have ids of their own wherever they stand in a text."""
    import base64

    with open(path, "rb") as lines:
        ranks = {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in lines)}
    encoding = tiktoken.Encoding("packing", pat_str=pattern, mergeable_ranks=ranks, special_tokens=special)
    return lambda text: encoding.encode(text, allowed_special="all")


def _pieces(batches: Iterator[pa.RecordBatch], make_encoder, size: int, end_id: int) -> Iterator[pa.RecordBatch]:
    encode = make_encoder()
    for batch in batches:
        rows = []
        for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist(), strict=True):
            ids = end_marked_ids(encode, text, end_id)
            first = len(ids) % size or size
            starts = [0, *range(first, len(ids), size)]
            for piece, (start, end) in enumerate(zip(starts, [*starts[1:], len(ids)], strict=True)):
                rows.append((doc_id, piece, start, end - start, zlib.crc32(ids[start:end].tobytes())))
        kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]
        columns = zip(*rows, strict=True) if rows else [[]] * 5
        yield pa.RecordBatch.from_arrays(
            [pa.array(column, kind) for column, kind in zip(columns, kinds, strict=True)],
            ["doc_id", "piece", "start", "length", "ids_crc32"],
        )


def best_fit(lengths: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Best fit, longest first: (bin, offset in it) of every item, and the fill of every bin."""
    bins, offsets = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
    fills: list[int] = []
    by_room: dict[int, list[int]] = {}
    rooms: list[int] = []  # the distinct rooms left, ascending; at most ``size`` of them
    for item in np.argsort(-lengths, kind="stable").tolist():
        length = int(lengths[item])
        at = bisect_left(rooms, length)
        if at == len(rooms):
            target, room = len(fills), size
            fills.append(0)
        else:
            room = rooms[at]
            target = by_room[room].pop()
            if not by_room[room]:
                del by_room[room], rooms[at]
        bins[item], offsets[item] = target, fills[target]
        fills[target] += length
        left = room - length
        if left:
            if left not in by_room:
                by_room[left] = []
                insort(rooms, left)
            by_room[left].append(target)
    return bins, offsets, np.array(fills, np.int64)


def patterns(counts: dict[int, int], size: int) -> list[tuple[list[int], int]]:
    """Best fit, largest first, over ``counts`` items of each length: (lengths that share a bin, number of such bins)."""
    made: list[list] = []
    by_room: dict[int, list[int]] = {}
    rooms: list[int] = []

    def open_up(lengths: list[int], count: int) -> None:
        left = size - sum(lengths)
        made.append([lengths, count])
        if left not in by_room:
            by_room[left] = []
            insort(rooms, left)
        by_room[left].append(len(made) - 1)

    for length in sorted(counts, reverse=True):
        count = counts[length]
        while count:
            at = bisect_left(rooms, length)
            if at == len(rooms):
                each = size // length
                if count >= each:
                    open_up([length] * each, count // each)
                if count % each:
                    open_up([length] * (count % each), 1)
                break
            room = rooms[at]
            number = by_room[room][-1]
            lengths, bins = made[number]
            taken = min(count, bins)
            made[number][1] -= taken
            if not made[number][1]:
                by_room[room].pop()
                if not by_room[room]:
                    del by_room[room], rooms[at]
            open_up([*lengths, length], taken)
            count -= taken
    return [(lengths, count) for lengths, count in made if count]


def _merged_at_once(open_bins: DataFrame, size: int) -> DataFrame:
    """(bin, into, at, fill): best fit over all of ``open_bins`` (bin, fill), whatever their number.

    The numbers of bins of each fill come to the driver, the patterns go to the tasks: both are bounded by the size of a bin.
    """
    spark = open_bins.sparkSession
    numbered = stored(ranked(open_bins.select("bin", "fill"), "fill", "bin"), fresh_folder(spark, "open-bins"))
    counts = {row.fill: row.n for row in numbered.groupBy("fill").agg(F.count(F.lit(1)).alias("n")).collect()}
    begin, total = {}, 1
    for fill in sorted(counts):
        begin[fill], total = total, total + counts[fill]
    slots, used = [], dict(begin)
    for lengths, count in patterns(counts, size):
        first, at = used[lengths[0]], 0
        for length in lengths:
            # ranks from used[length] on, one for each bin of the pattern; the first length names the bins
            slots.append((length, used[length], used[length] + count - 1, first - used[length], at, sum(lengths)))
            used[length] += count
            at += length
    schema = "fill bigint, low bigint, high bigint, shift bigint, at bigint, sum bigint"
    places = F.broadcast(spark.createDataFrame(slots, schema))
    met = numbered.join(places, "fill").where("tp_rank between low and high")
    met = met.select("bin", (F.col("tp_rank") + F.col("shift")).alias("head"), "at", F.col("sum").alias("fill"))
    heads = numbered.select(F.col("tp_rank").alias("head"), F.col("bin").alias("into"))
    return met.join(heads, "head").select("bin", "into", "at", "fill")


def _local(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
    """Pack the pieces of a batch, longest first; bins are numbered after their first piece's number."""
    for batch in batches:
        lengths = batch.column("length").to_numpy()
        bins, offsets, fills = best_fit(lengths, size)
        numbers = batch.column("item").to_numpy()
        names = np.full(len(fills), -1, np.int64)
        head = np.flatnonzero(offsets == 0)
        names[bins[head]] = numbers[head]
        yield pa.RecordBatch.from_arrays(
            [*batch.columns, pa.array(names[bins]), pa.array(offsets), pa.array(fills[bins] if len(bins) else offsets)],
            [*batch.schema.names, "bin", "offset", "fill"],
        )


def _merge(size: int):
    def merged(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values("bin")
        bins, offsets, fills = best_fit(frame["fill"].to_numpy(), size)
        numbers = frame["bin"].to_numpy()
        names = np.zeros(len(fills), np.int64)
        names[bins[offsets == 0]] = numbers[offsets == 0]
        return pd.DataFrame({"bin": numbers, "into": names[bins], "at": offsets, "fill": fills[bins]})

    return merged


def pieces_of(docs: DataFrame, make_encoder, size: int = 1024, end_id: int = 2) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32): each document's ids and the end id, cut into pieces of ``size``.

    Null and empty texts are just the end id. The first piece holds what the full ones leave over.
    """
    return docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text")
    ).mapInArrow(
        lambda batches: _pieces(batches, make_encoder, size, end_id),
        "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint",
    )


def pack(docs: DataFrame, make_encoder, size: int = 1024, end_id: int = 2, nearly: float = 0.995) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32, sequence_id, offset) for every piece of every row of ``docs``.

    ``make_encoder`` makes, in the task, a function from a text to its ids. Rows with null or repeated ids are
    packed like others. Pieces of equal length are taken in table order. An empty table gives no rows.
    """
    spark = docs.sparkSession
    pieces = stored(
        pieces_of(docs, make_encoder, size, end_id).withColumn("item", F.monotonically_increasing_id()),
        fresh_folder(spark, "pieces"),
    )
    packed = stored(
        pieces.where(F.col("length") < size).mapInArrow(
            lambda batches: _local(batches, size),
            "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint, item bigint, bin bigint,"
            " offset bigint, fill bigint",
        ),
        fresh_folder(spark, "packed"),
    )
    enough = int(nearly * size)
    whole = pieces.where(F.col("length") == size).select(
        "doc_id", "piece", "start", "length", "ids_crc32", F.col("item").alias("sequence_id"),
        F.lit(0).cast("bigint").alias("offset"),
    )
    columns = whole.columns
    closed = packed.where(F.col("fill") >= enough).withColumnRenamed("bin", "sequence_id").select(columns)
    underfull = packed.where(F.col("fill") < enough)
    moved = _tree(underfull.where("offset = 0").select("bin", "fill"), size, enough)
    rest = underfull.join(moved, "bin").select(
        "doc_id", "piece", "start", "length", "ids_crc32", F.col("into").alias("sequence_id"),
        (F.col("offset") + F.col("at")).alias("offset"),
    )
    return whole.union(closed).union(rest)


def _tree(bins: DataFrame, size: int, enough: int) -> DataFrame:
    """(bin, into, at): where every underfull bin goes, after rounds of best fit over ever larger groups."""
    spark = bins.sparkSession
    moves = stored(
        bins.selectExpr("bin", "bin as into", "0L as at", "fill"), fresh_folder(spark, "moves")
    )
    count = moves.count()
    groups, last, at_once = max(1, count // (GROUP // 8)), False, False
    while count and not last:
        last = groups == 1 or at_once
        open_bins = moves.where((F.col("fill") < enough) & (F.col("at") == 0) & (F.col("bin") == F.col("into")))
        open_bins = open_bins.select(F.col("into").alias("bin"), "fill")
        if at_once:
            merged = _merged_at_once(open_bins, size)
        else:
            merged = (
                open_bins.withColumn("group", F.pmod(F.xxhash64("bin", F.lit(groups)), F.lit(groups)))
                .groupBy("group")
                .applyInPandas(_merge(size), "bin bigint, into bigint, at bigint, fill bigint")
            )
        merged = merged.select(
            F.col("bin").alias("into"), F.col("into").alias("next"), F.col("at").alias("shift"), F.col("fill").alias("sum")
        )
        moves = stored(
            moves.join(merged, "into", "left").select(
                "bin",
                F.coalesce("next", "into").alias("into"),
                (F.col("at") + F.coalesce("shift", F.lit(0))).alias("at"),
                F.coalesce("sum", "fill").alias("fill"),
            ),
            fresh_folder(spark, "moves"),
        )
        left = moves.where((F.col("fill") < enough) & (F.col("at") == 0) & (F.col("bin") == F.col("into"))).count()
        at_once = left > (1 - GAIN) * count
        count, groups = left, max(1, groups // 8, -(-left // GROUP))
    return moves.select("bin", "into", "at")
