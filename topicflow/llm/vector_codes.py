"""Compress vectors to short codes: one codebook per part of the vector, trained by exact k-means with norm-of-sum bounds.

Components are scaled to integers, so every distance and every mean is exact and the result does not depend on how rows are spread.
The vectors lie in a stored table with their state; each round is one pass over it without a shuffle, which writes the next
state and, from every partition, the sums of its parts by codebook entry. Only those sums, as many numbers as the codebooks
have, are added up by Spark and come to the driver.

A part's state is its entry, an upper bound of the distance to it and a lower bound of the distance to every other entry, each
bound with the *round* in which it was last measured. The driver keeps all earlier codebooks. In a later round a bound is moved by the
distance between an entry's place now and its place in the bound's own round (the norm of the sum of its steps), never by the
sum of the steps, which can only be longer. Where the bounds still part, nothing is measured; else the distance to the
own entry is; and only if that is not enough all entries are. Bounds are rounded to the safe side, and an entry is kept unseen
only if it is strictly nearer than any other, so ties go to the lower index as in a full scan.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from topicflow.storage import Store, fresh_folder

SLACK = 1 + 1e-12  # more than all rounding in double precision
SCANNED_AT_ONCE = 1 << 20  # numbers of a block of distances
LABEL_SALTS = 32
STATE = "vec_id bigint, vector binary, entries binary, upper binary, lower binary, stamps binary, error bigint, sums binary, measured bigint, scanned bigint"


class Trained(NamedTuple):
    codes: DataFrame
    """vec_id, label, code (bytes of entry numbers), error (squared distance, summed over parts)."""
    codebooks: np.ndarray
    """parts x entries x width, integers."""
    measured: list[int]
    """Parts whose distance to their own entry was measured, by pass."""
    scanned: list[int]
    """Parts whose distances to all entries were measured, by pass."""


def kept(vectors: DataFrame) -> DataFrame:
    """(vec_id, label, v array<double>): rows with a vector without null or non-finite components."""
    label = F.col("label") if "label" in vectors.columns else F.lit(None).cast("int").alias("label")
    return vectors.select(
        F.col("vec_id").cast("bigint").alias("vec_id"), label, F.col("embedding").cast("array<double>").alias("v")
    ).where("v is not null and forall(v, x -> x is not null and not isnan(x) and abs(x) < double('infinity'))")


def largest(width: int) -> int:
    """Components are held within this size, so that squared distances stay below 2^62."""
    return min(1 << 30, math.isqrt((1 << 60) // width))


def scaled(column: pa.Array, parts: int, width: int, scale: int) -> np.ndarray:
    """rows x parts x width integers: floor(scale * x), zeros where a vector is shorter."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    offsets = column.offsets.to_numpy()
    flat = column.flatten().to_numpy(zero_copy_only=False)
    bound = largest(width)
    with np.errstate(over="ignore"):
        flat = np.clip(np.floor(flat * scale), -bound, bound).astype(np.int64)
    sizes = np.diff(offsets)
    rows = np.zeros((len(column), parts * width), np.int64)
    inside = np.arange(len(flat)) - np.repeat(offsets[:-1] - offsets[0], sizes)
    rows[np.repeat(np.arange(len(column)), sizes), inside] = flat
    return rows.reshape(len(column), parts, width)


def _distances(parts: np.ndarray, entries: np.ndarray) -> np.ndarray:
    """Squared distances of rows x width to entries x width."""
    return ((parts[:, None, :] - entries[None]) ** 2).sum(axis=2)


def _up(squares: np.ndarray) -> np.ndarray:
    return np.nextafter(np.sqrt(squares.astype(np.float64)).astype(np.float32), np.float32(np.inf))


def _down(squares: np.ndarray) -> np.ndarray:
    low = np.nextafter(np.sqrt(squares.astype(np.float64)).astype(np.float32), np.float32(-np.inf))
    return np.maximum(low, np.float32(0))


class Bounds:
    """The state of some rows' parts: arrays of rows x parts."""

    def __init__(self, rows: int, parts: int):
        self.entries = np.zeros((rows, parts), np.uint8)
        self.upper = np.full((rows, parts), np.inf, np.float32)
        self.lower = np.zeros((rows, parts), np.float32)
        self.upper_stamps = np.zeros((rows, parts), np.uint8)
        self.lower_stamps = np.zeros((rows, parts), np.uint8)


class Pass:
    """One round of assignment. ``history`` holds the codebooks of rounds 0 to now: each parts x entries x width."""

    def __init__(self, history: list[np.ndarray]):
        self.now, self.books = len(history) - 1, history[-1]
        steps = np.stack([self.books - old for old in history]).astype(np.float64)
        self.moved = np.sqrt((steps**2).sum(axis=3)) * SLACK  # round x parts x entries: net way since then
        order = np.argsort(-self.moved, axis=2, kind="stable")
        self.farthest = order[:, :, 0]
        most = np.take_along_axis(self.moved, order, axis=2)
        self.most, self.next = most[:, :, 0], most[:, :, 1] if most.shape[2] > 1 else 0 * most[:, :, 0]
        self.measured = self.scanned = 0

    def assign(self, vectors: np.ndarray, state: Bounds) -> None:
        """Bring every part of ``vectors`` (rows x parts x width) to its nearest entry."""
        for part in range(vectors.shape[1]):
            self._assign_part(vectors[:, part], self.books[part], part, state)

    def _assign_part(self, rows: np.ndarray, entries: np.ndarray, part: int, state: Bounds) -> None:
        own = state.entries[:, part].astype(np.int64)
        was_upper, was_lower = state.upper_stamps[:, part], state.lower_stamps[:, part]
        others = np.where(self.farthest[was_lower, part] == own, self.next[was_lower, part], self.most[was_lower, part])
        lower = state.lower[:, part].astype(np.float64) - others * SLACK
        upper = state.upper[:, part].astype(np.float64) + self.moved[was_upper, part, own]
        open_rows = np.flatnonzero(~(upper * SLACK < lower))
        self.measured += len(open_rows)
        tight = _up(((rows[open_rows] - entries[own[open_rows]]) ** 2).sum(axis=1))
        state.upper[open_rows, part] = tight
        state.upper_stamps[open_rows, part] = self.now
        open_rows = open_rows[~(tight.astype(np.float64) * SLACK < lower[open_rows])]
        self.scanned += len(open_rows)
        block = max(1, SCANNED_AT_ONCE // entries.size)
        for at in range(0, len(open_rows), block):
            some = open_rows[at : at + block]
            squares = _distances(rows[some], entries)
            nearest = squares.argmin(axis=1)
            state.entries[some, part] = nearest
            state.upper[some, part] = _up(squares[np.arange(len(some)), nearest])
            if squares.shape[1] > 1:
                state.lower[some, part] = _down(np.partition(squares, 1, axis=1)[:, 1])
            else:
                state.lower[some, part] = np.inf
            state.upper_stamps[some, part] = state.lower_stamps[some, part] = self.now

    def errors(self, vectors: np.ndarray, state: Bounds) -> np.ndarray:
        total = np.zeros(len(vectors), np.int64)
        for part in range(vectors.shape[1]):
            total += ((vectors[:, part] - self.books[part][state.entries[:, part]]) ** 2).sum(axis=1)
        return total

    def add_sums(self, sums: np.ndarray, vectors: np.ndarray, state: Bounds) -> None:
        """Add each part to its entry's sums; the last column counts."""
        for part in range(vectors.shape[1]):
            np.add.at(sums[part, :, :-1], state.entries[:, part], vectors[:, part])
            sums[part, :, -1] += np.bincount(state.entries[:, part], minlength=sums.shape[1])


def _binary(rows: np.ndarray, kind: str) -> pa.Array:
    rows = np.ascontiguousarray(rows.reshape(len(rows), -1), kind)
    return pa.array([row.tobytes() for row in rows], pa.binary())


def _array(column: pa.Array, kind: str, *shape: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), kind).reshape(len(column), *shape).copy()


def _passed(
    batches: Iterator[pa.RecordBatch], history: list[np.ndarray], scale: int, first: bool, last: bool, label_kind
) -> Iterator[pa.RecordBatch]:
    """One pass over a partition: the rows with their new state, then one row with the partition's sums."""
    run = Pass(history)
    parts, entries, width = run.books.shape
    sums = np.zeros((parts, entries, width + 1), np.int64)
    names = ["vec_id", "vector", "entries", "upper", "lower", "stamps", "error", "sums", "measured", "scanned", "label"]
    kinds = [pa.int64(), *[pa.binary()] * 5, pa.int64(), pa.binary(), pa.int64(), pa.int64(), label_kind]
    for batch in batches:
        if not len(batch):
            continue
        if first:
            vectors, state = scaled(batch.column("v"), parts, width, scale), Bounds(len(batch), parts)
        else:
            vectors, state = _array(batch.column("vector"), "<i4", parts, width).astype(np.int64), Bounds(0, parts)
            state.entries = _array(batch.column("entries"), "u1", parts)
            state.upper = _array(batch.column("upper"), "<f4", parts)
            state.lower = _array(batch.column("lower"), "<f4", parts)
            stamps = _array(batch.column("stamps"), "u1", 2, parts)
            state.upper_stamps, state.lower_stamps = stamps[:, 0].copy(), stamps[:, 1].copy()
        run.assign(vectors, state)
        none = pa.nulls(len(batch), pa.int64())
        stamps = np.stack([state.upper_stamps, state.lower_stamps], axis=1)
        if last:
            empty = pa.nulls(len(batch), pa.binary())
            columns = [empty, _binary(state.entries, "u1"), empty, empty, empty, pa.array(run.errors(vectors, state))]
        else:
            run.add_sums(sums, vectors, state)
            columns = [
                _binary(vectors, "<i4"), _binary(state.entries, "u1"), _binary(state.upper, "<f4"),
                _binary(state.lower, "<f4"), _binary(stamps, "u1"), none,
            ]
        yield pa.RecordBatch.from_arrays(
            [batch.column("vec_id"), *columns, pa.nulls(len(batch), pa.binary()), none, none, batch.column("label")], names
        )
    row = [None] * 7 + [sums.astype("<i8").tobytes(), run.measured, run.scanned, None]
    yield pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(row, kinds, strict=True)], names)


def _cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The numbers of each row of sums, with their places."""
    for batch in batches:
        for content in batch.column("sums").to_pylist():
            values = np.frombuffer(content, "<i8")
            used = np.flatnonzero(values)
            yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(values[used])], ["cell", "value"])


def moved_books(books: np.ndarray, totals: dict[int, int]) -> np.ndarray:
    """Codebooks at the floored means of their parts; unused entries stay."""
    parts, entries, width = books.shape
    found = books.copy()
    for part in range(parts):
        for entry in range(entries):
            at = (part * entries + entry) * (width + 1)
            count = int(totals.get(at + width, 0))
            if count:
                found[part, entry] = [int(totals.get(at + k, 0)) // count for k in range(width)]
    return found


def codebook_digest(books: np.ndarray) -> str:
    return hashlib.sha256(",".join(map(str, books.reshape(-1).tolist())).encode()).hexdigest()


def train(
    vectors: DataFrame, parts: int = 8, entries: int = 16, rounds: int = 6, scale: int = 4096
) -> Trained:
    """Codebooks and codes of every usable row of ``vectors`` (vec_id, embedding, perhaps label).

    Rows whose vector is null or holds null or non-finite components take no part. Component x becomes floor(scale * x), held
    within +-:func:`largest`. Vectors are padded with zeros to one length, a multiple of ``parts``. Codebooks start at the
    ``entries`` smallest vec_ids (ties by vector, null ids last; fewer rows, fewer entries). Each round assigns every part to its nearest entry,
    ties to the lower index, and moves entries to the floored mean of their parts; unused ones stay. Then parts
    are assigned once more. Repeated rows count each. An empty table gives no rows and empty codebooks.
    """
    if entries > 256 or rounds > 254:
        raise ValueError("entry numbers and rounds are stored in a byte")
    spark, rows = vectors.sparkSession, kept(vectors)
    longest = rows.agg(F.max(F.size("v"))).first()[0]
    width = max(1, -(-(longest or 0) // parts))
    smallest = rows.orderBy(F.col("vec_id").asc_nulls_last(), "v").limit(entries).select("v").collect()
    start = scaled(pa.array([row.v for row in smallest], pa.list_(pa.float64())), parts, width, scale)
    history = [np.ascontiguousarray(start.transpose(1, 0, 2))]
    if not smallest:
        codes = rows.selectExpr("vec_id", "label", "cast(null as binary) as code", "0L as error").limit(0)
        return Trained(codes, history[0], [], [])
    label = rows.schema["label"].dataType
    schema = f"{STATE}, label {label.simpleString()}"
    from pyspark.sql.pandas.types import to_arrow_type

    label_kind, store, old = to_arrow_type(label), None, None
    measured, scanned = [], []
    for turn in range(rounds + 1):
        folder = fresh_folder(spark, "vector-codes")
        rows.mapInArrow(
            lambda batches, known=list(history), first=turn == 0, last=turn == rounds: _passed(
                batches, known, scale, first, last, label_kind
            ),
            schema,
        ).write.parquet(folder)
        state = spark.read.schema(schema).parquet(folder)
        sums = state.where("sums is not null")
        work = sums.agg(F.sum("measured"), F.sum("scanned")).first()
        measured.append(work[0])
        scanned.append(work[1])
        if turn < rounds:
            cells = sums.select("sums").mapInArrow(_cells, "cell bigint, value bigint")
            totals = cells.groupBy("cell").agg(F.sum(F.col("value").cast("decimal(38,0)")).alias("value")).collect()
            history.append(moved_books(history[-1], {row.cell: int(row.value) for row in totals}))
        if old:  # the state before last is no longer read
            store.drop(old)
        store, old = Store(spark, folder), folder
        rows = state.where("sums is null").drop("sums", "measured", "scanned", "error")
    codes = state.where("sums is null").select("vec_id", "label", F.col("entries").alias("code"), "error")
    return Trained(codes, history[-1], measured, scanned)


def with_label_error(codes: DataFrame) -> DataFrame:
    """``codes`` with ``label_error``: the error summed over rows of equal label, nulls together.

    Sums are made per label and salt first, and the sums of a label are met by salted rows, so a common label is spread.
    """
    salted = codes.withColumn("salt", F.pmod(F.xxhash64("vec_id", "code"), F.lit(LABEL_SALTS)).cast("int"))
    totals = salted.groupBy("label").agg(F.sum(F.col("error").cast("decimal(38,0)")).cast("bigint").alias("label_error"))
    spread = totals.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(LABEL_SALTS - 1))))
    spread = spread.withColumnsRenamed({"label": "its_label", "salt": "its_salt"})
    met = salted["label"].eqNullSafe(spread["its_label"]) & (salted["salt"] == spread["its_salt"])
    return salted.join(spread, met).select("vec_id", "label", "code", "error", "label_error")


def reconstructed(codes: DataFrame, codebooks: np.ndarray, scale: int = 4096) -> DataFrame:
    """(vec_id, embedding): the vectors that the codes stand for."""
    books = codebooks

    def looked_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            chosen = _array(batch.column("code"), "u1", len(books))
            rows = books[np.arange(len(books)), chosen].reshape(len(batch), -1) / scale
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec_id"), pa.array(list(rows), pa.list_(pa.float64()))], ["vec_id", "embedding"]
            )

    return codes.select("vec_id", "code").mapInArrow(looked_up, "vec_id bigint, embedding array<double>")
