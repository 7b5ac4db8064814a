"""Exact ranked search by inner product over sparse ball trees.

A document is the sparse integer vector of its terms' scores, a query the terms of an item; the score is their inner product. Documents
lie in *segments*, runs of about two megabytes of text, whose term counts are stored once. For a block of queries each segment
is projected to the terms that the block has at all (other coordinates cannot change an inner product) and a tree is built over
it: a node is split between two documents far apart, down to leaves of a few.

A node keeps the centroid of its documents and their largest distance to it, in all and by *band* of terms of similar weight. By
Cauchy's inequality no document of the node scores more than the query's product with the centroid plus the radius times the root of the
number of query terms that occur in the node at all; the same holds band by band, and the smaller of the two bounds is used.
Radii and bounds are computed in doubles and rounded up by far more than all rounding errors together, so pruning is safe.
Subtrees are visited best bound first until no bound reaches the worst of the k scores found so far; leaves are scored exactly in
64-bit integers. A subtree is left out only if its bound is below that score, so equal scores are all seen and ties go by doc_id.

Two things make most of the work fall away. A task keeps its best k of each query from segment to segment. And a first search over
one segment in 64, picked by hash, gives each query a floor: a score that k documents are known to reach. All segments are
then searched, and only documents from the floor up leave the tasks.

Terms are compared by 64-bit hashes. Items are handled in blocks of bounded size, one at a time.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from topicflow.llm.words import PLAIN, text_blocks, word_hashes
from topicflow.storage import fresh_folder, stored

BLOCK_TERMS = 16_384  # terms of the items that are searched at a time, about
SEGMENT_DOCS = 2048
LEAF = 16
BANDS = 64
FLOOR_SHARE = 64  # one segment in so many gives the floors
SALTS = 64
SAFE = 1 + 1e-9
INDEX = "pick int, n_docs bigint, n_terms bigint, ids array<bigint>, sizes binary, terms binary, counts binary, bounds binary, codes binary, times binary"


def _segments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Term counts of the documents that have terms, a run of documents a row."""
    kinds = [pa.int32(), pa.int64(), pa.int64(), pa.list_(pa.int64()), *[pa.binary()] * 6]
    for batch in batches:
        for begin in range(0, len(batch), SEGMENT_DOCS):
            part = batch.slice(begin, SEGMENT_DOCS)
            for first, data, offsets in text_blocks(part.column("text")):
                words, bounds = word_hashes(data, offsets, PLAIN)
                sizes = np.diff(bounds)
                full = np.flatnonzero(sizes)
                if not len(full):
                    continue
                terms, codes = np.unique(words, return_inverse=True)
                owner = np.repeat(np.arange(len(full)), sizes[full])
                cells, times = np.unique(owner * len(terms) + codes, return_counts=True)
                owner, codes = cells // len(terms), cells % len(terms)
                ids = part.column("doc_id").slice(first, len(sizes)).take(pa.array(full)).to_pylist()
                pick = int(np.bitwise_xor.reduce(words)) % FLOOR_SHARE
                row = [
                    pick, len(full), len(words), ids, sizes[full].astype("<i8").tobytes(), terms.astype("<u8").tobytes(),
                    np.bincount(codes, minlength=len(terms)).astype("<i4").tobytes(),
                    np.searchsorted(owner, np.arange(len(full) + 1)).astype("<i8").tobytes(),
                    codes.astype("<i4").tobytes(), times.astype("<i4").tobytes(),
                ]
                names = [field.split()[0] for field in INDEX.split(", ")]
                yield pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(row, kinds, strict=True)], names)


def index(docs: DataFrame) -> DataFrame:
    """The stored term counts of ``docs`` (doc_id, text): one row per segment. Null texts have no terms."""
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return stored(rows.mapInArrow(_segments, INDEX), fresh_folder(docs.sparkSession, "term-counts"))


def _item_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for first, data, offsets in text_blocks(batch.column("text")):
            words, bounds = word_hashes(data, offsets, PLAIN)
            found = [np.unique(words[a:b]) for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
            part = batch.slice(first, len(found))
            yield pa.RecordBatch.from_arrays(
                [
                    *part.select([name for name in part.schema.names if name != "text"]).columns,
                    pa.array([len(one) for one in found], pa.int64()),
                    pa.array([one.astype("<u8").tobytes() for one in found], pa.binary()),
                ],
                [*(name for name in part.schema.names if name != "text"), "n_terms", "terms"],
            )


class Block(NamedTuple):
    """Some queries: their terms as numbers into ``terms``, and what the collection says of these terms."""

    items: list[int]
    queries: list[np.ndarray]
    terms: np.ndarray
    weights: np.ndarray
    bands: np.ndarray
    documents: int
    length: int


class Ball:
    """A node: its documents, the sparse centroid and the radii."""

    __slots__ = ("docs", "terms", "centre", "radius", "radii", "children")

    def bound(self, query: np.ndarray, bands: np.ndarray) -> float:
        """What no document of the node can exceed."""
        at = np.minimum(np.searchsorted(self.terms, query), len(self.terms) - 1)
        held = self.terms[at] == query
        if not held.any():
            return 0.0
        product = float(self.centre[at[held]].sum())
        present = np.bincount(bands[query[held]], minlength=len(self.radii))
        by_band = float((np.sqrt(present) * self.radii).sum())
        return (product + min(by_band, math.sqrt(present.sum()) * self.radius)) * SAFE + 1


class BallTree:
    """Sparse rows of positive integers: row r holds ``values[starts[r]:starts[r + 1]]`` at ascending ``terms``."""

    def __init__(self, starts: np.ndarray, terms: np.ndarray, values: np.ndarray, bands: np.ndarray):
        self.starts, self.terms, self.values, self.bands = starts, terms, values, bands
        self.evaluated = self.scored = 0
        rows = np.flatnonzero(np.diff(starts))
        self.root = None
        open_nodes = []
        if len(rows):
            self.root = Ball()
            open_nodes.append((self.root, rows))
        while open_nodes:
            node, rows = open_nodes.pop()
            halves = self._fill(node, rows)
            if halves:
                node.children = (Ball(), Ball())
                open_nodes += zip(node.children, halves, strict=True)

    def _entries(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For every entry of ``rows``: which of them it belongs to, and its place."""
        sizes = self.starts[rows + 1] - self.starts[rows]
        owner = np.repeat(np.arange(len(rows)), sizes)
        return owner, np.arange(len(owner)) + np.repeat(self.starts[rows] - (np.cumsum(sizes) - sizes), sizes)

    def _fill(self, node: Ball, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray] | None:
        owner, at = self._entries(rows)
        terms, place = np.unique(self.terms[at], return_inverse=True)
        value = self.values[at].astype(np.float64)
        centre = np.bincount(place, value) / len(rows)
        node.docs, node.terms, node.centre, node.children = rows, terms, centre, None
        bands = int(self.bands.max()) + 1
        squares = np.bincount(self.bands[terms], centre * centre, bands)
        change = np.bincount(owner * bands + self.bands[terms][place], value * (value - 2 * centre[place]), len(rows) * bands)
        size = np.bincount(owner * bands + self.bands[terms][place], value * (value + 2 * centre[place]), len(rows) * bands)
        apart = np.maximum(change.reshape(len(rows), bands) + squares, 0) + 1e-12 * (size.reshape(len(rows), bands) + squares)
        node.radii = np.sqrt(apart.max(axis=0)) * SAFE
        node.radius = math.sqrt(apart.sum(axis=1).max()) * SAFE
        if len(rows) <= LEAF:
            return None
        norms = np.bincount(owner, value * value, len(rows))

        def products(row: int) -> np.ndarray:
            one = np.zeros(len(terms))
            one[place[owner == row]] = value[owner == row]
            return np.bincount(owner, value * one[place], len(rows))

        far = products(int(apart.sum(axis=1).argmax()))
        other = products(int((norms - 2 * far).argmax()))
        order = np.argsort(other - far, kind="stable")
        return rows[order[: len(rows) // 2]], rows[order[len(rows) // 2 :]]

    def scores(self, rows: np.ndarray, wanted: np.ndarray) -> np.ndarray:
        """Exact inner products of ``rows``; ``wanted`` marks the query's terms."""
        sizes = self.starts[rows + 1] - self.starts[rows]
        _, at = self._entries(rows)
        marked = np.where(wanted[self.terms[at]], self.values[at], 0)
        return np.add.reduceat(marked, np.cumsum(sizes) - sizes)

    def search(self, query: np.ndarray, best: Best) -> None:
        """Offer ``best`` every row that may belong to it, best bound first."""
        if self.root is None:
            return
        wanted = np.zeros(len(self.bands), bool)
        wanted[query] = True
        ticket = 0
        waiting = [(-self.root.bound(query, self.bands), ticket, self.root)]
        while waiting and -waiting[0][0] >= best.least:
            node = heapq.heappop(waiting)[2]
            if node.children is None:
                self.scored += len(node.docs)
                best.offer(self.scores(node.docs, wanted), node.docs)
                continue
            for child in node.children:
                self.evaluated += 1
                bound = child.bound(query, self.bands)
                if bound >= best.least:
                    ticket += 1
                    heapq.heappush(waiting, (-bound, ticket, child))


class Best:
    """The k best (score, doc_id) so far: highest score first, then smallest doc_id, null ids last."""

    def __init__(self, k: int, floor: int = 1):
        self.k, self.least = k, max(1, floor)
        self.found: list[tuple[int, int | None]] = []
        self.ids: list[int | None] = []

    def offer(self, scores: np.ndarray, rows: np.ndarray) -> None:
        good = np.flatnonzero(scores >= self.least)
        if len(good):
            self.found += [(int(scores[g]), self.ids[rows[g]]) for g in good]
            self.found.sort(key=lambda pair: (-pair[0], pair[1] is None, pair[1] or 0))
            del self.found[self.k :]
            if len(self.found) == self.k:
                self.least = max(self.least, self.found[-1][0])


def projected(row: dict, block: Block) -> BallTree:
    """The tree of a segment over the terms of a block of queries."""
    terms = np.frombuffer(row["terms"], "<u8")
    at = np.minimum(np.searchsorted(block.terms, terms), len(block.terms) - 1)
    number = np.where(block.terms[at] == terms, at, -1)
    codes, times = np.frombuffer(row["codes"], "<i4"), np.frombuffer(row["times"], "<i4").astype(np.int64)
    bounds = np.frombuffer(row["bounds"], "<i8")
    sizes = np.frombuffer(row["sizes"], "<i8").tolist()
    long = np.array([10 + 90 * n * block.documents // block.length for n in sizes], np.int64)
    mine = np.flatnonzero(number[codes] >= 0)
    owner = np.searchsorted(bounds, mine, "right") - 1
    term, times = number[codes[mine]], times[mine]
    values = block.weights[term] * ((1_000_000_000 * times) // (1000 * times + 8 * long[owner]))
    used = values > 0
    owner, term, values = owner[used], term[used], values[used]
    starts = np.searchsorted(owner, np.arange(len(sizes) + 1))
    return BallTree(starts, term, values, block.bands)


def _searched(
    batches: Iterator[pa.RecordBatch], block: Block, floors: list[int], k: int
) -> Iterator[pa.RecordBatch]:
    best = [Best(k, floor) for floor in floors]
    for batch in batches:
        for row in batch.to_pylist():
            tree = projected(row, block)
            for query, one in zip(block.queries, best, strict=True):
                one.ids = row["ids"]
                tree.search(query, one)
    found = [(item, doc, score) for item, one in zip(block.items, best, strict=True) for score, doc in one.found]
    columns = zip(*found, strict=True) if found else [[]] * 3
    yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["item", "doc_id", "score"])


def _held(batches: Iterator[pa.RecordBatch], wanted: np.ndarray) -> Iterator[pa.RecordBatch]:
    """How many documents of the partition hold each of some terms."""
    total = np.zeros(len(wanted), np.int64)
    for batch in batches:
        for terms, counts in zip(batch.column("terms").to_pylist(), batch.column("counts").to_pylist(), strict=True):
            terms, counts = np.frombuffer(terms, "<u8"), np.frombuffer(counts, "<i4")
            at = np.minimum(np.searchsorted(terms, wanted), len(terms) - 1)
            total += np.where(terms[at] == wanted, counts[at], 0)
    used = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(total[used])], ["term", "n"])


def _best(found: DataFrame, k: int) -> DataFrame:
    """The k best of every item, ranked. Salted shares are cut first, so no task sees all partitions' rows of an item."""
    order = [F.col("score").desc(), F.col("doc_id").asc_nulls_last()]
    salted = found.withColumn("salt", F.pmod(F.xxhash64("doc_id"), F.lit(SALTS)))
    for keys in (["item", "salt"], ["item"]):
        salted = salted.withColumn("rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
        salted = salted.where(F.col("rank") <= k)
    return salted.drop("salt")


def search(docs: DataFrame, items: DataFrame, k: int = 10, block_terms: int = BLOCK_TERMS) -> DataFrame:
    """(item_id, rank, doc_id, score): the ``k`` best documents of ``docs`` (doc_id, text) for each row of ``items`` (item_id, text).

    Terms are runs of ASCII letters, digits and non-ASCII characters of the whole text, A-Z lower-cased. With N documents that have terms, L
    terms in all, n terms in a document and df documents that hold a term, the term weighs w = floor(1000 * ln((2N + 2) / (2df + 1)))
    and tf occurrences add w * ((10^9 tf) div (1000 tf + 8m)) with m = 10 + (90 n N) div L; all but the logarithm in integers. Each
    different term of an item counts once. Only scores above 0 are returned, the highest first, ties by doc_id, null ids last.

    Null and empty texts have no terms. Rows that share an id are rows of their own on either side, each item row with its own
    ranks. Empty tables give no rows.
    """
    spark, segments = docs.sparkSession, index(docs)
    documents, length = segments.agg(F.sum("n_docs"), F.sum("n_terms")).first()
    asked = items.select("item_id", F.col("text").cast("string").alias("text")).withColumn("item", F.monotonically_increasing_id())
    asked = stored(
        asked.mapInArrow(
            _item_terms, f"item_id {items.schema['item_id'].dataType.simpleString()}, item bigint, n_terms bigint, terms binary"
        ).where("n_terms > 0"),
        fresh_folder(spark, "item-terms"),
    )
    folder = fresh_folder(spark, "ranked")
    blocks = (asked.agg(F.sum("n_terms")).first()[0] or 0) // block_terms + 1
    for number in range(blocks if documents else 0):
        mine = asked.where(F.pmod(F.xxhash64("item"), F.lit(blocks)) == number).select("item", "terms").collect()
        if not mine:
            continue
        block = _block(segments, mine, documents, length)
        floors = [1] * len(block.items)
        some = segments.where("pick = 0").mapInArrow(
            lambda rows, b=block, f=floors: _searched(rows, b, f, k), "item bigint, doc_id bigint, score bigint"
        )
        known = {row.item: row.score for row in _best(some, k).where(F.col("rank") == k).select("item", "score").collect()}
        floors = [known.get(item, 1) for item in block.items]
        found = segments.mapInArrow(
            lambda rows, b=block, f=floors: _searched(rows, b, f, k), "item bigint, doc_id bigint, score bigint"
        )
        _best(found, k).write.mode("append").parquet(folder)
    ranked = "item bigint, doc_id bigint, score bigint, rank int"
    nothing = spark.createDataFrame([], ranked)
    nothing.write.mode("append").parquet(folder)
    rows = spark.read.schema(ranked).parquet(folder)
    return rows.join(asked.select("item", "item_id"), "item").select("item_id", "rank", "doc_id", "score")


def _block(segments: DataFrame, rows: list, documents: int, length: int) -> Block:
    lists = [np.frombuffer(row.terms, "<u8") for row in rows]
    terms = np.unique(np.concatenate(lists))
    counted = segments.select("terms", "counts").mapInArrow(lambda batches: _held(batches, terms), "term bigint, n bigint")
    held = {row.term: row.n for row in counted.groupBy("term").agg(F.sum("n").alias("n")).collect()}
    weights = [math.floor(1000 * math.log((2 * documents + 2) / (2 * held.get(t, 0) + 1))) for t in range(len(terms))]
    weights = np.array(weights, np.int64)
    bands = np.empty(len(terms), np.int64)
    bands[np.argsort(-weights, kind="stable")] = np.arange(len(terms)) * BANDS // len(terms)
    queries = [np.searchsorted(terms, one) for one in lists]
    return Block([row.item for row in rows], queries, terms, weights, bands, documents, length)
