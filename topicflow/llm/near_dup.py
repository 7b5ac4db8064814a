"""Near duplicates by a multi-index Hamming join over b-bit MinHash signatures, confirmed on full shingle sets.

A document's set holds its distinct runs of ``shingle`` words. Its signature has 64 symbols of 16 bits, one per MinHash
function; at Jaccard similarity s two signatures differ in about 64 * (1 - s) symbols. ``plan_chunks`` picks the
signature distance ``t`` so that a pair at the threshold exceeds it with probability ``miss`` at most, and cuts the 64
positions into ``m`` chunks with 2 * m > t: by pigeonhole two signatures within distance ``t`` agree on some chunk but
for one symbol. So every chunk is indexed once for each symbol left out, and all pairs within ``t`` share a key.

Pairs are never listed for whole groups:

* equal sets are one class, and only classes are joined;
* within each key, members are paired with one representative, the class whose keys are the fullest (the original of a
  group of edited copies), and confirmed; confirmed links give components;
* then, within each key, only classes of *different* components remain to be paired, each with the members outside its
  component. The members of a key are dealt into blocks, and blocks are compared in tasks of bounded size. A pair is
  looked at once, at the first key it shares, and must be within the signature distance and the size ratio; a longer
  signature made from the full sets drops the pairs that are clearly below the threshold. What is left is confirmed.
  This step is complete, so no link within the signature distance is lost.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from topicflow.llm.graph import components
from topicflow.llm.words import SPACED, mixed, shingle_sets, text_blocks, word_hashes
from topicflow.storage import fresh_folder, stored

SYMBOLS = 64
LONG = 512  # symbols of 8 bits of the longer signature
# rows with an id come before those without; equal ids are told apart by their texts
FIRST_ROW = "min(named_struct('no_id', doc_id is null, 'doc_id', doc_id, 'text_hash', text_hash)) as first_row"
BLOCK = 256  # members of a key that are compared with as many others in one task
SET_WORDS = 1 << 18  # shingles hashed at a time


def plan_chunks(percent: int, miss: float = 1e-4) -> tuple[int, list[np.ndarray]]:
    """The signature distance for a threshold in percent, and the symbol positions of every chunk."""
    differs, total, distance = 1 - percent / 100, 0.0, -1
    while total < 1 - miss and distance < SYMBOLS:
        distance += 1
        total += math.comb(SYMBOLS, distance) * differs**distance * (1 - differs) ** (SYMBOLS - distance)
    chunks = min(distance // 2 + 1, SYMBOLS // 2)
    return distance, [np.arange(start, SYMBOLS, chunks) for start in range(chunks)]


def least_agreements(percent: int, miss: float = 1e-6) -> int:
    """In how many of ``LONG`` symbols a pair at the threshold agrees at least, but for probability ``miss``."""
    agrees = percent / 100 + (1 - percent / 100) / 256
    total, count = 0.0, -1
    while total < miss and count < LONG:
        count += 1
        ways = math.lgamma(LONG + 1) - math.lgamma(count + 1) - math.lgamma(LONG - count + 1)
        total += math.exp(ways + count * math.log(agrees) + (LONG - count) * math.log1p(-min(agrees, 1 - 1e-12)))
    return max(count - 1, 0)


def signatures(values: np.ndarray, bounds: np.ndarray, symbols: int = SYMBOLS, seed: int = 0) -> np.ndarray:
    """MinHash symbols (sets x symbols, 16 bits) of concatenated sets that are not empty."""
    seeds = mixed(np.arange(1, 2 * symbols + 1, dtype=np.uint64) + np.uint64(seed << 32))
    low = (values >> np.uint64(32)).astype(np.uint32)
    out = np.empty((len(bounds) - 1, symbols), np.uint16)
    for symbol in range(symbols):
        flip = np.uint32(seeds[2 * symbol] & np.uint64(0xFFFFFFFF))
        odd = np.uint32(seeds[2 * symbol + 1] & np.uint64(0xFFFFFFFF)) | np.uint32(1)
        least = np.minimum.reduceat((low ^ flip) * odd, bounds[:-1])
        out[:, symbol] = mixed(least.astype(np.uint64)) & np.uint64(0xFFFF)
    return out


def _signed(batches: Iterator[pa.RecordBatch], shingle: int) -> Iterator[pa.RecordBatch]:
    """doc_id, hash of the text, n_shingles, digest of the set, signature."""
    for batch in batches:
        for first, data, offsets in text_blocks(batch.column("text")):
            sets = list(shingle_sets(*word_hashes(data, offsets, SPACED), shingle))
            sizes = np.array([len(s) for s in sets], np.int64)
            digests = [hashlib.blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None for s in sets]
            full = np.flatnonzero(sizes)
            signs: list[bytes | None] = [None] * len(sets)
            for begin, end, bounds in _set_runs(sizes[full]):
                made = signatures(np.concatenate([sets[i] for i in full[begin:end]]), bounds)
                for i, row in zip(full[begin:end].tolist(), made, strict=True):
                    signs[i] = row.tobytes()
            ids, hashes = (batch.column(name).slice(first, len(sets)) for name in ("doc_id", "text_hash"))
            yield pa.RecordBatch.from_arrays(
                [ids, hashes, pa.array(sizes), pa.array(digests, pa.binary()), pa.array(signs, pa.binary())],
                ["doc_id", "text_hash", "n_shingles", "digest", "signature"],
            )


def _keyed(batches: Iterator[pa.RecordBatch], chunks: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
    """node, key, slot: for each chunk and symbol left out (the slot), a hash of the chunk's other symbols."""
    for batch in batches:
        nodes = batch.column("node").to_numpy(zero_copy_only=False)
        signs = np.frombuffer(b"".join(batch.column("signature").to_pylist()), np.uint16).reshape(-1, SYMBOLS)
        wide = signs.astype(np.uint64)
        for number, chunk in enumerate(chunks):
            parts = mixed(wide[:, chunk] + (chunk.astype(np.uint64) << np.uint64(20)))
            whole = parts.sum(axis=1, dtype=np.uint64)
            for place in range(len(chunk)):
                tag = np.uint64((number << 8 | place) + 1)
                key = mixed(whole - parts[:, place] + mixed(np.array([tag]))[0])
                slots = np.full(len(nodes), number << 8 | place, np.int32)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(nodes), pa.array(key.view(np.int64)), pa.array(slots)], ["node", "key", "slot"]
                )


def _set_runs(sizes: np.ndarray) -> Iterator[tuple[int, int, np.ndarray]]:
    """(first, end, bounds) of runs of sets with about ``SET_WORDS`` members together; ``sizes`` are not 0."""
    begin = 0
    while begin < len(sizes):
        ends = np.cumsum(sizes[begin:])
        count = max(1, int(np.searchsorted(ends, SET_WORDS, "right")))
        yield begin, begin + count, np.concatenate([[0], ends[:count]])
        begin += count


def _long_signs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """node and the longer signature of its full set."""
    for batch in batches:
        sets = [np.frombuffer(members, np.uint64) for members in batch.column("members").to_pylist()]
        signs: list[bytes] = []
        for begin, end, bounds in _set_runs(np.array([len(s) for s in sets], np.int64)):
            made = signatures(np.concatenate(sets[begin:end]), bounds, LONG, seed=1).astype(np.uint8)
            signs += [row.tobytes() for row in made]
        yield pa.RecordBatch.from_arrays([batch.column("node"), pa.array(signs, pa.binary())], ["node", "long"])


class _Members:
    """Rows of block pairs as arrays."""

    def __init__(self, table: pa.Table):
        self.open = table.column("open").to_numpy()
        self.node, self.label, self.main, self.size, self.slot = (
            table.column(name).to_numpy() for name in ("node", "label", "main", "n_shingles", "slot")
        )
        self.sign = np.frombuffer(b"".join(table.column("signature").to_pylist()), np.uint16).reshape(-1, SYMBOLS)
        self.long = np.frombuffer(b"".join(table.column("long").to_pylist()), np.uint8).reshape(-1, LONG)


def _pairs(rows: _Members, begin: int, end: int, percent: int, distance: int, chunks, agree: int) -> np.ndarray:
    """Candidate pairs between the open and the other members of one block pair, rows ``begin`` to ``end``."""
    opened = rows.open[begin:end]
    one, two = np.flatnonzero(opened) + begin, np.flatnonzero(~opened) + begin
    out = [np.empty((0, 2), np.int64)]
    for first in range(0, len(one) if len(two) else 0, 32):
        part = one[first : first + 32]
        left, right = rows.size[part][:, None], rows.size[two][None]
        wanted = rows.label[part][:, None] != rows.label[two][None]
        wanted &= (rows.label[two] == rows.main[begin])[None] | (rows.node[part][:, None] < rows.node[two][None])
        wanted &= 100 * np.minimum(left, right) >= percent * np.maximum(left, right)
        if not wanted.any():
            continue
        wanted &= (rows.sign[part][:, None] != rows.sign[two][None]).sum(axis=2) <= distance
        x, y = np.nonzero(wanted)
        if not len(x):
            continue
        a, b = part[x], two[y]
        unlike = rows.sign[a] != rows.sign[b]
        bad = np.stack([unlike[:, chunk].sum(axis=1) for chunk in chunks], axis=1)
        chunk = (bad <= 1).argmax(axis=1)  # the first key they share
        place = np.zeros(len(a), np.int64)
        for number in set(chunk.tolist()):
            mine = chunk == number
            place[mine] = unlike[mine][:, chunks[number]].argmax(axis=1)
        here = (chunk << 8 | place) == rows.slot[begin]
        a, b = a[here], b[here]
        for at in range(0, len(a), 4096):
            i, j = a[at : at + 4096], b[at : at + 4096]
            near = (rows.long[i] == rows.long[j]).sum(axis=1) >= agree
            ends = np.stack([rows.node[i[near]], rows.node[j[near]]], 1)
            out.append(np.sort(ends, axis=1))
    return np.concatenate(out)


def _blocks_compared(batches, percent: int, distance: int, chunks, agree: int) -> Iterator[pa.RecordBatch]:
    """a, b: candidate pairs of all block pairs; rows come sorted by block pair, which may span batches."""
    held: list[pa.RecordBatch] = []

    def compared(table: pa.Table, whole: bool) -> tuple[np.ndarray, int]:
        """The pairs of the finished block pairs, and where the unfinished one begins."""
        marks = np.stack([table.column(n).to_numpy().astype(np.int64) for n in ("key", "slot", "i", "j")])
        cuts = np.flatnonzero((marks[:, 1:] != marks[:, :-1]).any(axis=0)) + 1
        borders = [0, *cuts.tolist()] + ([table.num_rows] if whole else [])
        rows = _Members(table)
        found = [np.empty((0, 2), np.int64)]
        for begin, end in zip(borders[:-1], borders[1:], strict=True):
            if end - begin > 1:
                found.append(_pairs(rows, begin, end, percent, distance, chunks, agree))
        return np.concatenate(found), borders[-1]

    for batch in batches:
        if not batch.num_rows:
            continue
        held.append(batch)
        table = pa.Table.from_batches(held)
        pairs, rest = compared(table, whole=False)
        held = table.slice(rest).to_batches()
        yield pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], ["a", "b"])
    if held:
        pairs, _ = compared(pa.Table.from_batches(held), whole=True)
        yield pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], ["a", "b"])


def _full_sets(batches: Iterator[pa.RecordBatch], shingle: int) -> Iterator[pa.RecordBatch]:
    """node, members: the whole set of a row whose text has the class's digest."""
    for batch in batches:
        for first, data, offsets in text_blocks(batch.column("text")):
            sets = list(shingle_sets(*word_hashes(data, offsets, SPACED), shingle))
            wanted = batch.column("digest").slice(first, len(sets)).to_pylist()
            nodes = batch.column("node").slice(first, len(sets)).to_pylist()
            kept = [
                (n, s.tobytes())
                for n, s, d in zip(nodes, sets, wanted, strict=True)
                if len(s) and hashlib.blake2b(s.tobytes(), digest_size=16).digest() == d
            ]
            yield pa.RecordBatch.from_arrays(
                [pa.array([n for n, _ in kept], pa.int64()), pa.array([s for _, s in kept], pa.binary())],
                ["node", "members"],
            )


def _confirmed(batches: Iterator[pa.RecordBatch], percent: int) -> Iterator[pa.RecordBatch]:
    """The pairs with 100 * intersection >= percent * union."""
    for batch in batches:
        held = []
        for row, (one, two) in enumerate(
            zip(batch.column("one").to_pylist(), batch.column("two").to_pylist(), strict=True)
        ):
            one, two = np.frombuffer(one, np.uint64), np.frombuffer(two, np.uint64)
            if len(one) > len(two):
                one, two = two, one
            if 100 * len(one) < percent * len(two):
                continue
            at = np.minimum(np.searchsorted(two, one), len(two) - 1)
            both = int(np.count_nonzero(two[at] == one))
            if 100 * both >= percent * (len(one) + len(two) - both):
                held.append(row)
        yield batch.select(["a", "b"]).take(pa.array(held, pa.int64()))


class _Join:
    """The join of one table: its stored classes, shared keys and confirmed links."""

    def __init__(self, docs: DataFrame, percent: int, shingle: int):
        self.spark, self.percent, self.shingle = docs.sparkSession, percent, shingle
        texts = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
        self.texts = texts.withColumn("text_hash", F.xxhash64("text"))
        self.distance, self.chunks = plan_chunks(percent)
        self.rows = self._store(
            self.texts.mapInArrow(
                lambda batches: _signed(batches, shingle),
                "doc_id bigint, text_hash bigint, n_shingles bigint, digest binary, signature binary",
            ),
            "rows",
        )
        self.classes = self._store(
            self.rows.where("digest is not null")
            .groupBy("digest")
            .agg(
                F.expr(FIRST_ROW),
                F.first("n_shingles").alias("n_shingles"),
                F.first("signature").alias("signature"),
            )
            .select("digest", "first_row.*", "n_shingles", "signature")
            .withColumn("node", F.monotonically_increasing_id()),
            "classes",
        )

    def _store(self, frame: DataFrame, label: str) -> DataFrame:
        return stored(frame, fresh_folder(self.spark, label))

    def labels(self) -> DataFrame:
        """(node, label): the component of every class that has a link."""
        chunks = self.chunks
        keys = self.classes.select("node", "signature").mapInArrow(
            lambda batches: _keyed(batches, chunks), "node bigint, key bigint, slot int"
        )
        shared = keys.groupBy("key").agg(F.count(F.lit(1)).alias("members")).where("members > 1")
        keyed = self._store(keys.join(shared, "key"), "keyed")
        weight = keyed.groupBy("node").agg(F.sum("members").alias("weight"))
        heads = (
            keyed.join(weight, "node").groupBy("key").agg(F.max(F.struct("weight", "node"))["node"].alias("head"))
        )
        pairs = (
            keyed.join(heads, "key")
            .where("node <> head")
            .select(F.least("node", "head").alias("a"), F.greatest("node", "head").alias("b"))
            .distinct()
        )
        tried = self._store(pairs, "pairs")
        involved = keyed.select("node").distinct()
        sets = self._store(self._sets(involved), "sets")
        links = self._store(self._confirm(tried, sets), "links")
        labels = components(links)
        rest = self._store(self._across(keyed, labels, sets).join(tried, ["a", "b"], "left_anti"), "pairs")
        if rest.isEmpty():
            return labels
        more = self._store(self._confirm(rest, sets), "links")
        return labels if more.isEmpty() else components(links.union(more))

    def _sets(self, involved: DataFrame) -> DataFrame:
        """The full sets of classes, from the texts of their first rows. Rows repeated in full are combined."""
        wanted = self.classes.join(involved, "node").select(
            "node", "digest", F.col("doc_id").alias("from_id"), F.col("text_hash").alias("from_hash")
        )
        shingle = self.shingle
        return (
            self.texts.join(wanted, (F.col("text_hash") == F.col("from_hash")) & F.col("doc_id").eqNullSafe(F.col("from_id")))
            .select("node", "digest", "text")
            .mapInArrow(lambda batches: _full_sets(batches, shingle), "node bigint, members binary")
            .groupBy("node")
            .agg(F.first("members").alias("members"))
        )

    def placed(self) -> DataFrame:
        """digest, doc_id and text_hash of its first row, label: every class and its component."""
        joined = self.classes.join(self.labels(), "node", "left")
        return joined.select("digest", "no_id", "doc_id", "text_hash", F.coalesce("label", "node").alias("label"))

    def _confirm(self, pairs: DataFrame, sets: DataFrame) -> DataFrame:
        percent = self.percent
        one = sets.select(F.col("node").alias("a"), F.col("members").alias("one"))
        two = sets.select(F.col("node").alias("b"), F.col("members").alias("two"))
        return (
            pairs.join(one, "a")
            .join(two, "b")
            .select("a", "b", "one", "two")
            .mapInArrow(lambda batches: _confirmed(batches, percent), "a bigint, b bigint")
        )

    def _across(self, keyed: DataFrame, labels: DataFrame, sets: DataFrame) -> DataFrame:
        """Candidate pairs that share a key and lie in different components."""
        placed = keyed.join(labels, "node", "left").select(
            "key", "slot", "node", F.coalesce("label", "node").alias("label")
        )
        placed = self._store(placed, "placed")
        parts = placed.groupBy("key", "label").agg(F.count(F.lit(1)).alias("n"))
        open_keys = (
            parts.groupBy("key")
            .agg(F.count(F.lit(1)).alias("labels"), F.sum("n").alias("n"), F.max(F.struct("n", "label")).alias("most"))
            .where("labels > 1")
            .select(
                "key",
                F.col("most.label").alias("main"),
                F.ceil(F.col("n") / BLOCK).cast("int").alias("blocks"),
                F.ceil((F.col("n") - F.col("most.n")) / BLOCK).cast("int").alias("open_blocks"),
            )
        )
        members = self._store(placed.join(open_keys, "key"), "open")
        longer = sets.join(members.select("node").distinct(), "node").mapInArrow(_long_signs, "node bigint, long binary")
        signs = self._store(
            self.classes.select("node", "n_shingles", "signature").join(longer, "node"), "longer"
        )
        block = "pmod(xxhash64(node), {})"
        rows = (
            members.withColumn("open", F.explode(F.expr("if(label <> main, array(true, false), array(false))")))
            .withColumn("own", F.expr(f"cast(if(open, {block.format('open_blocks')}, {block.format('blocks')}) as int)"))
            .withColumn("other", F.explode(F.expr("sequence(0, if(open, blocks, open_blocks) - 1)")))
            .withColumns({"i": F.expr("if(open, own, other)"), "j": F.expr("if(open, other, own)")})
            .select("key", "slot", "i", "j", "open", "node", "label", "main")
        )
        percent, distance, chunks = self.percent, self.distance, self.chunks
        agree = least_agreements(percent)
        return (
            rows.join(signs, "node")
            .repartition("key", "slot", "i", "j")
            .sortWithinPartitions("key", "slot", "i", "j")
            .mapInArrow(
                lambda batches: _blocks_compared(batches, percent, distance, chunks, agree), "a bigint, b bigint"
            )
        )


def near_duplicates(docs: DataFrame, percent: int = 80, shingle: int = 5) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) for every row of ``docs`` (doc_id, text; other columns are ignored).

    Rows are linked when ``100 * intersection >= percent * union`` of their shingle sets. ``component_id`` is the
    smallest doc_id reachable over links, ``kept`` says it is the row's own. A text with fewer words than ``shingle``
    is one shingle. Rows with null or wordless text have no shingle, are linked with nothing and kept. Null ids are
    never a component's id unless all its ids are null; then component_id is null and kept true. Repeated rows are
    judged one by one, so rows that share the id are kept together. An empty table gives no rows.
    """
    join = _Join(docs, percent, shingle)
    placed = join.placed()
    smallest = placed.groupBy("label").agg(F.min("doc_id").alias("component_id"))
    by_digest = join._store(placed.join(smallest, "label").select("digest", "component_id"), "classes")
    found = (
        join.rows.drop("signature", "text_hash")
        .join(by_digest, "digest", "left")
        .withColumn("component_id", F.when(F.col("digest").isNull(), F.col("doc_id")).otherwise(F.col("component_id")))
    )
    return found.select("doc_id", "n_shingles", "component_id", F.expr("doc_id <=> component_id").alias("kept"))


def one_of_each(docs: DataFrame, percent: int = 80, shingle: int = 5) -> DataFrame:
    """``docs`` without near copies, all columns as they were: one row of each group stays, the one with the smallest
    id (with any id before those without). Rows without words all stay; of rows with the same id and text one stays."""
    join = _Join(docs, percent, shingle)
    kept = join.placed().groupBy("label").agg(F.expr(FIRST_ROW)).select("first_row.*")
    kept = kept.select(F.col("doc_id").alias("__kept_id"), F.col("text_hash").alias("__kept_hash"))
    worded = F.coalesce(F.col("text").rlike(r"[^\x20\x09-\x0D]"), F.lit(False))
    same_id = F.col("doc_id").cast("bigint").eqNullSafe(F.col("__kept_id"))
    chosen = (
        docs.where(worded)
        .join(kept, (F.xxhash64(F.col("text").cast("string")) == F.col("__kept_hash")) & same_id)
        .select(docs.columns)
        .dropDuplicates(["doc_id", "text"])
    )
    return docs.where(~worded).unionByName(chosen)
