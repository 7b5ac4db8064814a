"""Benchmark decontamination over a distributed positional inverted index.

The index has one row per *segment*, a run of documents of about two megabytes of text. For each word hash of the
segment it stores the postings: the sorted positions of the word in the segment. Segments are made by one narrow pass,
so the index is spread like the documents and no posting list can grow beyond a segment, however common its word is.

A phrase is looked up in every segment: words are ordered by the length of their postings there, the rarest list, moved
back by the word's place in the phrase, gives candidate starts, and each further list is intersected with them. With a
``slop`` a word may lie that many places off (proximity).

Test items are handled in blocks of bounded size, one at a time: what a block has found is stored before the next one is
loaded, so neither the driver, a plan nor a task holds more than one.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from topicflow.llm.words import PLAIN, text_blocks, word_hashes
from topicflow.storage import fresh_folder, stored

ITEM_BLOCK_CHARS = 8 << 20  # characters of test items sent to the tasks at a time
INDEX = "ids array<bigint>, bounds binary, terms binary, starts binary, postings binary"


def _segments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One index row per block of documents."""
    kinds = [pa.list_(pa.int64()), *[pa.binary()] * 4]
    for batch in batches:
        for first, data, offsets in text_blocks(batch.column("text")):
            words, bounds = word_hashes(data, offsets, PLAIN)
            order = np.argsort(words, kind="stable").astype(np.int32)
            terms, starts = np.unique(words[order], return_index=True)
            ids = batch.column("doc_id").slice(first, len(offsets) - 1).to_pylist()
            row = [ids, *(x.tobytes() for x in (bounds.astype(np.int64), terms, starts.astype(np.int32), order))]
            yield pa.RecordBatch.from_arrays(
                [pa.array([value], kind) for value, kind in zip(row, kinds, strict=True)],
                ["ids", "bounds", "terms", "starts", "postings"],
            )


def positional_index(docs: DataFrame) -> DataFrame:
    """The stored index of all words of ``docs`` (doc_id, text). Null texts have no words."""
    made = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return stored(made.mapInArrow(_segments, INDEX), fresh_folder(docs.sparkSession, "index"))


class Phrases:
    """Distinct windows of a block of items: word hashes, and which items each window is of."""

    def __init__(self, items: list[tuple[str, str]], window: int):
        self.by_length: dict[int, tuple[np.ndarray, list[list[str]]]] = {}
        found: dict[tuple[int, ...], set[str]] = {}
        for first, data, offsets in text_blocks(pa.array([text for _, text in items], pa.string())):
            words, bounds = word_hashes(data, offsets, PLAIN)
            for number, (begin, end) in enumerate(zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True)):
                size = min(window, end - begin)
                for at in range(begin, end - size + 1) if size else ():
                    found.setdefault(tuple(words[at : at + size].tolist()), set()).add(items[first + number][0])
        for size in {len(words) for words in found}:
            chosen = [words for words in found if len(words) == size]
            self.by_length[size] = np.array(chosen, np.uint64), [sorted(found[words]) for words in chosen]


def occurrences(
    terms: np.ndarray, starts: np.ndarray, postings: np.ndarray, phrases: np.ndarray, slop: int = 0
) -> tuple[np.ndarray, np.ndarray]:
    """(phrase number, position of its first word) of every occurrence of ``phrases`` (phrases x words) in a segment."""
    none = np.empty(0, np.int64)
    if not len(terms) or not len(phrases):
        return none, none
    places = np.minimum(np.searchsorted(terms, phrases), len(terms) - 1)
    alive = np.flatnonzero((terms[places] == phrases).all(axis=1))
    if not len(alive):
        return none, none
    places = places[alive].astype(np.int64)
    ends = np.append(starts[1:], len(postings)).astype(np.int64)
    lengths = ends - starts
    rarity = np.argsort(lengths[places], axis=1, kind="stable")
    lists = np.repeat(np.arange(len(terms), dtype=np.int64), lengths)
    keys = (lists << 32) + postings  # sorted: by list, then by position
    rows = np.arange(len(alive))
    first = places[rows, rarity[:, 0]]
    count = lengths[first]
    which = np.repeat(rows, count)
    inner = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
    begin = postings[np.repeat(starts[first].astype(np.int64), count) + inner] - rarity[which, 0]
    which, begin = which[begin >= 0], begin[begin >= 0].astype(np.int64)
    for step in range(1, phrases.shape[1]):
        offset = rarity[which, step]
        wanted = (places[which, offset] << 32) + begin + offset
        at = np.minimum(np.searchsorted(keys, wanted - slop), len(keys) - 1)
        held = (keys[at] >= wanted - slop) & (keys[at] <= wanted + slop)
        which, begin = which[held], begin[held]
    return alive[which], begin


def _looked_up(batches: Iterator[pa.RecordBatch], phrases: Phrases, slop: int, last: bool) -> Iterator[pa.RecordBatch]:
    """Append to each segment a mark for each word that is hit and the items found in each document.

    After the last block of items the postings are no longer needed and left empty.
    """
    for batch in batches:
        for row in batch.to_pylist():
            bounds = np.frombuffer(row["bounds"], np.int64)
            terms = np.frombuffer(row["terms"], np.uint64)
            starts = np.frombuffer(row["starts"], np.int32)
            postings = np.frombuffer(row["postings"], np.int32)
            edges = np.zeros(int(bounds[-1]) + 1, np.int32)
            items: list[set[str]] = [set() for _ in row["ids"]]
            for size, (windows, owners) in phrases.by_length.items():
                which, begin = occurrences(terms, starts, postings, windows, slop)
                doc = np.searchsorted(bounds, begin, "right") - 1
                inside = begin + size <= bounds[np.minimum(doc + 1, len(bounds) - 1)]
                which, begin, doc = which[inside], begin[inside], doc[inside]
                np.add.at(edges, begin, 1)
                np.add.at(edges, begin + size, -1)
                for d, w in np.unique(np.stack([doc, which], 1), axis=0).tolist():
                    items[d].update(owners[w])
            marks = (np.cumsum(edges[:-1]) > 0).astype(np.uint8)
            row["exact"].append(np.packbits(marks).tobytes())
            row["items"].append(["\x00".join(sorted(one)) for one in items])
            if last:
                row |= {"terms": b"", "starts": b"", "postings": b""}
            yield pa.RecordBatch.from_arrays([pa.array([row[f.name]], f.type) for f in batch.schema], schema=batch.schema)


def _joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Put the lookups of several blocks of items over the same segment together: one row per document."""
    for batch in batches:
        for row in batch.to_pylist():
            bounds = np.frombuffer(row["bounds"], np.int64)
            marks = np.zeros((int(bounds[-1]) + 7) // 8, np.uint8)
            for one in row["exact"]:
                marks |= np.frombuffer(one, np.uint8)
            hits = np.concatenate([[0], np.cumsum(np.unpackbits(marks)[: int(bounds[-1])], dtype=np.int64)])
            names = [
                sorted({x for one in each if one for x in one.split("\x00")}) for each in zip(*row["items"], strict=True)
            ]
            n_hit = hits[bounds[1:]] - hits[bounds[:-1]]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(row["ids"], pa.int64()),
                    pa.array(np.diff(bounds)),
                    pa.array(n_hit),
                    pa.array([len(x) for x in names], pa.int64()),
                    pa.array([hashlib.sha256(",".join(x).encode()).hexdigest() for x in names]),
                    pa.array(n_hit > 0),
                    pa.array(names, pa.list_(pa.string())),
                ],
                ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated", "items"],
            )


def _usable(items: DataFrame) -> DataFrame:
    return items.where("item_id is not null and text is not null").select(
        F.col("item_id").cast("string").alias("item_id"), F.col("text").cast("string").alias("text")
    )


def item_block_count(items: DataFrame, block_chars: int) -> int:
    chars = _usable(items).agg(F.sum(F.length("text"))).first()[0] or 0
    return chars // block_chars + 1


def item_block(items: DataFrame, block: int, blocks: int) -> list[tuple[str, str]]:
    """The items of one of ``blocks`` blocks, chosen by hash."""
    mine = F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == block
    return [(row.item_id, row.text) for row in _usable(items).where(mine).toLocalIterator()]


def decontamination(
    docs: DataFrame, items: DataFrame, window: int = 10, slop: int = 0, block_chars: int = ITEM_BLOCK_CHARS
) -> DataFrame:
    """(doc_id, n_words, n_hit, n_items, items_sha256, contaminated, items) for every row of ``docs`` (doc_id, text).

    A window is ``window`` consecutive words of an item (item_id, text); an item of fewer words, but not none, is one
    window. ``n_hit`` counts the words inside any occurrence of a window, ``items`` are the ids with an occurring window,
    sorted as strings, ``items_sha256`` the lowercase hex digest of them joined by commas. With ``slop`` > 0 each word may
    be that many places off, and an occurrence covers the window's own length. Null and empty texts have no words and
    are never hit; items without id or without words take no part; items that share an id count once. Repeated rows
    and null doc_ids are reported one by one. Without items or rows nothing is contaminated.
    """
    found = positional_index(docs).selectExpr(
        "*", "cast(array() as array<binary>) as exact", "cast(array() as array<array<string>>) as items"
    )
    blocks = item_block_count(items, block_chars)
    for block in range(blocks):
        phrases, last = Phrases(item_block(items, block, blocks), window), block == blocks - 1
        found = found.mapInArrow(lambda rows, p=phrases, last=last: _looked_up(rows, p, slop, last), found.schema)
        if not last:  # so that neither the driver nor the next plan holds this block
            found = stored(found, fresh_folder(docs.sparkSession, "looked-up"))
    return found.mapInArrow(
        _joined,
        "doc_id bigint, n_words bigint, n_hit bigint, n_items bigint, items_sha256 string, contaminated boolean,"
        " items array<string>",
    )


def _clean(batches: Iterator[pa.RecordBatch], phrases: Phrases) -> Iterator[pa.RecordBatch]:
    """The rows of each batch in which no phrase occurs, by an index of the batch's segments."""
    for batch in batches:
        texts = batch.column("text").cast(pa.string())
        ids = pa.nulls(len(texts), pa.int64())
        hit = [np.empty(0, bool)]
        for segment in _segments(iter([pa.RecordBatch.from_arrays([ids, texts], ["doc_id", "text"])])):
            state = segment.append_column("exact", pa.array([[]], pa.list_(pa.binary())))
            state = state.append_column("items", pa.array([[]], pa.list_(pa.list_(pa.string()))))
            for found in _joined(_looked_up(iter([state]), phrases, 0, True)):
                hit.append(found.column("contaminated").to_numpy(zero_copy_only=False))
        yield batch.filter(pa.array(~np.concatenate(hit)))


def uncontaminated(
    docs: DataFrame, items: DataFrame, window: int = 10, block_chars: int = ITEM_BLOCK_CHARS
) -> DataFrame:
    """The rows of ``docs``, with all their columns, that hold no window of an item.

    A row is judged where it lies, through an index of its own segment, so nothing is shuffled. Null and empty texts stay. Repeated rows
    and rows without id are judged row by row. Without items every row stays; an empty table stays empty.
    """
    blocks = item_block_count(items, block_chars)
    for block in range(blocks):
        phrases = Phrases(item_block(items, block, blocks), window)
        docs = docs.mapInArrow(lambda rows, p=phrases: _clean(rows, p), docs.schema)
        if block < blocks - 1:  # so that neither the driver nor the next plan holds this block
            docs = stored(docs, fresh_folder(docs.sparkSession, "clean"))
    return docs
