"""Token ids in files of directly addressable codes: any token is read without decoding what lies before it.

An id is split into *chunks*, lowest bits first. Level 0 holds the first chunk of every token, level 1 the second chunk of those
tokens that have one, and so on; a bitmap at each level but the last says which tokens go on. The place of a token in the next level
is the number of set bits before it (its *rank*), which a directory of counts every 512 bits gives in constant time.
The chunk widths are those that make the file smallest for its own ids.

File format, all numbers little-endian and every section padded to 8 bytes::

    magic      8 bytes   b"TOKDAC1\\n"
    counts     u64 x 3   tokens, documents, levels
    per level  u64 x 2   chunk width in bits, chunks
    doc ids    i64 x documents
    has id     1 bit x documents, in u64 words
    starts     u64 x (documents + 1)      tokens of the file before each document
    per level  chunks      width bits each, in u64 words, one spare word
               bitmap      1 bit x chunks, in u64 words         (not the last level)
               directory   u64 x (bitmap words / 8 + 1)         (not the last level) set bits before every 512th bit

What follows the last section is ignored (Spark's writer ends every file with a line break).

Files are written by Spark's writer, one per ``shard``, under ``shard=<n>/tokens=<n>/docs=<n>/``: ascending shards hold
ascending documents, and listing the folder is enough to know where each shard begins.
"""

from __future__ import annotations

import os
import sys
import types
import zlib
from collections.abc import Callable, Iterator, Sequence
from itertools import chain, compress, count, repeat

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from topicflow.llm.words import LOWER, text_blocks
from topicflow.storage import Store

MAGIC = b"TOKDAC1\n"
SHARD_BITS = 24  # shards of one partition
SHARD_TOKENS = 16 << 20
PACKED_AT_ONCE = 1 << 18  # a multiple of 64
TRAILING = "!\"#$%&()*+,-./:;=?@[\\]^_`{}~"  # not the apostrophe, which begins endings, nor marks of special strings
LAST_LATIN, DOTTED_I = "\u024f", "\u0130"
TEXT_BYTES = 4 << 20
REMEMBERED = 400_000  # parts of text whose ids a worker process keeps
LONGEST_REMEMBERED = 48
FILES = "path string, modificationTime timestamp, length bigint, content binary, shard bigint, tokens bigint, docs bigint"

Encode = Callable[[pa.Array], tuple[np.ndarray, np.ndarray]]


class SpacedEncoder:
    """Ids of whole texts by a tokenizer none of whose ids spans ASCII white space.

    For such a tokenizer the ids of a text are those of its white-space separated parts, one after another. Equal parts of a
    batch are encoded once, and short ones are remembered for the next batches.

    With ``folds`` the tokenizer is one that composes characters, lower-cases them one by one, keeps letters, digits and punctuation
    apart and marks the last id of each run of letters (``word_end``). Then parts in Latin letters, which are composed as they
    are, are lower-cased and parted from the punctuation behind them, and runs of letters are encoded as one text.
    """

    def __init__(self, tokenizer, folds: bool = False, word_end: str = "</w>"):
        self.tokenizer, self.folds = tokenizer, folds
        self.known: dict[str, int] = {}  # remembered parts by number
        self.ids, self.bounds = np.zeros(0, np.uint32), np.zeros(1, np.int64)  # their ids, and where those of each begin
        self.ends = np.zeros(max(tokenizer.get_vocab().values()) + 1, bool)
        self.ends[[number for token, number in tokenizer.get_vocab().items() if token.endswith(word_end)]] = True

    def _encoded(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all words, and how many each has."""
        lists = [encoding.ids for encoding in self.tokenizer.encode_batch_fast(words, add_special_tokens=False)]
        counts = np.fromiter(map(len, lists), np.int64, len(lists))
        return np.fromiter(chain.from_iterable(lists), np.uint32, counts.sum()), counts

    def _encoded_letters(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The same of runs of Latin letters: encoded as one text, cut behind the ids that end a run."""
        encodings = self.tokenizer.encode_batch_fast([" ".join(words)], add_special_tokens=False)  # keeps no offsets
        ids = np.array(encodings[0].ids, np.uint32)
        counts = np.diff(np.flatnonzero(self.ends[ids]), prepend=-1)
        return (ids, counts) if len(counts) == len(words) and counts.sum() == len(ids) else self._encoded(words)

    def _kind(self, word: str) -> int:
        """0 for letters that are encoded together, 1 for others, 2 for what is not remembered."""
        if len(word) > LONGEST_REMEMBERED:
            return 2
        letters = self.folds and word.isalpha() and (word.isascii() or (max(word) <= LAST_LATIN and DOTTED_I not in word))
        return 0 if letters else 1

    def _numbers(self, words: list[str]) -> np.ndarray:
        """The numbers of distinct parts. Those not known yet are encoded, those not to be remembered come last."""
        numbers = np.fromiter(map(self.known.get, words, repeat(-1)), np.int64, len(words))
        new = np.flatnonzero(numbers < 0)
        if len(new):
            kinds = np.fromiter((self._kind(words[at]) for at in new.tolist()), np.int8, len(new))
            new = new[np.argsort(kinds, kind="stable")]
            letters, others, _ = np.bincount(kinds, minlength=3).tolist()
            ordered, first = [words[at] for at in new.tolist()], len(self.known)
            found = [self._encoded_letters(ordered[:letters]), self._encoded(ordered[letters:])]
            self.known.update(zip(ordered[: letters + others], count(first)))
            self.ids = np.concatenate([self.ids, *(ids for ids, _ in found)])
            sizes = np.concatenate([counts for _, counts in found])
            self.bounds = np.concatenate([self.bounds, self.bounds[-1] + np.cumsum(sizes)])
            numbers[new] = first + np.arange(len(new))
        return numbers

    def _forget(self, words: list[str], numbers: np.ndarray) -> None:
        """Drop what is not to be remembered and, once too much is, all but the parts of these words."""
        kept = numbers < len(self.known)
        self.bounds = self.bounds[: len(self.known) + 1]
        self.ids = self.ids[: self.bounds[-1]]
        if len(self.known) > REMEMBERED:
            self.known = dict(zip(compress(words, kept), count()))
            self.ids, before = self._gathered(numbers[kept])
            self.bounds = before

    def _gathered(self, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of parts one after another, and how many there are before each (and the end)."""
        starts = self.bounds[numbers]
        before = np.concatenate([[0], np.cumsum(self.bounds[numbers + 1] - starts)])
        return self.ids[np.repeat(starts - before[:-1], np.diff(before)) + np.arange(before[-1])], before

    def __call__(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids in order, and the number of ids before each text (and the end). Null texts have none."""
        ids, sizes = [], [np.zeros(1, np.int64)]
        for _, data, offsets in text_blocks(texts, TEXT_BYTES):
            parts, bounds = parted(data, offsets, self.folds)
            coded = parts.dictionary_encode()
            words = coded.dictionary.to_numpy(zero_copy_only=False).tolist()
            numbers = self._numbers(words)
            found, before = self._gathered(numbers[coded.indices.to_numpy()])
            ids.append(found)
            sizes.append(np.diff(before[bounds]))
            self._forget(words, numbers)
        return np.concatenate([*ids, np.zeros(0, np.uint32)]), np.cumsum(np.concatenate(sizes))


def _marked(characters: str) -> np.ndarray:
    table = np.zeros(256, bool)
    table[list(characters.encode())] = True
    return table


IS_WHITE, IS_TRAILING = _marked(" \t\n\x0b\x0c\r"), _marked(TRAILING)
IS_LETTER = _marked("abcdefghijklmnopqrstuvwxyz")


def _folded(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The bytes with Latin parts lower-cased, and where the punctuation behind such parts begins.

    Only parts are touched whose characters are below U+0240 without the capital dotted i (and its neighbours, lead byte C4),
    none of which combine, and that have no mark of a special string.
    """
    other = (data > 0xC8) | (data == 0xC4) | (data == ord("<"))
    others = np.concatenate([[0], np.cumsum(other, dtype=np.int32)])
    latin = others[ends] == others[starts]
    inside = np.zeros(len(data) + 1, np.int8)
    inside[starts[latin]] += 1
    inside[ends[latin]] -= 1
    lower = LOWER[data]
    accented = np.flatnonzero(data[:-1] == 0xC3) + 1  # U+00C0 to U+00FF
    second = data[accented]
    capital = accented[(second <= 0x9E) & (second != 0x97)]
    lower[capital] += 0x20
    folded = np.where(np.cumsum(inside[:-1], dtype=np.int8).astype(bool), lower, data)
    place = np.arange(len(data), dtype=np.int32)
    last = np.maximum.accumulate(np.where(IS_TRAILING[folded], np.int32(-1), place))[ends - 1]
    cut = latin & (last >= starts) & (last + 1 < ends)
    last = last[cut]
    final, before = folded[last], folded[np.maximum(last - 1, 0)]
    letter = IS_LETTER[final] | ((before == 0xC3) & (final >= 0x80) & (final != 0x97) & (final != 0xB7))
    return folded, last[letter].astype(np.int64) + 1


def parted(data: np.ndarray, offsets: np.ndarray, folds: bool) -> tuple[pa.Array, np.ndarray]:
    """Texts cut into parts, the white space between them parts as well, and the number of parts before each text."""
    edges = np.zeros(len(data) + 1, bool)
    white = IS_WHITE[data]
    edges[1:-1] = white[1:] != white[:-1]
    edges[offsets] = True
    places = np.flatnonzero(edges)
    if folds and len(data):
        full = np.flatnonzero(~white[places[:-1]])
        data, cuts = _folded(data, places[full], places[full + 1])
        edges[cuts] = True
        places = np.flatnonzero(edges)
    buffers = [None, pa.py_buffer(places.astype(np.int64)), pa.py_buffer(np.ascontiguousarray(data))]
    return pa.LargeStringArray.from_buffers(len(places) - 1, buffers[1], buffers[2]), np.searchsorted(places, offsets)


def spaced_encoder(path: str, folds: bool = False) -> SpacedEncoder:
    """The encoder of a ``tokenizers`` file. Special strings in a text become their own ids, as that library has it.

    A worker process keeps it, with what it remembers, for its later tasks.
    """
    kept = sys.modules.setdefault("topicflow_worker_state", types.ModuleType("topicflow_worker_state")).__dict__
    if (path, folds) not in kept:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        from tokenizers import Tokenizer

        kept[path, folds] = SpacedEncoder(Tokenizer.from_file(path), folds)
    return kept[path, folds]


def best_widths(ids: np.ndarray, most: int = 4) -> list[int]:
    """Chunk widths, at most ``most``, for which the ids take the fewest bits, bitmaps included."""
    steps = np.array([1 << b for b in range(1, 33)], np.uint64)
    lengths = np.searchsorted(steps, ids, "right") + 1  # bits of each id, 1 at least
    having = np.bincount(lengths, minlength=34)[::-1].cumsum()[::-1]  # ids of at least so many bits
    top = int(lengths.max()) if len(ids) else 1
    best: dict[tuple[int, int], tuple[int, list[int]]] = {}
    for levels in range(1, most + 1):
        for begin in range(top - 1, -1, -1):  # the level begins at this bit
            count = int(having[begin + 1])
            choices = [(count * (top - begin), [top - begin])]
            for width in range(1, top - begin) if levels > 1 else ():
                cost, rest = best[levels - 1, begin + width]
                choices.append((count * (width + 1) + cost, [width, *rest]))
            best[levels, begin] = min(choices)
    return best[most, 0][1]


def _words(bits: np.ndarray) -> np.ndarray:
    packed = np.packbits(bits, bitorder="little")
    return np.concatenate([packed, np.zeros(-len(packed) % 8, np.uint8)]).view("<u8")


def _packed(values: np.ndarray, width: int) -> np.ndarray:
    """``width`` bits of each value, in words, and a spare word."""
    steps = np.arange(width, dtype=np.uint32)
    words = [
        _words(((values[at : at + PACKED_AT_ONCE, None] >> steps) & np.uint32(1)).astype(np.uint8).reshape(-1))
        for at in range(0, len(values), PACKED_AT_ONCE)
    ]
    return np.concatenate([*words, np.zeros(1, "<u8")])


def file_bytes(ids: np.ndarray, starts: np.ndarray, doc_ids: Sequence[int | None]) -> bytes:
    """A whole file: ``ids`` of all documents, where each begins (and the end), and the documents' ids."""
    ids = ids.astype(np.uint32, copy=False)
    widths = best_widths(ids)
    sections, counts, left = [], [], ids
    for level, width in enumerate(widths):
        counts.append(len(left))
        sections.append(_packed(left & np.uint32((1 << width) - 1), width))
        if level < len(widths) - 1:
            rest = left >> np.uint32(width)
            bitmap = _words(rest != 0)
            sums = np.concatenate([[0], np.cumsum(np.bitwise_count(bitmap), dtype=np.uint64)]).astype("<u8")
            sections += [bitmap, np.append(sums[:-1:8], sums[-1])]
            left = rest[rest != 0]
    head = [len(ids), len(doc_ids), len(widths), *(n for pair in zip(widths, counts, strict=True) for n in pair)]
    named = np.array([i is not None for i in doc_ids], bool)
    numbers = np.array([i or 0 for i in doc_ids], "<i8")
    parts = [np.array(head, "<u8"), numbers, _words(named), starts.astype("<u8"), *sections]
    return MAGIC + b"".join(part.tobytes() for part in parts)


class TokenFile:
    """A file's bytes (also a memory map), read where needed."""

    def __init__(self, buffer):
        if bytes(buffer[: len(MAGIC)]) != MAGIC:
            raise ValueError("not a token file")
        self._buffer, self._at = buffer, len(MAGIC)
        self.tokens, self.documents, levels = self._take(3).tolist()
        shape = self._take(2 * levels).reshape(-1, 2).tolist()
        numbers, named = self._take(self.documents).view("<i8"), self._take(-(-self.documents // 64))
        self.doc_ids = [
            n if one else None for n, one in zip(numbers.tolist(), self._bits(named, np.arange(self.documents)), strict=True)
        ]
        self.starts = self._take(self.documents + 1).astype(np.int64)
        self._levels = []
        for level, (width, count) in enumerate(shape):
            chunks, bitmap, directory = self._take(-(-count * width // 64) + 1), None, None
            if level < levels - 1:
                bitmap = self._take(-(-count // 64))
                directory = self._take(-(-len(bitmap) // 8) + 1)
            self._levels.append((width, chunks, bitmap, directory))

    def _take(self, count: int) -> np.ndarray:
        found = np.frombuffer(self._buffer, "<u8", count, self._at)
        self._at += 8 * count
        return found

    @staticmethod
    def _bits(words: np.ndarray, at: np.ndarray) -> np.ndarray:
        return (words[at >> 6] >> (at & 63).astype(np.uint64)) & np.uint64(1) != 0

    @staticmethod
    def _rank(bitmap: np.ndarray, directory: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Set bits before each place: the directory's count, whole words after it, and a part of a word."""
        word, block = at >> 6, at >> 9
        found = directory[block].astype(np.int64)
        for step in range(7):
            inside = (block << 3) + step
            whole = inside < word
            found[whole] += np.bitwise_count(bitmap[inside[whole]])
        below = (np.uint64(1) << (at & 63).astype(np.uint64)) - np.uint64(1)
        return found + np.bitwise_count(bitmap[word] & below)

    @staticmethod
    def _chunks(chunks: np.ndarray, width: int, at: np.ndarray) -> np.ndarray:
        bit = at * width
        low, part = bit >> 6, (bit & 63).astype(np.uint64)
        high = np.where(part > 0, chunks[low + 1] << (np.uint64(63) - (part - np.uint64(1)) % np.uint64(64)), 0)
        return ((chunks[low] >> part) | high) & np.uint64((1 << width) - 1)

    def ids(self, places: np.ndarray) -> np.ndarray:
        """The ids of the tokens at ``places``, in any order."""
        at = np.asarray(places, np.int64)
        if len(at) and not 0 <= at.min() <= at.max() < self.tokens:
            raise IndexError("no such token")
        found, shift, alive = np.zeros(len(at), np.uint64), 0, np.arange(len(at))
        for width, chunks, bitmap, directory in self._levels:
            found[alive] |= self._chunks(chunks, width, at) << np.uint64(shift)
            if bitmap is None:
                break
            more = self._bits(bitmap, at)
            alive, at, shift = alive[more], self._rank(bitmap, directory, at[more]), shift + width
        return found.astype(np.uint32)

    def all_ids(self) -> np.ndarray:
        """The ids of all tokens. Levels are read from end to end, so no ranks are needed."""
        found, shift, alive = np.zeros(self.tokens, np.uint32), 0, None
        for width, chunks, bitmap, _ in self._levels:
            count, kept = self.tokens if alive is None else len(alive), []
            for begin in range(0, count, PACKED_AT_ONCE):
                at = np.arange(begin, min(count, begin + PACKED_AT_ONCE))
                mine = slice(begin, begin + len(at)) if alive is None else alive[at]
                found[mine] |= self._chunks(chunks, width, at).astype(np.uint32) << np.uint32(shift)
                if bitmap is not None:
                    more = at[self._bits(bitmap, at)]
                    kept.append(more if alive is None else alive[more])
            alive, shift = np.concatenate([*kept, np.zeros(0, np.int64)]), shift + width
        return found

    def document(self, number: int) -> np.ndarray:
        return self.ids(np.arange(self.starts[number], self.starts[number + 1]))


def _encoded(
    batches: Iterator[pa.RecordBatch], make_encoder: Callable[[], Encode], end_id: int, shard_tokens: int
) -> Iterator[pa.RecordBatch]:
    """Files of about ``shard_tokens`` tokens, from the documents of a partition in order."""
    encode, shard = make_encoder(), TaskContext.get().partitionId() << SHARD_BITS
    ids, sizes, names, waiting = [], [], [], 0

    def written() -> pa.RecordBatch:
        starts = np.concatenate([[0], np.cumsum(np.concatenate(sizes))])
        content = file_bytes(np.concatenate(ids), starts, names)
        row = [[shard], [int(starts[-1])], [len(names)], [content]]
        kinds = [pa.int64(), pa.int64(), pa.int64(), pa.large_binary()]
        return pa.RecordBatch.from_arrays(
            [pa.array(v, k) for v, k in zip(row, kinds, strict=True)], ["shard", "tokens", "docs", "content"]
        )

    for batch in batches:
        if not len(batch):
            continue
        found, bounds = encode(batch.column("text"))
        ids.append(np.insert(found, bounds[1:], end_id).astype(np.uint32))
        sizes.append(np.diff(bounds) + 1)
        names += batch.column("doc_id").to_pylist()
        waiting += len(ids[-1])
        if waiting >= shard_tokens:
            yield written()
            ids, sizes, names, waiting, shard = [], [], [], 0, shard + 1
    if names:
        yield written()


def write(
    docs: DataFrame,
    make_encoder: Callable[[], Encode],
    folder: str,
    end_id: int = 1,
    shard_tokens: int = SHARD_TOKENS,
) -> str:
    """Write the ids of every row of ``docs`` (doc_id, text), each followed by ``end_id``, in ascending doc_id order.

    ``make_encoder`` makes, in the task, a function from an Arrow array of texts to all ids and the texts' bounds. Null and empty texts
    are just the end id. Rows without id come last; rows that share an id are ordered by a hash of their text. An
    empty table gives a folder without shards. A file ends with the batch that fills it, and one document is never cut.
    """
    place = [F.col("doc_id").asc_nulls_last(), F.col("tie").asc()]
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    ordered = rows.withColumn("tie", F.xxhash64("text")).repartitionByRange(*place).sortWithinPartitions(*place)
    shards = ordered.select("doc_id", "text").mapInArrow(
        lambda batches: _encoded(batches, make_encoder, end_id, shard_tokens),
        "shard bigint, tokens bigint, docs bigint, content binary",
    )
    named = shards.select("shard", "tokens", "docs", F.col("content").cast("string").alias("value"))  # bytes as they are
    named.write.partitionBy("shard", "tokens", "docs").option("compression", "none").text(folder)
    return folder


def files(spark: SparkSession, folder: str) -> DataFrame:
    """(shard, tokens, docs, content) of every file. Without ``content`` nothing is opened."""
    columns = ["shard", "tokens", "docs", "content"]
    if not any(name.startswith("shard=") for name in Store(spark, folder).names(folder)):
        return spark.createDataFrame([], FILES).select(columns)
    return spark.read.format("binaryFile").schema(FILES).option("pathGlobFilter", "*.txt").load(folder).select(columns)


def shard_starts(spark: SparkSession, folder: str) -> DataFrame:
    """(shard, tokens, first): tokens of all shards before each one; one line per file, from the listing."""
    earlier = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    listed = files(spark, folder).select("shard", "tokens")
    return listed.withColumn("first", F.coalesce(F.sum("tokens").over(earlier), F.lit(0)))


def _documents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for shard, content in zip(batch.column("shard").to_pylist(), batch.column("content"), strict=True):
            file = TokenFile(content.as_buffer())
            ids, cuts = file.all_ids().astype("<u4", copy=False), file.starts.tolist()
            digests = [zlib.crc32(ids[a:b]) for a, b in zip(cuts[:-1], cuts[1:], strict=True)]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.full(file.documents, shard, np.int64)),
                    pa.array(file.doc_ids, pa.int64()),
                    pa.array(file.starts[:-1]),
                    pa.array(np.diff(file.starts)),
                    pa.array(digests, pa.int64()),
                ],
                ["shard", "doc_id", "inside", "n_tokens", "ids_crc32"],
            )


def read_documents(spark: SparkSession, folder: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document, read back from the files.

    ``start`` is the number of ids of all documents before it, ``ids_crc32`` the checksum of its ids as little-endian 32-bit numbers.
    """
    rows = files(spark, folder).select("shard", "content").mapInArrow(
        _documents, "shard bigint, doc_id bigint, inside bigint, n_tokens bigint, ids_crc32 bigint"
    )
    placed = rows.join(shard_starts(spark, folder).select("shard", "first"), "shard")
    return placed.select("doc_id", (F.col("first") + F.col("inside")).alias("start"), "n_tokens", "ids_crc32")


def tokens_at(spark: SparkSession, folder: str, places: Sequence[int]) -> DataFrame:
    """(place, id) of the tokens at the given places of the whole corpus. Opens only the files that hold them."""
    wanted = sorted(set(places))
    spans = shard_starts(spark, folder).where(F.col("tokens") > 0)
    asked = F.array(*(F.lit(place).cast("bigint") for place in wanted))
    inside = F.filter(asked, lambda p: (p >= F.col("first")) & (p < F.col("first") + F.col("tokens")))
    held = {row.shard: (row.first, row.inside) for row in spans.select("shard", "first", inside.alias("inside")).where("size(inside) > 0").collect()} if wanted else {}

    def looked_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for shard, content in zip(batch.column("shard").to_pylist(), batch.column("content"), strict=True):
                first, mine = held[shard]
                at = np.array(mine, np.int64)
                ids = TokenFile(content.as_buffer()).ids(at - first)
                yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(ids.astype(np.int64))], ["place", "id"])

    chosen = files(spark, folder).where(F.col("shard").isin(list(held) or [-1])).select("shard", "content")
    return chosen.mapInArrow(looked_up, "place bigint, id bigint")
