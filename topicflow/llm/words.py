"""Words, shingles and their 64-bit hashes, computed for whole Arrow columns at once with numpy.

A text is its UTF-8 bytes with A-Z lower-cased. A *word class* is a table of 256 booleans; as only ASCII characters ever
separate words, bytes are enough. Null and empty texts have no words. Texts are cut into *blocks* of a few megabytes, so
memory does not depend on the batch size; a single longer text is one block and is hashed in pieces cut between words.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

BLOCK_BYTES = 2 << 20
_ODD = 0x9E3779B97F4A7C15  # any odd number does
_INVERSE = pow(_ODD, -1, 1 << 64)


def _bytes_table(words: str) -> np.ndarray:
    table = np.ones(256, bool)
    if words == "spaced":  # everything but white space: [^\x20\x09-\x0D]
        table[[0x20, *range(0x09, 0x0E)]] = False
    elif words == "plain":  # letters, digits, non-ASCII: [^\x00-\x2F\x3A-\x60\x7B-\x7F] after lower-casing
        table[:0x80] = False
        table[ord("0") : ord("9") + 1] = True
        table[ord("a") : ord("z") + 1] = True
        table[ord("A") : ord("Z") + 1] = True
    return table


SPACED = _bytes_table("spaced")
PLAIN = _bytes_table("plain")


def lower_table() -> np.ndarray:
    table = np.arange(256, dtype=np.uint8)
    table[ord("A") : ord("Z") + 1] += 32
    return table


LOWER = lower_table()


def mixed(values: np.ndarray) -> np.ndarray:
    """A bijection on unsigned 64-bit numbers that spreads every bit."""
    values = values ^ (values >> np.uint64(30))
    values = values * np.uint64(0xBF58476D1CE4E5B9)
    values = values ^ (values >> np.uint64(27))
    values = values * np.uint64(0x94D049BB133111EB)
    return values ^ (values >> np.uint64(31))


def _powers(base: int, count: int) -> np.ndarray:
    steps = np.full(count, base, np.uint64)
    steps[0] = 1
    return np.multiply.accumulate(steps)


_BYTE_VALUES = mixed(LOWER.astype(np.uint64) + np.uint64(1))


def text_blocks(column: pa.Array, limit: int = BLOCK_BYTES) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(index of the first text, bytes, offsets of the texts in the bytes) for runs of about ``limit`` bytes."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string()).fill_null("")
    if not len(column):
        return
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    data = np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)
    first = 0
    while first < len(column):
        last = int(np.searchsorted(offsets, offsets[first] + limit, "right")) - 1
        last = min(max(last, first + 1), len(column))
        yield first, data[offsets[first] : offsets[last]], offsets[first : last + 1] - offsets[first]
        first = last


def word_hashes(data: np.ndarray, offsets: np.ndarray, is_word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words in order, and the number of words before each text's start (and the end)."""
    hashes, places, begin = [], [], 0
    while begin < len(data):
        end = min(len(data), begin + 2 * BLOCK_BYTES)
        while end < len(data) and is_word[data[end]]:  # never cut a word
            gaps = np.flatnonzero(~is_word[data[end : end + BLOCK_BYTES]])
            end = end + int(gaps[0]) if len(gaps) else min(len(data), end + BLOCK_BYTES)
        piece = data[begin:end]
        inside = is_word[piece]
        starts = inside.copy()
        starts[1:] &= ~inside[:-1]
        texts = offsets[np.searchsorted(offsets, begin) : np.searchsorted(offsets, end)] - begin
        starts[texts] = inside[texts]
        at = np.flatnonzero(starts)
        if len(at):
            values = _BYTE_VALUES[piece] * inside * _powers(_ODD, len(piece))
            sums = np.add.reduceat(values, at) * _powers(_INVERSE, len(piece))[at]
            hashes.append(mixed(sums))
            places.append(at + begin)
        begin = end
    if not hashes:
        return np.empty(0, np.uint64), np.zeros(len(offsets), np.int64)
    return np.concatenate(hashes), np.searchsorted(np.concatenate(places), offsets)


def run_hashes(words: np.ndarray, size: int) -> np.ndarray:
    """One hash for every run of ``size`` consecutive words."""
    count = len(words) - size + 1
    if count <= 0:
        return np.empty(0, np.uint64)
    total = np.zeros(count, np.uint64)
    factor = 1
    for shift in range(size):
        factor = factor * _ODD % (1 << 64)
        total += words[shift : shift + count] * np.uint64(factor)
    return mixed(total)


def shingle_sets(words: np.ndarray, bounds: np.ndarray, size: int) -> Iterator[np.ndarray]:
    """For each text the sorted distinct hashes of its runs of ``size`` words; shorter texts are one run."""
    runs = run_hashes(words, size)
    for begin, end in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
        if end - begin >= size:
            yield np.unique(runs[begin : end - size + 1])
        elif end > begin:
            yield mixed(run_hashes(words[begin:end], end - begin) + np.uint64(end - begin))
        else:
            yield np.empty(0, np.uint64)
