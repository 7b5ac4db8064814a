import random
import zlib
from collections import defaultdict

import numpy as np
import pytest
from helpers import AWKWARD, frame
from hypothesis import given, settings
from hypothesis import strategies as st

from topicflow.llm import packing, queries

P = pytest.importorskip("public_tokenizers")


@pytest.fixture(scope="module")
def tokenizer():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(P.path("byte_bpe_50k.json"))


def checked(found, docs, tokenizer, size):
    """The pieces of every row, and their place in gapless sequences."""
    pieces = defaultdict(list)
    for r in found:
        pieces[r.doc_id].append(r)
    expected = defaultdict(list)
    for doc, text, *_ in docs:
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 2]
        first = len(ids) % size or size
        cuts = [0, *range(first, len(ids) + 1, size)] if first < len(ids) else [0, len(ids)]
        for k, (a, b) in enumerate(zip(cuts, cuts[1:], strict=False)):
            expected[doc].append((k, a, b - a, zlib.crc32(np.array(ids[a:b], "<u4").tobytes())))
    assert {d: sorted((r.piece, r.start, r.length, r.ids_crc32) for r in rs) for d, rs in pieces.items()} == {
        d: sorted(rs) for d, rs in expected.items()
    }
    sequences = defaultdict(list)
    for r in found:
        sequences[r.sequence_id].append((r.offset, r.length))
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= size
    return len(sequences)


@pytest.mark.parametrize("group", [200_000, 40])
def test_round_trip(spark, tokenizer, monkeypatch, group):
    monkeypatch.setattr(packing, "GROUP", group)
    rng = random.Random(1)
    docs = list(AWKWARD) + [(i, "word! " * rng.randrange(0, 90) + "<|endoftext|> é漢\n\n  x") for i in range(100, 500)]
    found = packing.pack(frame(spark, docs), queries.encoder, size=128).collect()
    count = checked(found, docs, tokenizer, 128)
    assert count <= 1.03 * sum(r.length for r in found) / 128 + 2


@settings(max_examples=150, deadline=None)
@given(st.dictionaries(st.integers(1, 60), st.integers(1, 40), max_size=12))
def test_patterns_are_best_fit(counts):
    made = packing.patterns(counts, 60)
    held = defaultdict(int)
    for lengths, bins in made:
        assert sum(lengths) <= 60 and bins > 0
        for length in lengths:
            held[length] += bins
    assert held == counts
    items = np.array([length for length, n in counts.items() for _ in range(n)], np.int64)
    plain = len(packing.best_fit(items, 60)[2])
    assert plain * 0.95 - 2 <= sum(bins for _, bins in made) <= plain * 1.05 + 2


def test_all_bins_merged_at_once(spark):
    rng = random.Random(8)
    fills = [rng.choice([100, 100, rng.randrange(1, 128)]) for _ in range(900)] + [28] * 200  # one fill has a third of all bins
    rows = [(7 * n + 3, fill) for n, fill in enumerate(fills)]
    found = packing._merged_at_once(spark.createDataFrame(rows, "bin bigint, fill bigint").repartition(3), 128).collect()
    assert sorted(r.bin for r in found) == sorted(b for b, _ in rows)
    fill_of, bins = dict(rows), defaultdict(list)
    for r in found:
        bins[r.into].append((r["at"], fill_of[r.bin], r.fill))
    for into, parts in bins.items():
        at = 0
        for begin, fill, total in sorted(parts):
            assert begin == at and total == sum(f for _, f, _ in parts) <= 128
            at += fill
        assert min(parts)[1] == fill_of[into]
    assert len(bins) <= len(packing.best_fit(np.array(fills, np.int64), 128)[2]) * 1.02 + 1


def test_empty_table(spark):
    assert packing.pack(frame(spark, []), queries.encoder).collect() == []


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 50), max_size=60))
def test_best_fit_fills_bins(lengths):
    bins, offsets, fills = packing.best_fit(np.array(lengths, np.int64), 50)
    at = defaultdict(list)
    for b, o, n in zip(bins.tolist(), offsets.tolist(), lengths, strict=True):
        at[b].append((o, n))
    for b, parts in at.items():
        total = 0
        for o, n in sorted(parts):
            assert o == total
            total += n
        assert total == fills[b] <= 50
    assert sum(f <= 25 for f in fills) <= 1  # two half-empty bins would have been one


def test_ids_like_the_tokenizers_library(tokenizer):
    encode = queries.encoder()
    end = "<|endoftext|>"

    @settings(max_examples=300, deadline=None)
    @given(st.lists(st.one_of(st.text(alphabet=st.characters(codec="utf-8"), max_size=30), st.just(end), st.sampled_from("<|>dx ")), max_size=6))
    def same(parts):
        text = "".join(parts)
        assert encode(text) == tokenizer.encode(text, add_special_tokens=False).ids

    same()
    for text in (end, end + end, f"a{end}b", f" {end} ", f"{end}\n\n{end}x{end}", "<|endoftext |>", "<|ENDOFTEXT|>", f"<|{end}|>"):
        assert encode(text) == tokenizer.encode(text, add_special_tokens=False).ids
        assert encode(text).count(50256) == text.count(end)
    text = end + " \u2003 \x85\x1c \u200b it's 12345 ÀÉ \ud7ff"
    assert encode(text) == tokenizer.encode(text, add_special_tokens=False).ids
