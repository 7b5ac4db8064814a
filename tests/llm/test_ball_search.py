import math
import random
from collections import Counter

import numpy as np
import pytest
from helpers import AWKWARD, frame, plain_words
from hypothesis import given, settings
from hypothesis import strategies as st

from topicflow.llm import ball_search

ITEM = "item_id string, text string, doc_id string, score string, rank string, item string, terms string"


def items_table(spark, items):
    return spark.createDataFrame([(i, t, "d", "s", "r", "i", "t") for i, t in items], ITEM)


def brute_force(docs, items, k):
    counted = [(doc, Counter(plain_words(text))) for doc, text, *_ in docs]
    counted = [(doc, words) for doc, words in counted if words]
    n, total = len(counted), sum(sum(words.values()) for _, words in counted)
    df = Counter(word for _, words in counted for word in words)
    rows = []
    for item, text in items:
        scores = []
        for doc, words in counted:
            m = 10 + 90 * sum(words.values()) * n // total
            score = 0
            for term in set(plain_words(text)):
                if tf := words.get(term):
                    score += math.floor(1000 * math.log((2 * n + 2) / (2 * df[term] + 1))) * (10**9 * tf // (1000 * tf + 8 * m))
            if score > 0:
                scores.append((-score, doc is None, doc or 0, doc))
        rows += [(item, rank, doc, -s) for rank, (s, _, _, doc) in enumerate(sorted(scores, key=lambda x: x[:3])[:k], 1)]
    return Counter(rows)


def corpus(rng, n):
    vocabulary = [f"w{int(rng.paretovariate(0.6)) % 4000}" for _ in range(4000)]
    groups = [rng.sample(vocabulary, 60) for _ in range(9)]
    return [(i, " ".join(rng.choice(rng.choice(groups) if rng.random() < 0.2 else groups[i % 9]) for _ in range(rng.randrange(1, 80)))) for i in range(n)]


@pytest.mark.parametrize("segment,block,share", [(2048, 16_384, 64), (50, 30, 2), (40, 1, 1)])
def test_equal_to_brute_force(spark, monkeypatch, segment, block, share):
    monkeypatch.setattr(ball_search, "SEGMENT_DOCS", segment)
    monkeypatch.setattr(ball_search, "FLOOR_SHARE", share)
    rng = random.Random(5)
    docs = list(AWKWARD) + corpus(rng, 700)
    docs += [(1000 + i, docs[40][1]) for i in range(120)]  # a large group of copies: ties go by doc_id
    items = [(str(i), docs[rng.randrange(20, 700)][1]) for i in range(25)]
    items += [("n", None), ("e", ""), ("x", "none of these"), ("0", "one ONE oNe"), (None, docs[40][1]), ("word", "WORD")]
    found = ball_search.search(frame(spark, docs).repartition(3), items_table(spark, items), k=10, block_terms=block)
    assert found.columns == ["item_id", "rank", "doc_id", "score"]
    assert Counter(map(tuple, found.collect())) == brute_force(docs, items, 10)


def test_empty_tables(spark):
    docs, items = frame(spark, [(1, "a b")]), items_table(spark, [("1", "a")])
    for d, i in [(frame(spark, []), items), (docs, items_table(spark, [])), (frame(spark, [(1, None), (2, " ")]), items)]:
        assert ball_search.search(d, i).collect() == []
    assert [tuple(r) for r in ball_search.search(docs, items, k=3).collect()] == sorted(brute_force([(1, "a b")], [("1", "a")], 3))


def tree_of(rows, terms, bands):
    starts = np.cumsum([0, *(len(r) for r in rows)])
    flat = [(t, v) for r in rows for t, v in sorted(r.items())]
    return ball_search.BallTree(
        starts, np.array([t for t, _ in flat], np.int64), np.array([v for _, v in flat], np.int64), np.arange(terms) % bands
    )


@settings(max_examples=150, deadline=None)
@given(st.integers(0, 10**9), st.sampled_from([3, 10**3, 25_000_000_000]), st.integers(1, 5))
def test_no_bound_is_exceeded(seed, top, bands):
    rng = random.Random(seed)
    rows = [{rng.randrange(20): rng.randrange(1, top) for _ in range(rng.randrange(8))} for _ in range(rng.randrange(120))]
    tree = tree_of(rows, 20, bands)
    for _ in range(5):
        query = np.array(sorted(rng.sample(range(20), rng.randrange(1, 12))))
        exact = [sum(v for t, v in r.items() if t in query) for r in rows]
        stack = [tree.root] if tree.root else []
        while stack:
            node = stack.pop()
            assert node.bound(query, tree.bands) >= max(exact[r] for r in node.docs.tolist())
            stack += node.children or ()
        best = ball_search.Best(4)
        best.ids = list(range(len(rows)))
        tree.search(query, best)
        wanted = sorted((-s, i) for i, s in enumerate(exact) if s > 0)[:4]
        assert [(-s, i) for s, i in best.found] == wanted


def test_subtrees_are_pruned():
    rng = random.Random(6)
    rows = [{100 * (i % 10) + rng.randrange(100): rng.randrange(50, 100) for _ in range(20)} for i in range(2000)]
    tree = tree_of(rows, 1000, 64)
    best = ball_search.Best(10)
    best.ids = list(range(2000))
    tree.search(np.array(sorted(rows[7])), best)
    assert best.found[0][1] == 7
    assert tree.scored < 600
