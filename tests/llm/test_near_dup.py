import random
from collections import defaultdict

import pytest
from helpers import AWKWARD, frame, spaced_words

from topicflow.llm import near_dup
from topicflow.llm.graph import components


def brute(rows, percent):
    """doc_id -> (size, smallest reachable id) by comparing all pairs."""
    sets = []
    for _, text, *_ in rows:
        w = spaced_words(text)
        sets.append(frozenset(tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))) if w else frozenset())
    group = list(range(len(rows)))

    def find(x):
        while group[x] != x:
            x = group[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            both = len(a & sets[j])
            if a and 100 * both >= percent * (len(a) + len(sets[j]) - both):
                group[find(i)] = find(j)
    members = defaultdict(list)
    for i in range(len(rows)):
        members[find(i)].append(rows[i][0])
    out = []
    for i, row in enumerate(rows):
        ids = [x for x in members[find(i)] if x is not None]
        least = (min(ids) if ids else None) if sets[i] else row[0]
        out.append((row[0], len(sets[i]), least, row[0] == least))
    return sorted(out, key=str)


def found(frame_, percent):
    return sorted(map(tuple, near_dup.near_duplicates(frame_, percent).collect()), key=str)


def edited(rng, words, edits):
    words = list(words)
    for _ in range(edits):
        words[rng.randrange(len(words))] = f"new{rng.random()}"
    return " ".join(words)


@pytest.mark.parametrize("percent", [80, 85])
def test_like_all_pairs(spark, percent):
    rng = random.Random(percent)
    rows, number = list(AWKWARD), 100
    for base in range(6):
        words = [f"w{rng.randrange(4000)}" for _ in range(rng.choice([8, 40, 150]))]
        for copy in range(14):
            rows.append((number + 7 * copy % 60, edited(rng, words, rng.randrange(0, max(2, len(words) // 20)))))
        number += 100
    assert found(frame(spark, rows), percent) == brute(rows, percent)


def test_group_of_copies_linked_only_through_their_original(spark):
    """Edited copies are near the original but not near each other; some are only near another copy."""
    rng = random.Random(5)
    words = [f"w{i}" for i in range(200)]
    rows = [(1000, " ".join(words))] + [(i, edited(rng, words, rng.randrange(1, 6))) for i in range(330)]
    assert found(frame(spark, rows), 85) == brute(rows, 85)


def test_empty_table(spark):
    assert near_dup.near_duplicates(frame(spark, [])).collect() == []
    assert near_dup.one_of_each(frame(spark, [])).collect() == []


def test_one_of_each_keeps_columns_and_one_row(spark):
    text = " ".join(f"t{i}" for i in range(50))
    rows = [(5, text), (3, text), (3, text), (9, text + " more"), (6, "another text"), (1, None), (1, None), (2, " ")]
    docs = frame(spark, rows)
    kept = near_dup.one_of_each(docs)
    assert kept.columns == docs.columns
    assert sorted((r.doc_id, r.text) for r in kept.collect() if r.text) == [(2, " "), (3, text), (6, "another text")]
    assert kept.where("text is null").count() == 2


def test_groups_without_ids(spark):
    """Copies and near copies whose rows have no id: one stays, and those with an id go first."""
    words = [f"w{i}" for i in range(60)]
    near = [*words[:-1], "x"]
    other = [f"o{i}" for i in range(60)]
    rows = [(None, " ".join(words))] * 5 + [(None, " ".join(near)), (None, " ".join(other)), (8, " ".join(other[:-1]))]
    docs = frame(spark, rows)
    assert found(docs, 80) == brute(rows, 80)
    kept = near_dup.one_of_each(docs).collect()
    assert sorted((r.doc_id is None, r.text[0]) for r in kept) == [(False, "o"), (True, "w")]


def test_same_id_with_different_texts(spark):
    one, two = (" ".join(f"{c}{i}" for i in range(40)) for c in "ab")
    rows = [(3, one), (3, two), (3, one + " z"), (4, two)]
    assert found(frame(spark, rows), 80) == brute(rows, 80)
    kept = near_dup.one_of_each(frame(spark, rows)).collect()
    assert sorted((r.doc_id, r.text[0]) for r in kept) == [(3, "a"), (3, "b")]


def test_chunks_hold_every_pair_within_the_distance():
    distance, chunks = near_dup.plan_chunks(85)
    assert 2 * len(chunks) > distance
    assert sorted(i for chunk in chunks for i in chunk.tolist()) == list(range(near_dup.SYMBOLS))
    assert near_dup.plan_chunks(100)[0] == 0
    assert 0.85 * near_dup.LONG > near_dup.least_agreements(85) > 0.7 * near_dup.LONG


def test_components_of_chains_and_stars(spark):
    links = [(i, i + 1) for i in range(100, 140)] + [(7, i) for i in range(200, 260)] + [(1, 1), (None, 3)]
    found = dict(map(tuple, components(spark.createDataFrame(links, "a bigint, b bigint")).collect()))
    assert found == {i: 100 for i in range(100, 141)} | {7: 7} | {i: 7 for i in range(200, 260)}
