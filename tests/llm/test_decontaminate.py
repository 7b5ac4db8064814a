import hashlib
import random

import pytest
from helpers import AWKWARD, frame, plain_words

from topicflow.llm import decontaminate


def brute(docs, items, window):
    windows = {}
    for item, text, *_ in items:
        w = plain_words(text)
        n = min(window, len(w))
        for i in range(len(w) - n + 1) if item is not None and n else ():
            windows.setdefault(tuple(w[i : i + n]), set()).add(str(item))
    sizes = {len(w) for w in windows}
    out = []
    for doc, text, *_ in docs:
        w, owners = plain_words(text), set()
        hit = [0] * len(w)
        for n in sizes:
            for i in range(len(w) - n + 1):
                found = windows.get(tuple(w[i : i + n]))
                if found:
                    owners |= found
                    hit[i : i + n] = [1] * n
        digest = hashlib.sha256(",".join(sorted(owners)).encode()).hexdigest()
        out.append((doc, len(w), sum(hit), len(owners), digest, any(hit)))
    return sorted(out, key=str)


def tables(spark, seed=1):
    rng = random.Random(seed)
    text = lambda n: " ".join(rng.choice("abcdefgh") for _ in range(n))
    docs = list(AWKWARD) + [(i, text(rng.randrange(1, 120)) + rng.choice(["", "! A-B c.D"])) for i in range(20, 60)]
    items = [(i, text(rng.choice([0, 1, 3, 5, 9]))) for i in range(12)]
    items += [(3, "one"), (None, "a b c"), (12, None), (13, "word word word"), (2, " ".join(plain_words(docs[20][1])[:7]))]
    return frame(spark, docs), spark.createDataFrame(items, "item_id int, text string"), docs, items


@pytest.mark.parametrize("block_chars", [8 << 20, 20])
def test_like_brute_force_in_one_or_many_blocks(spark, block_chars):
    docs, items, doc_rows, item_rows = tables(spark)
    found = decontaminate.decontamination(docs, items, window=5, block_chars=block_chars)
    assert sorted((tuple(r)[:-1] for r in found.collect()), key=str) == brute(doc_rows, item_rows, 5)


def test_clean_rows_stay_whole(spark):
    docs, items, doc_rows, item_rows = tables(spark, 2)
    kept = decontaminate.uncontaminated(docs, items, window=5)
    dirty = {str(r[0]) for r in brute(doc_rows, item_rows, 5) if r[-1]}
    assert kept.columns == docs.columns and len(dirty) > 3
    assert {str(r.doc_id) for r in kept.collect()} & dirty <= {"None", "7"}
    assert kept.count() == sum(not r[-1] for r in brute(doc_rows, item_rows, 5))


def test_empty_tables(spark):
    docs, items, *_ = tables(spark)
    assert decontaminate.decontamination(docs.limit(0), items).collect() == []
    assert decontaminate.decontamination(docs, items.limit(0)).where("contaminated").count() == 0
    assert decontaminate.uncontaminated(docs, items.limit(0)).count() == docs.count()


def test_proximity(spark):
    docs = spark.createDataFrame([(1, "a x b c"), (2, "a b c"), (3, "c b a z"), (4, "a x x x b c")], "doc_id int, text string")
    items = spark.createDataFrame([(1, "a b c")], "item_id int, text string")
    exact = decontaminate.decontamination(docs, items, window=3).where("n_items > 0")
    near = decontaminate.decontamination(docs, items, window=3, slop=1).where("n_items > 0")
    assert {r.doc_id for r in exact.collect()} == {2}
    assert {r.doc_id for r in near.collect()} == {1, 2}
