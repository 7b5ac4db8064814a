import corpus_pipeline
import pytest
from helpers import plain_words, spaced_words

from topicflow.llm import secrets

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    out = [docs]
    for name, stage in corpus_pipeline.STAGES:
        folder = str(tmp_path_factory.mktemp("stages") / name)
        stage(spark, out[-1], SMALL).write.parquet(folder)
        out.append(spark.read.parquet(folder))
    return out


def test_columns(stages):
    for found in stages[1:-1]:
        assert found.dtypes == stages[0].dtypes
    assert stages[-1].columns == ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]


def test_clean_documents_stay(stages):
    first, second = stages[0].count(), stages[1].count()
    assert second >= 0.97 * first


def shingles(text):
    w = spaced_words(text)
    return frozenset(tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))) if w else frozenset()


def test_one_of_each_group(stages):
    before = {r.doc_id: shingles(r.text) for r in stages[1].collect()}
    after = {r.doc_id for r in stages[2].collect()}
    group = {d: d for d in before}
    ids = sorted(before)
    for i, a in enumerate(ids):
        for b in ids[:i]:
            both = len(before[a] & before[b])
            if before[a] and 100 * both >= 80 * (len(before[a]) + len(before[b]) - both):
                old, new = group[a], group[b]
                group = {d: min(old, new) if g in (old, new) else g for d, g in group.items()}
    assert after == set(group.values())


def test_benchmark_is_gone(stages, spark):
    windows = set()
    for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").collect():
        w = plain_words(r.text)
        windows |= {tuple(w[i : i + 10]) for i in range(max(1, len(w) - 9)) if w}
    def hit(text):
        w = plain_words(text)
        return any(tuple(w[i : i + n]) in windows for n in {len(x) for x in windows} for i in range(len(w) - n + 1))
    kept = {r.doc_id for r in stages[3].collect()}
    assert kept == {r.doc_id for r in stages[2].collect() if not hit(r.text)}


def test_secrets_are_masked(stages):
    before = {r.doc_id: r for r in stages[3].collect()}
    for r in stages[4].collect():
        old = before[r.doc_id]
        assert r.n_chars == len(r.text)
        if r.text != old.text:
            assert secrets.MASK in r.text
        assert 'token = "' not in r.text or f'token = "{secrets.MASK}"' in r.text
    assert len(before) == stages[4].count()


def test_everything_is_packed(stages):
    pieces = stages[5].collect()
    assert {r.doc_id for r in pieces} == {r.doc_id for r in stages[4].collect()}
    fill = {}
    for r in pieces:
        fill[r.sequence_id] = fill.get(r.sequence_id, 0) + r.length
    assert max(fill.values()) <= 1024


def test_run_applies_the_stages(spark, stages):
    found = corpus_pipeline.run(spark, SMALL)
    assert found.count() == stages[-1].count() and found.dtypes == stages[-1].dtypes
