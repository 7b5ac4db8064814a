import numpy as np
import pytest

from topicflow.llm import neighbours


def brute(ids, vectors, query, k):
    scores = vectors @ vectors[query]
    order = sorted((i for i in range(len(ids)) if i != query), key=lambda i: (-scores[i], ids[i]))[:k]
    return [(ids[i], scores[i]) for i in order]


@pytest.fixture(scope="module")
def clustered(spark):
    rng = np.random.default_rng(1)
    centres = rng.normal(size=(8, 16))
    vectors = centres[rng.integers(0, 8, 1500)] + 0.4 * rng.normal(size=(1500, 16))
    vectors[100:130] = vectors[100]  # copies
    rows = [(i, v.tolist(), "x", "y") for i, v in enumerate(vectors)]
    return vectors, spark.createDataFrame(rows, "vec_id long, embedding array<double>, node string, score string")


def test_recall_against_brute_force(spark, clustered, monkeypatch):
    monkeypatch.setattr(neighbours, "CELL_BLOCK", 200)
    vectors, table = clustered
    found = neighbours.nearest(table, table.where("vec_id % 20 = 0"), k=10, neighbours=10, beam=60).collect()
    by_query, hits = {}, 0
    for r in found:
        by_query.setdefault(r.query_id, []).append(r)
    assert set(by_query) == set(range(0, 1500, 20))
    for query, rows in by_query.items():
        rows.sort(key=lambda r: r.rank)
        assert [r.rank for r in rows] == list(range(1, 11)) and query not in {r.vec_id for r in rows}
        assert np.allclose([r.score for r in rows], [vectors[r.vec_id] @ vectors[query] for r in rows], atol=1e-12)
        assert [(-r.score, r.vec_id) for r in rows] == sorted((-r.score, r.vec_id) for r in rows)
        hits += len({r.vec_id for r in rows} & {i for i, _ in brute(range(1500), vectors, query, 10)})
    assert hits >= 0.9 * 10 * len(by_query)


def test_copies_come_back_by_id(spark, clustered):
    vectors, table = clustered
    found = neighbours.nearest(table, table.where("vec_id in (110, 120)"), k=300, beam=400).collect()
    for query in (110, 120):
        copies = [r for r in sorted(found, key=lambda r: r.rank) if r.query_id == query and 100 <= r.vec_id < 130]
        assert [r.vec_id for r in copies] == [i for i in range(100, 130) if i != query]
        assert len({r.score for r in copies}) == 1 and copies[-1].rank == copies[0].rank + 28


def test_awkward_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0]), (20, [0.5, 1.0]), (1, None), (2, []), (3, [0.0, 0.0]), (4, [nan, 1.0]), (5, [inf, 1.0]),
            (6, [None, 1.0]), (7, [1.0, 2.0, 3.0]), (None, [1.0, 1.0]), (8, [0.5, 1.0]), (9, [-1.0, 0.0]), (20, [3.0, 3.0])]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    found = neighbours.nearest(table, table.where("vec_id % 20 = 0"), k=20).collect()
    assert {r.vec_id for r in found} == {0, 8, 9, 20}
    zero = sorted((r.rank, r.vec_id, r.score) for r in found if r.query_id == 0)
    assert zero == [(1, 20, 3.0), (2, 8, 0.5), (3, 20, 0.5), (4, 9, -1.0)]
    assert neighbours.nearest(table, table.where("vec_id = 3")).collect() == []
    assert neighbours.nearest(table.limit(0), table).collect() == []
    one = spark.createDataFrame([(1, [1.0])], "vec_id long, embedding array<double>")
    assert neighbours.nearest(one, one).collect() == []
