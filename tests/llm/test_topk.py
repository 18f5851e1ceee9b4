"""Top-k search against scores of all pairs."""

import math
import random

import numpy as np
import pytest

from riskloom.llm import topk


def brute(rows, k, every):
    usable = {}
    for i, v in rows:
        if i is None or v is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        grid = [math.floor(64 * x) for x in v]
        usable[i] = min(usable.get(i, grid), grid)
    out = []
    for q in (i for i in usable if i % every == 0):
        scored = [(-sum(a * b for a, b in zip(usable[q], v)), i) for i, v in usable.items() if i != q]
        out += [(q, rank, i, -score) for rank, (score, i) in enumerate(sorted(scored)[:k], 1)]
    return sorted(out)


def found(spark, rows, k=5, every=4):
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    return sorted(map(tuple, topk.top_inner_products(df, k=k, query_every=every).collect()))


def vectors(n, width, seed=1):
    rng = random.Random(seed)
    return [(i, [float(np.float32(rng.gauss(0, 0.2))) for _ in range(width)], 0) for i in range(n)]


def test_against_all_pairs(spark, monkeypatch):
    monkeypatch.setattr(topk, "BLOCK_ROWS", 64)
    monkeypatch.setattr(topk, "QUERY_GROUP", 32)
    rows = vectors(400, 12)
    assert found(spark, rows) == brute([r[:2] for r in rows], 5, 4)


def test_ties_nulls_and_odd_vectors(spark):
    rows = [
        (0, [1.0, 0.0], None), (4, [0.5, 0.5], None), (1, [1.0, 1.0], 1), (2, [1.0, 1.0], 1), (3, [1.0, 1.0], 1),
        (5, [float("nan"), 1.0], 1), (6, [float("inf"), 1.0], 1), (7, None, 1), (None, [9.0, 9.0], 1),
        (9, [None, 3.0], 1), (8, [], 1), (11, [0.25], 1), (1, [1.0, 1.0], 1),
    ]
    assert found(spark, rows, k=3) == brute([r[:2] for r in rows], 3, 4)


def test_fewer_candidates_than_k_and_empty(spark):
    rows = [(0, [1.0], 0), (1, [-2.0], 0)]
    assert found(spark, rows, k=20) == [(0, 1, 1, -8192)]
    assert found(spark, [(0, [1.0], 0)]) == []
    assert found(spark, []) == []


@pytest.mark.parametrize("scale", [1.0, 1e3, 1e6])
def test_bounds_stay_exact_for_large_components(scale):
    rng = np.random.default_rng(3)
    vectors = (rng.standard_normal((300, 8)) * 64 * scale).astype(np.int64)
    lists = topk.SortedLists(np.arange(300), vectors, int(np.abs(vectors).max()))
    got = {q: (ids.tolist(), scores.tolist()) for q, ids, scores in lists.search(np.arange(10), vectors[:10], 7)}
    for q in range(10):
        scores = vectors @ vectors[q]
        order = [i for i in np.lexsort((np.arange(300), -scores)) if i != q][:7]
        assert got[q] == (order, scores[order].tolist())


def test_stops_before_the_lists_end():
    """With one far better group, outsiders are cut off before the last round."""
    rng = np.random.default_rng(5)
    vectors = rng.integers(-3, 4, (1000, 4))
    vectors[:6] = 60
    lists = topk.SortedLists(np.arange(1000), vectors, 60)
    lists.rounds = lists.rounds[:-1] + [None]  # the last round must not be needed
    (_, ids, scores), = lists.search(np.array([0]), vectors[:1], 5)
    assert ids.tolist() == [1, 2, 3, 4, 5] and set(scores.tolist()) == {14400}
