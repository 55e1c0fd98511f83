"""Exact top-k by the impact-ordered index: against all inner products."""

from __future__ import annotations

import math

import numpy as np
import pytest

from slotwise.llm import impact_topk as topk
from slotwise.llm.common import prepare

TABLE = "vec_id long, embedding array<double>, id string, v string, block int, g int, rank int, score int"


def vectors(spark, rows):
    prepare(spark)
    return spark.createDataFrame([(i, v, "i", "v", 1, 2, 3, 4) for i, v in rows], TABLE)


def brute_force(rows, every, k):
    whole = {(i, tuple(max(-topk.LIMIT, min(topk.LIMIT, math.floor(1024 * x))) for x in v)) for i, v in rows
             if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)}
    out = set()
    for q in {i for i, _ in whole if i % every == 0}:
        found = [(max(-2**63, min(2**63 - 1, sum(a * b for a, b in zip(x, y)))), i)
                 for j, x in whole if j == q for i, y in whole if i != q]
        found.sort(key=lambda f: (-f[0], f[1]))
        out |= {(q, r, i, s) for r, (s, i) in enumerate(found[:k], 1)}
    return out


def search(spark, rows, every, k):
    whole = topk.whole_vectors(vectors(spark, rows))
    found = topk.top_k(whole, whole.where(f"id % {every} = 0"), k)
    assert found.columns == ["query_id", "rank", "vec_id", "score"]
    out = found.collect()
    assert len(out) == len({tuple(r) for r in out})
    return {tuple(r) for r in out}


@pytest.mark.parametrize("kind", ["even", "clusters", "copies", "skewed"])
def test_equals_all_inner_products(spark, monkeypatch, kind):
    monkeypatch.setattr(topk, "BLOCK", 150)
    monkeypatch.setattr(topk, "PART", 90)                  # some blocks have several parts
    monkeypatch.setattr(topk, "QUERY_GROUP", 8)
    monkeypatch.setattr(topk, "RESCORE", 12)
    rng = np.random.RandomState(8)
    x = rng.randn(700, 9)
    if kind == "clusters":
        x = rng.randn(7, 9)[rng.randint(0, 7, 700)] + 0.1 * x
    elif kind == "copies":                                 # a third is one vector, and it is a query
        x[::3] = x[0]
    elif kind == "skewed":
        x = np.exp(3 * x) * (rng.rand(700, 9) < 0.3)
    rows = [(i, v.tolist()) for i, v in enumerate(x)]
    assert search(spark, rows, 25, 10) == brute_force(rows, 25, 10)


def test_odd_rows_have_defined_results(spark):
    rows = [(0, [1.0, 2.0]), (0, [1.0, 2.0]), (0, [-1.0, 0.5]), (2, None), (3, []), (4, [None, 1.0]), (5, [float("nan"), 1.0]),
            (6, [float("inf")]), (7, [3.0, 3.0, 9.0]), (8, [0.0001, -0.0001]), (None, [5.0, 5.0]), (10, [1e300, 1.0]), (-10, [-7.0]),
            (20, [3e15, 1e15]), (21, [1.0, 2.0]), (22, [1.0, 2.0]), (30, [0.0, 0.5]), (40, [0.0])]
    assert search(spark, rows, 10, 4) == brute_force(rows, 10, 4)


def test_empty_and_tiny_tables(spark):
    assert search(spark, [], 1, 3) == set()
    assert search(spark, [(5, [1.0])], 1, 3) == set()
    assert search(spark, [(0, []), (1, [])], 1, 3) == {(0, 1, 1, 0), (1, 1, 0, 0)}


def test_reading_stops_on_proof():
    rng = np.random.RandomState(2)
    centres = 40 * rng.randn(50, 16)
    values = np.floor(centres[rng.randint(0, 50, 6_000)] + rng.randn(6_000, 16)).astype(np.int64)
    ids = np.arange(6_000, dtype=np.int64)
    names = ["block", "part", "dim", "low", "step", "ends", "slots", "ids", "size"]
    part = topk.Part([dict(zip(names, r)) for r in topk.index_rows(0, 0, ids, values)])
    shares = []
    for q in range(0, 6_000, 200):
        found, scores, read = part.search(values[q], q, 10, None)
        dots = values @ values[q]
        wanted = [i for i in np.lexsort((ids, -dots)) if i != q][:10]
        assert found == wanted and scores == dots[wanted].tolist()
        shares.append(read / values.size)
    assert np.mean(shares) < 0.9
    assert part.search(values[0], 0, 10, 10 ** 12) == ([], [], 0)     # a floor no member can reach
