import math

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tests.conftest import SMALL
from tideline.llm import cover_search as search


def brute(rows, top=5, every=50):
    whole = {}
    for i, v in rows:
        if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v):
            whole[i] = [math.floor(256 * x) for x in v]
    out = []
    for q, x in whole.items():
        if q % every == 0:
            held = lambda s: max(-(2**63), min(2**63 - 1, s))
            scored = sorted((-held(sum(a * b for a, b in zip(x, y))), i) for i, y in whole.items() if i != q)[:top]
            out += [(q, k + 1, i, -s) for k, (s, i) in enumerate(scored)]
    return sorted(out)


def found(spark, rows, **more):
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    return sorted(map(tuple, search.top_products(frame.withColumns({k: F.lit(v) for k, v in more.items()})).collect()))


@settings(max_examples=60, deadline=None)
@given(st.integers(0, 10**6), st.integers(1, 400), st.integers(1, 300), st.integers(1, 6), st.sampled_from([1, 3, 1000]))
def test_dual_search_is_exact(seed, n, m, width, spread):
    rng = np.random.default_rng(seed)
    c, q = rng.integers(-spread, spread + 1, (n, width)).astype(float), rng.integers(-spread, spread + 1, (m, width)).astype(float)
    ids, scores = search.dual_search(q, np.arange(m), np.full(m, -np.inf), c, np.arange(n), 5)
    for i in range(m):
        want = sorted((-float(c[j] @ q[i]), j) for j in range(n) if j != i)[:5]
        want += [(0, -1)] * (5 - len(want))
        assert [(-s, j) for s, j in zip(scores[i], ids[i])] == want


def test_trees_cover_and_prune():
    rng = np.random.default_rng(1)
    centres = rng.normal(size=(40, 8)) * 100
    points = np.repeat(centres, 50, 0) + rng.normal(size=(2000, 8))
    root, order = search.cover_tree(points)
    assert sorted(order) == list(range(2000))
    stack, leaves = [root], 0
    while stack:
        node = stack.pop()
        inside = points[order[node.low : node.high]]
        assert np.sqrt(((inside - node.centre) ** 2).sum(1)).max() <= node.radius + 1e-9
        if node.children:
            assert [c.low for c in node.children[1:]] == [c.high for c in node.children[:-1]]
            stack += node.children
        else:
            leaves += 1
    assert leaves > 20


@pytest.mark.parametrize("small", [False, True])
def test_equals_brute_force(spark, monkeypatch, small):
    if small:
        monkeypatch.setattr(search, "PIVOTS", 7)
        monkeypatch.setattr(search, "CANDIDATES", 20)
        monkeypatch.setattr(search, "QUERIES", 3)
    frame = spark.read.parquet(f"{SMALL}/embeddings.parquet")
    rows = [(r.vec_id, [float(x) for x in r.embedding]) for r in frame.select("vec_id", "embedding").collect()]
    rows += [(600 + i, rows[50][1]) for i in range(90)]  # ties, also between a query and its copies
    assert found(spark, rows, label=1, v=2, cell=3, score=4) == brute(rows)


def test_edges(spark):
    rows = [(0, [1.0, 0.0]), (50, None), (100, [0.5, None]), (150, [float("nan"), 1.0]), (7, [float("inf"), 1.0]),
            (None, [1.0, 1.0]), (200, [-0.001, 2.0]), (3, []), (4, [0.25]), (4, [0.25]), (250, [0.0, 0.0])]
    assert found(spark, rows) == brute(rows)
    assert found(spark, [(0, [1.0])]) == []
    assert found(spark, []) == []
    wide = [(0, [3e30, 1.0]), (1, [2.0**60, -1.0]), (2, [1.0, 2.0**61]), (50, [-1.0, 0.5]), (51, [2.0**28, 3.0])]
    assert found(spark, wide) == brute(wide)


def test_negative_ids_are_candidates(spark):
    rng = np.random.default_rng(4)
    rows = [(i, rng.normal(size=3).tolist()) for i in range(-120, 60)] + [(-(2**63), [9.0, 0.0, 0.0]), (2**63 - 1, [0.0, 9.0, 0.0])]
    want = brute(rows)
    assert any(i < 0 for _, _, i, _ in want) and any(q < 0 for q, *_ in want)
    assert found(spark, rows) == want
