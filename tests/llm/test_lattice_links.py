import itertools
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.conftest import SMALL
from tideline.llm import lattice_links as lattice


def brute(rows, least=0.9):
    named = {}
    for i, v in rows:
        good = v is not None and all(x is not None and math.isfinite(x) for x in v) and any(v)
        if i is not None:
            named[i] = v if good else None
    ids = [i for i, v in named.items() if v is not None]
    width = max((len(named[i]) for i in ids), default=0)
    x = np.array([named[i] + [0.0] * (width - len(named[i])) for i in ids]).reshape(len(ids), width)
    x = x / np.abs(x).max(1, keepdims=True) if len(x) else x
    x = x / np.linalg.norm(x, axis=1, keepdims=True) if len(x) else x
    links = x @ x.T >= least
    root = {i: i for i in named}
    for _ in ids:
        for a, b in zip(*np.nonzero(links)):
            root[ids[a]] = root[ids[b]] = min(root[ids[a]], root[ids[b]])
        if all(root[ids[a]] == root[ids[b]] for a, b in zip(*np.nonzero(links))):
            break
    count = dict(zip(ids, links.sum(1) - 1))
    return sorted((i, int(count.get(i, 0)), root[i], root[i] == i) for i in named)


def found(spark, rows, **more):
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    frame = frame.withColumns({k: F.lit(v) for k, v in more.items()})
    return sorted(map(tuple, lattice.near_vectors(frame).collect()))


def test_nearest_points_are_nearest():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(300, 8)) * 3
    point = lattice.nearest_e8(x)
    doubled = 2 * point
    assert (doubled == np.rint(doubled)).all()
    even = (doubled % 2 == 0).all(1)
    assert (even | (doubled % 2 != 0).all(1)).all() and (point.sum(1) % 2 == 0).all()
    own = ((x - point) ** 2).sum(1)
    others = ((x[:, None] - point[:, None] - lattice.NEIGHBOURS) ** 2).sum(2)
    assert (own <= others.min(1) + 1e-9).all() and own.max() <= 1 + 1e-9  # the covering radius
    assert np.allclose((lattice.NEIGHBOURS**2).sum(1), 2) and len({tuple(v) for v in lattice.NEIGHBOURS}) == 240


def test_pairs_at_the_threshold_meet():
    rng = np.random.default_rng(2)
    u = lattice.unit(rng.normal(size=(1500, 64)))
    w = rng.normal(size=u.shape)
    w = lattice.unit(w - (w * u).sum(1, keepdims=True) * u)
    v = 0.9 * u + math.sqrt(1 - 0.81) * w
    a, b = lattice.cells(u), lattice.cells(v)
    meet = (a[:, :, :1] == b).any((1, 2)) | (b[:, :, :1] == a).any((1, 2))
    assert meet.mean() >= 0.95
    far = (a[:, :, :1] == np.roll(b, 7, axis=0)).any(2).mean()
    assert far < 0.02


def test_numbers_do_not_depend_on_zeros_at_the_end():
    x = lattice.unit(np.random.default_rng(3).normal(size=(20, 5)))
    assert (lattice.cells(x) == lattice.cells(np.pad(x, ((0, 0), (0, 3))))).all()


@pytest.mark.parametrize("block", [512, 13])
def test_equals_brute_force_on_the_table(spark, monkeypatch, block):
    monkeypatch.setattr(lattice, "BLOCK", block)
    frame = spark.read.parquet(f"{SMALL.replace('0.001', '0.1')}/embeddings.parquet").select("vec_id", "embedding")
    rows = [(r.vec_id, [float(x) for x in r.embedding]) for r in frame.limit(1200).collect()]
    rng = np.random.default_rng(5)
    base = np.array(rows[3][1])
    rows += [(5000 + i, (base + rng.normal(size=64) * 0.02).tolist()) for i in range(150)]
    rows += [(6000 + i, rows[8][1]) for i in range(120)] + [(7000, [2 * x for x in rows[8][1]])]
    assert found(spark, rows, id=1, v=2, cell=3, component=4, block=5) == brute(rows)


def test_edges(spark):
    rows = [(1, None), (2, []), (3, [0.0, 0.0]), (4, [1.0, None]), (5, [float("nan"), 1.0]), (6, [float("inf"), 0.0]),
            (7, [1.0, 0.0]), (8, [1.0]), (9, [1e300, 1e299]), (9, [1e300, 1e299]), (None, [1.0]), (10, [-1.0, 0.0]), (12, [1e-300])]
    assert found(spark, rows) == brute(rows)
    assert found(spark, []) == []
