"""Global ranks and positions against a plain sort, with ties that a third of all rows share."""

import random

import pytest
from pyspark.sql import functions as F

from tideline.operators import ranking


def rows(n, seed=1):
    rng = random.Random(seed)
    values = [7.0 if rng.random() < 0.35 else rng.choice([None, round(rng.uniform(-50, 50), 1), rng.uniform(-50, 50)]) for _ in range(n)]
    return [(i * 37 % n, v) for i, v in enumerate(values)]


def key(v):
    return (v is not None, v or 0.0)


@pytest.mark.parametrize("n", [0, 1, 2, 3000])
def test_ranks_against_a_sort(spark, n):
    data = rows(n)
    df = spark.createDataFrame(data, "id long, v double")
    order = sorted(key(v) for _, v in data)
    first, last = {}, {}
    for i, k in enumerate(order):
        first.setdefault(k, i + 1)
        last[k] = i + 1
    got = ranking.global_ranks(df, "v").collect()
    assert len(got) == n
    for r in got:
        k = key(r.v)
        assert (r["rank"], r.ties) == (first[k], last[k] - first[k] + 1)
        assert r["percent_rank"] == pytest.approx((first[k] - 1) / max(n - 1, 1))
        assert r["cume_dist"] == pytest.approx(last[k] / n)


@pytest.mark.parametrize("n,tiles", [(0, 4), (1, 3), (3, 7), (3000, 7)])
def test_positions_and_tiles(spark, n, tiles):
    data = rows(n, 2)
    df = spark.createDataFrame(data, "id long, v double")
    place = {i: p for p, (_, i) in enumerate(sorted((key(v), i) for i, v in data), 1)}
    got = ranking.global_positions(df, "v", "id", tiles).collect()
    size, larger = divmod(n, tiles)
    tile = [t + 1 for t in range(tiles) for _ in range(size + (t < larger))]
    assert {(r.id, r.position, r.ntile) for r in got} == {(i, p, tile[p - 1]) for i, p in place.items()}


def test_no_single_partition_and_no_large_slice(spark):
    df = spark.range(20_000).select(F.col("id"), F.when(F.col("id") % 3 == 0, 5).otherwise(F.col("id") % 1000).alias("v"))
    out = ranking.global_positions(df, "v", "id")
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "SinglePartition" not in plan
    cut = ranking.cuts(df, "v", "id")
    assert max(cut.counts.values()) < 20_000 / 30


def test_roc_area_against_all_pairs(spark):
    rng = random.Random(3)
    data = [(round(rng.random(), 1), float(rng.random() < 0.4)) for _ in range(300)] + [(None, 1.0), (0.5, None)]
    got = ranking.roc_area(spark.createDataFrame(data, "p double, label double"), "p").first()
    pos, neg = ([p for p, y in data if y == label and p is not None] for label in (1.0, 0.0))
    pairs = sum((a > b) + (a == b) / 2 for a in pos for b in neg) / (len(pos) * len(neg))
    assert got.roc_auc == pytest.approx(pairs) and (got.positives, got.negatives) == (len(pos), len(neg))
    assert ranking.roc_area(spark.createDataFrame([(0.1, 1.0)], "p double, label double"), "p").first().roc_auc is None


def test_cuts_do_not_grow_with_the_values(spark):
    """A row's slice is looked up once, however many values are cut again along the ties."""

    def lookups(values):
        df = spark.range(values * 100).select("id", (F.col("id") % values).cast("double").alias("v"))
        cut = ranking.cuts(df, "v", "id")
        assert {p for _, p in cut.counts} == set(range(ranking.PARTS))
        plan = df.withColumn("_slice", cut.slice).withColumn("_part", cut.part).withColumn("before", cut.before(True))
        return plan._jdf.queryExecution().optimizedPlan().toString().count("lambdafunction")

    assert lookups(40) == lookups(4)
