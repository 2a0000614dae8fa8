"""Overlapping intervals against a loop, whatever the bins and however they are split."""

import datetime
import random

import pytest

from tideline.operators import intervals
from tideline.operators.intervals import overlap_join

SCHEMA = "key string, low long, high long, id int"


def rows(n, seed, longest=60):
    rng = random.Random(seed)
    out = []
    for i in range(n):
        low = rng.randrange(-500, 500)
        length = rng.choice([0, 0, 1, rng.randrange(longest), rng.randrange(longest * 50)])
        out.append((rng.choice(["a", "a", "a", "b", None]), low, low + length, i))
    return out + [("a", 5, 4, -1), ("a", None, 9, -2), ("a", 3, None, -3), ("a", 0, 10, -4), ("a", 0, 10, -4)]


def pairs(a, b, on):
    return sorted(
        (x[3], y[3]) for x in a for y in b
        if None not in (x[1], x[2], y[1], y[2]) and x[1] <= x[2] and y[1] <= y[2]
        and x[1] <= y[2] and y[1] <= x[2] and (not on or (x[0] is not None and x[0] == y[0]))
    )


@pytest.mark.parametrize("on", [(), ("key",)])
@pytest.mark.parametrize("width", [None, 1, 7, 10_000])
@pytest.mark.parametrize("hot", [50_000, 5])
def test_against_a_loop(spark, on, width, hot):
    a, b = rows(90, 1), rows(60, 2)
    joined = overlap_join(spark.createDataFrame(a, SCHEMA), spark.createDataFrame(b, SCHEMA), "low", "high", on, width, hot)
    assert sorted((r.a.id, r.b.id) for r in joined.collect()) == pairs(a, b, on)


def test_dates_and_no_nested_loop(spark):
    day = lambda n: datetime.date(2020, 1, 1) + datetime.timedelta(days=n)
    df = spark.createDataFrame([(day(0), day(3), 1), (day(3), day(900), 2), (day(5), day(5), 3)], "s date, e date, id int")
    joined = overlap_join(df, df, "s", "e")
    assert sorted((r.a.id, r.b.id) for r in joined.collect()) == [(1, 1), (1, 2), (2, 1), (2, 2), (2, 3), (3, 2), (3, 3)]
    plan = joined._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_long_intervals_are_split_into_few_bins(spark):
    df = spark.createDataFrame([("a", 0, 10**9, 1), ("a", 0, 1, 2)], SCHEMA)
    levels = df.selectExpr("low AS _low", "high AS _high").withColumn("_level", intervals.level_of(1))
    spread = intervals._spread(levels, 1, [r[0] for r in levels.select("_level").distinct().collect()])
    assert spread.count() <= 2 * (intervals.FACTOR + 2)


def test_empty_tables(spark):
    df = spark.createDataFrame(rows(5, 1), SCHEMA)
    assert overlap_join(df, df.limit(0), "low", "high").count() == 0
