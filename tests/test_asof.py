"""As-of joins and calendar spans, with and without cuts, against plain Python."""

import datetime
import random

import pytest
from pyspark.sql import functions as F

from tideline.operators.asof import asof_join
from tideline.operators.calendar import calendar_features, span_statistics
from tideline.operators.layout import Axis

DAY = datetime.date(2020, 1, 1)


def days(n):
    return datetime.timedelta(days=n)


def axes():
    """Plain, and cut into blocks of a few rows down to one."""
    return [Axis().bounded(), *[Axis(min_block_rows=n, max_block_rows=n, slices_per_block=3) for n in (40, 7, 1)]]


def panel(spark, seed=4):
    rng = random.Random(seed)
    rows = []
    for symbol, n in (("a", 200), ("b", 3), (None, 30), ("c", 0)):
        for day in sorted(rng.sample(range(400), n)):
            rows.append((DAY + days(day), symbol, float(rng.randrange(1, 50)), len(rows)))
    rows += [(None, "a", 5.0, -1), (None, None, 5.0, -2)]
    return rows, spark.createDataFrame(rows, "Date date, symbol string, Close double, id int")


def facts(spark, seed=5):
    rng = random.Random(seed)
    rows = [(DAY + days(d), s, f"{s}{d}") for s, n in (("a", 25), ("b", 9), ("z", 5)) for d in rng.sample(range(400), n)]
    rows += [(None, "a", "no time"), (DAY, None, "nobody's"), (DAY + days(399), "a", "late") if ("a", 399) not in {(r[1], r[0]) for r in rows} else rows[0]]
    rows = list({(r[1], r[0]): r for r in rows}.values())
    return rows, spark.createDataFrame(rows, "since date, symbol string, regime string")


@pytest.mark.parametrize("direction", ["backward", "forward"])
@pytest.mark.parametrize("exact", [True, False])
@pytest.mark.parametrize("within", [None, 6])
def test_asof_against_a_loop(spark, direction, exact, within):
    rows, left = panel(spark)
    known, right = facts(spark)
    expected = set()
    for day, symbol, close, number in rows:
        best = None
        for since, other, regime in known:
            if None in (day, symbol, since) or other != symbol or (since == day and not exact):
                continue
            gap = (day - since).days if direction == "backward" else (since - day).days
            if gap >= 0 and (within is None or gap <= within) and (best is None or gap < best[0]):
                best = (gap, since, regime)
        expected.add((day, symbol, close, number, *(best[1:] if best else (None, None))))
    for axis in axes():
        span = None if within is None else days(within)
        got = asof_join(left, right, axis, "since", direction, exact, span)
        assert got.columns == ["Date", "symbol", "Close", "id", "since", "regime"]
        assert {tuple(r) for r in got.collect()} == expected and got.count() == len(rows), axis


def test_asof_has_no_join_by_inequality(spark):
    _, left = panel(spark)
    _, right = facts(spark)
    plan = asof_join(left, right, Axis().bounded(), "since")._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and plan.count("Exchange hashpartitioning") <= 1


def test_asof_of_timestamps_empty_tables_and_clashes(spark):
    at = datetime.datetime(2020, 1, 1, 12)
    left = spark.createDataFrame([("a", at)], "symbol string, Date timestamp")
    right = spark.createDataFrame([("a", at.date(), 1)], "symbol string, known_time date, v int")
    assert [tuple(r) for r in asof_join(left, right).collect()] == [("a", at, at.date(), 1)]
    assert asof_join(left.limit(0), right).count() == 0
    assert asof_join(left, right.limit(0)).first().v is None
    with pytest.raises(ValueError):
        asof_join(left, right.withColumnRenamed("v", "Date"))
    with pytest.raises(ValueError):
        asof_join(left, right, direction="nearest")


@pytest.mark.parametrize("now", [True, False])
def test_spans_against_a_loop(spark, now):
    rows, df = panel(spark)
    spans = {"3d": days(3), "40d": days(40)}
    expected = {}
    for day, symbol, _, number in rows:
        for tag, span in spans.items():
            values = [c for d, s, c, _ in rows if s == symbol and None not in (d, day)
                      and (0 <= (day - d).days < span.days if now else 1 <= (day - d).days <= span.days)]
            mean = sum(values) / len(values) if values else None
            std = (sum((v - mean) ** 2 for v in values) / (len(values) - 1)) ** 0.5 if len(values) > 1 else None
            expected[number, tag] = (None, None, None) if day is None else (mean, std, len(values))
    for axis in axes():
        got = span_statistics(df, axis, "Close", spans, "x", now).collect()
        assert len(got) == len(rows)
        for r in got:
            for tag in spans:
                assert tuple(r[f"x_{s}_{tag}"] for s in ("mean", "std", "count")) == pytest.approx(expected[r.id, tag]), (axis, r)


def test_calendar_features_cut_and_uncut(spark):
    _, df = panel(spark)
    df = df.withColumn("Close", F.col("Close") + 1)
    first = None
    for axis in axes():
        got = sorted((tuple(None if v is None else round(v, 9) if isinstance(v, float) else v for v in r)
                      for r in calendar_features(df, axis).collect()), key=str)
        first = first or got
        assert got == first
    scored = calendar_features(df, Axis().bounded()).where("zscore_30d IS NOT NULL")
    assert scored.count() > 50 and scored.where("ret_count_30d < 10").count() == 0


def test_a_missing_day_shortens_a_span(spark, bars):
    df = bars({"a": [1.0, 2.0, 3.0, 4.0]}, days=[0, 1, 9, 10])
    got = [(r.price_mean_7d, r.price_count_7d) for r in calendar_features(df).orderBy("Date").collect()]
    assert got == [(1.0, 1), (1.5, 2), (3.0, 1), (3.5, 2)]


def test_span_statistics_run_in_running_frames(spark):
    """Each span is a difference of frames from a block's start, not a sliding frame per row."""
    t = datetime.datetime(2024, 1, 1)
    data = [
        (1, "a", t, 100.0), (2, "a", t, 300.0), (3, "a", t + datetime.timedelta(hours=5), None),
        (4, "a", t + datetime.timedelta(hours=7), 50.0), (5, "a", None, 7.0), (6, "b", t, 5.0),
    ]
    df = spark.createDataFrame(data, "id long, kind string, ts timestamp, value double")
    axis = Axis(entity="kind", time="ts", min_block_rows=2)
    found = span_statistics(df, axis, "value", {"6h": datetime.timedelta(hours=6)}, "v")
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "unboundedpreceding" in plan.lower() and "-21599999999" not in plan
    got = {r.id: (r.v_mean_6h, r.v_std_6h, r.v_count_6h) for r in found.collect()}
    assert got[1] == got[2] == (200.0, pytest.approx(2**0.5 * 100), 2)
    assert got[3] == (200.0, pytest.approx(2**0.5 * 100), 2)
    assert got[4] == (50.0, None, 1)
    assert got[5] == (None, None, None)
    assert got[6] == (5.0, None, 1)
