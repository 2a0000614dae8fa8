"""Cutting hot entities into blocks changes no result."""

import datetime
import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from tideline.operators import breadth, features, layout, returns, transitions
from tideline.operators.layout import Axis

EPOCH = datetime.datetime(2024, 1, 1, tzinfo=datetime.timezone.utc)


def cut_axis(size, **more):
    return Axis("key", "ts", min_block_rows=size, max_block_rows=size, **more)


WHOLE = Axis("key", "ts").bounded()


def panel(spark, seed, spread):
    """One key with most rows; times even, in bursts, or mostly far apart."""
    rng = random.Random(seed)
    rows = []
    for key, n in (("hot", 400), ("warm", 90), ("cold", 7), ("one", 1)):
        at = 0.0
        for _ in range(n):
            if spread == "even":
                at += 1.0
            elif spread == "bursts":
                at += 0.001 if rng.random() < 0.9 else 500.0
            else:
                at += rng.expovariate(1.0) ** 6 + 0.001
            value = round(rng.uniform(0.5, 9.0), 2)
            rows.append((key, EPOCH + datetime.timedelta(seconds=at), value, rng.choice("ABC")))
    schema = "key string, ts timestamp, value double, regime string"
    return spark.createDataFrame(rows, schema).dropDuplicates(["key", "ts"])


def table(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


@pytest.fixture(scope="module", params=["even", "bursts", "sparse"])
def rows(request, spark):
    return panel(spark, 7, request.param).cache()


@pytest.mark.parametrize("size", [1, 5, 64])
def test_each_row_is_home_once_and_keeps_its_place(rows, size):
    axis = cut_axis(size).measured(rows)
    laid = layout.cut(rows, axis, before=3, after=2).withColumn("place", layout.position(axis))
    plain = F.row_number().over(Window.partitionBy("key").orderBy("ts"))
    assert table(layout.home_rows(laid)) == table(rows.withColumn("place", plain))


@pytest.mark.parametrize("size,before,after", [(1, 4, 0), (3, 0, 4), (5, 7, 2), (64, 31, 1)])
def test_frames_see_the_rows_outside_their_block(rows, size, before, after):
    def framed(axis):
        laid = layout.cut(rows, axis, before, after)
        frame = axis.window().rowsBetween(-before, after)
        seen = F.collect_list("value").over(frame)
        return table(layout.home_rows(laid.withColumn("seen", seen)))

    assert framed(cut_axis(size).measured(rows)) == framed(WHOLE)


def test_blocks_are_small_and_few(rows):
    axis = cut_axis(50).measured(rows)
    laid = layout.cut(rows, axis)
    sizes = [r["n"] for r in laid.groupBy(*axis.block_keys()).agg(F.count("*").alias("n")).collect()]
    assert max(sizes) <= 1.25 * 50


def test_number_of_blocks_is_bounded(rows):
    axis = cut_axis(1, max_blocks=10).measured(rows)
    assert axis.block_rows == -(-rows.count() // 10)
    laid = layout.cut(rows, axis)
    hot = [h[0] for h in axis.hot]
    blocks = laid.where(F.col("key").isin(hot)).select(*axis.block_keys()).distinct().count()
    assert len(hot) <= 10 and blocks <= 10 + len(hot)


def test_nothing_is_cut_without_hot_entities(rows):
    axis = Axis("key", "ts").measured(rows)
    assert axis.hot == ()
    plan = layout.cut(rows, axis, 5, 5)._jdf.queryExecution().toString()
    assert "Join" not in plan and "Generate" not in plan


def test_times_without_zone_keep_their_order_where_clocks_change(spark):
    zone = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        local = spark.range(600).selectExpr(
            "'a' AS key",
            "timestamp_ntz '2024-03-10 00:00:00' + make_dt_interval(0, 0, 0, id * 25) AS ts",
            "CAST(id % 7 AS DOUBLE) AS value",
            "CAST(id % 3 AS STRING) AS regime",
        )
        cut = transitions.with_run_ids(local, cut_axis(11))
        assert table(cut) == table(transitions.with_run_ids(local, WHOLE))
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_empty_panel(rows):
    assert table(transitions.with_run_ids(rows.limit(0), cut_axis(1))) == []


@pytest.mark.parametrize("size", [2, 33])
def test_features_do_not_depend_on_blocks(rows, size):
    def run(axis):
        return table(features.bar_features(rows, axis, price="value"))

    assert run(cut_axis(size)) == run(WHOLE)


@pytest.mark.parametrize("size", [1, 40])
def test_run_ids_do_not_depend_on_blocks(rows, size):
    assert table(transitions.with_run_ids(rows, cut_axis(size))) == table(
        transitions.with_run_ids(rows, WHOLE)
    )


@pytest.mark.parametrize("size", [1, 40])
def test_forward_returns_do_not_depend_on_blocks(rows, size):
    assert table(returns.with_forward_returns(rows, cut_axis(size), "value")) == table(
        returns.with_forward_returns(rows, WHOLE, "value")
    )


@pytest.fixture(scope="module", params=["even", "bursts", "sparse"])
def holed(request, spark):
    """Rows without value, time or entity, an entity without any time, and a burst behind an outlier."""
    rng = random.Random(3)
    base = panel(spark, 11, request.param).collect()
    rows = [(r.key, r.ts, r.value if rng.random() < 0.8 else None, r.regime) for r in base]
    rows += [(None, r.ts + datetime.timedelta(days=3), r.value, r.regime) for r in base if r.key == "hot"]
    rows += [(k, None, 1.5, "C") for k in ("hot", "cold", None, "timeless")]
    rows += [("late", datetime.datetime(1970, 1, 2, tzinfo=datetime.timezone.utc), 3.0, "A")]
    rows += [("late", EPOCH + datetime.timedelta(milliseconds=7 * i), 1.0 + i % 5, "AB"[i % 3 == 0]) for i in range(500)]
    return spark.createDataFrame(rows, "key string, ts timestamp, value double, regime string").cache()


@pytest.mark.parametrize("size", [1, 6, 40])
def test_holes_and_bursts_change_nothing(holed, size):
    axis = cut_axis(size)
    assert len(axis.measured(holed).hot) >= 3
    for run in (
        lambda a: returns.with_forward_returns(holed, a, "value"),
        lambda a: transitions.with_run_ids(holed, a),
        lambda a: transitions.with_neighbours(holed, a),
        lambda a: features.bar_features(holed, a, price="value"),
    ):
        assert table(run(axis)) == table(run(WHOLE))


def test_forward_returns_skip_rows_without_return(spark):
    rows = [("a", EPOCH + datetime.timedelta(days=i), v, r) for i, (v, r) in enumerate(zip([1.0, 2.0, None, 4.0, 5.0], "ABCDE"))]
    df = spark.createDataFrame(rows, "key string, ts timestamp, value double, regime string")
    for axis in (WHOLE, cut_axis(1)):
        got = returns.with_forward_returns(df, axis, "value").orderBy("ts").collect()
        assert [(r.regime, r.ret_fwd1, r.regime_prev) for r in got] == [("A", 2.0, None), ("C", 4.0, "A"), ("D", 5.0, "C")]


def test_blocks_hold_no_more_than_a_quarter_above_target(spark):
    burst = [("a", EPOCH - datetime.timedelta(days=9000), 1.0)]
    burst += [("a", EPOCH + datetime.timedelta(milliseconds=i), 1.0) for i in range(20_000)]
    burst += [(None, EPOCH + datetime.timedelta(seconds=(i / 50) ** 3), 1.0) for i in range(20_000)]
    df = spark.createDataFrame(burst, "key string, ts timestamp, value double").cache()
    axis = cut_axis(1250).measured(df)
    sizes = layout.cut(df, axis).groupBy("key", layout.BLOCK).count().collect()
    assert max(r["count"] for r in sizes) <= 1.25 * 1250
    assert {r.key for r in sizes} == {"a", None} and len(sizes) >= 2 * 13


def test_forward_series_does_not_depend_on_blocks(rows):
    assert table(returns.forward_series(rows, "hot", cut_axis(9), "value")) == table(
        returns.forward_series(rows, "hot", WHOLE, "value")
    )


def test_rolling_correlation_does_not_depend_on_blocks(rows):
    series = rows.where("key = 'hot'").withColumn("other", F.hash("regime", "value") / 1e9)

    def run(**size):
        found = breadth.rolling_correlation(series, "value", "other", time="ts", **size)
        return table(found.select("ts", "corr30"))

    assert run(min_block_rows=20, max_block_rows=20) == run()


def test_block_size_follows_the_number_of_cores(spark):
    rows = spark.range(10_000).select(
        F.lit("a").alias("key"), F.timestamp_seconds("id").alias("ts")
    )
    axis = Axis("key", "ts", min_block_rows=10).measured(rows)
    assert axis.block_rows == 10_000 // (4 * spark.sparkContext.defaultParallelism)
