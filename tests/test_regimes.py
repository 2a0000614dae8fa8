"""Transitions, runs, returns and breadth on panels small enough to work out by hand."""

import datetime

import pytest
from pyspark.sql import functions as F

from tideline.operators import breadth, reshape, returns, transitions
from tideline.operators.layout import Axis
from tideline.settings import REGIMES

AXIS = Axis().bounded()
DAY = datetime.date(2020, 1, 1)


def cells(df):
    return {tuple(r)[:-1]: r[-1] for r in df.collect()}


def test_first_row_is_left_out_and_last_counts_under_null(labelled):
    rows = transitions.with_neighbours(labelled({"x": "AABA", "y": "B"}), AXIS)
    assert cells(transitions.transition_counts(rows)) == {("A", "B"): 1, ("B", "A"): 1, ("A", None): 1}
    assert cells(transitions.transition_counts(rows, strict=True)) == {
        ("A", "A"): 1, ("A", "B"): 1, ("B", "A"): 1,
    }


def test_probabilities_and_matrices(labelled):
    rows = transitions.with_neighbours(labelled({"x": "AABA"}), AXIS)
    probs = transitions.transition_probabilities(transitions.transition_counts(rows))
    assert {(r["regime"], r["regime_next"]): r["prob"] for r in probs.collect()} == {
        ("A", "B"): 0.5, ("A", None): 0.5, ("B", "A"): 1.0,
    }
    matrix = transitions.transition_matrix(probs, "prob", ["A", "B", "C"])
    assert {tuple(r) for r in matrix.collect()} == {("A", 0.0, 0.5, 0.0), ("B", 1.0, 0.0, 0.0)}
    assert cells(transitions.matrix_row_sums(matrix)) == {("A",): 0.5, ("B",): 1.0}
    dense = reshape.dense_matrix(matrix.drop("C"), ["B", "A", "C"])
    assert [tuple(r) for r in dense.collect()] == [
        ("B", 0.0, 1.0, 0.0), ("A", 0.5, 0.0, 0.0), ("C", 0.0, 0.0, 0.0),
    ]


def test_runs_and_dwell(labelled):
    labels = labelled({"x": "AABA", "y": "BBBBB"})
    rows = transitions.with_run_ids(labels, AXIS)
    runs = transitions.run_lengths(rows, AXIS)
    assert cells(runs) == {("x", "A", 0): 2, ("x", "B", 1): 1, ("x", "A", 2): 1, ("y", "B", 0): 5}
    for exact in (True, False):
        overall = {r["regime"]: tuple(r)[1:] for r in transitions.dwell_overall(runs, exact).collect()}
        assert overall == {"A": (2, 1.5, 1, 2, 1, 2), "B": (2, 3.0, 1, 5, 1, 5)}
    assert transitions.dwell_conservation(runs).first()[0] == labels.count()
    names = [r["transition"] for r in rows.where("symbol = 'x'").orderBy("Date").collect()]
    assert names == ["A", "A → A", "A → B", "B → A"]
    by_symbol = [tuple(r) for r in transitions.dwell_by_entity(runs, AXIS).collect()]
    assert by_symbol == [("x", "A", 2, 1.5, 1, 2, 2), ("x", "B", 1, 1.0, 1, 1, 1), ("y", "B", 1, 5.0, 5, 5, 5)]


def test_label_counts(labelled):
    labels = labelled({"x": "AABCD", "y": "DDDDA"})
    assert [tuple(r) for r in transitions.label_counts(labels).collect()] == [
        ("D", 5), ("A", 3), ("B", 1), ("C", 1),
    ]
    assert cells(transitions.label_counts_on(labels, "2020-01-01")) == {("A",): 1, ("D",): 1}
    top = transitions.top_labels(labels, AXIS, 2)
    assert [tuple(r) for r in top.collect()] == [("x", "A", 2), ("x", "B", 1), ("y", "D", 4), ("y", "A", 1)]


@pytest.fixture(scope="module")
def joined(spark):
    rows = [
        (DAY + datetime.timedelta(days=i), s, 0, regime, ret)
        for s, series in {
            "x": [("A", 0.1), ("A", -0.2), ("B", 0.3), ("A", 0.0)],
            "y": [("B", 0.5), ("B", 0.5)],
        }.items()
        for i, (regime, ret) in enumerate(series)
    ]
    return spark.createDataFrame(
        rows, "Date date, symbol string, cluster int, regime string, ret_1d_w double"
    )


def test_return_stats(joined):
    stats = {r["regime"]: r for r in returns.returns_by(joined, ["regime"]).collect()}
    a = stats["A"]
    assert (a["n"], a["median_ret"]) == (3, 0.0)
    assert a["mean_ret"] == pytest.approx(-0.1 / 3) and a["hit_rate"] == pytest.approx(1 / 3)
    assert a["sharpe_d"] == pytest.approx(a["mean_ret"] / a["std_ret"])
    flat = returns.return_stats(joined.where("symbol = 'y'"), "ret_1d_w", ["regime"]).first()
    assert flat["std_ret"] == 0.0 and flat["sharpe_d"] is None
    lone = returns.return_stats(joined.limit(1), "ret_1d_w", ["regime"]).first()
    assert lone["std_ret"] is None and lone["sharpe_d"] is None


def test_forward_rows_drop_the_last_then_look_back(joined):
    forward = returns.with_forward_returns(joined, AXIS)
    got = forward.orderBy("symbol", "Date").select("symbol", "regime_prev", "ret_fwd1", "is_transition")
    assert [tuple(r) for r in got.collect()] == [
        ("x", None, -0.2, False), ("x", "A", 0.3, False), ("x", "A", 0.0, True), ("y", None, 0.5, False),
    ]
    # All rows less one first and one last row per symbol.
    tallies = returns.change_tallies(forward).first()
    assert tuple(tallies) == (2, 1, 1)
    assert cells(returns.change_counts(forward)) == {("A → B",): 1}
    assert returns.stay_or_change_returns(forward).count() == 2
    assert returns.change_returns(forward, ["symbol", "transition"]).first()["mean_ret_fwd1"] == 0.0


def test_nulls_are_skipped_when_looking_back_in_a_whole_entity(joined):
    holed = joined.withColumn("ret_1d_w", F.when(F.col("ret_1d_w") != 0.3, F.col("ret_1d_w")))
    got = returns.with_forward_returns(holed, AXIS).where("symbol = 'x'").orderBy("Date")
    assert [(r["regime"], r["regime_prev"]) for r in got.collect()] == [("A", None), ("B", "A")]


def test_forward_series_keeps_the_last_row(joined):
    got = returns.forward_series(joined, "x", AXIS).orderBy("Date").collect()
    assert [r["ret_fwd1"] for r in got] == [-0.2, 0.3, 0.0, None]


def test_join_needs_the_return_column(joined):
    labels = joined.select("Date", "symbol", "cluster", "regime")
    with pytest.raises(ValueError, match="ret_1d_w"):
        returns.join_features(labels, joined.drop("ret_1d_w"))


def breadth_labels(spark):
    rows = [
        (DAY, "x", REGIMES[0]), (DAY, "y", REGIMES[4]), (DAY, "z", REGIMES[4]),
        (DAY + datetime.timedelta(days=1), "x", REGIMES[1]), (DAY, "x", REGIMES[0]),
    ]
    return spark.createDataFrame(rows, "Date date, symbol string, regime string")


def test_breadth_counts_symbols_once(spark):
    got = breadth.breadth_daily(breadth_labels(spark), AXIS).collect()
    assert (got[0]["total_syms"], got[0][REGIMES[0]], got[0][REGIMES[4]]) == (3, 1, 2)
    assert got[0]["frac_bull"] == pytest.approx(2 / 3)
    assert got[1]["frac_choppy"] == 1.0
    daily = breadth.breadth_daily(breadth_labels(spark), AXIS)
    assert tuple(breadth.breadth_conservation(daily).first()) == (2, 0)


def test_correlation_of_a_constant_is_null(spark):
    days = [DAY + datetime.timedelta(days=i) for i in range(40)]
    shares = [(d, 0.5, float(i % 3), float(i), 0.1 * i, -1.0 * i, float(i)) for i, d in enumerate(days)]
    df = spark.createDataFrame(
        shares,
        "Date date, frac_calm double, frac_choppy double, frac_sello double, frac_blowoff double, "
        "frac_bull double, lead_fwd1 double",
    )
    got = {r["share"]: r["corr"] for r in breadth.lead_correlations(df).collect()}
    assert got["frac_calm"] is None
    assert got["frac_sello"] == pytest.approx(1.0) and got["frac_bull"] == pytest.approx(-1.0)
    rolled = breadth.rolling_correlation(df, "frac_calm", "lead_fwd1").collect()
    assert all(r["corr30"] is None for r in rolled)
    rolled = breadth.rolling_correlation(df, "frac_bull", "lead_fwd1").collect()
    assert [r["corr30"] is None for r in rolled] == [True] * 29 + [False] * 11


def test_rolling_correlation_needs_every_pair(spark):
    rows = [(DAY + datetime.timedelta(days=i), float(i), None if i == 35 else float(i * i)) for i in range(70)]
    df = spark.createDataFrame(rows, "Date date, x double, y double")
    got = [r["corr30"] is not None for r in breadth.rolling_correlation(df, "x", "y").collect()]
    assert got == [29 <= i < 35 or i >= 65 for i in range(70)]
