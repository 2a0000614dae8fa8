import math
import random
import statistics

import pytest

from tideline.operators import diagnostics
from tideline.operators.features import bar_features, model_features
from tideline.operators.layout import Axis
from tideline.settings import FeatureSettings

AXIS = Axis().bounded()


def rows(df):
    return sorted(df.collect(), key=lambda r: (r["symbol"], r["Date"]))


def test_short_series_has_no_zscores(bars):
    rng = random.Random(1)
    got = rows(bar_features(bars({"a": [rng.uniform(1, 2) for _ in range(13)]}), AXIS))
    assert len(got) == 13 and all(r["zscore_7"] is None and r["zscore_30"] is None for r in got)


def test_constant_prices_have_no_spread(bars):
    got = rows(bar_features(bars({"a": [5.0] * 40}), AXIS))
    assert got[-1]["ret_std_7"] == 0.0 and got[-1]["zscore_7"] is None
    assert got[-1]["ma_gap_30"] == 0.0


def test_returns_need_two_positive_prices(bars):
    got = rows(bar_features(bars({"a": [1.0, 0.0, 2.0, -1.0, 3.0, 6.0]}), AXIS))
    assert [r["ret_1d"] is None for r in got] == [True] * 5 + [False]
    assert got[-1]["ret_1d"] == pytest.approx(math.log(2))
    # Division by a zero price gives NULL instead of an error.
    assert got[2]["ret_pct"] is None and got[1]["ret_pct"] == -1.0


def test_one_row_symbol(bars):
    (got,) = rows(bar_features(bars({"a": [1.0]}), AXIS))
    assert got["rn"] == 1 and got["ma_close_7"] == 1.0 and got["ret_1d_w"] is None
    assert got["q_lo"] is None


def test_frames_count_rows_not_days(bars):
    far = bars({"a": [float(i) for i in range(1, 11)]}, days=[i * i for i in range(10)])
    assert rows(bar_features(far, AXIS))[-1]["ma_close_7"] == statistics.mean(range(4, 11))


def test_every_column_against_plain_python(bars):
    rng = random.Random(5)
    closes = [100.0]
    for _ in range(79):
        closes.append(closes[-1] * math.exp(rng.gauss(0, 0.05)))
    got = rows(bar_features(bars({"a": closes}), AXIS))
    ret = [None] + [math.log(b) - math.log(a) for a, b in zip(closes, closes[1:])]
    known = sorted(ret[1:])
    low = known[math.ceil(0.025 * len(known)) - 1]
    high = known[math.ceil(0.975 * len(known)) - 1]
    clamped = [None if v is None else min(max(v, low), high) for v in ret]
    for i, r in enumerate(got):
        assert r["rn"] == i + 1
        assert r["ma_close_30"] == pytest.approx(statistics.mean(closes[max(0, i - 29) : i + 1]))
        before = [v for v in clamped[max(0, i - 7) : i] if v is not None]
        assert r["cnt_7"] == len(before)
        if i >= 13:
            z = (clamped[i] - statistics.mean(before)) / statistics.stdev(before)
            assert r["zscore_7"] == pytest.approx(z)
        else:
            assert r["zscore_7"] is None
        if i:
            assert r["ret_1d_w"] == pytest.approx(clamped[i])
    assert (got[5]["q_lo"], got[5]["q_hi"]) == (pytest.approx(low), pytest.approx(high))
    assert model_features(bar_features(bars({"a": closes}), AXIS)).count() == 80 - 13


def test_simple_returns(bars):
    settings = FeatureSettings(log_returns=False)
    got = rows(bar_features(bars({"a": [1.0, 3.0]}), AXIS, settings=settings))
    assert got[1]["ret_1d"] == got[1]["ret_pct"] == 2.0


def test_diagnostics(spark):
    df = spark.createDataFrame(
        [("a", 1, 3.0, 0.1, 0.5), ("a", 2, -3.5, 0.2, -0.5), ("b", 1, None, 0.3, None), ("b", 2, -4.0, None, 0.5)],
        "symbol string, Date int, zscore_7 double, ret_std_30 double, ret_pct double",
    )
    assert [tuple(r) for r in diagnostics.anomaly_counts(df).collect()] == [("a", 2), ("b", 1)]
    by_symbol = diagnostics.anomalies_by_entity(df).collect()
    assert [tuple(r) for r in by_symbol] == [("a", 1, 1), ("b", 0, 1)]
    by_date = diagnostics.anomalies_by_date(df)
    assert [tuple(r) for r in by_date.collect()] == [(1, 1, 0), (2, 0, 2)]
    assert [r["Date"] for r in diagnostics.widespread_down_days(by_date, 2).collect()] == [2]
    assert [tuple(r) for r in diagnostics.volatility_summary(df).collect()] == [("b", 0.3, 0.3), ("a", 0.1, 0.2)]
    assert [r["Date"] for r in diagnostics.top_moves(df, True, n=1).collect()] == [1, 2]
    assert diagnostics.volatility_series(df, "a", first=1).count() == 1
