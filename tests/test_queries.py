"""Every named query against its SQL on the smallest tables, and the shape of the plans."""

import os
import sys

import pytest

from tests.conftest import SMALL
from tideline.plans import panels, queries
from tideline.plans.oracles import SQL
from tideline.plans.queries import QUERIES

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "checks"))
from compare import connect, differences  # noqa: E402

# Fitted models, and one sketch that may differ from exact values: no SQL.
WITHOUT_SQL = {
    "analysis_results", "feature_percentiles_sketch", "gauge_coefficients",
    "gauge_coefficients_balanced", "gauge_confusion_default", "gauge_metrics",
    "gauge_threshold_sweep", "kmeans_centroids", "kmeans_predictions", "kmeans_saved_model",
    "kmeans_silhouettes", "kmeans_sweep", "kmeans_unscaled_centroids",
}


@pytest.fixture(scope="module")
def duck():
    return connect(SMALL)


def test_every_query_has_sql_unless_it_fits_a_model():
    assert set(SQL) <= set(QUERIES)
    assert set(QUERIES) - set(SQL) == WITHOUT_SQL


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(SQL))
def test_against_sql(spark, duck, name):
    df = QUERIES[name](spark, SMALL)
    plan = plan_of(df)
    assert "Python" not in plan and "Cartesian" not in plan and "NestedLoop" not in plan
    assert differences(df, duck, SQL[name]) == ""


def test_sketch_is_near_the_exact_percentiles(spark):
    near = {r["feature"]: r["p50"] for r in QUERIES["feature_percentiles_sketch"](spark, SMALL).collect()}
    exact = {r["feature"]: r["p50"] for r in QUERIES["feature_percentiles"](spark, SMALL).collect()}
    assert near == pytest.approx(exact, abs=1e-3)


def test_scans_read_only_the_columns_they_need(spark):
    plan = plan_of(QUERIES["anomaly_counts"](spark, SMALL))
    read = [line for line in plan.splitlines() if "ReadSchema" in line]
    assert read and all("l_tax" not in line and "l_discount" not in line for line in read)


def test_filter_on_one_symbol_passes_the_windows(spark):
    series = QUERIES["volatility_series"](spark, SMALL)
    lines = plan_of(series).splitlines()
    window = next(i for i, line in enumerate(lines) if "Window" in line)
    below = "\n".join(lines[window:])
    assert "= S1" in below


@pytest.mark.parametrize("name", ["features_full", "features_model", "features_simple_returns"])
def test_features_read_and_lay_out_the_bars_once(spark, name):
    df = QUERIES[name](spark, SMALL)
    df.collect()
    final = plan_of(df).split("== Initial Plan ==")[0]
    assert final.count("FileScan") == 1
    # One exchange makes the daily bars, one lays them out for all windows.
    assert final.count("Exchange hashpartitioning") == 2 and "Join" not in final


def test_entry_is_the_model_features(spark):
    from __spark_entry__ import entry

    df = entry(spark)
    assert df.columns == ["Date", "symbol", *queries.FEATURES] and not df.isEmpty()


def test_fitted_queries_keep_their_laws(spark):
    metrics = QUERIES["gauge_metrics"](spark, SMALL).first()
    rows = QUERIES["direction_labels"](spark, SMALL).count()
    assert metrics["train_rows"] + metrics["test_rows"] == rows
    assert 0 <= metrics["roc_auc"] <= 1 and 0 <= metrics["brier"] <= 1
    labelled = QUERIES["kmeans_predictions"](spark, SMALL)
    assert labelled.count() == QUERIES["features_model"](spark, SMALL).count()
    scores = QUERIES["kmeans_silhouettes"](spark, SMALL).collect()
    assert all(-1 <= r["mean_silhouette"] <= 1 for r in scores)
    assert sum(r["n"] for r in scores) == labelled.count()
