import datetime
import math
import random

import pytest
from pyspark.sql import functions as F

from tideline.operators import gauge
from tideline.operators.layout import Axis
from tideline.settings import FEATURES

DAY = datetime.date(2020, 1, 1)


@pytest.fixture(scope="module")
def labelled(spark):
    rng = random.Random(2)
    rows = []
    for i in range(2000):
        x = [rng.gauss(0, 1) for _ in FEATURES]
        p = 1 / (1 + math.exp(-(2 * x[0] - x[1])))
        rows.append((DAY + datetime.timedelta(days=i // 4), f"s{i % 4}", float(rng.random() < p), *x))
    schema = "Date date, symbol string, label double, " + ", ".join(f"{c} double" for c in FEATURES)
    return spark.createDataFrame(rows, schema).cache()


def test_labels(spark):
    forward = spark.createDataFrame(
        [(DAY, "a", 0.1, *[1.0] * 6), (DAY, "b", 0.0, *[1.0] * 6), (DAY, "c", 0.2, None, *[1.0] * 5)],
        "Date date, symbol string, ret_fwd1 double, " + ", ".join(f"{c} double" for c in FEATURES),
    )
    assert {r["symbol"]: r["label"] for r in gauge.direction_labels(forward).collect()} == {"a": 1.0, "b": 0.0}


def test_random_split_is_whole_and_does_not_depend_on_partitions(labelled):
    train, test = gauge.random_split(labelled, 0.25)
    assert train.count() + test.count() == 2000 and abs(test.count() - 500) < 100
    moved = gauge.random_split(labelled.repartition(9, "label"), 0.25)[1]
    assert test.exceptAll(moved).isEmpty() and moved.exceptAll(test).isEmpty()


def test_chronological_split(labelled):
    for exact in (True, False):
        train, test = gauge.chronological_split(labelled, 0.2, exact=exact)
        cut = train.agg(F.max("Date")).first()[0]
        assert cut == DAY + datetime.timedelta(days=399)
        assert test.agg(F.min("Date")).first()[0] > cut
        assert (train.count(), test.count()) == (1600, 400)
    train, test = gauge.chronological_split(labelled, cut_date="2020-01-10")
    assert (train.count(), test.count()) == (40, 1960)


def test_chronological_split_of_timestamps(spark):
    rows = spark.range(100).select(F.timestamp_seconds("id").alias("ts"), F.lit("a").alias("k"), F.lit(1.0).alias("label"))
    train, test = gauge.chronological_split(rows, 0.2, axis=Axis("k", "ts"))
    assert (train.count(), test.count()) == (80, 20)


def test_class_weights(spark, labelled):
    w = gauge.class_weights(labelled).first()
    p = w["positive_share"]
    assert w["w_pos"] == pytest.approx(0.5 / p) and w["w_neg"] == pytest.approx(0.5 / (1 - p))
    weighted = gauge.add_class_weights(labelled).groupBy("label").agg(F.sum("w").alias("w")).collect()
    assert [r["w"] for r in weighted] == pytest.approx([1000, 1000])
    ones = labelled.where("label = 1")
    assert gauge.class_weights(ones).first()["w_neg"] == pytest.approx(0.5 / 1e-12)
    # No positives, or no rows at all: taken as balanced.
    assert gauge.class_weights(labelled.where("label = 0")).first()["w_pos"] == 1.0
    assert gauge.class_weights(labelled.limit(0)).first()["w_neg"] == 1.0


def scored_of(spark, pairs):
    rows = [(float(y), float(p), float(p > 0.5)) for y, p in pairs]
    return spark.createDataFrame(rows, "label double, proba1 double, prediction double")


def test_sweep_against_brute_force(spark):
    rng = random.Random(4)
    pairs = [(rng.random() < 0.5, round(rng.random(), 2)) for _ in range(500)]
    scored = scored_of(spark, pairs)
    sweep = gauge.threshold_sweep(scored).collect()
    for row in sweep:
        t = row["threshold"]
        tp = sum(y and p >= t for y, p in pairs)
        fp = sum((not y) and p >= t for y, p in pairs)
        assert (row["TP"], row["FP"]) == (tp, fp)
        assert row["TP"] + row["FP"] + row["TN"] + row["FN"] == 500
    best = gauge.best_threshold(gauge.threshold_sweep(scored)).first()
    assert best["f1"] == max(r["f1"] for r in sweep)
    assert best["threshold"] == min(r["threshold"] for r in sweep if r["f1"] == best["f1"])
    cells = gauge.confusion_of(gauge.best_threshold(gauge.threshold_sweep(scored))).collect()
    assert [r["count"] for r in cells] == [best["TN"], best["FP"], best["FN"], best["TP"]]


def test_sweep_is_one_pass(spark):
    scored = scored_of(spark, [(1, 0.5)])
    plan = gauge.threshold_sweep(scored)._jdf.queryExecution().executedPlan().toString()
    # One exchange gathers the partial counts; the nine rows are ordered where they are.
    assert plan.count("Exchange") == 1 and "Join" not in plan


def test_all_of_one_class(spark):
    none = gauge.default_metrics(gauge.confusion(scored_of(spark, [(0, 0.1), (0, 0.2)]))).first()
    assert (none["precision"], none["recall"], none["f1"], none["accuracy"]) == (0.0, 0.0, 0.0, 1.0)
    base = gauge.trivial_baselines(scored_of(spark, [(0, 0.1)])).first()
    assert base["f1_always_positive"] == 0.0 and base["acc_majority"] == 1.0
    empty = gauge.trivial_baselines(scored_of(spark, [(0, 0.1)]).limit(0)).first()
    assert empty["test_positive_rate"] is None and empty["acc_majority"] == 0.5


def test_brier_quantiles_and_areas(spark):
    pairs = [(0, 0.1), (0, 0.4), (1, 0.35), (1, 0.8)]
    scored = scored_of(spark, pairs)
    assert gauge.brier(scored).first()[0] == pytest.approx(sum((p - y) ** 2 for y, p in pairs) / 4)
    for exact in (True, False):
        assert tuple(gauge.probability_quantiles(scored, exact).first()) == (0.1, 0.35, 0.8)
    roc, pr = gauge.areas(scored, raw="proba1")
    assert roc == pytest.approx(0.75) and 0 < pr <= 1


@pytest.mark.parametrize("balanced", [False, True])
def test_fit_recovers_the_signs(spark, labelled, balanced):
    train, test = gauge.random_split(labelled)
    weighted = gauge.add_class_weights(train) if balanced else train
    model = gauge.fit_gauge(weighted, weight="w" if balanced else None)
    weights = {r["feature"]: r["weight"] for r in gauge.coefficient_table(spark, model).collect()}
    assert weights["ret_1d_w"] > 1 and weights["zscore_7"] < -0.5
    assert gauge.by_strength(gauge.coefficient_table(spark, model)).first()["feature"] == "ret_1d_w"
    scored = gauge.score(model, test)
    roc, pr = gauge.areas(scored)
    assert 0.8 < roc <= 1 and 0 < pr <= 1
    metrics = gauge.default_metrics(gauge.confusion(scored)).first()
    assert metrics["TP"] + metrics["FP"] + metrics["TN"] + metrics["FN"] == test.count()
