"""The stages from CSV files to saved results, with their conservation laws."""

import datetime
import glob
import json
import math
import random

import pytest

from tideline.plans import stages
from tideline.settings import FEATURES, REGIMES
from tideline.sources import readers, writers

DAYS, SYMBOLS = 120, ("aaa", "bbb", "ccc", "ddd")


@pytest.fixture(scope="module")
def root(tmp_path_factory):
    """CSV files in nested folders: one per symbol, one without symbols, one excluded."""
    folder = tmp_path_factory.mktemp("stages")
    rng = random.Random(9)
    header = "SNo,Name,Symbol,Date,High,Low,Open,Close,Volume,Marketcap"
    for i, symbol in enumerate((*SYMBOLS, "usdt")):
        lines, price = [header], 100.0
        for d in range(DAYS):
            price *= math.exp(rng.gauss(0, 0.02 * (1 + (d // 30 + i) % 3)))
            day = datetime.date(2020, 1, 1) + datetime.timedelta(days=d)
            told = "" if symbol == "bbb" else symbol
            lines.append(f'{d},n,{told},{day} 23:59:59,1,1,1,"${price:,.2f}",5,6')
        lines.append(f"{DAYS},n,{symbol},not a date,1,1,1,5,5,6")
        path = folder / "data" / f"part{i % 2}"
        path.mkdir(parents=True, exist_ok=True)
        (path / f"coin_{symbol}.csv").write_text("\n".join(lines) + "\n")
    (folder / "data" / "notes.txt").write_text("not,a,table")
    return str(folder)


@pytest.fixture(scope="module")
def features(spark, root):
    clean = stages.run_ingest(spark, f"{root}/data", f"{root}/cleaned")
    assert clean.count() == DAYS * len(SYMBOLS)
    assert sorted(r[0] for r in clean.select("symbol").distinct().collect()) == ["AAA", "BBB", "CCC", "DDD"]
    model = stages.run_features(spark, f"{root}/cleaned", f"{root}/full", f"{root}/model")
    assert spark.read.parquet(f"{root}/full").count() == DAYS * len(SYMBOLS)
    return model


@pytest.fixture(scope="module")
def predictions(spark, root, features):
    labels = stages.run_regimes(spark, f"{root}/model", f"{root}/regimes", ks=[3, 5])
    assert labels.count() == features.count()
    return labels


def one_json(path):
    (name,) = glob.glob(f"{path}/part-*")
    with open(name) as f:
        return json.load(f)


def test_model_features_are_complete(features):
    assert features.count() == (DAYS - 13) * len(SYMBOLS)
    assert features.dropna().count() == features.count()


def test_panel_is_partitioned_by_symbol(root):
    assert len(glob.glob(f"{root}/cleaned/symbol=*")) == len(SYMBOLS)


def test_diagnostics(spark, root, features):
    day = spark.read.parquet(f"{root}/model").agg({"Date": "max"}).first()[0]
    saved = stages.run_diagnostics(spark, f"{root}/model", f"{root}/diagnostics", event_day=day)
    assert set(saved) == {
        "anomaly_counts_by_coin", "anomaly_counts_by_date", "vol30_summary", "feature_percentiles",
        "widespread_down_days", "event_day",
    }
    assert saved["event_day"].count() == 1 and saved["feature_percentiles"].count() == 6
    assert saved["vol30_summary"].count() == len(SYMBOLS)


def test_regimes(root, predictions):
    metrics = one_json(f"{root}/regimes/metrics.json")
    assert [r["k"] for r in metrics["results"]] == [3, 5]
    best = metrics["best"]
    assert sum(best["sizes"].values()) == predictions.count()
    assert glob.glob(f"{best['model_dir']}/metadata/*")
    seen = {r[0] for r in predictions.select("regime").distinct().collect()}
    assert seen == set(best["label_map"].values()) <= set(REGIMES)
    assert len(glob.glob(f"{root}/regimes/centroids.csv/*.csv")) == 1


@pytest.mark.parametrize("mode,balance", [("random", False), ("chron", True)])
def test_analysis(spark, root, predictions, mode, balance):
    out = f"{root}/out_{mode}"
    saved = stages.run_analysis(
        spark, f"{root}/regimes/predictions.parquet",
        f"{root}/model", out, "all", split_mode=mode, balance_classes=balance, lead="AAA",
    )
    n, symbols = predictions.count(), len(SYMBOLS)
    seen = {r.symbol for r in predictions.select("symbol").collect()}
    assert {r.symbol for r in saved["symbols"].collect()} == seen
    assert one_json(f"{out}/manifest.json")["symbols_table"] == "symbols"
    assert saved["breadth_conservation"].first()["bad_dates"] == 0
    assert saved["change_tallies"].first()["rows_with_prev"] == n - 2 * symbols
    total = lambda name, column: saved[name].agg({column: "sum"}).first()[0]
    assert total("regime_counts", "count") == n
    assert total("transitions_counts", "count") == n - symbols
    assert saved["transitions_counts"].where("regime_next IS NULL").agg({"count": "sum"}).first()[0] == symbols
    lengths = saved["dwell_overall"].selectExpr("sum(num_runs * mean_len)").first()[0]
    assert lengths == pytest.approx(n)
    assert total("returns_overall", "n") == n == total("returns_by_symbol", "n")
    assert total("returns_fwd1_overall", "n") == n - symbols == total("returns_fwd1_by_symbol", "n")
    assert total("transitions_fwd1_stay_vs_change", "n") == n - 2 * symbols
    assert total("transitions_fwd1_overall", "n") == total("transitions_fwd1_by_symbol", "n")
    assert saved["breadth_daily"].where("total_syms <> %d" % symbols).isEmpty()
    assert total("step6_cluster_centroids", "n") == n == total("step6_per_cluster_silhouette", "n")
    tested = total("gauge_confusion_default", "count")
    for row in saved["gauge_threshold_sweep"].collect():
        assert row["TP"] + row["FP"] + row["TN"] + row["FN"] == tested
    assert total("gauge_confusion_best", "count") == tested
    metrics = one_json(f"{out}/gauge_metrics.json")
    assert metrics["train_rows"] + metrics["test_rows"] == n - symbols
    assert 0 <= metrics["roc_auc"] <= 1 and metrics["features"] == list(FEATURES)
    assert len(metrics["threshold_sweep"]) == 9 and len(metrics["coefficients"]) == 6
    assert sum(metrics["best_confusion"].values()) == metrics["test_rows"] == tested
    assert metrics["best_f1"] == max(r["f1"] for r in metrics["threshold_sweep"])
    assert one_json(f"{out}/manifest.json")["rows"] == n
    assert one_json(f"{out}/step2_manifest.json")["ok"] is True
    assert len(one_json(f"{out}/breadth_lead_corr.json")["corr_frac_vs_lead_fwd1"]) == 5
    assert one_json(f"{out}/step6_manifest.json")["kmeans_k"] == 5
    # Both forms, one file each for short results, and the CSV form reads back the same.
    assert len(glob.glob(f"{out}/matrix_prob/*.parquet")) == 1
    assert len(glob.glob(f"{out}/matrix_prob_csv/*.csv")) == 1
    text = spark.read.option("header", True).csv(f"{out}/matrix_prob_csv")
    assert text.count() == saved["matrix_prob"].count()


def test_steps_can_be_chosen(spark, root, predictions):
    saved = stages.run_analysis(
        spark, f"{root}/regimes/predictions.parquet", None, f"{root}/some", [2], cache=False
    )
    assert "stay_prob" in saved and "returns_overall" not in saved
    with pytest.raises(ValueError, match="features"):
        stages.run_analysis(spark, f"{root}/regimes/predictions.parquet", None, f"{root}/x", [3])


def test_result_scan_prefers_parquet(spark, tmp_path):
    base = str(tmp_path)
    rows = spark.createDataFrame([("a", 1)], "regime string, n int")
    writers.save_result(rows, f"{base}/both")
    writers.save_csv(spark.createDataFrame([("b", 2)], "regime string, n int"), f"{base}/text_csv")
    assert readers.read_table(spark, base, "both").first()["regime"] == "a"
    assert tuple(readers.read_table(spark, base, "text").first()) == ("b", 2)
    with pytest.raises(Exception):
        readers.read_table(spark, base, "none").collect()


def test_json_summary_keeps_nulls(spark, tmp_path):
    writers.save_json(spark.createDataFrame([(1, None)], "a int, b string"), f"{tmp_path}/s")
    assert one_json(f"{tmp_path}/s") == {"a": 1, "b": None}
