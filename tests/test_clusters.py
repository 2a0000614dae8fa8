import math
import random

import pytest
from pyspark.sql import functions as F

from tideline.operators import clusters, reshape
from tideline.settings import BLOWOFF, BULL, CALM, CHOPPY, FEATURES, SELLOFF


def centre(z, vol, gap):
    """ret_1d_w, zscore_7, ret_std_7, ret_std_30, ma_gap_7, ma_gap_30"""
    return [0.0, z, 0.0, vol, 0.0, gap]


def test_names_of_five():
    centres = {
        0: centre(2.1, 0.050, 0.10), 1: centre(-0.1, 0.037, 0.0), 2: centre(-1.7, 0.059, -0.09),
        3: centre(0.04, 0.074, 0.07), 4: centre(0.45, 0.078, 1.0),
    }
    assert clusters.name_regimes(centres) == {0: BLOWOFF, 1: CALM, 2: SELLOFF, 3: CHOPPY, 4: BULL}


def test_fewer_than_five_rank_by_gap_alone():
    centres = {0: centre(2.1, 0.05, 0.10), 1: centre(-1.0, 0.04, 0.0), 2: centre(0.4, 0.07, 1.0)}
    assert clusters.name_regimes(centres) == {2: BLOWOFF, 1: SELLOFF, 0: BULL}


def test_one_cluster_is_named_last_by_zscore():
    assert clusters.name_regimes({0: centre(1.0, 0.1, 0.1)}) == {0: SELLOFF}


def test_hottest_and_coldest_in_one():
    # By gap cluster 0 is hottest, by heat it is coldest: the lowest z-score decides.
    centres = {0: centre(-9.0, 0.1, 1.0), 1: centre(0.0, 0.2, 0.5), 2: centre(1.0, 0.3, 0.4)}
    named = clusters.name_regimes(centres)
    assert named[0] == SELLOFF and named[2] == BULL and named[1] == CALM


def test_six_clusters_leave_the_rest_choppy():
    centres = {i: centre(i - 3.0, 0.1 * (i + 1), 0.1 * i) for i in range(6)}
    named = clusters.name_regimes(centres)
    assert sorted(named.values()) == sorted([BLOWOFF, SELLOFF, BULL, CALM, CHOPPY, CHOPPY])


@pytest.fixture(scope="module")
def rows(spark):
    rng = random.Random(11)
    made = []
    for i in range(600):
        c = i % 3
        made.append((i, *[5.0 * c + rng.gauss(0, 0.3) for _ in FEATURES]))
    schema = "id long, " + ", ".join(f"{c} double" for c in FEATURES)
    return spark.createDataFrame(made, schema).cache()


def test_sweep_finds_the_groups(spark, rows):
    vectors = clusters.assemble(rows)
    scaler = clusters.fit_scaler(vectors)
    scaled = scaler.transform(vectors)
    fits = clusters.fit_sweep(scaled, [2, 3, 4], clusters.SCALED)
    best = clusters.best_fit(fits)
    assert best.k == 3 and sorted(best.sizes.values()) == [200, 200, 200]
    for fit in fits:
        assert sum(fit.sizes.values()) == 600 and -1 <= fit.silhouette <= 1
    sweep = clusters.sweep_table(spark, fits).collect()
    assert [r["k"] for r in sweep] == [2, 3, 4] and sweep[1]["sizes"]["c0"] == 200
    centres = sorted(clusters.unscaled(c, scaler)[0] for c in best.model.clusterCenters())
    assert centres == pytest.approx([0.0, 5.0, 10.0], abs=0.1)

    names = clusters.name_regimes({i: clusters.unscaled(c, scaler) for i, c in enumerate(best.model.clusterCenters())})
    table = clusters.centroid_table(spark, best, scaler, names)
    assert {r["label"] for r in table.collect()} == set(names.values())
    predicted = best.model.transform(scaled)
    regime = clusters.label_clusters(predicted, {0: "zero"})
    counted = {r[0]: r[1] for r in predicted.groupBy(regime.alias("r")).count().collect()}
    assert counted == {"zero": 200, "Unknown": 400}


def test_first_of_equal_silhouettes_wins():
    fits = [clusters.Fit(k, None, s, {}) for k, s in ((5, 0.4), (3, 0.4), (4, 0.3))]
    assert clusters.best_fit(fits).k == 3


def test_missing_and_null_features(spark, rows):
    with pytest.raises(ValueError, match="missing"):
        clusters.assemble(rows.drop("zscore_7"))
    holed = rows.withColumn("zscore_7", F.when(F.col("id") != 5, F.col("zscore_7")))
    assert clusters.assemble(holed).count() == 599
    assert clusters.centroid_means(holed.withColumn("c", F.lit(1)), "c").first()["n"] == 599


def test_silhouette_against_centres(spark, rows):
    centres = [[0.0] * 6, [5.0] * 6, [10.0] * 6]
    predicted = rows.withColumn("kpred", (F.col("id") % 3).cast("int"))
    got = clusters.silhouette_by_cluster(predicted, centres).collect()

    def score(row, own):
        apart = [math.dist([row[c] for c in FEATURES], c) for c in centres]
        a, b = apart[own], min(d for i, d in enumerate(apart) if i != own)
        return (b - a) / max(a, b)

    for k, row in enumerate(got):
        expected = [score(r, k) for r in predicted.where(F.col("kpred") == k).collect()]
        assert row["n"] == 200
        assert row["mean_silhouette"] == pytest.approx(sum(expected) / len(expected))
    # A single centre leaves nothing to compare with; a row on top of it scores 0.
    alone = spark.createDataFrame([(0, *[0.0] * 6)], "kpred int, " + ", ".join(f"{c} double" for c in FEATURES))
    assert clusters.silhouette_by_cluster(alone, [[0.0] * 6]).first()["mean_silhouette"] == 0.0


def test_silhouette_runs_without_python_workers(rows):
    predicted = rows.withColumn("kpred", F.lit(0))
    plan = clusters.silhouette_by_cluster(predicted, [[0.0] * 6, [1.0] * 6])._jdf.queryExecution().toString()
    assert "Python" not in plan


def test_long_centroids(rows):
    means = clusters.centroid_means(rows.withColumn("cluster", F.lit(1)), "cluster")
    long = reshape.long_centroids(means).collect()
    assert {r["feat"] for r in long} == set(FEATURES) and long[0]["cluster"] == 1


def test_label_order_and_replication(spark):
    table = spark.createDataFrame([("b", 2), ("z", 9)], "regime string, n int")
    ordered = [tuple(r) for r in reshape.in_label_order(table, ["a", "b", "c"]).collect()]
    assert ordered == [("a", None), ("b", 2), ("c", None)]
    panel = spark.createDataFrame([("s", 1), ("t", 2)], "symbol string, v int")
    copies = reshape.replicate_entities(panel, 3)
    assert sorted(tuple(r) for r in copies.collect()) == [
        ("s", 1), ("s_x1", 1), ("s_x2", 1), ("t", 2), ("t_x1", 2), ("t_x2", 2),
    ]
    plan = copies._jdf.queryExecution().toString()
    assert "Join" not in plan and "Exchange" not in plan


def test_nearest_centre_reads_each_vector_once(spark):
    from pyspark.ml.linalg import Vectors

    from tideline.plans.queries import _nearest

    centres = [[0.0, 0.0], [3.0, 4.0], [0.0, 0.0], [1.0, 1.0]]
    rows = [(Vectors.dense([0.1, 0.2]),), (Vectors.dense([2.9, 4.2]),), (Vectors.dense([0.6, 0.6]),), (Vectors.dense([0.5, 0.5]),)]
    nearest = _nearest("v", centres)
    got = [r.n for r in spark.createDataFrame(rows, ["v"]).select(nearest.alias("n")).collect()]
    # The first of equal centres wins: 0 over 2, and 0 over 3 for a point halfway between them.
    assert got == [0, 1, 3, 0]
    # Once per row, not once per centre and component.
    assert str(nearest).count("vector_to_array") == 1
