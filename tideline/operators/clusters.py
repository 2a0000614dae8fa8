"""K-Means regimes: scaling, the sweep over k, naming, labelling and cluster quality."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.ml.clustering import KMeans, KMeansModel
from pyspark.ml.evaluation import ClusteringEvaluator
from pyspark.ml.feature import StandardScaler, StandardScalerModel, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.storagelevel import StorageLevel

from tideline.operators.cleaning import present_columns
from tideline.settings import BLOWOFF, BULL, CALM, CHOPPY, FEATURES, SEED, SELLOFF

RAW = "features"
SCALED = "scaledFeatures"


def assemble(df: DataFrame, columns: Sequence[str] = FEATURES) -> DataFrame:
    """Adds the feature vector; rows with a NULL feature are dropped."""
    columns = present_columns(df, [], required=columns)
    assembler = VectorAssembler(inputCols=columns, outputCol=RAW, handleInvalid="error")
    return assembler.transform(df.dropna(subset=columns))


def fit_scaler(vectors: DataFrame) -> StandardScalerModel:
    """Mean and sample deviation of each feature."""
    return StandardScaler(
        inputCol=RAW, outputCol=SCALED, withMean=True, withStd=True
    ).fit(vectors)


def scaled_columns(scaled: DataFrame, columns: Sequence[str] = FEATURES) -> list[Column]:
    """The scaled vector as one column per feature, named ``scaled_<feature>``."""
    values = vector_to_array(F.col(SCALED))
    return [values.getItem(i).alias(f"scaled_{c}") for i, c in enumerate(columns)]


@dataclass
class Fit:
    """One K-Means fit."""

    k: int
    model: KMeansModel
    silhouette: float
    sizes: dict[int, int]


def fit_kmeans(
    vectors: DataFrame, k: int, column: str = RAW, seed: int = SEED, prediction: str = "cluster"
) -> Fit:
    model = KMeans(k=k, seed=seed, featuresCol=column, predictionCol=prediction).fit(vectors)
    predicted = model.transform(vectors)
    silhouette = ClusteringEvaluator(
        featuresCol=column, predictionCol=prediction, distanceMeasure="squaredEuclidean"
    ).evaluate(predicted)
    sizes = {c: n for c, n in enumerate(model.summary.clusterSizes) if n}
    return Fit(k, model, float(silhouette), sizes)


def fit_sweep(
    vectors: DataFrame,
    ks: Iterable[int] = range(3, 9),
    column: str = RAW,
    seed: int = SEED,
) -> list[Fit]:
    """One fit per k over vectors that are read once and kept for the length of the sweep."""
    kept = vectors.select(column).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        return [fit_kmeans(kept, k, column, seed) for k in ks]
    finally:
        kept.unpersist()


def best_fit(fits: Sequence[Fit]) -> Fit:
    """Highest silhouette; the smallest k among equals."""
    return max(sorted(fits, key=lambda f: f.k), key=lambda f: f.silhouette)


def sweep_table(spark: SparkSession, fits: Sequence[Fit]) -> DataFrame:
    schema = "k int, silhouette double, sizes map<string,bigint>"
    rows = [(f.k, f.silhouette, {f"c{c}": n for c, n in f.sizes.items()}) for f in fits]
    return spark.createDataFrame(rows, schema)


def unscaled(
    centre: Sequence[float], scaler: StandardScalerModel | None
) -> list[float]:
    """A centre back in the units of the features."""
    if scaler is None:
        return [float(v) for v in centre]
    return [float(v * s + m) for v, s, m in zip(centre, scaler.std, scaler.mean)]


def name_regimes(
    centres: Mapping[int, Sequence[float]], columns: Sequence[str] = FEATURES
) -> dict[int, str]:
    """Regime of each cluster from its centre in feature units.

    ``heat`` tilts the 30-row gap by the z-score. The hottest cluster is the blow-off (by gap
    alone with fewer than five clusters) and the coldest the sell-off; of the rest the most
    bullish is the bull impulse, then the least volatile is calm, and others are choppy.
    """
    clusters = sorted(centres)
    feature = {c: dict(zip(columns, centres[c])) for c in clusters}

    def z(c: int) -> float:
        return feature[c]["zscore_7"]

    def gap(c: int) -> float:
        return feature[c]["ma_gap_30"]

    def heat(c: int) -> float:
        return gap(c) + 0.75 * z(c)

    blowoff = max(clusters, key=heat if len(clusters) >= 5 else gap)
    names = {blowoff: BLOWOFF}
    coldest = min(clusters, key=heat)
    # A single cluster can be both; then the lowest z-score decides, and may rename it.
    names[min(clusters, key=z) if coldest in names else coldest] = SELLOFF
    for regime, choose in (
        (BULL, lambda rest: max(rest, key=lambda c: z(c) + 0.5 * gap(c))),
        (CALM, lambda rest: min(rest, key=lambda c: feature[c]["ret_std_30"])),
    ):
        rest = [c for c in clusters if c not in names]
        if rest:
            names[choose(rest)] = regime
    return {c: names.get(c, CHOPPY) for c in clusters}


def label_clusters(
    predicted: DataFrame, names: Mapping[int, str], prediction: str = "cluster"
) -> Column:
    """Regime of the predicted cluster by a literal map, ``Unknown`` if it has no name."""
    pairs = [F.lit(v) for c, name in names.items() for v in (c, name)]
    return F.coalesce(F.create_map(*pairs)[predicted[prediction]], F.lit("Unknown"))


def centroid_table(
    spark: SparkSession,
    fit: Fit,
    scaler: StandardScalerModel | None,
    names: Mapping[int, str],
    columns: Sequence[str] = FEATURES,
) -> DataFrame:
    """One row per cluster: its regime and its centre as fitted and in feature units."""
    fields = [T.StructField("cluster", T.IntegerType()), T.StructField("label", T.StringType())]
    for c in columns:
        fields.append(T.StructField(f"scaled_{c}", T.DoubleType()))
        fields.append(T.StructField(f"orig_{c}", T.DoubleType()))
    rows = []
    for cluster, centre in enumerate(fit.model.clusterCenters()):
        pairs = zip(centre, unscaled(centre, scaler))
        rows.append((cluster, names[cluster], *[float(v) for pair in pairs for v in pair]))
    return spark.createDataFrame(rows, T.StructType(fields))


def plain_centroid_table(
    spark: SparkSession, centres: Sequence[Sequence[float]], columns: Sequence[str] = FEATURES
) -> DataFrame:
    """One row per centre, one column per feature."""
    fields = [T.StructField("k", T.IntegerType())]
    fields += [T.StructField(c, T.DoubleType()) for c in columns]
    rows = [(i, *[float(v) for v in centre]) for i, centre in enumerate(centres)]
    return spark.createDataFrame(rows, T.StructType(fields))


def centroid_means(
    joined: DataFrame, by: str, columns: Sequence[str] = FEATURES
) -> DataFrame:
    """Mean of each feature and row count per cluster or regime, complete rows only."""
    columns = present_columns(joined, columns)
    means = [F.avg(c).alias(f"avg_{c}") for c in columns]
    grouped = joined.dropna(subset=columns).groupBy(by)
    return grouped.agg(*means, F.count(F.lit(1)).alias("n")).orderBy(by)


def with_centre_silhouette(
    predicted: DataFrame,
    centres: Sequence[Sequence[float]],
    prediction: str = "kpred",
    columns: Sequence[str] = FEATURES,
) -> DataFrame:
    """Adds ``silhouette``: how much nearer a row is to its own centre than to the next.

    Plain arithmetic on the feature columns, with the few centres as literals.
    """

    def squared_distance(centre: Sequence[float]) -> Column:
        apart = [F.col(c) - F.lit(float(v)) for c, v in zip(columns, centre)]
        return sum((d * d for d in apart[1:]), apart[0] * apart[0])

    to_centre = {f"_to_{i}": squared_distance(c) for i, c in enumerate(centres)}
    mine = [F.when(F.col(prediction) == i, F.col(d)) for i, d in enumerate(to_centre)]
    others = [F.when(F.col(prediction) != i, F.col(d)) for i, d in enumerate(to_centre)]
    nearest = F.least(*others) if len(centres) > 1 else F.lit(0.0)
    own, other = F.col("_own"), F.col("_other")
    wider = F.greatest(own, other)
    score = F.when(wider > 0, (other - own) / wider).otherwise(F.lit(0.0))
    return (
        predicted.withColumns(to_centre)
        .withColumns({"_own": F.sqrt(F.coalesce(*mine)), "_other": F.sqrt(nearest)})
        .withColumn("silhouette", score)
        .drop("_own", "_other", *to_centre)
    )


def silhouette_by_cluster(
    predicted: DataFrame,
    centres: Sequence[Sequence[float]],
    prediction: str = "kpred",
    columns: Sequence[str] = FEATURES,
) -> DataFrame:
    """Rows and mean centre silhouette per cluster."""
    return (
        with_centre_silhouette(predicted, centres, prediction, columns)
        .groupBy(prediction)
        .agg(F.count(F.lit(1)).alias("n"), F.avg("silhouette").alias("mean_silhouette"))
        .orderBy(prediction)
    )
