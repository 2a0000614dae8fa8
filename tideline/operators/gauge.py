"""A logistic gauge of the next return's sign: labels, splits, fit and evaluation."""

from __future__ import annotations

import datetime
from collections.abc import Sequence

from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tideline.functions import epoch_seconds, positive_probability
from tideline.operators.cleaning import present_columns
from tideline.operators.layout import Axis
from tideline.operators.quantiles import exact_quantiles, sketch_quantile
from tideline.operators.returns import with_forward_returns
from tideline.settings import FEATURES, THRESHOLDS

SPLIT_BUCKETS = 10_000
COUNTS = ("TP", "FP", "TN", "FN")


def direction_labels(
    forward: DataFrame, axis: Axis = Axis(), columns: Sequence[str] = FEATURES
) -> DataFrame:
    """Key, label 1.0 where the next return is positive, and complete features."""
    columns = present_columns(forward, columns)
    label = (F.col("ret_fwd1") > 0).cast("double").alias("label")
    return forward.dropna(subset=columns).select(axis.time, axis.entity, label, *columns)


def direction_labels_of(joined: DataFrame, axis: Axis = Axis()) -> DataFrame:
    return direction_labels(with_forward_returns(joined, axis), axis)


def split_bucket(rows: DataFrame, *keys: str) -> Column:
    """A number below ``SPLIT_BUCKETS`` that depends on the key alone.

    The same row always falls on the same side, however the data are partitioned and whatever
    the session's time zone: an instant counts by its microseconds, not by its text.
    """
    instants = {f.name for f in rows.schema if isinstance(f.dataType, T.TimestampType)}
    plain = [F.unix_micros(k) if k in instants else F.col(k) for k in keys]
    digest = F.md5(F.concat_ws("|", *[c.cast("string") for c in plain]))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint") % SPLIT_BUCKETS


def random_split(
    labelled: DataFrame, test_share: float = 0.2, axis: Axis = Axis()
) -> tuple[DataFrame, DataFrame]:
    """Training and test rows by a hash of the key."""
    test = split_bucket(labelled, axis.entity, axis.time) < round(test_share * SPLIT_BUCKETS)
    return labelled.where(~test), labelled.where(test)


def cut_time(
    labelled: DataFrame, test_share: float = 0.2, axis: Axis = Axis(), exact: bool = False
) -> DataFrame:
    """One row: epoch second up to which the first ``1 - test_share`` of rows lie."""
    seconds = labelled.select(epoch_seconds(F.col(axis.time)).alias("_seconds"))
    if exact:
        return exact_quantiles(seconds, [], "_seconds", {"cut_seconds": 1.0 - test_share})
    return seconds.agg(sketch_quantile("_seconds", 1.0 - test_share).alias("cut_seconds"))


def chronological_split(
    labelled: DataFrame,
    test_share: float = 0.2,
    cut_date: str | datetime.date | None = None,
    axis: Axis = Axis(),
    exact: bool = False,
) -> tuple[DataFrame, DataFrame]:
    """Rows up to the cut for training, later rows for testing."""
    if cut_date is not None:
        # A date literal reaches the scan; an exact day ends with its last instant.
        early = F.to_date(axis.time) <= F.to_date(F.lit(cut_date))
    else:
        cut = cut_time(labelled, test_share, axis, exact).scalar()
        early = epoch_seconds(F.col(axis.time)) <= cut
    return labelled.where(early), labelled.where(~early)


def class_weights(train: DataFrame) -> DataFrame:
    """One row: share of positives and the weight that balances each class."""
    share = F.avg("label")
    tiny = F.lit(1e-12)
    known = F.when(share > 0, share).otherwise(F.lit(0.5))
    return train.agg(known.alias("positive_share")).select(
        "positive_share",
        (F.lit(0.5) / F.greatest(F.col("positive_share"), tiny)).alias("w_pos"),
        (F.lit(0.5) / F.greatest(1.0 - F.col("positive_share"), tiny)).alias("w_neg"),
    )


def add_class_weights(train: DataFrame, column: str = "w") -> DataFrame:
    weights = class_weights(train).agg(
        F.first(F.struct("w_pos", "w_neg")).alias("w")
    ).scalar()
    chosen = F.when(F.col("label") == 1.0, weights["w_pos"]).otherwise(weights["w_neg"])
    return train.withColumn(column, chosen)


def as_vectors(labelled: DataFrame, columns: Sequence[str] = FEATURES) -> DataFrame:
    return VectorAssembler(inputCols=list(columns), outputCol="features").transform(labelled)


def fit_gauge(
    train: DataFrame, columns: Sequence[str] = FEATURES, weight: str | None = None
) -> LogisticRegressionModel:
    """Unregularised logistic regression."""
    regression = LogisticRegression(maxIter=100, regParam=0.0, elasticNetParam=0.0)
    if weight:
        regression = regression.setWeightCol(weight)
    return regression.fit(as_vectors(train, columns))


def score(
    model: LogisticRegressionModel, rows: DataFrame, columns: Sequence[str] = FEATURES
) -> DataFrame:
    """Rows with prediction, raw prediction and ``proba1``."""
    scored = model.transform(as_vectors(rows, columns))
    return scored.withColumn("proba1", positive_probability(F.col("probability")))


def confusion(scored: DataFrame) -> DataFrame:
    return (
        scored.groupBy("label", "prediction")
        .agg(F.count(F.lit(1)).alias("count"))
        .orderBy("label", "prediction")
    )


def _share(above: Column, below: Column) -> Column:
    return F.when(below > 0, above / below).otherwise(F.lit(0.0))


def add_point_metrics(counts: DataFrame) -> DataFrame:
    """Precision, recall, F1 and accuracy from TP, FP, TN and FN; 0 on empty denominators."""
    tp, fp, tn, fn = (F.col(c) for c in COUNTS)
    precision, recall = F.col("precision"), F.col("recall")
    return (
        counts.withColumns({"precision": _share(tp, tp + fp), "recall": _share(tp, tp + fn)})
        .withColumn("f1", _share(2 * precision * recall, precision + recall))
        .withColumn("accuracy", _share(tp + tn, tp + tn + fp + fn))
    )


def default_metrics(cells: DataFrame) -> DataFrame:
    """One row of counts and metrics from a confusion table."""

    def cell(label: float, prediction: float) -> Column:
        here = (F.col("label") == label) & (F.col("prediction") == prediction)
        return F.coalesce(F.sum(F.when(here, F.col("count"))), F.lit(0))

    counted = cells.agg(
        cell(1, 1).alias("TP"), cell(0, 1).alias("FP"), cell(0, 0).alias("TN"), cell(1, 0).alias("FN")
    )
    return add_point_metrics(counted)


def threshold_sweep(
    scored: DataFrame, thresholds: Sequence[float] = THRESHOLDS
) -> DataFrame:
    """Counts and metrics per threshold from one aggregation to a single row."""
    positive, negative = F.col("label") == 1, F.col("label") == 0
    aggs = []
    for i, t in enumerate(thresholds):
        above, below = F.col("proba1") >= t, F.col("proba1") < t
        aggs += [
            F.count_if(positive & above).alias(f"TP{i}"),
            F.count_if(negative & above).alias(f"FP{i}"),
            F.count_if(negative & below).alias(f"TN{i}"),
            F.count_if(positive & below).alias(f"FN{i}"),
        ]
    rows = F.array(
        *[
            F.struct(F.lit(float(t)).alias("threshold"), *[F.col(f"{c}{i}").alias(c) for c in COUNTS])
            for i, t in enumerate(thresholds)
        ]
    )
    counted = scored.agg(*aggs).select(F.inline(rows))
    return add_point_metrics(counted).orderBy("threshold")


def best_threshold(sweep: DataFrame) -> DataFrame:
    """Row of the sweep with the highest F1, the lowest threshold among equals."""
    return sweep.orderBy(F.desc("f1"), "threshold").limit(1)


def confusion_of(best: DataFrame) -> DataFrame:
    """Confusion table of one sweep row."""
    cells = [(0, 0, "TN"), (0, 1, "FP"), (1, 0, "FN"), (1, 1, "TP")]
    rows = F.array(
        *[
            F.struct(F.lit(y).alias("label"), F.lit(p).alias("prediction"), F.col(c).alias("count"))
            for y, p, c in cells
        ]
    )
    return best.select(F.inline(rows)).orderBy("label", "prediction")


def brier(scored: DataFrame) -> DataFrame:
    return scored.agg(F.avg(F.pow(F.col("proba1") - F.col("label"), 2)).alias("brier"))


PROBABILITY_QUANTILES = {"q10": 0.1, "q50": 0.5, "q90": 0.9}


def probability_quantiles(scored: DataFrame, exact: bool = False) -> DataFrame:
    if exact:
        return exact_quantiles(scored, [], "proba1", PROBABILITY_QUANTILES)
    return scored.agg(
        *[sketch_quantile("proba1", p).alias(n) for n, p in PROBABILITY_QUANTILES.items()]
    )


BASELINES = ("acc_majority", "f1_always_positive", "f1_always_negative", "f1_trivial_best")


def _baselines() -> list[Column]:
    known = F.coalesce("test_positive_rate", F.lit(0.5))
    always_up = F.when(known > 0, 2 * known / (1 + known)).otherwise(F.lit(0.0))
    values = (F.greatest(known, 1.0 - known), always_up, F.lit(0.0), always_up)
    return [value.alias(name) for value, name in zip(values, BASELINES)]


def trivial_baselines(test: DataFrame) -> DataFrame:
    """What always guessing the majority, or always guessing up, would score."""
    rate = test.agg(F.avg("label").alias("test_positive_rate"))
    return rate.select("test_positive_rate", *_baselines())


def score_summary(scored: DataFrame) -> DataFrame:
    """Rows, baselines, Brier score and score quantiles in one pass."""
    return scored.agg(
        F.count(F.lit(1)).alias("test_rows"),
        F.avg("label").alias("test_positive_rate"),
        F.avg(F.pow(F.col("proba1") - F.col("label"), 2)).alias("brier"),
        *[sketch_quantile("proba1", p).alias(n) for n, p in PROBABILITY_QUANTILES.items()],
    ).select("*", *_baselines())


def areas(
    scored: DataFrame, raw: str = "rawPrediction", bins: int = 1000
) -> tuple[float, float]:
    """Areas under the ROC and precision-recall curves; ``bins=0`` keeps every distinct score."""
    evaluator = BinaryClassificationEvaluator(
        rawPredictionCol=raw, labelCol="label", numBins=bins
    )
    return (
        float(evaluator.evaluate(scored, {evaluator.metricName: "areaUnderROC"})),
        float(evaluator.evaluate(scored, {evaluator.metricName: "areaUnderPR"})),
    )


def area_table(spark: SparkSession, roc: float, pr: float) -> DataFrame:
    return spark.createDataFrame([(roc, pr)], "roc_auc double, pr_auc double")


def coefficient_table(
    spark: SparkSession, model: LogisticRegressionModel, columns: Sequence[str] = FEATURES
) -> DataFrame:
    rows = [(c, float(w)) for c, w in zip(columns, model.coefficients)]
    return spark.createDataFrame(rows, "feature string, weight double")


def by_strength(coefficients: DataFrame, strongest_first: bool = True) -> DataFrame:
    strength = F.abs("weight")
    return coefficients.orderBy(F.desc(strength) if strongest_first else F.asc(strength), "feature")
