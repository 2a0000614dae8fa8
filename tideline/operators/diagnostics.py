"""Anomalies, volatility and top movers."""

from __future__ import annotations

import datetime
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tideline.operators.layout import Axis
from tideline.operators.quantiles import column_quantiles, sketch_quantile
from tideline.settings import ANOMALY_Z, FEATURES, TOP_K, WIDESPREAD_DOWN

PERCENTILES = {"p01": 0.01, "p50": 0.50, "p99": 0.99}


def feature_percentiles(
    features: DataFrame, columns: Sequence[str] = FEATURES, exact: bool = False
) -> DataFrame:
    return column_quantiles(features, columns, PERCENTILES, exact)


def _signed_counts(limit: float) -> list[Column]:
    z = F.col("zscore_7")
    return [F.count_if(z >= limit).alias("up_3p"), F.count_if(z <= -limit).alias("dn_3p")]


def anomaly_counts(features: DataFrame, axis: Axis = Axis(), limit: float = ANOMALY_Z) -> DataFrame:
    """Two-sided anomalies per entity."""
    hits = F.count_if(F.abs("zscore_7") >= limit).alias("anom_7_count")
    return features.groupBy(axis.entity).agg(hits).orderBy(axis.entity)


def anomalies_by_entity(
    features: DataFrame, axis: Axis = Axis(), limit: float = ANOMALY_Z
) -> DataFrame:
    """Signed anomalies per entity, most downward first."""
    counted = features.groupBy(axis.entity).agg(*_signed_counts(limit))
    return counted.orderBy(F.desc("dn_3p"), F.desc("up_3p"), axis.entity)


def anomalies_by_date(
    features: DataFrame, axis: Axis = Axis(), limit: float = ANOMALY_Z
) -> DataFrame:
    return features.groupBy(axis.time).agg(*_signed_counts(limit)).orderBy(axis.time)


def anomalies_on(
    features: DataFrame, day: str | datetime.date, axis: Axis = Axis(), limit: float = ANOMALY_Z
) -> DataFrame:
    """Signed anomalies of one date; the filter reaches the scan of ``features``."""
    return anomalies_by_date(features.where(F.col(axis.time) == F.lit(day)), axis, limit)


def widespread_down_days(
    by_date: DataFrame, at_least: int = WIDESPREAD_DOWN, time: str = "Date"
) -> DataFrame:
    return by_date.where(F.col("dn_3p") >= at_least).orderBy(F.desc("dn_3p"), time)


def volatility_summary(features: DataFrame, axis: Axis = Axis()) -> DataFrame:
    """Median and largest 30-row volatility per entity, calmest last."""
    return (
        features.groupBy(axis.entity)
        .agg(
            sketch_quantile("ret_std_30", 0.5).alias("vol30_med"),
            F.max("ret_std_30").alias("vol30_max"),
        )
        .orderBy(F.desc("vol30_med"), axis.entity)
    )


def top_per_group(
    df: DataFrame, by: Sequence[str], order: Sequence[Column], n: int, rank: str = "rank"
) -> DataFrame:
    """First ``n`` rows of each group. Spark limits each map task to ``n`` per group before
    it shuffles, so a hot group sends only ``n`` rows per task."""
    w = Window.partitionBy(*by).orderBy(*order)
    return df.withColumn(rank, F.row_number().over(w)).where(F.col(rank) <= n)


def top_moves(features: DataFrame, up: bool, axis: Axis = Axis(), n: int = 5) -> DataFrame:
    """Largest rises (or falls) per entity by simple return; ties go to the earlier row."""
    order = [F.desc("ret_pct") if up else F.asc("ret_pct"), F.asc(axis.time)]
    moved = features.where(F.col("ret_pct").isNotNull())
    return (
        top_per_group(moved, [axis.entity], order, n)
        .select(axis.entity, axis.time, "ret_pct", "zscore_7")
        .orderBy(axis.entity, axis.time)
    )


def top_zscores(features: DataFrame, axis: Axis = Axis(), n: int = TOP_K) -> DataFrame:
    """Rows with the largest absolute z-scores in the whole panel."""
    columns = ("ret_1d", "ret_1d_w", "ret_mean_7", "ret_std_7", "zscore_7")
    return (
        features.where(F.col("zscore_7").isNotNull())
        .select(axis.time, axis.entity, "Close", *columns)
        .orderBy(F.desc(F.abs("zscore_7")), axis.entity, axis.time)
        .limit(n)
    )


def volatility_series(
    features: DataFrame, symbol: str, axis: Axis = Axis(), first: int | None = None
) -> DataFrame:
    """30-row volatility of one entity over time, whole or its ``first`` rows."""
    series = (
        features.where(F.col(axis.entity) == symbol)
        .select(axis.time, axis.entity, "ret_std_30")
        .orderBy(axis.time)
    )
    return series if first is None else series.limit(first)
