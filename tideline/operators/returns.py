"""Returns by regime: same day, next day, and after a change of regime."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tideline.operators import layout
from tideline.operators.cleaning import present_columns
from tideline.operators.layout import Axis
from tideline.operators.quantiles import exact_quantiles, sketch_quantile
from tideline.operators.transitions import add_change_flags
from tideline.settings import FEATURES


def join_features(labels: DataFrame, features: DataFrame, axis: Axis = Axis()) -> DataFrame:
    """Labels with the model features of the same (time, entity), where both exist.

    The key is unique on both sides, so no key is hot; Spark picks the join by size.
    """
    columns = present_columns(features, FEATURES, required=["ret_1d_w"])
    day = F.col(axis.time).cast(labels.schema[axis.time].dataType).alias(axis.time)
    return labels.join(features.select(day, axis.entity, *sorted(columns)), [axis.time, axis.entity])


def return_stats(
    df: DataFrame,
    value: str,
    by: Sequence[str],
    suffix: str = "",
    exact_median: bool = False,
    few_groups: bool = False,
) -> DataFrame:
    """Count, mean, median, deviation, share of gains and Sharpe ratio of ``value`` per group.

    The median comes from the one-pass sketch unless ``exact_median``. ``few_groups`` states that
    the groups are a short fixed list, such as labels, whose medians' brackets may be broadcast.
    """
    mean, median, std = f"mean_ret{suffix}", f"median_ret{suffix}", f"std_ret{suffix}"
    stats = df.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n"),
        F.avg(value).alias(mean),
        *([] if exact_median else [sketch_quantile(value, 0.5).alias(median)]),
        F.stddev_samp(value).alias(std),
        F.avg(F.when(F.col(value) > 0, 1.0).otherwise(0.0)).alias(f"hit_rate{suffix}"),
    )
    if exact_median:
        stats = stats.join(
            exact_quantiles(df, by, value, {median: 0.5}, few_groups=few_groups), list(by), "left"
        )
    sharpe = F.when(F.col(std) > 0, F.col(mean) / F.col(std))
    return stats.select(
        *by, "n", mean, median, std, f"hit_rate{suffix}", sharpe.alias(f"sharpe_d{suffix}")
    )


def with_forward_returns(
    joined: DataFrame, axis: Axis = Axis(), value: str = "ret_1d_w"
) -> DataFrame:
    """Rows whose next row in their entity has a return, with it as ``ret_fwd1`` and the regime of
    the row before, among the rows kept, as ``regime_prev`` plus the change flags.

    Each lookup has a layout of its own, since the first decides which rows the second sees;
    without hot entities both are the same shuffle.
    """
    axis = axis.measured(joined)
    ahead = layout.cut(joined, axis, after=1).withColumn("ret_fwd1", F.lead(value).over(axis.window()))
    kept = layout.home_rows(ahead).where(F.col("ret_fwd1").isNotNull())
    behind = layout.cut(kept, axis, before=1)
    flagged = add_change_flags(behind.withColumn("regime_prev", F.lag("regime").over(axis.window())))
    return layout.home_rows(flagged.withColumn("has_prev", F.col("regime_prev").isNotNull()))


def forward_series(
    features: DataFrame, symbol: str, axis: Axis = Axis(), value: str = "ret_1d_w"
) -> DataFrame:
    """Next return of one entity by time; its last row is kept with NULL."""
    axis = axis.measured(features)
    one = features.where(F.col(axis.entity) == symbol).select(axis.entity, axis.time, value)
    laid = layout.cut(one, axis, after=1)
    shifted = laid.withColumn("ret_fwd1", F.lead(value).over(axis.window()))
    return layout.home_rows(shifted).select(axis.time, axis.entity, "ret_fwd1")


def returns_by(
    joined: DataFrame, by: Sequence[str], exact_median: bool = False
) -> DataFrame:
    """Same-day return statistics, best mean first within a regime."""
    stats = return_stats(joined, "ret_1d_w", by, exact_median=exact_median)
    return stats.orderBy(*_regime_first(by), F.desc("mean_ret"), *by)


def forward_returns_by(
    forward: DataFrame, by: Sequence[str], exact_median: bool = False
) -> DataFrame:
    """Next-day return statistics, best mean first within a regime or transition."""
    stats = return_stats(forward, "ret_fwd1", by, "_fwd1", exact_median)
    return stats.orderBy(*_regime_first(by), F.desc("mean_ret_fwd1"), *by)


def _regime_first(by: Sequence[str]) -> list[str]:
    return [c for c in ("regime", "transition") if c in by and len(by) > 1]


def change_returns(
    forward: DataFrame, by: Sequence[str] = ("transition",), exact_median: bool = False
) -> DataFrame:
    """Next-day returns after each change of regime."""
    return forward_returns_by(forward.where("is_transition"), by, exact_median)


def stay_or_change_returns(forward: DataFrame, exact_median: bool = False) -> DataFrame:
    """Next-day returns of rows whose regime changed against rows whose regime stayed."""
    return forward_returns_by(forward.where("has_prev"), ["is_transition"], exact_median)


def change_tallies(forward: DataFrame) -> DataFrame:
    """Rows with a row before, and how many of them changed or stayed."""
    return forward.agg(
        F.count_if("has_prev").alias("rows_with_prev"),
        F.count_if("is_transition").alias("transitions"),
        F.count_if(F.col("has_prev") & ~F.col("is_transition")).alias("stays"),
    )


def change_counts(forward: DataFrame) -> DataFrame:
    counted = forward.where("is_transition").groupBy("transition")
    return counted.agg(F.count(F.lit(1)).alias("count")).orderBy(F.desc("count"), "transition")


def top_changes(changes: DataFrame, n: int = 15) -> DataFrame:
    """Transitions with the largest absolute mean next-day return."""
    strength = F.abs("mean_ret_fwd1")
    return (
        changes.where(F.col("mean_ret_fwd1").isNotNull())
        .orderBy(F.desc(strength), "transition")
        .limit(n)
    )
