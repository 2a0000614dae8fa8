"""Rolling features of price bars: moving averages, returns, winsorising, z-scores, gaps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tideline.functions import clamp, guarded_zscore, log_return, relative_gap
from tideline.operators import layout
from tideline.operators.layout import Axis
from tideline.settings import FEATURES, FeatureSettings

DERIVED = (
    "ma_close_7", "ma_close_30", "ret_1d", "ret_pct", "q_lo", "q_hi", "ret_1d_w",
    "ret_mean_7", "ret_std_7", "cnt_7", "ret_mean_30", "ret_std_30", "cnt_30", "rn",
    "zscore_7", "zscore_30", "ma_gap_7", "ma_gap_30",
)


def bar_features(
    bars: DataFrame,
    axis: Axis = Axis(),
    price: str = "Close",
    settings: FeatureSettings = FeatureSettings(),
) -> DataFrame:
    """``bars`` plus every derived column, one row per input row.

    Frames count rows, not days. Trailing statistics leave the current row out; moving
    averages include it and accept short frames. One shuffle of the bars, by (entity,
    block), serves all windows, the winsor bounds among them. Only where an entity is cut into
    blocks are its bounds aggregated apart, which reads the bars a second time.
    """
    axis = axis.measured(bars)
    # The longest trailing frame needs returns, and each return one price more.
    laid = layout.cut(bars, axis, before=settings.long + 1)
    laid = add_returns(laid, axis, price, settings)
    laid = add_winsor(laid, axis, settings)
    laid = add_zscores(laid, axis, price, settings)
    return layout.home_rows(laid).select(*bars.columns, *DERIVED)


def add_returns(laid: DataFrame, axis: Axis, price: str, settings: FeatureSettings) -> DataFrame:
    w = axis.window()
    now, before = F.col(price), F.col("_price_before")
    simple = relative_gap(now, before)
    return (
        laid.withColumns(
            {
                "ma_close_7": F.avg(price).over(w.rowsBetween(1 - settings.short, 0)),
                "ma_close_30": F.avg(price).over(w.rowsBetween(1 - settings.long, 0)),
                "_price_before": F.lag(price).over(w),
            }
        )
        .withColumns(
            {
                "ret_1d": log_return(now, before) if settings.log_returns else simple,
                "ret_pct": simple,
            }
        )
        .drop("_price_before")
    )


def winsor_bounds(laid: DataFrame, axis: Axis, settings: FeatureSettings) -> DataFrame:
    """Bounds per (entity, block): an entity's bounds, repeated for each of its blocks.

    Keyed like the laid-out rows, so attaching them moves no rows and no block is larger
    than the others.
    """
    by_entity = layout.home_rows(laid, keep_block=True).groupBy(axis.entity).agg(
        F.percentile_approx(
            "ret_1d", [settings.winsor_low, settings.winsor_high], settings.accuracy
        ).alias("_bounds"),
        F.collect_set(layout.BLOCK).alias("_in"),
    )
    return by_entity.select(
        axis.entity,
        F.explode("_in").alias(layout.BLOCK),
        F.col("_bounds")[0].alias("q_lo"),
        F.col("_bounds")[1].alias("q_hi"),
    )


def add_winsor(laid: DataFrame, axis: Axis, settings: FeatureSettings) -> DataFrame:
    shares = [settings.winsor_low, settings.winsor_high]
    if axis.hot:
        # Plain equality keeps the layout; rows without entity, which it cannot match, are one
        # group, whose bounds are a single value.
        joined = laid.join(winsor_bounds(laid, axis, settings), axis.block_keys(), "left")
        nameless = layout.home_rows(laid.where(F.col(axis.entity).isNull()))
        of_none = nameless.agg(F.percentile_approx("ret_1d", shares, settings.accuracy).alias("b")).scalar()
        missing = F.col(axis.entity).isNull()
        joined = joined.withColumns(
            {c: F.when(missing, of_none[i]).otherwise(F.col(c)) for i, c in enumerate(("q_lo", "q_hi"))}
        )
    else:
        whole = F.percentile_approx("ret_1d", shares, settings.accuracy).over(axis.group())
        joined = (
            laid.withColumn("_bounds", whole)
            .withColumns({"q_lo": F.col("_bounds")[0], "q_hi": F.col("_bounds")[1]})
            .drop("_bounds")
        )
    return joined.withColumn("ret_1d_w", clamp(F.col("ret_1d"), F.col("q_lo"), F.col("q_hi")))


def add_zscores(laid: DataFrame, axis: Axis, price: str, settings: FeatureSettings) -> DataFrame:
    w = axis.window()
    trailing = {"rn": layout.position(axis)}
    for tag, span in (("7", settings.short), ("30", settings.long)):
        frame = w.rowsBetween(-span, -1)
        trailing[f"ret_mean_{tag}"] = F.avg("ret_1d_w").over(frame)
        trailing[f"ret_std_{tag}"] = F.stddev_samp("ret_1d_w").over(frame)
        trailing[f"cnt_{tag}"] = F.count("ret_1d_w").over(frame)
    scored = {}
    for tag, least in (("7", settings.min_short), ("30", settings.min_long)):
        scored[f"zscore_{tag}"] = guarded_zscore(
            F.col("ret_1d_w"),
            F.col(f"ret_mean_{tag}"),
            F.col(f"ret_std_{tag}"),
            F.col(f"cnt_{tag}"),
            F.col("rn"),
            least,
            settings.sigma_floor,
            settings.burn_in,
        )
        scored[f"ma_gap_{tag}"] = relative_gap(F.col(price), F.col(f"ma_close_{tag}"))
    return laid.withColumns(trailing).withColumns(scored)


def model_features(features: DataFrame, axis: Axis = Axis()) -> DataFrame:
    """Rows on which all six model features are set, and only the columns a model needs."""
    return features.dropna(subset=list(FEATURES)).select(axis.time, axis.entity, *FEATURES)
