"""Rolling statistics over spans of time instead of numbers of rows."""

from __future__ import annotations

import datetime
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tideline.functions import guarded_zscore, log_return
from tideline.operators import layout
from tideline.operators.layout import Axis
from tideline.settings import FeatureSettings

DAYS = {"7d": datetime.timedelta(days=7), "30d": datetime.timedelta(days=30)}


def add_span_statistics(
    laid: DataFrame, axis: Axis, value: str, spans: Mapping[str, datetime.timedelta], prefix: str, now: bool
) -> DataFrame:
    """``{prefix}_mean_{tag}``, ``_std_``, ``_count_`` of ``value`` over each span before a row.

    A span reaches back from a row's time, which it includes or, without ``now``, leaves out
    together with all rows of that time. Rows without a time have NULLs.
    """
    tick = layout.ticks_of(F.col(axis.time), laid.schema[axis.time].dataType)
    w = Window.partitionBy(*axis.block_keys()).orderBy("_tick")
    timed = F.col("_tick").isNotNull()
    out: dict[str, Column] = {}
    for tag, span in spans.items():
        reach = layout.reach_of(laid, axis, span)
        frame = w.rangeBetween(1 - reach, 0) if now else w.rangeBetween(-reach, -1)
        out[f"{prefix}_mean_{tag}"] = F.when(timed, F.avg(value).over(frame))
        out[f"{prefix}_std_{tag}"] = F.when(timed, F.stddev_samp(value).over(frame))
        out[f"{prefix}_count_{tag}"] = F.when(timed, F.count(value).over(frame))
    return laid.withColumn("_tick", tick).withColumns(out).drop("_tick")


def add_running_span_statistics(
    laid: DataFrame, axis: Axis, value: str, spans: Mapping[str, datetime.timedelta], prefix: str, now: bool
) -> DataFrame:
    """The columns of :func:`add_span_statistics`, in time linear in the rows of a block.

    A frame of a span is the difference of two running frames from the block's start, which Spark
    extends row by row instead of summing each span anew; the sums are decimals, so whole numbers
    (such as cents) and numbers of up to three decimals give exact sums and differences.
    """
    tick = layout.ticks_of(F.col(axis.time), laid.schema[axis.time].dataType)
    w = Window.partitionBy(*axis.block_keys()).orderBy("_tick")
    timed = F.col("_tick").isNotNull()
    x = F.col(value).try_cast(T.DecimalType(38, 9))
    parts = {
        "_n": F.when(timed & F.col(value).isNotNull(), F.lit(1)).otherwise(F.lit(0)).cast("bigint"),
        "_s1": F.when(timed, x),
        "_s2": F.when(timed, x * x),
    }
    out: dict[str, Column] = {}
    for tag, span in spans.items():
        reach = layout.reach_of(laid, axis, span)
        upper = w.rangeBetween(Window.unboundedPreceding, 0 if now else -1)
        lower = w.rangeBetween(Window.unboundedPreceding, -reach if now else -reach - 1)
        n, s1, s2 = (
            F.coalesce(F.sum(c).over(upper), F.lit(0)) - F.coalesce(F.sum(c).over(lower), F.lit(0))
            for c in parts
        )
        spread = (n * s2 - s1 * s1).cast("double") / (n * (n - 1)).cast("double")
        out[f"{prefix}_mean_{tag}"] = F.when(timed & (n > 0), s1.cast("double") / n.cast("double"))
        out[f"{prefix}_std_{tag}"] = F.when(timed & (n > 1), F.sqrt(F.greatest(spread, F.lit(0.0))))
        out[f"{prefix}_count_{tag}"] = F.when(timed, n)
    return laid.withColumn("_tick", tick).withColumns(parts).withColumns(out).drop("_tick", *parts)


def span_statistics(
    rows: DataFrame,
    axis: Axis,
    value: str,
    spans: Mapping[str, datetime.timedelta] = DAYS,
    prefix: str = "span",
    now: bool = True,
) -> DataFrame:
    """``rows`` with statistics of ``value`` over spans of time, one row per input row.

    One shuffle by (entity, block). A hot entity is cut along time, and a block carries copies of
    the rows within the longest span before it, however many they are.
    """
    axis = axis.measured(rows)
    reach = max(layout.reach_of(rows, axis, span) for span in spans.values())
    laid = layout.cut(rows, axis, reach=reach)
    return layout.home_rows(add_running_span_statistics(laid, axis, value, spans, prefix, now))


def calendar_features(
    bars: DataFrame,
    axis: Axis = Axis(),
    price: str = "Close",
    settings: FeatureSettings = FeatureSettings(),
    spans: Mapping[str, datetime.timedelta] = DAYS,
) -> DataFrame:
    """Moving averages and z-scores of ``bars`` over calendar days.

    ``price_mean_{tag}`` is over the days up to today, partial spans allowed; ``ret_1d`` is the log
    return since the row before, and ``zscore_{tag}`` compares it with the returns of the days
    before today. It is NULL with fewer than ``min_short`` returns in spans of a week and
    ``min_long`` in longer ones, or where they hardly vary. A missing day shortens a span instead
    of stretching it.
    """
    axis = axis.measured(bars)
    laid = layout.cut(bars, axis, before=1)
    returned = layout.home_rows(
        laid.withColumn("ret_1d", log_return(F.col(price), F.lag(price).over(axis.window())))
    )
    # Only now cut by time: the return furthest back may need a row that is further away still.
    reach = max(layout.reach_of(bars, axis, span) for span in spans.values())
    laid = layout.cut(returned, axis, reach=reach)
    laid = add_span_statistics(laid, axis, price, spans, "price", now=True)
    laid = add_span_statistics(laid, axis, "ret_1d", spans, "ret", now=False)
    scores = {}
    for tag, span in spans.items():
        least = settings.min_short if span <= DAYS["7d"] else settings.min_long
        count = F.col(f"ret_count_{tag}")
        scores[f"zscore_{tag}"] = guarded_zscore(
            F.col("ret_1d"), F.col(f"ret_mean_{tag}"), F.col(f"ret_std_{tag}"), count, count,
            least, settings.sigma_floor, least,
        )
    names = [f"{p}_{s}_{t}" for p in ("price", "ret") for s in ("mean", "std", "count") for t in spans]
    return layout.home_rows(laid.withColumns(scores)).select(*bars.columns, "ret_1d", *names, *scores)
