"""Breadth: what share of the entities is in each regime on a date."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tideline.functions import safe_correlation, safe_ratio
from tideline.operators import layout
from tideline.operators.layout import Axis
from tideline.operators.returns import forward_series
from tideline.settings import BREADTH_COLUMNS, LEAD_SYMBOL, REGIMES


def breadth_daily(
    labels: DataFrame, axis: Axis = Axis(), shares: Mapping[str, str] = BREADTH_COLUMNS
) -> DataFrame:
    """Entities per date and regime, all entities per date, and each regime's share.

    Rows are first reduced to one per (date, entity), then to one per date; both steps
    combine before their shuffle, and the date totals come from the same rows.
    """
    present = labels.where(F.col(axis.entity).isNotNull())
    flags = [F.bool_or(F.col("regime") == r).alias(r) for r in shares]
    per_entity = present.groupBy(axis.time, axis.entity).agg(*flags)
    counted = per_entity.groupBy(axis.time).agg(
        *[F.count_if(F.col(f"`{r}`")).alias(r) for r in shares],
        F.count(F.lit(1)).alias("total_syms"),
    )
    return counted.withColumns(
        {name: F.col(f"`{r}`") / F.col("total_syms") for r, name in shares.items()}
    ).orderBy(axis.time)


def breadth_with_lead(
    breadth: DataFrame,
    joined: DataFrame,
    axis: Axis = Axis(),
    lead: str = LEAD_SYMBOL,
    keep_last: bool = False,
) -> DataFrame:
    """Breadth on the dates of the lead entity, with its next return as ``lead_fwd1``.

    The lead's last row has no next return and is dropped unless ``keep_last``.
    """
    series = forward_series(joined, lead, axis)
    if not keep_last:
        series = series.where(F.col("ret_fwd1").isNotNull())
    series = series.select(axis.time, F.col("ret_fwd1").alias("lead_fwd1"))
    return breadth.join(series, axis.time)


def breadth_conservation(breadth: DataFrame) -> DataFrame:
    """Dates on which the regimes do not add up to the total."""
    added = F.lit(0)
    for r in REGIMES:
        added = added + F.col(f"`{r}`")
    return breadth.agg(
        F.count(F.lit(1)).alias("dates"),
        F.count_if(added != F.col("total_syms")).alias("bad_dates"),
    )


def lead_correlations(with_lead: DataFrame) -> DataFrame:
    """Correlation of each regime's share with the lead's next return, in one pass."""
    names = sorted(BREADTH_COLUMNS.values())
    one_row = with_lead.agg(
        *[safe_correlation(F.col(n), F.col("lead_fwd1")).alias(n) for n in names]
    )
    return one_row.unpivot([], names, "share", "corr").orderBy(
        F.desc(F.abs("corr")), "share"
    )


def rolling_correlation(
    df: DataFrame,
    x: str,
    y: str,
    time: str = "Date",
    rows: int = 30,
    out: str = "corr30",
    **block_size: int,
) -> DataFrame:
    """Correlation over the last ``rows`` rows of a whole series, NULL unless all are set.

    The series is one group by nature; with more rows than a block it is laid out in blocks like
    a hot entity.
    """
    series = df.withColumn("_series", F.lit(0))
    axis = Axis(entity="_series", time=time, single=True, **block_size).measured(series)
    frame = axis.window().rowsBetween(1 - rows, 0)
    both = F.col(x).isNotNull() & F.col(y).isNotNull()
    spread = F.stddev_samp(x).over(frame) * F.stddev_samp(y).over(frame)
    corr = F.when(
        F.count_if(both).over(frame) == rows,
        safe_ratio(F.covar_samp(x, y).over(frame), spread),
    )
    laid = layout.cut(series, axis, before=rows - 1)
    return layout.home_rows(laid.withColumn(out, corr)).drop("_series").orderBy(time)
