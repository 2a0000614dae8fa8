"""How regimes follow one another: counts, probabilities, matrices, runs and dwell times."""

from __future__ import annotations

import datetime
from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tideline.operators import layout
from tideline.operators.diagnostics import top_per_group
from tideline.operators.layout import Axis
from tideline.operators.quantiles import exact_quantiles, sketch_quantile
from tideline.settings import ARROW, REGIMES


def label_counts(labels: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Rows per regime, most common first, overall or within ``by``."""
    counted = labels.groupBy(*by, "regime").agg(F.count(F.lit(1)).alias("count"))
    return counted.orderBy(*by, F.desc("count"), "regime")


def label_counts_on(
    labels: DataFrame, day: str | datetime.date, axis: Axis = Axis()
) -> DataFrame:
    return label_counts(labels.where(F.col(axis.time) == F.lit(day)))


def top_labels(labels: DataFrame, axis: Axis = Axis(), n: int = 3) -> DataFrame:
    """Most common regimes of each entity; ties go to the first label by name."""
    counted = labels.groupBy(axis.entity, "regime").agg(F.count(F.lit(1)).alias("count"))
    order = [F.desc("count"), F.asc("regime")]
    return (
        top_per_group(counted, [axis.entity], order, n)
        .select(axis.entity, "regime", "count")
        .orderBy(axis.entity, F.desc("count"), "regime")
    )


def add_change_flags(rows: DataFrame) -> DataFrame:
    """From ``regime_prev`` and ``regime``: whether the regime changed, and the change's name."""
    changed = F.col("regime_prev").isNotNull() & (F.col("regime_prev") != F.col("regime"))
    return rows.withColumns(
        {
            "is_transition": changed,
            "transition": F.concat_ws(ARROW, "regime_prev", "regime"),
        }
    )


def with_neighbours(labels: DataFrame, axis: Axis = Axis()) -> DataFrame:
    """Previous and next regime of each row within its entity, and the change flags."""
    laid = _laid_with_neighbours(labels, axis.measured(labels))
    return layout.home_rows(laid)


def _laid_with_neighbours(labels: DataFrame, axis: Axis) -> DataFrame:
    laid = layout.cut(labels, axis, before=1, after=1)
    w = axis.window()
    return add_change_flags(
        laid.withColumns(
            {"regime_next": F.lead("regime").over(w), "regime_prev": F.lag("regime").over(w)}
        )
    )


def transition_counts(rows: DataFrame, strict: bool = False) -> DataFrame:
    """Rows per (regime, next regime).

    By default each entity's first row is left out and its last row counts under a NULL
    next regime. ``strict`` counts exactly the rows that have a next regime.
    """
    kept = rows.where(F.col("regime_next" if strict else "regime_prev").isNotNull())
    return kept.groupBy("regime", "regime_next").agg(F.count(F.lit(1)).alias("count"))


def transition_probabilities(counts: DataFrame) -> DataFrame:
    """Share of each next regime among the rows counted for a regime."""
    total = F.sum("count").over(Window.partitionBy("regime"))
    return counts.withColumn("row_count", total).withColumn(
        "prob", F.col("count") / F.col("row_count")
    )


def transition_matrix(
    cells: DataFrame, value: str, regimes: Sequence[str] = REGIMES
) -> DataFrame:
    """One row per regime, one column per next regime, 0 where there is no cell."""
    pivoted = cells.groupBy("regime").pivot("regime_next", list(regimes)).agg(F.first(value))
    return pivoted.fillna(0)


def matrix_row_sums(matrix: DataFrame, key: str = "regime") -> DataFrame:
    total = F.lit(0)
    for c in matrix.columns:
        if c != key:
            total = total + F.col(f"`{c}`")
    return matrix.select(key, total.alias("row_sum"))


def stay_probabilities(probabilities: DataFrame) -> DataFrame:
    return probabilities.where(F.col("regime") == F.col("regime_next")).select(
        "regime", F.col("prob").alias("stay_prob")
    )


def with_run_ids(labels: DataFrame, axis: Axis = Axis()) -> DataFrame:
    """Neighbours plus ``regime_group_id``, which counts the changes so far in the entity."""
    axis = axis.measured(labels)
    laid = _laid_with_neighbours(labels, axis)
    so_far = axis.window().rowsBetween(Window.unboundedPreceding, Window.currentRow)
    changes = F.count_if(F.col("is_transition") & layout.at_home()).over(so_far)
    home = layout.home_rows(laid.withColumn("_run_in_block", changes), keep_block=True)
    return layout.add_block_offsets(home, axis, "_run_in_block", "regime_group_id").drop(
        "_run_in_block", layout.BLOCK
    )


def run_lengths(rows: DataFrame, axis: Axis = Axis()) -> DataFrame:
    """Rows per run, from rows with run ids."""
    return rows.groupBy(axis.entity, "regime", "regime_group_id").agg(
        F.count(F.lit(1)).alias("run_len")
    )


def dwell(runs: DataFrame, by: Sequence[str] = ("regime",), exact: bool = False) -> DataFrame:
    """Run-length statistics per group. ``exact`` quantiles are meant for a short list of groups."""
    quantiles = {"p50_len": 0.5, "p90_len": 0.9}
    length = F.col("run_len")
    sketched = [sketch_quantile(length, p).alias(name) for name, p in quantiles.items()]
    stats = runs.groupBy(*by).agg(
        F.count(F.lit(1)).alias("num_runs"),
        F.avg(length).alias("mean_len"),
        F.min(length).alias("min_len"),
        F.max(length).alias("max_len"),
        *([] if exact else sketched),
    )
    if exact:
        found = exact_quantiles(runs, by, "run_len", quantiles, few_groups=list(by) == ["regime"])
        stats = stats.join(found, list(by))
    return stats.select(*by, "num_runs", "mean_len", *quantiles, "min_len", "max_len").orderBy(*by)


def dwell_overall(runs: DataFrame, exact: bool = False) -> DataFrame:
    return dwell(runs, exact=exact)


def dwell_by_entity(runs: DataFrame, axis: Axis = Axis()) -> DataFrame:
    return dwell(runs, [axis.entity, "regime"]).drop("min_len")


def dwell_conservation(runs: DataFrame) -> DataFrame:
    """Total run length, which must equal the number of labelled rows."""
    return runs.agg(F.coalesce(F.sum("run_len"), F.lit(0)).alias("total_run_len"))
