"""Summaries kept at the finest grain, from which coarser ones are merged without the rows.

:func:`summary_states` reduces a panel to one row per group of its finest keys. What a row holds can
be merged: counts, sums, extremes, a quantile sketch and a sketch of distinct entities, each of
bounded size. :func:`summaries` merges stored states over any grouping sets of those keys.

:func:`distinct_states` and :func:`merged_distinct` count distinct whole numbers exactly, by bitmaps
of 32,768 numbers in 4 KB, so a day's states give the week's count though entities come back.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Size of the quantile sketch: ranks are within about 1.4 % of the rows in 99 of 100 cases.
QUANTILE_K = 200
#: Logarithm of the registers of the distinct sketch: a standard error of about 0.8 %.
DISTINCT_LOG = 14


def summary_states(rows: DataFrame, keys: Sequence[str], value: str, entity: str) -> DataFrame:
    """One row per group of ``keys``: ``rows, known, total, least, most, quantiles, entities``.

    ``known`` counts values that are not NULL; the sums, extremes and quantiles are of those.
    NULL entities count as none. Rows with a NULL key are a group of their own.
    """
    return rows.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("rows"),
        F.count(value).alias("known"),
        F.sum(value).alias("total"),
        F.min(value).alias("least"),
        F.max(value).alias("most"),
        F.kll_sketch_agg_double(F.col(value).cast("double"), QUANTILE_K).alias("quantiles"),
        F.hll_sketch_agg(entity, DISTINCT_LOG).alias("entities"),
    )


def summaries(states: DataFrame, keys: Sequence[str], sets: Sequence[Sequence[str]]) -> DataFrame:
    """States merged over each of the grouping ``sets`` of ``keys``.

    ``level`` has a bit for each key, the first key's the highest, that is 1 where the row is not
    grouped by it; that tells an absent key from a NULL one. ``median`` and ``entities`` are
    estimates within the sketches' errors; everything else is exact.
    """
    merged = states.groupingSets([[F.col(k) for k in one] for one in sets], *keys).agg(
        F.grouping_id().alias("level"),
        F.sum("rows").alias("rows"),
        F.sum("known").alias("known"),
        F.sum("total").alias("total"),
        F.min("least").alias("least"),
        F.max("most").alias("most"),
        F.kll_merge_agg_double("quantiles", QUANTILE_K).alias("_quantiles"),
        F.hll_sketch_estimate(F.hll_union_agg("entities")).alias("entities"),
    )
    middle = F.when(F.col("known") > 0, F.kll_sketch_get_quantile_double("_quantiles", F.lit(0.5)))
    mean = F.when(F.col("known") > 0, F.col("total") / F.col("known"))
    return merged.withColumns({"mean": mean, "median": middle}).drop("_quantiles")


def distinct_states(rows: DataFrame, keys: Sequence[str], number: str) -> DataFrame:
    """Bitmaps of the distinct values of a whole-number column, one row per group and 32,768 values."""
    known = rows.where(F.col(number).isNotNull())
    bucket = F.bitmap_bucket_number(number).alias("bucket")
    return known.groupBy(*keys, bucket).agg(F.bitmap_construct_agg(F.bitmap_bit_position(number)).alias("bits"))


def merged_distinct(states: DataFrame, keys: Sequence[str], into: str = "entities") -> DataFrame:
    """Exact distinct counts by ``keys``, which may be any columns of the states or made from them."""
    united = states.groupBy(*keys, "bucket").agg(F.bitmap_or_agg("bits").alias("bits"))
    return united.groupBy(*keys).agg(F.sum(F.bitmap_count("bits")).alias(into))
