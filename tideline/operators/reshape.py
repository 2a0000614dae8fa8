"""Shapes of result tables: replicated panels, long centroids, rows in a fixed label order."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tideline.settings import REGIMES


def replicate_entities(panel: DataFrame, copies: int, entity: str = "symbol") -> DataFrame:
    """The panel ``copies`` times over; copy *i* of an entity is named ``<entity>_x<i>``.

    A map over the rows: no shuffle and no join.
    """
    named = F.col(entity).cast("string")
    names = F.transform(
        F.sequence(F.lit(0), F.lit(copies - 1)),
        lambda i: F.when(i == 0, named).otherwise(F.concat(named, F.lit("_x"), i.cast("string"))),
    )
    others = [c for c in panel.columns if c != entity]
    return panel.select(*others, F.explode(names).alias(entity)).select(*panel.columns)


def long_centroids(centroids: DataFrame, key: str = "cluster") -> DataFrame:
    """One row per (cluster, feature) from the ``avg_`` columns."""
    averages = [c for c in centroids.columns if c.startswith("avg_")]
    long = centroids.unpivot([key], averages, "feat", "value")
    return long.withColumn("feat", F.regexp_replace("feat", "^avg_", ""))


def in_label_order(
    table: DataFrame, labels: Sequence[str] = REGIMES, key: str = "regime"
) -> DataFrame:
    """One row per listed label, in list order, NULL measures where ``table`` has none.

    ``table`` is keyed by ``key``; rows with other labels are left out.
    """
    listed = table.sparkSession.createDataFrame(
        list(enumerate(labels)), f"_place int, {key} string"
    )
    dense = listed.join(table.where(F.col(key).isin(list(labels))), key, "left")
    return dense.orderBy("_place").select(*table.columns)


def dense_matrix(matrix: DataFrame, labels: Sequence[str] = REGIMES, key: str = "regime") -> DataFrame:
    """Square matrix over ``labels``: rows and columns it lacks are added as 0."""
    lacking = [c for c in labels if c not in matrix.columns]
    full = matrix.withColumns({c: F.lit(0.0) for c in lacking}) if lacking else matrix
    listed = full.select(key, *[F.col(f"`{c}`").cast("double").alias(c) for c in labels])
    ordered = in_label_order(listed, labels, key)
    return ordered.select(
        key, *[F.coalesce(F.col(f"`{c}`"), F.lit(0.0)).alias(c) for c in labels]
    )
