"""Connected components by alternating large and small stars over an edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tideline.llm.tables import Stored


def _large_star(edges: DataFrame) -> tuple[DataFrame, Stored]:
    """Each node's larger neighbours point to the smallest of its neighbours and itself."""
    both = edges.union(edges.select("lo", "hi")).toDF("u", "v")
    # Stored, so that the join has two plain sides and can split a node with many neighbours, or
    # send the smaller one to all tasks where its size allows.
    least = Stored(both.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m")), "least")
    moved = both.where("v > u").join(least.df, "u")
    return moved.select(F.col("v").alias("hi"), F.col("m").alias("lo")).distinct(), least


def _small_star(edges: DataFrame) -> tuple[DataFrame, Stored]:
    """Each node and its smaller neighbours point to the smallest of them."""
    least = Stored(edges.groupBy("hi").agg(F.min("lo").alias("m")), "least")
    moved = edges.join(least.df, "hi").where("lo <> m").select("lo", "m")
    return least.df.union(moved).toDF("hi", "lo").distinct(), least


def _are_stars(edges: DataFrame) -> bool:
    """Whether every node points to one other at most, and none to a node that points on."""
    ends = edges.select(F.col("hi").alias("node"), F.lit(1).alias("points")).union(
        edges.select("lo", F.lit(0)).distinct()
    )
    counted = ends.groupBy("node").agg(F.sum("points").alias("points"), F.count("*").alias("ends"))
    return counted.where("points > 1 OR (points = 1 AND ends > 1)").isEmpty()


def components(edges: DataFrame) -> DataFrame:
    """``node, component`` for every node of ``edges`` (two columns of numbers).

    ``component`` is the smallest node that can be reached. Loops, repeated edges and edges with
    a null end count for nothing; an empty table gives an empty one. Each step is written to
    the shared folder, so a lost executor costs at most a step; the driver learns no more than
    whether the edges are stars yet. The number of rounds grows with the logarithm of the
    longest chain.
    """
    a, b = (F.col(c) for c in edges.columns)
    kept = Stored(
        edges.where(a != b).select(F.greatest(a, b).alias("hi"), F.least(a, b).alias("lo")).distinct(),
        "edges",
    )
    while not _are_stars(kept.df):
        for star in (_large_star, _small_star):
            turned, least = star(kept.df)
            before, kept = kept, Stored(turned, "edges")
            before.drop()
            least.drop()
    return kept.df.select(F.col("hi").alias("node"), F.col("lo").alias("component")).union(
        kept.df.select("lo", "lo").distinct()
    )
