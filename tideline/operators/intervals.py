"""Joins of time intervals that overlap, by bins of time on several levels.

An interval stands in the bins it touches on the level where it touches few: bins of a level are
``FACTOR`` times as wide as those of the level below, so a long interval is split into at most
``FACTOR + 1`` pieces and never into one for each day. Two intervals meet on the level of the longer
one, where the shorter touches one bin or two. They may share several bins and are compared in the
first of them only, so every pair comes out once.

A bin that holds more intervals than a task should read is split: both sides are dealt into parts
by a hash, and every part of one side meets every part of the other in a task of its own.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

FACTOR = 8
#: Widths and lengths stay below this.
_WIDEST = 2**62
#: Intervals of one side in a bin from which it is split, and how many split bins there may be.
HOT_ROWS, HOT_BINS = 50_000, 100_000


def overlap_join(
    a: DataFrame,
    b: DataFrame,
    start: str,
    end: str,
    on: Sequence[str] = (),
    width: int | None = None,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Pairs of rows of ``a`` and ``b`` that share at least one point of time: structs ``a``, ``b``.

    ``start`` and ``end`` are whole numbers or dates of closed intervals; ``on`` columns must be
    equal as well. Intervals with a NULL or that end before they start overlap nothing, and NULL
    keys equal nothing. Repeated rows make pairs of their own. ``width`` is that of the narrowest
    bins, by default the mean length of the intervals; it changes no result.

    Runs two aggregations: over the lengths, and over the bins to find those to split.
    """
    sides = [_marked(df, start, end, on) for df in (a, b)]
    both = sides[0].select("_low", "_high").unionByName(sides[1].select("_low", "_high"))
    if width is None:
        mean = both.agg(F.avg(F.col("_high") - F.col("_low"))).first()[0]
        width = max(1, round(mean or 1))
    binned = [df.withColumn("_level", level_of(width)) for df in sides]
    # Levels that hold any interval: some twenty numbers at most.
    levels = sorted({r[0] for df in binned for r in df.select("_level").distinct().collect()})
    spread = [_spread(df, width, levels) for df in binned]
    keys = ["_level_at", "_bin", *[f"_on_{i}" for i in range(len(on))]]
    spread = _split(spread, keys, hot_rows)
    # Where both are short for the level they have met on a lower one.
    keys += ["_part_a", "_part_b"]
    own = ("_row", "_low", "_high", "_native", "_first")
    left, right = (
        df.select(*keys, *[F.col(c).alias(f"{c}_{side}") for c in own]) for side, df in zip("ab", spread)
    )
    met = left.join(right, keys)
    once = F.col("_bin") == F.greatest("_first_a", "_first_b")
    overlap = (F.col("_low_a") <= F.col("_high_b")) & (F.col("_low_b") <= F.col("_high_a"))
    return met.where(once & overlap & (F.col("_native_a") | F.col("_native_b"))).select(
        F.col("_row_a").alias("a"), F.col("_row_b").alias("b")
    )


def _marked(df: DataFrame, start: str, end: str, on: Sequence[str]) -> DataFrame:
    numbers = [_number(df, c) for c in (start, end)]
    rows = df.select(
        F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("_row"),
        numbers[0].alias("_low"),
        numbers[1].alias("_high"),
        *[F.col(f"`{c}`").alias(f"_on_{i}") for i, c in enumerate(on)],
    )
    kept = [F.col(f"_on_{i}").isNotNull() for i in range(len(on))]
    return rows.where(reduce(Column.__and__, kept, F.col("_low") <= F.col("_high")))


def _number(df: DataFrame, name: str) -> Column:
    kind = dict(df.dtypes)[name]
    if kind == "date":
        return F.unix_date(name).cast("bigint")
    if kind == "timestamp":
        return F.unix_micros(name)
    return F.col(f"`{name}`").cast("bigint")


def level_of(width: int) -> Column:
    """The lowest level on which an interval is no longer than ``FACTOR`` bins."""
    length = F.col("_high") - F.col("_low")
    levels = 1
    while width * FACTOR ** (levels + 1) < _WIDEST:
        levels += 1
    level = F.lit(levels - 1)
    for k in reversed(range(levels - 1)):
        level = F.when(length <= F.lit(width * FACTOR ** (k + 1)), k).otherwise(level)
    return level


def _spread(df: DataFrame, width: int, levels: list[int]) -> DataFrame:
    """A row for every bin an interval touches on its own level and on the higher ones in use."""
    entries = []
    for k in levels:
        wide = F.lit(width * FACTOR**k)
        first, last = (F.call_function("div", F.col(c) - F.pmod(c, wide), wide) for c in ("_low", "_high"))
        entry = F.struct(F.lit(k).alias("level"), first.alias("first"), F.sequence(first, last).alias("bins"))
        entries.append(F.when(F.col("_level") <= k, entry))
    told = df.withColumn("_at", F.explode(F.array_compact(F.array(*entries))))
    return told.select(
        "*",
        F.col("_at.level").alias("_level_at"),
        F.col("_at.first").alias("_first"),
        (F.col("_at.level") == F.col("_level")).alias("_native"),
        F.explode("_at.bins").alias("_bin"),
    ).drop("_at", "_level")


def _split(sides: list[DataFrame], keys: list[str], hot_rows: int) -> list[DataFrame]:
    """Both sides with the parts their rows are dealt to; bins that are not hot have one."""
    counted = [df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")) for df in sides]
    total = sum(df.agg(F.sum("n")).first()[0] or 0 for df in counted)
    size = max(hot_rows, -(-total // HOT_BINS))
    hot = [df.where(F.col("n") > size).withColumnRenamed("n", f"_n{i}") for i, df in enumerate(counted)]
    # At most total / size bins on each side.
    table = hot[0].join(hot[1], keys, "full")
    parts = {f"_parts_{s}": F.ceil(F.coalesce(F.col(f"_n{i}"), F.lit(1)) / size).cast("int") for i, s in enumerate("ab")}
    table = F.broadcast(table.select(*keys, *[c.alias(n) for n, c in parts.items()]))
    out = []
    for mine, other, df in (("a", "b", sides[0]), ("b", "a", sides[1])):
        found = df.join(table, keys, "left")
        own = F.coalesce(F.col(f"_parts_{mine}"), F.lit(1))
        theirs = F.coalesce(F.col(f"_parts_{other}"), F.lit(1))
        found = found.withColumn(f"_part_{mine}", F.pmod(F.xxhash64("_row"), own).cast("int"))
        found = found.withColumn(f"_part_{other}", F.explode(F.sequence(F.lit(0), theirs - 1)))
        out.append(found.drop("_parts_a", "_parts_b"))
    return out
