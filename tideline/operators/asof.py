"""As-of join: each row gets the last row known before it, or the next one after it."""

from __future__ import annotations

import datetime

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tideline.operators import layout
from tideline.operators.layout import Axis

DIRECTIONS = ("backward", "forward")


def asof_join(
    rows: DataFrame,
    known: DataFrame,
    axis: Axis = Axis(),
    known_time: str = "known_time",
    direction: str = "backward",
    exact: bool = True,
    within: datetime.timedelta | None = None,
) -> DataFrame:
    """``rows`` with the columns of the row of ``known`` that is last at or before its time.

    ``known`` has the entity, a time column ``known_time`` and values; ``(entity, known_time)`` must
    be unique there. ``forward`` takes the next row at or after instead. ``exact`` lets equal times
    match, ``within`` leaves out rows that are further away. Rows without an entity or a time match
    nothing, and rows without a match have NULLs; every row of ``rows`` is returned once, repeated
    ones as often as they stand there.

    Both tables are laid out together by (entity, block) and read in one order, so there is no join
    by inequality, and a hot entity is cut along time. What is known at the end of a block is
    carried into later blocks by a table of at most one row per block.
    """
    if direction not in DIRECTIONS:
        raise ValueError(f"direction is one of {DIRECTIONS}")
    values = [c for c in known.columns if c != axis.entity]
    clash = sorted(set(values) & set(rows.columns))
    if clash:
        raise ValueError(f"columns of both tables: {clash}")
    kind = rows.schema[axis.time].dataType
    entity = F.col(axis.entity)
    asking = rows.select(
        entity, F.col(axis.time), F.struct(*[F.col(f"`{c}`") for c in rows.columns]).alias("_row")
    )
    telling = known.where(entity.isNotNull() & F.col(known_time).isNotNull()).select(
        entity,
        F.col(known_time).cast(kind).alias(axis.time),
        F.struct(*[F.col(f"`{c}`") for c in values]).alias("_known"),
    )
    both = asking.unionByName(telling, allowMissingColumns=True)
    axis = axis.measured(both)
    laid = layout.cut(both, axis)
    back = direction == "backward"
    # At equal times what is known comes first if it may be used.
    first = F.col("_row").isNotNull() if exact else F.col("_row").isNull()
    time = F.col(axis.time)
    order = [time.asc_nulls_first() if back else time.desc_nulls_last(), first.asc()]
    so_far = Window.partitionBy(*axis.block_keys()).orderBy(*order)
    so_far = so_far.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    found = laid.withColumn("_found", F.last("_known", ignorenulls=True).over(so_far))
    found = layout.carry(found, laid, axis, "_known", "_found", ahead=not back)
    answered = found.where(F.col("_row").isNotNull())
    usable = entity.isNotNull() & time.isNotNull()
    if within is not None:
        there = F.col("_found")[known_time].cast(kind)
        apart = layout.ticks_of(time, kind) - layout.ticks_of(there, kind)
        usable &= F.abs(apart) <= layout.reach_of(rows, axis, within)
    match = F.when(usable, F.col("_found"))
    return answered.select("_row.*", *[match[c].alias(c) for c in values])

