"""How a panel is cut so that no window ever holds a whole hot entity.

``Window.partitionBy(entity)`` puts every row of an entity in one task. That is
fine for most entities and fatal for one that holds a third of the table. Frames
here reach a bounded number of rows back or ahead, so a hot entity can be cut into
blocks along time, each block carrying copies of the few rows just outside it:

1. :meth:`Axis.measured` counts rows per entity; one with more than a block's worth is *hot*, and
   quantiles of its times are sketched. This is done once per base panel, and its answer holds
   for every table derived from that panel by dropping rows or adding columns;
2. slice each hot entity at quantiles of its rows, so that neither bursts nor outliers make a
   slice large, and count rows per slice;
3. group neighbouring slices into blocks, and note for each slice which other blocks
   need it because they start (or end) within reach;
4. send each row to its block, plus a copy to each block that needs it.

Windows then run per (entity, block) and copies are dropped. Rows without a time are an entity's
first, as in any window; rows without an entity are one entity. A block holds at least
``1 / max_blocks`` of the panel, so the two lookup tables have at most ``max_blocks`` hot
entities and some ``2 * slices_per_block * max_blocks`` slices whatever the size of the data,
and are safe to broadcast. Without hot entities none of this enters the plan.
"""

from __future__ import annotations

import datetime
from dataclasses import dataclass, replace
from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F
from pyspark.sql import types as T

BLOCK = "_block"
HOME = "_home_block"
START = "_slice_start"
SLICE = "_slice"
#: Quantiles of an entity's times that are kept, a power of two, and the sketch's accuracy.
QUANTILES, ACCURACY = 256, 4096
_LATEST = 2**63 - 1


@dataclass(frozen=True)
class Axis:
    """Key of a panel and the size of the pieces it is windowed in.

    ``(entity, time)`` must be unique: with repeats, which row comes first in a
    window is up to Spark, as in any ordered window.
    """

    entity: str = "symbol"
    time: str = "Date"
    min_block_rows: int = 100_000
    max_block_rows: int = 1_000_000
    slices_per_block: int = 5
    max_blocks: int = 100_000
    # The whole table is one entity, and its column a constant.
    single: bool = False
    # Set by `measured`: rows per block, and (entity, bounds of its slices, its last time, how
    # many slices lie between two bounds) if hot.
    block_rows: int | None = None
    hot: tuple[tuple[Any, tuple[int, ...], int, int], ...] = ()

    def window(self) -> WindowSpec:
        """Rows of a block in time order, for a panel laid out by :func:`cut`."""
        return Window.partitionBy(self.entity, BLOCK).orderBy(self.time)

    def group(self) -> WindowSpec:
        """All rows of a block."""
        return Window.partitionBy(self.entity, BLOCK)

    def block_keys(self) -> list[str]:
        return [self.entity, BLOCK]

    def bounded(self) -> Axis:
        """This axis for a panel known to have no hot entity, such as one that was grouped by
        entity and calendar day and so holds at most one row per entity and day."""
        return replace(self, block_rows=self.max_block_rows)

    def measured(self, df: DataFrame) -> Axis:
        """This axis with the hot entities of ``df`` noted.

        Rows are counted per entity first. Only where an entity is hot does a second aggregation
        sketch quantiles, of the hot entities' times alone. A block is a quarter of one core's
        share of the rows, within the set limits.
        """
        if self.block_rows is not None:
            return self
        counted = df.groupBy(self.entity).agg(F.count(F.lit(1)).alias("rows")).persist()
        try:
            seen = counted.agg(F.sum("rows").alias("total"), F.max("rows").alias("most")).first()
            total = seen["total"] or 0
            share = total // (4 * df.sparkSession.sparkContext.defaultParallelism)
            size = max(
                self.min_block_rows, min(self.max_block_rows, share), -(-total // self.max_blocks)
            )
            if (seen["most"] or 0) <= size:
                return replace(self, block_rows=size)
            # At most total / size rows, so at most max_blocks of them.
            large = counted.where(F.col("rows") > size).withColumnRenamed("rows", "_rows")
            schema = large.schema
            names = df.sparkSession.createDataFrame(large.collect(), schema)
        finally:
            counted.unpersist()
        timed = _looked_up(df.select(self.entity, self.time), names, [self.entity])
        shares = [k / QUANTILES for k in range(QUANTILES)]
        tick = _ticks(df, self)
        sketched = timed.where(F.col("_rows").isNotNull()).groupBy(self.entity).agg(
            F.first("_rows"), F.percentile_approx(tick, shares, ACCURACY), F.max(tick)
        )
        hot = tuple(self._sliced(*r, size) for r in sketched.collect())
        return replace(self, block_rows=size, hot=hot)

    def _sliced(
        self, entity: Any, rows: int, bounds: list[int] | None, last: int | None, size: int
    ) -> tuple[Any, tuple[int, ...], int, int]:
        wanted = -(-rows * self.slices_per_block // size)
        parts = 1
        while parts < min(wanted, QUANTILES):
            parts *= 2
        # Without any time there is no order to cut along.
        kept = tuple(bounds[:: QUANTILES // parts]) if bounds else (0,)
        return entity, kept, last or 0, -(-wanted // parts)


def cut(df: DataFrame, axis: Axis, before: int = 0, after: int = 0, reach: int = 0) -> DataFrame:
    """``df`` with block columns, ready for frames of ``before`` rows back and ``after`` ahead.

    ``reach`` adds the rows within that much time back, however many they are, in the numbers of
    :func:`ticks_of`. Rows near a cut appear in more than one block; :func:`home_rows` keeps each
    once.
    """
    axis = axis.measured(df)
    zero = F.lit(0).cast("bigint")
    if not axis.hot:
        return df.withColumns({BLOCK: zero, HOME: zero, START: zero})
    sliced = _add_slice(df, axis)
    directory = _block_directory(sliced, axis, before, after, reach)
    keys = [axis.entity, SLICE]
    if axis.single:
        directory, keys = directory.drop(axis.entity), [SLICE]
    return (
        _looked_up(sliced, directory, keys)
        .withColumns({HOME: F.coalesce(HOME, zero), START: F.coalesce(START, zero)})
        .withColumn(BLOCK, F.explode(F.coalesce("_blocks", F.array(zero))))
        .drop(SLICE, "_blocks")
    )


def home_rows(df: DataFrame, keep_block: bool = False) -> DataFrame:
    """Each row once, in its own block; helper columns dropped unless ``keep_block``."""
    rows = df.where(F.col(BLOCK) == F.col(HOME))
    return rows.drop(HOME, START) if keep_block else rows.drop(BLOCK, HOME, START)


def at_home() -> Column:
    return F.col(BLOCK) == F.col(HOME)


def position(axis: Axis) -> Column:
    """1-based place of a row within its whole entity, over the rows of a block."""
    w = axis.window()
    offset = F.first(START).over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return (offset + F.row_number().over(w)).cast("int")


def add_block_offsets(df: DataFrame, axis: Axis, local: str, out: str) -> DataFrame:
    """Turn a count that restarts in every block into one that runs through the entity.

    ``local`` is a running count within each block, over home rows. The totals of earlier
    blocks are looked up for an entity's second and later blocks, at most ``max_blocks``.
    """
    if not axis.hot:
        return df.withColumn(out, F.col(local))
    w = Window.partitionBy(axis.entity).orderBy(BLOCK)
    offsets = (
        df.groupBy(*axis.block_keys())
        .agg(F.max(local).alias("_in_block"))
        .withColumn(
            "_offset",
            F.sum("_in_block").over(w.rowsBetween(Window.unboundedPreceding, -1)),
        )
        .where(F.col("_offset") > 0)
        .drop("_in_block")
    )
    return (
        _looked_up(df, offsets, axis.block_keys())
        .withColumn(out, F.col(local) + F.coalesce("_offset", F.lit(0)))
        .drop("_offset")
    )


def carry(df: DataFrame, laid: DataFrame, axis: Axis, value: str, into: str, ahead: bool = False) -> DataFrame:
    """``df`` with ``into`` filled, where it is NULL, by the last ``value`` of the blocks before.

    ``laid`` is the panel laid out by :func:`cut` that ``df`` was made from, where ``value`` is
    NULL in rows that know none; ``ahead`` looks for the first one of the blocks after instead.
    Only blocks of hot entities have others, at most ``max_blocks``.
    """
    if not axis.hot:
        return df
    known = F.when(F.col(value).isNotNull(), F.col(axis.time))
    edge = (F.min_by if ahead else F.max_by)(value, known)
    order = F.col(BLOCK).desc() if ahead else F.col(BLOCK).asc()
    passed = Window.partitionBy(axis.entity).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    ends = laid.groupBy(*axis.block_keys()).agg(edge.alias("_edge"))
    carried = ends.withColumn("_carried", F.last("_edge", ignorenulls=True).over(passed)).drop("_edge")
    filled = _looked_up(df, carried.where(F.col("_carried").isNotNull()), axis.block_keys())
    return filled.withColumn(into, F.coalesce(into, "_carried")).drop("_carried")


def _looked_up(df: DataFrame, table: DataFrame, keys: list[str]) -> DataFrame:
    """``df`` with the other columns of a small ``table`` at equal keys, where NULL equals NULL."""
    renamed = {k: f"_{k}_of_table" for k in keys}
    there = table.withColumnsRenamed(renamed)
    equal = [F.col(k).eqNullSafe(F.col(name)) for k, name in renamed.items()]
    found = df.join(F.broadcast(there), reduce(Column.__and__, equal), "left")
    return found.drop(*renamed.values())


def _ticks(df: DataFrame, axis: Axis) -> Column:
    """Time as a whole number."""
    return ticks_of(F.col(axis.time), df.schema[axis.time].dataType)


def reach_of(df: DataFrame, axis: Axis, span: datetime.timedelta) -> int:
    """A span of time in the whole numbers of :func:`ticks_of`."""
    if isinstance(df.schema[axis.time].dataType, T.DateType):
        return span.days
    return span // datetime.timedelta(microseconds=1)


def ticks_of(time: Column, kind: T.DataType) -> Column:
    """Times as whole numbers: days of dates, microseconds of timestamps."""
    if isinstance(kind, T.DateType):
        return F.unix_date(time).cast("bigint")
    if isinstance(kind, T.TimestampType):
        return F.unix_micros(time)
    if isinstance(kind, T.TimestampNTZType):
        # Without a time zone, whose clock changes would put rows out of order.
        minutes = F.unix_date(time.cast("date")).cast("bigint") * 1440 + F.hour(time) * 60
        micros = (F.extract(F.lit("SECOND"), time) * 1_000_000).cast("bigint")
        return (minutes + F.minute(time)) * 60_000_000 + micros
    return time.cast("bigint")


def _add_slice(df: DataFrame, axis: Axis) -> DataFrame:
    """Number of the slice a row falls in, in the order of time; NULL for entities that are not hot."""
    schema = T.StructType(
        [
            T.StructField(axis.entity, df.schema[axis.entity].dataType),
            T.StructField("_bounds", T.ArrayType(T.LongType())),
            T.StructField("_last", T.LongType()),
            T.StructField("_parts", T.LongType()),
        ]
    )
    padded = [
        (entity, list(bounds) + [_LATEST] * (QUANTILES - len(bounds)), last, parts)
        for entity, bounds, last, parts in axis.hot
    ]
    if axis.single:
        _, bounds, last, parts = padded[0]
        known = {"_bounds": F.lit(bounds), "_last": F.lit(last), "_parts": F.lit(parts)}
        found = df.withColumns({c: v.cast(schema[c].dataType) for c, v in known.items()})
    else:
        found = _looked_up(df, df.sparkSession.createDataFrame(padded, schema), [axis.entity])
    # Rows without a time come first.
    tick = F.coalesce(_ticks(df, axis), F.col("_bounds")[0])
    found = found.withColumn("_tick", tick)
    steps = [QUANTILES >> k for k in range(1, QUANTILES.bit_length())]
    # Binary search for the last bound that is not after the row.
    further = lambda at, step: F.when(F.col("_bounds")[at + step] <= F.col("_tick"), step).otherwise(0)
    search = F.aggregate(F.lit(steps), F.lit(0), lambda at, step: at + further(at, step))
    found = found.withColumn("_at", search)
    low = F.col("_bounds")[F.col("_at")]
    end = F.least(F.try_element_at("_bounds", F.col("_at") + 2), F.col("_last") + 1)
    passed = (F.col("_tick") - low).cast("double") / F.greatest(end - low, F.lit(1))
    part = F.greatest(F.least(F.floor(passed * F.col("_parts")), F.col("_parts") - 1), F.lit(0))
    number = F.col("_at") * F.col("_parts") + part
    return found.withColumn(SLICE, F.when(F.col("_parts").isNotNull(), number)).drop(
        "_bounds", "_last", "_parts", "_tick", "_at"
    )


def _block_directory(sliced: DataFrame, axis: Axis, before: int, after: int, reach: int) -> DataFrame:
    """One row per slice of a hot entity: first row, own block, and all blocks that read it."""
    ordered = Window.partitionBy(axis.entity).orderBy(SLICE)
    counted = (
        sliced.where(F.col(SLICE).isNotNull())
        .groupBy(axis.entity, SLICE)
        .agg(F.count(F.lit(1)).alias("_n"), F.max(_ticks(sliced, axis)).alias("_high"))
        .withColumn("_end", F.sum("_n").over(ordered.rowsBetween(Window.unboundedPreceding, 0)))
        .withColumn(START, F.col("_end") - F.col("_n"))
        .withColumn(HOME, F.floor(F.col(START) / axis.block_rows))
        .withColumn("_next", F.lead(HOME).over(ordered))
        .withColumn("_prev", F.lag(HOME).over(ordered))
    )
    readers = [F.array(HOME)]
    opens = F.when(F.col("_next") != F.col(HOME), F.col("_next"))
    if before > 0:
        # Later blocks that start within `before` rows of this slice's end.
        rows = Window.partitionBy(axis.entity).orderBy("_end").rangeBetween(0, before - 1)
        readers.append(F.collect_list(opens).over(rows))
    if reach > 0:
        # Later blocks that may start within `reach` of this slice's last time: the slice before
        # such a block ends no later than the block starts.
        times = Window.partitionBy(axis.entity).orderBy("_high").rangeBetween(0, reach)
        readers.append(F.collect_list(opens).over(times))
    if after > 0:
        # Earlier blocks that end within `after` rows of this slice's start.
        rows = Window.partitionBy(axis.entity).orderBy(START).rangeBetween(-(after - 1), 0)
        closes = F.when(F.col("_prev") != F.col(HOME), F.col("_prev"))
        readers.append(F.collect_list(closes).over(rows))
    return counted.withColumn("_blocks", F.array_distinct(F.concat(*readers))).select(
        axis.entity, SLICE, START, HOME, "_blocks"
    )
