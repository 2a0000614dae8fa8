"""Ranks over a whole table, without a window that has no key.

The table is cut into slices by quantiles of the ordering column: the rows equal to a bound are a
slice, and the rows between two bounds are one. Counts per slice give every slice the number of
rows before it, and what is left is a window within each slice. All rows of a slice at a bound have
the same rank, so a value that a third of all rows share is dealt out freely; for positions it is cut
again along the column that breaks ties.

Bounds and counts are ``2 * SLICES + 2`` numbers, and ``PARTS`` times as many where ties are broken,
whatever the size of the table.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tideline.functions import safe_ratio

#: Bounds along the order and along ties, powers of two, and the accuracy of their sketch.
SLICES, PARTS, ACCURACY = 256, 16, 8192
_SLICE, _PART = "_slice", "_part"


@dataclass(frozen=True)
class Cuts:
    """Slices of a table: column expressions of a row's slice and, where that is a column, of its part,
    and the counts of all."""

    slice: Column
    part: Column
    counts: dict[tuple[int, int], int]

    @property
    def total(self) -> int:
        return sum(self.counts.values())

    def before(self, parts: bool) -> Column:
        """Rows in earlier slices, and in earlier parts of the row's own."""
        size = 1 + max((s for s, _ in self.counts), default=0)
        by_slice = [0] * (size + 1)
        for (s, _), n in self.counts.items():
            by_slice[s + 1] += n
        for s in range(size):
            by_slice[s + 1] += by_slice[s]
        if not parts:
            return F.get(_longs(by_slice), F.col(_SLICE))
        # One look-up for all slices, whether they are cut again or not.
        passed = []
        for s in range(size):
            passed += [by_slice[s] + sum(self.counts.get((s, q), 0) for q in range(p)) for p in range(PARTS)]
        return F.get(_longs(passed), F.col(_SLICE) * PARTS + F.col(_PART))

    def rows_in_slice(self) -> Column:
        size = 1 + max((s for s, _ in self.counts), default=0)
        return F.get(_longs([sum(n for (t, _), n in self.counts.items() if t == s) for s in range(size)]), F.col(_SLICE))


def _longs(numbers: list[int]) -> Column:
    return F.array(*[F.lit(n).cast("bigint") for n in numbers])


def _last_not_after(value: Column, held: Column, size: int) -> Column:
    """Place of the last bound that is not after a value; ``held`` has ``size`` of them in ascending order,
    a power of two."""
    steps = [size >> k for k in range(1, size.bit_length())]
    if not steps:
        return F.lit(0)
    return F.aggregate(
        F.array(*[F.lit(s) for s in steps]),
        F.lit(0),
        lambda at, step: at + F.when(F.get(held, at + step) <= value, step).otherwise(0),
    )


def _array(values: list) -> Column:
    return F.array(*[F.lit(v) for v in values])


def _bounds(found: list, size: int) -> list:
    """Different bounds, the last one repeated up to ``size``."""
    kept = sorted(set(found))
    return kept + kept[-1:] * (size - len(kept))


def cuts(rows: DataFrame, by: str, tie: str | None = None) -> Cuts:
    """Where ``rows`` is cut along ``by``; runs two aggregations, or three with ``tie``."""
    value = F.col(by)
    sketch = F.percentile_approx(by, [k / SLICES for k in range(SLICES)], ACCURACY)
    found = rows.agg(sketch.alias("bounds"), F.min(by).alias("low")).first()
    if found["bounds"] is None:
        return Cuts(F.lit(0), F.lit(0), {(0, 0): rows.count()})
    bounds = _bounds([found["low"], *found["bounds"]][:SLICES], SLICES)
    at = _last_not_after(value, _array(bounds), SLICES)
    # Rows without a value come first, then rows at a bound and rows after it in turn.
    exact = F.get(_array(bounds), at) == value
    slice_ = F.when(value.isNull(), 0).otherwise(1 + 2 * at + F.when(exact, 0).otherwise(1)).cast("int")
    # At a bound: all rows of the slice are equal.
    alike = F.col(_SLICE) % 2 == 1
    numbered = rows.withColumn(_SLICE, slice_)
    if tie is None:
        counted = numbered.groupBy(_SLICE).agg(F.count(F.lit(1)).alias("n")).collect()
        return Cuts(slice_, F.lit(0), {(r[_SLICE], 0): r["n"] for r in counted})
    shares = [k / PARTS for k in range(PARTS)]
    along = numbered.groupBy(_SLICE).agg(
        F.count(F.lit(1)).alias("n"),
        F.when(alike | (F.col(_SLICE) == 0), F.percentile_approx(tie, shares, ACCURACY)).alias("bounds"),
    )
    sizes = along.collect()
    total = sum(r["n"] for r in sizes)
    # Only where equal rows are more than a slice should hold.
    cut = {r[_SLICE]: _bounds(r["bounds"], PARTS) for r in sizes if r["bounds"] is not None and r["n"] > 2 * total // SLICES}
    part: Column = F.lit(0)
    if cut:
        # The bounds of all slices are one array, looked up once a row by the slice that the row is in.
        of = F.get(_longs([sorted(cut).index(s) if s in cut else -1 for s in range(max(cut) + 1)]), F.col(_SLICE))
        held = F.get(F.array(*[_array(cut[s]) for s in sorted(cut)]), of.cast("int"))
        within = _last_not_after(F.col(tie), held, PARTS)
        part = F.when(of < 0, 0).when(F.col(tie).isNull(), 0).otherwise(F.coalesce(within, F.lit(0)))
    counted = numbered.withColumn(_PART, part.cast("int")).groupBy(_SLICE, _PART).agg(F.count(F.lit(1)).alias("n"))
    return Cuts(slice_, part.cast("int"), {(r[_SLICE], r[_PART]): r["n"] for r in counted.collect()})


def global_ranks(rows: DataFrame, by: str) -> DataFrame:
    """``rows`` with ``rank``, ``percent_rank``, ``cume_dist`` and ``ties`` in the order of ``by``.

    As the window functions of these names over all rows, NULLs first; ``ties`` is how many rows
    have the same value. A single row has a percent rank of 0.
    """
    cut = cuts(rows, by)
    total = cut.total
    # Equal rows need no order among them; they are dealt out by their hash.
    alike = (F.col(_SLICE) % 2 == 1) | (F.col(_SLICE) == 0)
    salt = F.when(alike, F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in rows.columns]), F.lit(SLICES))).otherwise(0)
    laid = rows.withColumn(_SLICE, cut.slice).withColumn("_salt", salt)
    w = Window.partitionBy(_SLICE, "_salt").orderBy(by)
    same = Window.partitionBy(_SLICE, "_salt", by)
    ranked = laid.withColumns(
        {
            "_before": cut.before(parts=False),
            "rank": F.when(alike, 1).otherwise(F.rank().over(w)).cast("bigint"),
            "ties": F.when(alike, cut.rows_in_slice()).otherwise(F.count(F.lit(1)).over(same)),
        }
    ).withColumn("rank", F.col("_before") + F.col("rank"))
    return ranked.withColumns(
        {
            "percent_rank": (F.col("rank") - 1) / F.lit(float(max(total - 1, 1))),
            "cume_dist": (F.col("rank") + F.col("ties") - 1) / F.lit(float(max(total, 1))),
        }
    ).drop(_SLICE, "_salt", "_before")


def global_positions(rows: DataFrame, by: str, tie: str, tiles: int | None = None) -> DataFrame:
    """``rows`` with ``position``, from 1, in the order of ``by`` and then ``tie``, and their ``ntile``.

    ``(by, tie)`` must be unique, or which row comes first is up to Spark. NULLs come first.
    ``ntile`` is of ``tiles``, the first ones larger by a row where they do not divide the rows.
    """
    cut = cuts(rows, by, tie)
    laid = rows.withColumn(_SLICE, cut.slice).withColumn(_PART, cut.part)
    w = Window.partitionBy(_SLICE, _PART).orderBy(by, tie)
    out = laid.withColumn("position", cut.before(parts=True) + F.row_number().over(w)).drop(_SLICE, _PART)
    if tiles is None:
        return out
    size, larger = divmod(cut.total, tiles)
    place = F.col("position") - 1
    edge = larger * (size + 1)
    late = F.call_function("div", place - edge, F.lit(max(size, 1))) + larger
    early = F.call_function("div", place, F.lit(size + 1))
    return out.withColumn("ntile", (F.when(place < edge, early).otherwise(late) + 1).cast("bigint"))


def roc_area(scored: DataFrame, score: str, label: str = "label") -> DataFrame:
    """One row ``roc_auc``, ``positives``, ``negatives``: the exact area under the ROC curve.

    It is the chance that a positive row scores above a negative one, ties counting half, from the
    ranks of positive rows; no bins and no curve. NULL without rows of either label.
    """
    ranked = global_ranks(scored.where(F.col(score).isNotNull() & F.col(label).isNotNull()), score)
    positive = F.col(label) > 0
    middle = F.col("rank") + (F.col("ties") - 1) / 2
    sums = ranked.agg(
        F.sum(F.when(positive, middle)).alias("ranks"),
        F.count_if(positive).alias("positives"),
        F.count_if(~positive).alias("negatives"),
    )
    above = F.col("ranks") - F.col("positives") * (F.col("positives") + 1) / 2
    pairs = F.col("positives").cast("double") * F.col("negatives")
    return sums.select(safe_ratio(above, pairs).alias("roc_auc"), "positives", "negatives")
