"""Column expressions: all built-in functions, safe under ANSI mode."""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column
from pyspark.sql import functions as F


def clean_number(text: Column) -> Column:
    """Number left after everything but digits, dots and minus signs is dropped; NULL if none."""
    return F.regexp_replace(text.cast("string"), r"[^0-9.\-]", "").try_cast("double")


def parse_day(text: Column) -> Column:
    """Date in the first ten characters, NULL if they are not ``yyyy-MM-dd``.

    The form is checked first, because a parser that fails on many rows is slow.
    """
    day = F.substring(text.cast("string"), 1, 10)
    return F.when(day.rlike(r"^\d{4}-\d{2}-\d{2}$"), day.try_cast("date"))


def epoch_seconds(time: Column) -> Column:
    return F.unix_seconds(time.cast("timestamp"))


def safe_ratio(above: Column, below: Column) -> Column:
    """Quotient, NULL on a zero denominator."""
    return F.try_divide(above, below)


def relative_gap(value: Column, base: Column) -> Column:
    """How far ``value`` lies from ``base``, as a share of ``base``."""
    return safe_ratio(value, base) - F.lit(1.0)


def log_return(now: Column, before: Column) -> Column:
    """Difference of logarithms where both prices are positive, else NULL."""
    return F.when((now > 0) & (before > 0), F.ln(now) - F.ln(before))


def clamp(value: Column, low: Column, high: Column) -> Column:
    """``value`` kept within the bounds; a NULL value stays NULL, a NULL bound does not bind."""
    return F.when(value < low, low).when(value > high, high).otherwise(value)


def guarded_zscore(
    value: Column,
    mean: Column,
    std: Column,
    count: Column,
    position: Column,
    min_count: int,
    sigma_floor: float,
    burn_in: int,
) -> Column:
    """Z-score, NULL until there is enough history and spread."""
    ready = (count >= min_count) & (std >= sigma_floor) & (position >= burn_in)
    return F.when(ready, (value - mean) / std)


def safe_correlation(x: Column, y: Column) -> Column:
    """Pearson correlation over rows where both are set, NULL where either one is constant.

    Plain ``corr`` divides by zero there, which ANSI mode raises on. It works as an
    aggregate only; see ``breadth.rolling_correlation`` for the windowed form.
    """
    both = x.isNotNull() & y.isNotNull()
    spread = F.stddev_samp(F.when(both, x)) * F.stddev_samp(F.when(both, y))
    return safe_ratio(F.covar_samp(x, y), spread)


def positive_probability(probability: Column) -> Column:
    """Probability of class 1 in an ML probability vector."""
    return vector_to_array(probability).getItem(1)
