"""From raw text rows to a typed panel, and checks on what was lost on the way."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tideline.functions import clean_number, parse_day, safe_ratio
from tideline.settings import EXCLUDED_SYMBOLS

# Measures of a raw row, columns of a clean one, and the file-name form.
MEASURES = ("Open", "High", "Low", "Close", "Volume", "Marketcap")
PANEL_COLUMNS = ("Date", "symbol", *MEASURES)
FILE_TOKEN = r"coin_([^./\\]+)\.csv[^/\\]*$"


def name_symbols(raw: DataFrame, file_column: str = "file_name") -> DataFrame:
    """Upper-case ``symbol`` from the ``Symbol`` column or, where that is NULL, the file name.

    A file name without a token gives NULL, so that :func:`drop_incomplete` removes the row.
    """
    token = F.get(F.regexp_extract_all(file_column, F.lit(FILE_TOKEN), F.lit(1)), 0)
    symbol = F.upper(F.coalesce(F.col("Symbol"), token))
    others = [c for c in raw.columns if c.lower() != "symbol"]
    return raw.select(*others, symbol.alias("symbol")).withColumnsRenamed(
        {"SNo": "sno", "Name": "name"}
    )


def type_measures(raw: DataFrame, columns: Sequence[str] = MEASURES) -> DataFrame:
    return raw.withColumns({c: clean_number(F.col(c)) for c in columns})


def type_dates(raw: DataFrame, column: str = "Date") -> DataFrame:
    return raw.withColumn(column, parse_day(F.col(column)))


def drop_incomplete(
    panel: DataFrame, columns: Sequence[str] = ("symbol", "Date", "Close")
) -> DataFrame:
    return panel.dropna(subset=list(columns))


def without_symbols(
    panel: DataFrame, symbols: Iterable[str] = EXCLUDED_SYMBOLS, column: str = "symbol"
) -> DataFrame:
    """Drops listed symbols; the list is matched in upper case."""
    return panel.where(~F.col(column).isin(sorted({s.upper() for s in symbols})))


def clean_bars(raw: DataFrame, exclude: Iterable[str] = EXCLUDED_SYMBOLS) -> DataFrame:
    """Raw text rows to a clean panel: a single map over the scan, with no shuffle."""
    named = name_symbols(raw)
    typed = type_dates(type_measures(named))
    return without_symbols(drop_incomplete(typed), exclude).select(*PANEL_COLUMNS)


def present_columns(df: DataFrame, wanted: Sequence[str], required: Sequence[str] = ()) -> list[str]:
    """The wanted columns ``df`` has, in the order asked for, without repeats."""
    missing = [c for c in required if c not in df.columns]
    if missing:
        raise ValueError(f"missing columns: {missing}")
    found = [c for c in dict.fromkeys([*required, *wanted]) if c in df.columns]
    if not found:
        raise ValueError(f"none of the columns {list(wanted)} is present")
    return found


def distinct_entities(panel: DataFrame, entity: str = "symbol") -> DataFrame:
    return panel.select(entity).distinct().orderBy(entity)


def panel_summary(panel: DataFrame, entity: str = "symbol", time: str = "Date") -> DataFrame:
    """Rows, entities and time span. Entities are first reduced to one row each."""
    per_entity = panel.groupBy(entity).agg(
        F.count(F.lit(1)).alias("rows"), F.min(time).alias("first"), F.max(time).alias("last")
    )
    return per_entity.agg(
        F.coalesce(F.sum("rows"), F.lit(0)).alias("rows"),
        F.count(entity).alias("symbols"),
        F.min("first").alias("min_date"),
        F.max("last").alias("max_date"),
    )


def retention(panel: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows before and after dropping incomplete ones, and NULLs per column, in one pass."""
    complete = F.lit(True)
    for c in columns:
        complete = complete & F.col(c).isNotNull()
    counted = panel.agg(
        F.count(F.lit(1)).alias("rows_before"),
        F.count_if(complete).alias("rows_after"),
        *[F.count_if(F.col(c).isNull()).alias(f"nulls_{c}") for c in columns],
    )
    return counted.withColumn("retained", safe_ratio(F.col("rows_after"), F.col("rows_before")))
