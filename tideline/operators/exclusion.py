"""Rows with or without a match in a table of keys that may itself be large.

A Bloom filter of the keys is kept as bitmaps of 32,768 places, one row each, so its size is set
by ``log_places`` alone and it is safe to broadcast: 16 MB with 2**27 places. Rows that miss the
filter match nothing; that is known where they are scanned, and only the rest is shuffled to meet
the keys. A filter that fills up lets more rows through and changes no result.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Logarithm of the places of a filter, and of those of a bitmap.
LOG_PLACES, LOG_BITMAP = 27, 15
#: Places a key sets, each from a hash of its own.
PROBES = 2


def _places(on: Sequence[str], log_places: int) -> list[Column]:
    hashes = (F.xxhash64(F.lit(i), *[F.col(f"`{c}`") for c in on]) for i in range(PROBES))
    return [F.shiftrightunsigned(h, 64 - log_places) for h in hashes]


def _known(on: Sequence[str]) -> Column:
    known = F.lit(True)
    for c in on:
        known = known & F.col(f"`{c}`").isNotNull()
    return known


def key_filter(keys: DataFrame, on: Sequence[str], log_places: int = LOG_PLACES) -> DataFrame:
    """``bitmap, bits``: the filter of the keys, at most ``2**(log_places - 15)`` rows of 4 KB.

    Keys with a NULL match nothing and set no place. Bitmaps merge within tasks before the shuffle.
    """
    if not LOG_BITMAP <= log_places <= 30:
        raise ValueError(f"log_places is 15 to 30, not {log_places}")
    places = keys.where(_known(on)).select(F.explode(F.array(*_places(on, log_places))).alias("place"))
    bitmap = F.shiftright("place", LOG_BITMAP).alias("bitmap")
    position = F.col("place").bitwiseAND((1 << LOG_BITMAP) - 1)
    return places.groupBy(bitmap).agg(F.bitmap_construct_agg(position).alias("bits"))


def _is_set(bits: Column, place: Column) -> Column:
    """Whether a place is set in its bitmap; not in one that is missing."""
    position = place.bitwiseAND((1 << LOG_BITMAP) - 1)
    byte = F.conv(F.hex(F.substring(bits, F.shiftright(position, 3).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    return F.coalesce(F.bit_get(byte, position.bitwiseAND(7).cast("int")) == 1, F.lit(False))


def possible(
    rows: DataFrame, found: DataFrame, on: Sequence[str], log_places: int = LOG_PLACES, wanted: bool = True
) -> DataFrame:
    """The rows whose key may be in a filter, or with ``wanted=False`` those whose key is not.

    Every row is in one of the two. ``found`` is a filter of as many places.
    """
    told, passes = rows, _known(on)
    for i, place in enumerate(_places(on, log_places)):
        side = found.select(F.col("bitmap").alias(f"_bitmap_{i}"), F.col("bits").alias(f"_bits_{i}"))
        told = told.join(F.broadcast(side), F.shiftright(place, LOG_BITMAP) == F.col(f"_bitmap_{i}"), "left")
        passes = passes & _is_set(F.col(f"_bits_{i}"), place)
    return told.where(passes if wanted else ~passes).select(*[f"`{c}`" for c in rows.columns])


def with_keys(rows: DataFrame, keys: DataFrame, on: Sequence[str], log_places: int = LOG_PLACES) -> DataFrame:
    """The rows that have a match in ``keys``, once each, however often their key is listed.

    NULL matches nothing. Only rows that pass the filter are shuffled.
    """
    found = key_filter(keys, on, log_places)
    listed = keys.select(*[f"`{c}`" for c in on]).where(_known(on))
    return possible(rows, found, on, log_places).join(listed, list(on), "left_semi").select(*[f"`{c}`" for c in rows.columns])


def without_keys(rows: DataFrame, keys: DataFrame, on: Sequence[str], log_places: int = LOG_PLACES) -> DataFrame:
    """The rows that have no match in ``keys``; with a NULL in its key a row stays.

    Rows that miss the filter stay where they are, without a shuffle; the rest meets the keys. The
    rows are scanned twice for it, which costs less than to shuffle and sort them all; rows that are
    themselves costly to make belong in a table first.
    """
    found = key_filter(keys, on, log_places)
    listed = keys.select(*[f"`{c}`" for c in on]).where(_known(on))
    doubtful = possible(rows, found, on, log_places).join(listed, list(on), "left_anti")
    clear = possible(rows, found, on, log_places, wanted=False)
    return clear.unionByName(doubtful.select(*[f"`{c}`" for c in rows.columns]))
