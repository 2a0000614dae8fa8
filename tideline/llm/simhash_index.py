"""SimHash fingerprints and near copies by multi-index hashing.

Of two fingerprints that differ in at most two bits, one of the two 32-bit segments differs in at
most one. So there is a table for each segment, in which every fingerprint stands under its own
segment; each fingerprint looks up the values in a ball of radius one around each of its segments,
and complete distances are verified on what the tables hold there.

A segment that very many different fingerprints share would make one entry too large for a task.
Such entries, and the lookups that hit them, go to tables keyed by half of the bits that were free
as well: 48 bits, then 56. What is left of the distance again fits one of the halves in at most one
bit, or none where the ball has used one, so no link is lost. An entry of 56 bits holds 256 different
fingerprints at most, whatever the texts. Only different fingerprints are indexed.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tideline.llm.components import components
from tideline.llm.tables import Stored, row_key

SHINGLE, SEED, BITS, DISTANCE = 3, 42, 64, 2
#: Comparisons an entry may take before it is split, and the free bits at which splitting ends.
WORK, SMALLEST = 1 << 22, 8
#: Hashes whose bits are counted at a time, which bounds the memory a long text takes.
CHUNK = 1 << 16


def fingerprint(text: str | None, shingle: int = SHINGLE, seed: int = SEED) -> int:
    """Signed 64-bit SimHash; 0 for texts without words.

    Words lie between ASCII white space and are lower-cased from A to Z only. A text of fewer
    words than a shingle is one shingle. Repeated shingles count each time.
    """
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    n = max(1, len(words) - shingle + 1)
    ones = np.zeros(BITS, np.int64)
    digest, join = xxhash.xxh64_intdigest, b" ".join
    for start in range(0, n, CHUNK):
        hashes = np.fromiter(
            (digest(join(words[i : i + shingle]), seed) for i in range(start, min(n, start + CHUNK))), np.uint64
        )
        octets = hashes.astype("<u8").view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(octets, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = np.packbits(2 * ones > n, bitorder="little")
    return int(bits.view("<i8")[0])


def with_fingerprints(
    docs: DataFrame, text: str = "text", into: str = "fingerprint", shingle: int = SHINGLE, seed: int = SEED
) -> DataFrame:
    """``docs`` with the fingerprint of its texts as a long; null texts count as empty ones."""

    @F.pandas_udf("long")
    def of(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            yield pd.Series([fingerprint(x, shingle, seed) for x in batch], dtype="int64")

    return docs.withColumn(into, of(F.col(text)))


def _narrow(entries: DataFrame, free: int, ball: bool) -> DataFrame:
    """``entries`` keyed by half of their free bits as well, once for each half.

    ``key`` is the fingerprint with ``free`` bits from ``low`` on left out. With ``ball`` also the
    values one bit away, for rows that have not ``used`` their bit. Only bits that are 0 are
    changed: of two values one bit apart exactly one reaches the other so.
    """
    half = free // 2
    sides = entries.withColumn("side", F.explode(F.array(F.lit(0), F.lit(half)))).selectExpr(
        "print", "used", f"low + {half} - side AS rest", "low + side AS fixed",
        f"key | (print & shiftleft({(1 << half) - 1}L, low + side)) AS key",
    )
    if ball:
        sides = (
            sides.withColumn("place", F.explode(F.sequence(F.lit(-1), F.lit(half - 1))))
            .where("place < 0 OR (used = 0 AND (shiftright(print, fixed + place) & 1L) = 0)")
            .selectExpr(
                "print", "IF(place < 0, used, 1) AS used", "rest",
                "IF(place < 0, key, key | shiftleft(1L, fixed + place)) AS key",
            )
        )
    return sides.select("print", "used", F.col("rest").alias("low"), "key")


def near_fingerprints(prints: DataFrame, work: int = WORK) -> DataFrame:
    """All pairs ``a, b`` of different fingerprints (one column of longs) at two bits or fewer, once.

    An entry that would take more than ``work`` comparisons is split by further bits, down to
    entries of 256 fingerprints.

    Spark sizes a table that is made longer by explode as if it were not, and stored ones by files
    in which few different numbers take no room; so the joins say that neither side is broadcast.
    """
    (name,) = prints.columns
    whole = prints.where(F.col(name).isNotNull()).distinct().selectExpr(
        f"`{name}` AS print", "0 AS used", "0 AS low", "0L AS key"
    )
    whole = Stored(whole, "prints")
    tables, lookups, found, over, free = whole.df, whole.df, [], [whole], BITS
    while True:
        tables, lookups, free = _narrow(tables, free, ball=False), _narrow(lookups, free, ball=True), free // 2
        held = Stored(tables.groupBy("low", "key").agg(F.count("*").alias("held")), "held")
        # What hits nothing but the fingerprint itself ends here, which is nearly all.
        hits = Stored(lookups.join(held.df.hint("merge"), ["low", "key"]).where("used = 1 OR held > 1"), "hits")
        asked = hits.df.groupBy("low", "key").agg(F.first("held").alias("held"), F.count("*").alias("asked"))
        sizes = Stored(asked.withColumn("hot", F.expr(f"held * asked > {work} AND {free} > {SMALLEST}")), "sizes")
        over += [held, hits, sizes]
        cold, hot = (sizes.df.where(kind).select("low", "key") for kind in ("NOT hot", "hot"))
        there = tables.join(cold.hint("merge"), ["low", "key"]).select("low", "key", F.col("print").alias("other"))
        near = hits.df.join(there.hint("merge"), ["low", "key"]).where(
            f"(used = 1 OR print < other) AND bit_count(print ^ other) <= {DISTANCE}"
        )
        found.append(near.selectExpr("least(print, other) AS a", "greatest(print, other) AS b"))
        if hot.isEmpty():
            break
        tables = tables.join(hot.hint("merge"), ["low", "key"], "left_semi").select("print", "used", "low", "key")
        lookups = hits.df.join(hot.hint("merge"), ["low", "key"], "left_semi").select("print", "used", "low", "key")
    links = Stored(reduce(DataFrame.union, found).distinct(), "links").df
    for table in over:
        table.drop()
    return links


def near_copies(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", keyed: bool = False) -> DataFrame:
    """``doc_id, fingerprint, component_id``, one row per row of ``docs``; with ``keyed`` also
    ``component``, a fingerprint that names the component, and the row's key ``row_a, row_b``.

    ``component_id`` is the smallest id that can be reached over fingerprints two bits apart or
    fewer; rows with no id have one only if a row with an id is among those. Empty texts have
    fingerprint zero and are linked like others. Other columns are ignored.
    """
    keys = [key.alias(name) for key, name in zip(row_key(doc_id, text), ("row_a", "row_b"))] if keyed else []
    named = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"), *keys)
    prints = Stored(with_fingerprints(named).drop("text"), "prints").df
    least = prints.groupBy("fingerprint").agg(F.min("doc_id").alias("first_id"))
    linked = components(near_fingerprints(prints.select("fingerprint")))
    classes = least.join(linked, least["fingerprint"] == linked["node"], "left").select(
        "fingerprint", "first_id", F.coalesce("component", "fingerprint").alias("component")
    )
    classes = Stored(classes, "classes").df
    named = (
        classes.groupBy("component")
        .agg(F.min("first_id").alias("component_id"))
        .join(classes, "component")
        .select("fingerprint", "component_id", "component")
    )
    more = ["component", "row_a", "row_b"] if keyed else []
    return prints.join(named, "fingerprint").select("doc_id", "fingerprint", "component_id", *more)
