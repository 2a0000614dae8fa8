"""Near copies of vectors by lattice hashing.

Each table projects unit vectors at random to eight dimensions and decodes the result to the
nearest point of the E8 lattice, which is the vector's cell. A vector also looks into the
neighbouring cells that lie closest to it. Vectors that meet in a cell are compared by their
cosine. Cells that hold many vectors are compared block by block, so a task holds two blocks at
most, and a block sends on only enough links to connect what it links.

Links are then counted within each connected class, again block by block, where every pair of
blocks is compared once; no pair of vectors is ever written as a row.
"""

from __future__ import annotations

import itertools
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tideline.llm.components import components
from tideline.llm.tables import Stored
from tideline.llm.vectors import by_runs, finite, matrix, one_per_id

LEAST = 0.9
#: Tables, neighbouring cells a vector looks into, and the width of a cell in units of one
#: coordinate's spread. At a cosine of 0.9 a pair meets in a table about every second time.
TABLES, PROBES, WIDTH = 8, 4, 1.5
#: Vectors of a block.
BLOCK = 512
SEED = 8


def _neighbours() -> np.ndarray:
    """The 240 shortest vectors of E8."""
    out = []
    for i, j in itertools.combinations(range(8), 2):
        for a, b in itertools.product((1.0, -1.0), repeat=2):
            out.append([a if k == i else b if k == j else 0.0 for k in range(8)])
    out += [list(s) for s in itertools.product((0.5, -0.5), repeat=8) if np.prod(s) > 0]
    return np.array(out)


NEIGHBOURS = _neighbours()


def _nearest_d8(x: np.ndarray) -> np.ndarray:
    """Nearest integer point with an even sum: where the sum is odd, the least certain coordinate
    goes the other way."""
    point = np.rint(x)
    odd = np.flatnonzero(point.sum(1) % 2 != 0)
    worst = np.abs(x[odd] - point[odd]).argmax(1)
    point[odd, worst] += np.where(x[odd, worst] >= point[odd, worst], 1, -1)
    return point


def nearest_e8(x: np.ndarray) -> np.ndarray:
    """Nearest point of E8: the even points, or those shifted by one half."""
    whole, half = _nearest_d8(x), _nearest_d8(x - 0.5) + 0.5
    closer = ((x - whole) ** 2).sum(1) <= ((x - half) ** 2).sum(1)
    return np.where(closer[:, None], whole, half)


def unit(x: np.ndarray) -> np.ndarray:
    x = x / np.maximum(np.abs(x).max(1, keepdims=True), 1e-300)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def cells(x: np.ndarray, tables: int = TABLES, probes: int = PROBES, seed: int = SEED) -> np.ndarray:
    """Cell numbers of unit vectors, ``(n, tables, 1 + probes)``: their own and those they look into."""
    n, width = x.shape
    # Row by row, so that zeros at the end of a vector change nothing.
    directions = np.random.default_rng(seed).normal(size=(width, 8 * tables))
    shifts = np.random.default_rng(seed + 1).random(8 * tables) * 2
    spread = (x @ directions / WIDTH + shifts).reshape(n, tables, 8)
    names = np.random.default_rng(seed + 2).integers(1, 2**63, (tables, 8), dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    out = np.empty((n, tables, 1 + probes), np.int64)
    for t in range(tables):
        point = nearest_e8(spread[:, t])
        # A neighbour's distance falls with its share of the way from the point to the vector.
        share = (spread[:, t] - point) @ NEIGHBOURS.T
        closest = np.argsort(-share, axis=1, kind="stable")[:, :probes]
        all_points = np.concatenate([point[:, None], point[:, None] + NEIGHBOURS[closest]], axis=1)
        number = ((2 * all_points).astype(np.int64).view(np.uint64) * names[t]).sum(2) + np.uint64(t)
        number = (number ^ (number >> np.uint64(31))) * np.uint64(0x9FB21C651E98DF25)
        out[:, t] = (number ^ (number >> np.uint64(29))).view(np.int64)
    return out


def _in_blocks(rows: DataFrame, group: str, vectors: DataFrame) -> DataFrame:
    """Pairs of blocks of each group, with the vectors in them, next to each other.

    ``rows`` has ``group, id`` and what else is needed; groups of one row are left out.
    """
    # Stored, so that the join is free to split a group that holds many rows.
    sizes = Stored(rows.groupBy(group).count().where("count > 1"), "sizes").df
    blocks = F.ceil(F.col("count") / BLOCK)
    dealt = (
        rows.join(sizes, group)
        .withColumn("block", F.pmod(F.xxhash64("id", F.lit(5)), blocks))
        .withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), blocks - 1)))
        .withColumns({"low": F.least("block", "other"), "high": F.greatest("block", "other")})
        .drop("other", "count")
    )
    placed = dealt.join(vectors, "id")
    keys = [group, "low", "high"]
    return placed.repartition(*keys).sortWithinPartitions(*keys, "block", "id")


def _linked(table: pa.Table, least: float) -> np.ndarray:
    """Which rows of a pair of blocks are linked; across the blocks, or within the one block."""
    x = unit(matrix(table.column("v").combine_chunks()))
    links = x @ x.T >= least
    np.fill_diagonal(links, False)
    if table.column("low")[0].as_py() != table.column("high")[0].as_py():
        block = table.column("block").to_numpy()
        links &= block[:, None] != block
    return links


def _roots(links: np.ndarray) -> np.ndarray:
    """Smallest row that each row is connected to."""
    root = np.arange(len(links))
    while True:
        least = np.minimum(root, np.where(links, root, len(root)).min(1, initial=len(root)))
        least = least[least]
        if (least == root).all():
            return root
        root = least


def _edges(least: float) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def work(table: pa.Table) -> Iterator[pa.RecordBatch]:
        home = table.column("home").to_numpy()
        links = _linked(table, least)
        links &= home[:, None] | home  # two vectors that only look in are no match of this cell
        if links.any():
            ids, root = table.column("id").to_numpy(), _roots(links)
            linked = root != np.arange(len(root))
            yield pa.RecordBatch.from_arrays([pa.array(ids[linked]), pa.array(ids[root[linked]])], names=["a", "b"])

    return lambda batches: by_runs(batches, ["cell", "low", "high"], work)


def _counts(least: float) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def work(table: pa.Table) -> Iterator[pa.RecordBatch]:
        found = _linked(table, least) @ table.column("copies").to_numpy()
        some = found > 0
        ids = table.column("id").to_numpy()[some]
        yield pa.RecordBatch.from_arrays([pa.array(ids), pa.array(found[some].astype(np.int64))], names=["id", "n"])

    return lambda batches: by_runs(batches, ["component", "low", "high"], work)


def near_vectors(
    vectors: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", least: float = LEAST,
    tables: int = TABLES, probes: int = PROBES,
) -> DataFrame:
    """``vec_id, n_links, component_id, kept``, one row per id; rows without id are left out.

    Two vectors are linked if their cosine, in double precision, is ``least`` or more; shorter
    vectors count as ending in zeros. Null, empty and zero vectors, and those with null or
    non-finite components, are linked with nothing. Of several rows of one id the least vector
    counts. Equal vectors are one class from the start, so copies are not compared.

    No link is wrong; one can be missed if its ends meet in no table and in no class.
    """
    given = one_per_id(vectors, vec_id, vector)
    usable = finite("v") & F.coalesce(F.exists("v", lambda x: x != 0), F.lit(False))
    rows = Stored(
        given.select("vec_id", F.when(usable, F.col("v")).alias("v")).withColumns(
            {"h1": F.xxhash64("v", F.lit(1)), "h2": F.xxhash64(F.lit(2), "v")}
        ),
        "vectors",
    ).df
    classes = Stored(
        rows.where("v IS NOT NULL")
        .groupBy("h1", "h2")
        .agg(F.min("vec_id").alias("id"), F.count("*").alias("copies"), F.min("v").alias("v")),
        "classes",
    ).df

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                found = cells(unit(matrix(batch.column("v"))), tables, probes).reshape(batch.num_rows, -1)
                home = np.tile(np.arange(1 + probes) == 0, (batch.num_rows, tables))
                ids = np.repeat(batch.column("id").to_numpy(), found.shape[1])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids), pa.array(found.ravel()), pa.array(home.ravel())], names=["id", "cell", "home"]
                )

    looked = Stored(classes.select("id", "v").mapInArrow(look, "id long, cell long, home boolean"), "cells").df
    edges = _in_blocks(looked, "cell", classes.select("id", "v")).mapInArrow(_edges(least), "a long, b long")
    linked = components(edges.distinct()).withColumnsRenamed({"node": "id"})
    groups = Stored(linked.join(classes.select("id", "copies"), "id"), "groups").df
    counted = (
        _in_blocks(groups, "component", classes.select("id", "v"))
        .mapInArrow(_counts(least), "id long, n long")
        .groupBy("id")
        .agg(F.sum("n").alias("n"))
    )
    named = classes.select("h1", "h2", "id", "copies").join(groups.select("id", "component"), "id", "left")
    named = named.join(counted, "id", "left").select(
        "h1", "h2", (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
        F.coalesce("component", "id").alias("component_id"),
    )
    plain = rows.select("vec_id", "h1", "h2", F.col("v").isNotNull().alias("usable"))
    joined = plain.where("usable").join(named, ["h1", "h2"]).select("vec_id", "n_links", "component_id")
    alone = plain.where("NOT usable").select("vec_id", F.lit(0).cast("long"), "vec_id")
    return joined.union(alone).withColumn("kept", F.col("vec_id") == F.col("component_id"))
