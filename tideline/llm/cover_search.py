"""Exact inner-product search with two cover trees.

Vectors are dealt to cells by their nearest pivot; a cell is the top node of a tree, with a covering
radius, and what a cell has too many of for one task is dealt to several trees. Queries are indexed
by trees of their own. A pair of nodes is left out when even the largest product that their
centres and covering radii allow is less than the worst kth score among the node's queries.

Queries first meet their own cell, which gives each a kth score to beat; then only the cells that
can hold a better one. Trees and products are numpy inside a task of bounded size; Spark deals out
the blocks and merges the results.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tideline.llm.tables import Stored
from tideline.llm.vectors import finite, matrix, one_per_id, stacked

SCALE, TOP, EVERY = 256, 5, 50
#: Cells at most, by a hash of the ids; candidates and queries that a task searches at a time.
PIVOTS, CANDIDATES, QUERIES = 64, 8192, 1024
#: Points that a node holds without children, and children it has at most.
LEAF, CHILDREN = 64, 16

_LONG = 2**63


class Node:
    __slots__ = ("centre", "radius", "norm", "low", "high", "children")

    def __init__(self, points: np.ndarray, centre: np.ndarray, low: int, high: int):
        self.centre, self.low, self.high = centre, low, high
        self.radius = float(np.sqrt(((points - centre) ** 2).sum(1).max(initial=0)))
        self.norm = float(np.sqrt((centre**2).sum()))
        self.children: list[Node] = []


def cover_tree(points: np.ndarray) -> tuple[Node, np.ndarray]:
    """The root, and the order in which nodes hold the points as ranges.

    Children of a node are chosen farthest first, its centre among them, until they cover the node
    within half its radius or are :data:`CHILDREN`; they are apart by more than what covers them.
    Each covers its points within a radius that is measured.
    """
    order = np.arange(len(points))

    def grow(node: Node) -> None:
        n = node.high - node.low
        if n <= LEAF or node.radius == 0:
            return
        own = order[node.low : node.high]
        x = points[own]
        nearest = ((x - node.centre) ** 2).sum(1)
        owner, centres = np.zeros(n, np.int64), [node.centre]
        while len(centres) < CHILDREN and nearest.max() > (node.radius / 2) ** 2:
            centres.append(x[int(nearest.argmax())])
            to_new = ((x - centres[-1]) ** 2).sum(1)
            closer = to_new < nearest
            owner[closer], nearest[closer] = len(centres) - 1, to_new[closer]
        if len(centres) == 1:  # all within half the radius of the centre: halve it instead
            half = np.argsort(nearest, kind="stable")
            owner[half[n // 2 :]] = 1
            centres.append(x[half[-1]])
        by = np.argsort(owner, kind="stable")
        order[node.low : node.high] = own[by]
        sizes = np.bincount(owner, minlength=len(centres))
        at = node.low
        for centre, size in zip(centres, sizes.tolist()):
            if size:
                child = Node(points[order[at : at + size]], centre, at, at + size)
                node.children.append(child)
                at += size
        if len(node.children) == 1 and node.children[0].radius >= node.radius:
            node.children = []
            return
        for child in node.children:
            grow(child)

    centre = points[int(((points - points.mean(0)) ** 2).sum(1).argmin())]
    root = Node(points, centre, 0, len(points))
    grow(root)
    return root, order


def _products(q: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Exact products of whole numbers; those beyond 64 bits count as the nearest that has them."""
    if not q.size or not c.size:
        return np.zeros((len(q), len(c)))
    if float(np.abs(q).max()) * float(np.abs(c).max()) * q.shape[1] < 2**53:
        return q @ c.T
    whole = lambda m: np.array([[int(v) for v in row] for row in m], object)
    return np.clip(whole(q) @ whole(c).T, -_LONG, _LONG - 1)


def _bound(q: Node, c: Node) -> float:
    most = float(q.centre @ c.centre) + q.norm * c.radius + q.radius * c.norm + q.radius * c.radius
    return max(most + abs(most) * 1e-9 + 1e-6, -_LONG)


def dual_search(
    q: np.ndarray, q_ids: np.ndarray, floors: np.ndarray, c: np.ndarray, c_ids: np.ndarray, top: int = TOP
) -> tuple[np.ndarray, np.ndarray]:
    """Ids and scores of the best ``top`` candidates of each query, in order; -1 where there are fewer."""
    ids, scores, filled = filled_search(q, q_ids, floors, c, c_ids, top)
    return np.where(filled, ids, -1), scores


def filled_search(
    q: np.ndarray, q_ids: np.ndarray, floors: np.ndarray, c: np.ndarray, c_ids: np.ndarray, top: int = TOP
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Ids and scores of the best ``top`` candidates of each query, in order, and which places are filled.

    ``floors``: a score for each query that its kth one elsewhere has reached already. Smaller ids
    win ties, so only what is less than a floor is left out.
    """
    q_root, q_order = cover_tree(q)
    c_root, c_order = cover_tree(c)
    q, q_ids, floors = q[q_order], q_ids[q_order], floors[q_order]
    c, c_ids = c[c_order], c_ids[c_order]
    wide = max(float(np.abs(q).max(initial=0)) * float(np.abs(c).max(initial=0)) * max(q.shape[1], 1), 1.0) >= 2**53
    kind = object if wide else float
    none = -np.inf
    best, best_ids = np.full((len(q), top), none, kind), np.full((len(q), top), _LONG - 1, np.int64)

    def to_beat(node: Node) -> float:
        rows = slice(node.low, node.high)
        return float(np.maximum(best[rows, -1].astype(float), floors[rows]).min())

    number = 0
    heap = [(-_bound(q_root, c_root), number, q_root, c_root)]
    while heap:
        minus, _, a, b = heapq.heappop(heap)
        if -minus < to_beat(a):
            continue
        if not a.children and not b.children:
            rows = slice(a.low, a.high)
            scores = _products(q[rows], c[b.low : b.high]).astype(kind)
            ids = np.broadcast_to(c_ids[b.low : b.high], scores.shape)
            scores = np.where(ids == q_ids[rows, None], none, scores)
            scores = np.concatenate([best[rows], scores], 1)
            ids = np.concatenate([best_ids[rows], ids], 1)
            ids = np.where(scores == none, _LONG - 1, ids)
            for r in range(a.high - a.low) if wide else ():
                pick = sorted(range(scores.shape[1]), key=lambda j: (-scores[r, j], ids[r, j]))[:top]
                best[a.low + r], best_ids[a.low + r] = scores[r, pick], ids[r, pick]
            if not wide:
                pick = np.lexsort((ids, -scores), axis=1)[:, :top]
                best[rows], best_ids[rows] = np.take_along_axis(scores, pick, 1), np.take_along_axis(ids, pick, 1)
            continue
        split_query = a.children and (not b.children or a.radius >= b.radius)
        for x in a.children if split_query else b.children:
            pair = (x, b) if split_query else (a, x)
            bound = _bound(*pair)
            if bound >= to_beat(pair[0]):
                number += 1
                heapq.heappush(heap, (-bound, number, *pair))
    back = np.argsort(q_order)
    filled = (best != none)[back]
    return best_ids[back], np.where(filled, best[back], 0), filled


def _whole(vectors: DataFrame, vec_id: str, vector: str, scale: int) -> DataFrame:
    given = one_per_id(vectors, vec_id, vector).where(finite("v"))
    return given.select("vec_id", F.transform("v", lambda x: _floor(x * scale)).alias("v"))


def _floor(x: Column) -> Column:
    """Floor as a double, whatever its size: beyond 2**52 a double has no fraction."""
    return F.when(F.abs(x) < 2.0**52, F.floor(x).cast("double")).otherwise(x)


def _search(rows: DataFrame, probes: DataFrame, top: int) -> DataFrame:
    """The best of each tree for the queries that visit it."""

    def work(both: pd.DataFrame) -> pd.DataFrame:
        asks = both["floor"].notna().to_numpy()
        x, ids = matrix(pa.array(both["v"], pa.list_(pa.float64()))), both["id"].to_numpy()
        if asks.all() or not asks.any():
            return pd.DataFrame({"query_id": [], "vec_id": [], "score": []}).astype("int64")
        floors = both["floor"].to_numpy(float)[asks]
        best, scores, filled = filled_search(x[asks], ids[asks], floors, x[~asks], ids[~asks], top)
        found = filled.ravel()
        queries = np.repeat(ids[asks], top)
        return pd.DataFrame(
            {"query_id": queries[found], "vec_id": best.ravel()[found], "score": [int(x) for x in scores.ravel()[found]]}, dtype="int64"
        )

    visited = rows.join(probes.select("cell", "visit").distinct(), "cell")
    trees = probes.join(rows.select("cell", "tree").distinct(), "cell")
    both = visited.select("cell", "tree", "visit", F.col("vec_id").alias("id"), "v", F.lit(None).cast("double").alias("floor"))
    both = both.union(trees.select("cell", "tree", "visit", F.col("query_id").alias("id"), "v", "floor"))
    return both.groupBy("cell", "tree", "visit").applyInPandas(work, "query_id long, vec_id long, score long")


def top_products(
    vectors: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", scale: int = SCALE,
    top: int = TOP, every: int = EVERY,
) -> DataFrame:
    """``query_id, rank, vec_id, score``: the best ``top`` inner products of each query.

    Components are turned into whole numbers, floor(``scale`` * x). Queries are the rows whose id
    ``every`` divides, and candidates all rows but the query's own; ties go to the smaller id, and
    there are fewer ranks where there are fewer candidates. Vectors that are null or hold null or
    non-finite components take no part, rows without id neither; of several rows of one id the
    least vector counts. Shorter vectors count as ending in zeros. Scores beyond 64 bits
    count as the nearest that has them.

    The driver gets at most :data:`PIVOTS` vectors and three numbers for each.
    """
    whole = Stored(_whole(vectors, vec_id, vector, scale), "whole").df
    pivots = [r.v for r in whole.orderBy(F.xxhash64("vec_id", F.lit(9)), "vec_id").limit(PIVOTS).collect()]
    centres = matrix(pa.array(pivots, pa.list_(pa.float64()))) if pivots else np.zeros((1, 0))

    def padded(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        both = stacked([x, centres])
        return both[: len(x)], both[len(x) :]

    @F.pandas_udf("cell int, distance double")
    def nearest(v: pd.Series) -> pd.DataFrame:
        x, y = padded(matrix(pa.array(v, pa.list_(pa.float64()))))
        # Distances as sums of squares, one centre at a time: products would lose digits.
        far = np.stack([np.sqrt(((x - c) ** 2).sum(1)) for c in y], 1)
        cell = far.argmin(1)
        return pd.DataFrame({"cell": cell.astype("int32"), "distance": far[np.arange(len(x)), cell]})

    dealt = Stored(whole.withColumn("p", nearest("v")).select("vec_id", "v", "p.*"), "dealt").df
    known = {r.cell: (r.n, r.radius) for r in dealt.groupBy("cell").agg(F.count("*").alias("n"), F.max("distance").alias("radius")).collect()}
    per_cell = F.create_map(*[F.lit(x) for c, (n, _) in known.items() for x in (c, -(-n // CANDIDATES))]) if known else None
    trees = per_cell[F.col("cell")] if known else F.lit(1)
    rows = dealt.withColumn("tree", F.pmod(F.xxhash64("vec_id", F.lit(1)), trees).cast("int")).drop("distance")
    asked = dealt.where(F.col("vec_id") % every == 0)
    visits = max(1, -(-asked.count() // QUERIES))
    visit = F.pmod(F.xxhash64("vec_id", F.lit(2)), F.lit(visits)).cast("int").alias("visit")
    queries = asked.select(F.col("vec_id").alias("query_id"), "v", "cell", visit)
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    first = Stored(_search(rows, queries.withColumn("floor", F.lit(float("-inf"))), top), "first").df
    floors = first.groupBy("query_id").agg(
        F.when(F.count("*") >= top, F.element_at(F.sort_array(F.collect_list("score"), False), top)).alias("floor")
    )

    @F.pandas_udf("array<int>")
    def worth(v: pd.Series, floor: pd.Series, own: pd.Series) -> pd.Series:
        x, y = padded(matrix(pa.array(v, pa.list_(pa.float64()))))
        names = np.array(sorted(known))
        radius = np.array([known[c][1] for c in sorted(known)])
        most = x @ y[names].T + np.sqrt((x**2).sum(1))[:, None] * radius
        most = np.maximum(most + np.abs(most) * 1e-9 + 1e-6, -_LONG)
        keep = (most >= floor.to_numpy(float)[:, None]) & (names != own.to_numpy()[:, None])
        return pd.Series([names[k].tolist() for k in keep], dtype=object)

    floored = queries.join(floors, "query_id", "left").withColumn("floor", F.coalesce(F.col("floor").cast("double"), F.lit(float("-inf"))))
    onward = floored.select(
        "query_id", "v", "visit", "floor", F.explode(worth("v", "floor", "cell")).alias("cell")
    )
    both = first.union(_search(rows, onward, top))
    ranked = both.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    return ranked.select("query_id", "rank", "vec_id", "score")
