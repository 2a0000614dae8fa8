"""What the vector operators share: valid rows, one per id, and arrays of them in tasks."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def finite(vector: str) -> Column:
    """Whether a vector is there and all its components are finite numbers; never null."""
    fine = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return F.coalesce(fine, F.lit(False))


def one_per_id(vectors: DataFrame, vec_id: str, vector: str) -> DataFrame:
    """``vec_id, v``: a row per id, as doubles; of several vectors of an id the least counts.

    Rows without id are left out.
    """
    plain = vectors.select(F.col(vec_id).cast("long").alias("vec_id"), F.col(vector).cast("array<double>").alias("v"))
    return plain.where("vec_id IS NOT NULL").groupBy("vec_id").agg(F.min("v").alias("v"))


def matrix(column: pa.Array) -> np.ndarray:
    """Rows of a list column as a matrix; shorter vectors end in zeros."""
    lengths = column.value_lengths().to_numpy()
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(float)
    width = int(lengths.max(initial=0))
    if (lengths == width).all():
        return flat.reshape(len(column), width)
    out = np.zeros((len(column), width))
    out[np.arange(width) < lengths[:, None]] = flat
    return out


def stacked(parts: list[np.ndarray]) -> np.ndarray:
    width = max(p.shape[1] for p in parts)
    return np.concatenate([np.pad(p, ((0, 0), (0, width - p.shape[1]))) for p in parts])


def by_runs(
    batches: Iterator[pa.RecordBatch], keys: list[str], work: Callable[[pa.Table], Iterator[pa.RecordBatch]]
) -> Iterator[pa.RecordBatch]:
    """Calls ``work`` with the rows of each run of equal keys of sorted batches.

    Far cheaper for many small groups than a call from Spark for each; holds one group at a time.
    """
    held: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        columns = [batch.column(k).to_numpy(zero_copy_only=False) for k in keys]
        new = np.zeros(batch.num_rows, bool)
        for column in columns:
            new[1:] |= column[1:] != column[:-1]
        cuts = [0, *np.flatnonzero(new).tolist(), batch.num_rows]
        for low, high in zip(cuts, cuts[1:]):
            key = tuple(c[low] for c in columns)
            if held and key != last:
                yield from work(pa.Table.from_batches(held))
                held = []
            held.append(batch.slice(low, high - low))
            last = key
    if held:
        yield from work(pa.Table.from_batches(held))
