"""Vectors in tasks, shared by the operators on embeddings.

Rows of a table are dealt out to cells; inside a sorted partition a cell's
block of rows comes first and the queries that look at it follow, so a task
holds one block and one Arrow batch of queries.
"""

from __future__ import annotations

import sys

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

cloudpickle.register_pickle_by_value(sys.modules[__name__])


def usable(vector) -> Column:
    """The vector and all its components are there and finite."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != F.lit(float("inf"))))
    return F.coalesce(finite, F.lit(False))


def matrix(vectors) -> np.ndarray:
    """A list column as the rows of a matrix of doubles; shorter vectors are
    filled with zeros."""
    if isinstance(vectors, pa.ChunkedArray):
        vectors = vectors.combine_chunks()
    size = np.diff(vectors.offsets.to_numpy())
    flat = vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    width = int(size.max()) if len(size) else 0
    if (size == width).all():
        return flat.reshape(len(size), width)
    out = np.zeros((len(size), width))
    out[np.arange(width) < size[:, None]] = flat
    return out


def same_width(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    width = max(a.shape[1], b.shape[1])
    return tuple(np.pad(x, ((0, 0), (0, width - x.shape[1]))) if x.shape[1] < width else x for x in (a, b))


def best(score: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Where the ``k`` highest scores are, ties by the smaller id, in this order."""
    at = np.arange(len(score))
    if len(score) > k:
        least = np.partition(score, len(score) - k)[len(score) - k]
        at = np.flatnonzero(score >= least)
    return at[np.lexsort((ids[at], -score[at]))][:k]


def runs(batches, keys: list[str]):
    """The rows of sorted batches as (key, slice); a run of equal keys that goes
    over a batch's end comes in several slices."""
    for b in batches:
        if not b.num_rows:
            continue
        cols = [b.column(b.schema.get_field_index(k)).to_numpy(zero_copy_only=False) for k in keys]
        new = np.ones(b.num_rows, bool)
        new[1:] = False
        for c in cols:
            new[1:] |= c[1:] != c[:-1]
        at = np.flatnonzero(new)
        for s, e in zip(at.tolist(), [*at[1:].tolist(), b.num_rows]):
            yield tuple(c[s] for c in cols), b.slice(s, e - s)


def meet(batches, keys: list[str], handle):
    """Call ``handle(block, queries)`` for each cell and batch of its queries,
    and yield what it yields.  The batches are sorted by ``keys`` and ``kind``:
    0 for the rows of the cell's block, 1 for queries."""
    cell, held, block = None, [], None
    for key, piece in runs(batches, [*keys, "kind"]):
        if key[:-1] != cell:
            cell, held, block = key[:-1], [], None
        if key[-1] == 0:
            held.append(piece)
        elif held:
            block = block or pa.Table.from_batches(held)
            yield from handle(block, piece)


def sorted_cells(rows: DataFrame, queries: DataFrame, keys: list[str]) -> DataFrame:
    """``rows`` and ``queries`` (same columns) dealt out by ``keys``, each cell's rows first."""
    both = rows.withColumn("kind", F.lit(0)).unionByName(queries.withColumn("kind", F.lit(1)))
    return both.repartition(*keys).sortWithinPartitions(*keys, "kind")


def one_row_per_id(vectors: DataFrame, *columns: str) -> DataFrame:
    """``vec_id`` (not null) and ``columns``; of rows with one id the smallest counts."""
    low = (vectors.filter(F.col("vec_id").isNotNull()).groupBy("vec_id")
                  .agg(F.min(F.struct(*columns)).alias("row")))
    return low.select("vec_id", "row.*")
