"""Vectors in packed blocks, and pairs of a query block and a candidate block as tiles.

A block is one row that holds many vectors as bytes, so what a tile shuffles is a few large
rows, and a tile is one group of bounded size. Blocks are dealt by a hash of the row number.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from keyweave.llm.common import materialise


def numbered(df: DataFrame, vec_id: str, vec: str, name: str, **more: Column) -> DataFrame:
    """rid, vec_id, v (doubles) and ``more`` of the valid rows, as a written table.

    Rows with a null id, a null vector or a null or non-finite component are left out. ``rid``
    tells rows with equal ids apart; it is fixed since the table is written.
    """
    x = F.col(vec).cast("array<double>")
    bad = F.exists(x, lambda e: e.isNull() | F.isnan(e) | (F.abs(e) == float("inf")))
    good = df.where(F.col(vec_id).isNotNull() & x.isNotNull() & ~bad)
    return materialise(good.select(
        F.monotonically_increasing_id().alias("rid"), F.col(vec_id).cast("long").alias("vec_id"),
        x.alias("v"), *[c.alias(k) for k, c in more.items()]), name)


def matrix(column: pa.ChunkedArray, dims: int, dtype=np.float64) -> np.ndarray:
    """Rows of lists as a matrix; what a shorter list lacks is 0."""
    out = np.zeros((len(column), dims), dtype)
    row = 0
    for chunk in column.chunks:
        lengths = np.diff(chunk.offsets.to_numpy())
        ends = np.cumsum(lengths)
        at = np.arange(ends[-1] if len(ends) else 0) - np.repeat(ends - lengths, lengths)
        out[row + np.repeat(np.arange(len(lengths)), lengths), at] = chunk.flatten().to_numpy()
        row += len(chunk)
    return out


def blocks_of(n: int, size: int) -> int:
    return max(1, -(-n // size))


def deal(n: int, seed: int) -> Column:
    """A block in 0..n-1 for a row, by its number."""
    return F.pmod(F.xxhash64("rid", F.lit(seed)), F.lit(n)).cast("int")


def every(n: int) -> Column:
    return F.explode(F.sequence(F.lit(0), F.lit(n - 1)))


def tiles(queries: DataFrame, candidates: DataFrame, fn, schema: str) -> DataFrame:
    """``fn`` on the rows of each (qb, cb): those of a query block and of a candidate block."""
    return (queries.groupBy("qb", "cb").cogroup(candidates.groupBy("qb", "cb"))
            .applyInArrow(lambda q, c: fn(q, c), schema))


def best(scores: np.ndarray, ids: np.ndarray, at: np.ndarray, k: int) -> np.ndarray:
    """Of the positions ``at``, the k of the highest scores in order; ties to the smaller id."""
    if len(at) > k:
        cut = np.partition(scores[at], len(at) - k)[len(at) - k]
        at = at[scores[at] >= cut]
    return at[np.lexsort((ids[at], -scores[at]))][:k]
