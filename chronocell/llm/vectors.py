"""Shared pieces of the vector operators: which rows take part, exact integer components, Arrow lists as matrices."""

from __future__ import annotations

from math import isqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

STEP = 2048  # rows worked on at once: bounds the arrays of a task whatever the Arrow batches hold


def largest(dim: int) -> int:
    """Components up to this keep the squared distance of any two vectors in 63 bits."""
    return isqrt(((1 << 63) - 1) // max(1, dim)) // 2


def finite(vector: Column) -> Column:
    """Whether the vector is there and all its components are numbers."""
    return vector.isNotNull() & ~F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))


def integers(vector: Column, scale: int, dim: int) -> Column:
    """floor(scale * x) of every component; a result beyond largest(dim) is an error, as its distances would not be exact."""

    def whole(x: Column) -> Column:
        n = F.floor(x.cast("double") * scale)
        return F.when(F.abs(n) <= largest(dim), n.cast("int")).otherwise(F.raise_error(F.concat(F.lit("a component is too large for exact distances: "), x.cast("string"))).cast("int"))

    return F.transform(vector, whole)


def matrix(col: pa.Array | pa.ChunkedArray, dim: int) -> np.ndarray:
    """A list column without nulls whose lists all have dim elements, as rows."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    return np.asarray(col.flatten()).reshape(len(col), dim)


def lists(m: np.ndarray) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(np.arange(len(m) + 1, dtype=np.int32) * m.shape[1]), pa.array(m.ravel()))


def sums(parts: DataFrame, keys: list[str], dim: int) -> list:
    """Rows (keys, n, total) added up over all tasks; as many as there are keys, so callers bound those."""
    added = parts.groupBy(*keys).agg(F.sum("n").alias("n"), F.array(*(F.sum(F.col("total")[i]) for i in range(dim))).alias("total"))
    return added.collect()


def by_group(x: np.ndarray, group: np.ndarray, groups: int) -> tuple[np.ndarray, np.ndarray]:
    """Number of rows and exact component sums of each group."""
    n = np.bincount(group, minlength=groups)
    total = np.zeros((groups, x.shape[1]), np.int64)
    order = np.argsort(group, kind="stable")
    on = np.flatnonzero(n)
    if len(on):
        total[on] = np.add.reduceat(x[order].astype(np.int64), (np.cumsum(n) - n)[on], axis=0)
    return n, total
