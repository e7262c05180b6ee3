"""Vectors of whole numbers: from columns to matrices, and their exact inner products."""

from __future__ import annotations

from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Inner products of float64 matrices are exact below this.
EXACT = 1 << 53
# A component, times the scale, must be smaller than this.
LARGEST = float(1 << 62)


def sound(vector: Column) -> Column:
    """Whether a vector is there and all its components are finite numbers."""
    fine = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return vector.isNotNull() & F.coalesce(fine, F.lit(False))


def whole(vector: Column, scale: int) -> Column:
    """``floor(scale * x)`` of each component; one past 62 bits is an error."""

    def number(x: Column) -> Column:
        far = F.raise_error(F.concat(F.lit("component out of range: "), x.cast("string"))).cast("bigint")
        return F.when(F.abs(x * scale) < LARGEST, F.floor(x * scale).cast("bigint")).otherwise(far)

    return F.transform(vector, number)


def matrix(column: pa.ChunkedArray | pa.Array, width: int) -> np.ndarray:
    """Rows of an array column of equal lengths."""
    flat = (column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column).flatten()
    return flat.to_numpy(zero_copy_only=False).astype(np.int64).reshape(len(column), width)


def every_pair(left: DataFrame, right: DataFrame, *more: Column) -> DataFrame:
    """Each row of one table beside each of the other with the same ``dim``, where ``more`` holds.

    The pairs are made task by task from parts of both tables.  An equi join would copy the
    smaller table once for each row of the larger, through a shuffle or, as plans go by its
    size before that, through the driver.
    """
    own = F.col("dim") - F.col("_dim") == 0  # no equality of columns, which would be taken for a key
    met = left.join(right.withColumnRenamed("dim", "_dim").hint("shuffle_replicate_nl"), reduce(lambda a, b: a & b, more, own))
    return met.drop("_dim")


def span(*tables: np.ndarray) -> int:
    """The largest size an inner product of rows of two tables, or a sum on the way to it, can have."""
    most = [max(int(t.max(initial=0)), -int(t.min(initial=0))) for t in tables]
    return most[0] * most[-1] * tables[0].shape[1]


def products(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Exact inner products of all rows of two integer tables; beyond 64 bits an error."""
    most = span(left, right)
    if most < EXACT:
        return (left.astype(np.float64) @ right.astype(np.float64).T).astype(np.int64)
    if most < 1 << 63:
        return left @ right.T
    return (left.astype(object) @ right.astype(object).T).astype(np.int64)
