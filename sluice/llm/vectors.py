"""Helpers for embedding columns."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def usable(vector: Column) -> Column:
    """True for a vector that is not NULL and holds neither NULL nor non-finite components."""
    fine = F.forall(
        F.transform(vector, lambda x: x.cast("double")),
        lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")),
    )
    return F.coalesce(fine, F.lit(False))


def widest(df: DataFrame, vector_col: str) -> int:
    """Most components of a vector; shorter ones count as padded with zeros."""
    return df.agg(F.max(F.size(vector_col))).first()[0] or 0


def matrix(column: pa.ListArray, dims: int) -> np.ndarray:
    """Rows of a list column as doubles, padded with zeros."""
    out = np.zeros((len(column), dims))
    lengths = column.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    values = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    if len(column) and (lengths == dims).all():
        return values.reshape(len(column), dims)
    rows = np.repeat(np.arange(len(column)), lengths)
    out[rows, np.arange(len(values)) - np.repeat(np.cumsum(lengths) - lengths, lengths)] = values
    return out


def packed(vectors: np.ndarray) -> pa.Array:
    """Rows of a matrix of doubles as binary values."""
    return pa.array([v.tobytes() for v in vectors], pa.binary())


def unpacked(column: pa.Array, dims: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.float64).reshape(len(column), dims)


def largest(vectors: np.ndarray) -> int:
    """Largest absolute component of whole numbers held as doubles."""
    return int(np.abs(vectors).max(initial=0))


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact inner products (rows of ``a`` by rows of ``b``) of whole numbers held as doubles.

    Doubles are exact while every partial sum stays below 2**53; beyond it Python's integers are used.
    """
    if a.shape[1] * max(largest(a), 1) * max(largest(b), 1) < 1 << 53:
        return (a @ b.T).astype(np.int64)
    whole = np.vectorize(int, otypes=[object])
    if not (a.size and b.size):
        return np.zeros((len(a), len(b)), object)
    return whole(a) @ whole(b).T


def as_long(value: int) -> int:
    if not -(1 << 63) <= value < 1 << 63:
        raise OverflowError(f"score {value} does not fit a long")
    return int(value)
