"""Vectors of a table as matrices, and cosines in double precision."""

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F


def usable(vector: str) -> Column:
    """Is the vector there, all its components finite numbers, and one of them not zero?"""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(finite & F.exists(vector, lambda x: x != 0), F.lit(False))


def matrix(column) -> np.ndarray:
    """A list column of vectors of one length."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), -1)


def by_length(column):
    """(rows, matrix) of the vectors of each length."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    size = column.value_lengths().to_numpy(zero_copy_only=False)
    for d in np.unique(size):
        rows = np.flatnonzero(size == d)
        yield rows, matrix(column.take(pa.array(rows)))


def unit(x: np.ndarray) -> np.ndarray:
    """Rows scaled to length 1, by their largest component first, so that squares neither overflow nor vanish."""
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def cosine(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Cosines of rows with rows, one by one; the same for the same two vectors wherever they stand."""
    a = a / np.abs(a).max(axis=1, keepdims=True)
    b = b / np.abs(b).max(axis=1, keepdims=True)
    return (a * b).sum(axis=1) / (np.sqrt((a * a).sum(axis=1)) * np.sqrt((b * b).sum(axis=1)))
