"""Vector columns: which rows count, and their way into numpy."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F


def as_doubles(col: str) -> Column:
    return F.col(f"`{col}`").cast("array<double>")


def is_finite(vector: Column) -> Column:
    """A vector that is there and holds neither nulls nor NaN nor infinities."""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(float("inf"))))
    return vector.isNotNull() & ~bad


def matrix(vectors: pa.ListArray, width: int) -> np.ndarray:
    """Rows of doubles; a shorter vector is filled up with zeros."""
    ends = np.asarray(vectors.offsets, dtype=np.int64)
    flat = np.asarray(vectors.values, dtype=np.float64)
    lens = np.diff(ends)
    if (lens == width).all():
        return flat[ends[0] : ends[-1]].reshape(len(lens), width)
    out = np.zeros((len(lens), width))
    for i, (a, n) in enumerate(zip(ends[:-1].tolist(), lens.tolist())):
        out[i, :n] = flat[a : a + n]
    return out
