"""Vectors as whole numbers, in Spark and as NumPy matrices."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F


def sound(vector: Column) -> Column:
    """Whether a vector is there and all its components are finite."""
    finite = F.forall(vector, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c.cast("double")) < F.lit(float("inf"))))
    return F.coalesce(vector.isNotNull() & finite, F.lit(False))


def whole_numbers(vector: Column, scale: int) -> Column:
    """floor(scale * x) of each component as LONG; those beyond LONG become its limits."""
    return F.transform(vector, lambda c: F.floor(c.cast("double") * F.lit(float(scale))))


def matrix(column: pa.Array, width: int) -> np.ndarray:
    """Rows of an Arrow list column, padded with zeros to ``width``."""
    lengths = column.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    flat = column.flatten().to_numpy(zero_copy_only=False)
    if (lengths == width).all():
        return flat.reshape(len(column), width)
    out = np.zeros((len(column), width), np.int64)
    row = np.repeat(np.arange(len(column)), lengths)
    out[row, np.arange(len(flat)) - np.repeat(np.cumsum(lengths) - lengths, lengths)] = flat
    return out


def largest(rows: np.ndarray) -> int:
    """The largest absolute value, 0 if there is none."""
    return max(int(rows.max()), -int(rows.min())) if rows.size else 0


def clamped(values: np.ndarray) -> np.ndarray:
    """Whole numbers as LONG; those beyond become its limits."""
    if values.dtype != object:
        return values.astype(np.int64)
    return np.array([max(-(2**63), min(2**63 - 1, int(x))) for x in values], np.int64)
