"""Helpers for embedding operators: which vectors take part, and their unit form."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F


def usable(vector: Column) -> Column:
    """Not null, not empty, all components finite, and not all zero."""
    return F.coalesce(
        vector.isNotNull() & (F.size(vector) > 0)
        & F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
        & F.exists(vector, lambda x: x != 0), F.lit(False))


def matrix(column: pa.Array) -> np.ndarray:
    """Rows of a list column as double precision; all of one length."""
    flat = np.asarray(column.flatten()).astype(np.float64)
    return flat.reshape(len(column), -1) if len(column) else flat.reshape(0, 0)


def unit(v: np.ndarray) -> np.ndarray:
    """Rows of length 1; scaled first, so that no square overflows or vanishes."""
    v = v / np.abs(v).max(axis=1, keepdims=True)
    return v / np.sqrt((v * v).sum(axis=1, keepdims=True))


def cosine_pairs(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Cosine of each row of a with the same row of b, in double precision."""
    a = a / np.abs(a).max(axis=1, keepdims=True)
    b = b / np.abs(b).max(axis=1, keepdims=True)
    return (a * b).sum(axis=1) / (np.sqrt((a * a).sum(axis=1)) * np.sqrt((b * b).sum(axis=1)))


def of_one_length(df: DataFrame, vector: str) -> DataFrame:
    """Adds ``dim``, the length of the vector; vectors are compared within one length only."""
    return df.withColumn("dim", F.size(vector))
