"""Vectors of Arrow columns, and their validity."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def usable(column: str) -> Column:
    """Whether a vector takes part: not null, every component finite, not all zero."""
    finite = F.forall(column, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != F.lit(float("inf"))))
    return F.coalesce(finite & F.exists(column, lambda x: x != 0), F.lit(False))


def typed(df: DataFrame, column: str) -> Column:
    return F.col(column).cast("array<double>")


def matrix(column: pa.Array) -> np.ndarray:
    """Rows of equal length as one matrix of doubles."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1).astype(np.float64) if len(column) else np.zeros((0, 0))


def unit(x: np.ndarray) -> np.ndarray:
    """Rows at length one; scaled first, so that neither huge nor tiny components overflow."""
    x = x / np.abs(x).max(1, keepdims=True)
    return x / np.sqrt((x * x).sum(1, keepdims=True))


def lists(x: np.ndarray, kind: pa.DataType) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(np.arange(0, x.size + 1, x.shape[1], dtype=np.int32)), pa.array(x.reshape(-1), kind))


def k_means(x: np.ndarray, k: int, rounds: int, rng: np.random.Generator) -> np.ndarray:
    """Centres of at most ``k`` groups."""
    centres = x[rng.choice(len(x), min(k, len(x)), replace=False)]
    for _ in range(rounds):
        nearest = ((centres * centres).sum(1) - 2 * (x @ centres.T)).argmin(1)
        count = np.bincount(nearest, minlength=len(centres))
        total = np.zeros_like(centres)
        np.add.at(total, nearest, x)
        full = count > 0
        centres[full] = total[full] / count[full, None]
    return centres
