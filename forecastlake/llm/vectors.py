"""Vectors that take part in searches and links."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import column


def usable(vec: Column) -> Column:
    """Not null, not all zero, and every component a finite number."""
    finite = F.forall(vec, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return F.coalesce(vec.isNotNull() & finite & F.exists(vec, lambda x: x != 0), F.lit(False))


def usable_vectors(df: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """(vec_id, vec): one row for each usable vector, as doubles; ids not null."""
    return df.select(column(id_col).cast("long").alias("vec_id"), column(vec_col).cast("array<double>").alias("vec")) \
        .filter(usable(F.col("vec")) & F.col("vec_id").isNotNull())


def matrix(vecs: pd.Series) -> np.ndarray:
    return np.stack([np.asarray(v, dtype=np.float64) for v in vecs]) if len(vecs) else np.empty((0, 0))


def unit(x: np.ndarray) -> np.ndarray:
    # Scaled by the largest component first: squares of very small or large ones stay finite.
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))
