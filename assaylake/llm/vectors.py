"""Reading vectors out of Arrow columns, and which vectors count."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F


def usable(vector: str) -> Column:
    """Whether a vector is there, has a component, and no null or non-finite one."""
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    return F.coalesce(F.col(vector).isNotNull() & (F.size(vector) > 0) & F.forall(vector, finite), F.lit(False))


def one_per_id(vectors: DataFrame, key: str, vector: str) -> DataFrame:
    """``id`` and ``vector`` (doubles) of the usable vectors; of rows that repeat an id the least vector counts, and
    rows without an id do not."""
    slim = vectors.select(F.col(f"`{key}`").cast("long").alias("id"), F.col(f"`{vector}`").cast("array<double>").alias("vector"))
    return slim.where(F.col("id").isNotNull() & usable("vector")).groupBy("id").agg(F.min("vector").alias("vector"))


def matrix(arrays: pa.Array) -> np.ndarray:
    """Arrays of equal length as rows of a matrix."""
    flat = arrays.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(arrays), -1).astype(np.float64)
