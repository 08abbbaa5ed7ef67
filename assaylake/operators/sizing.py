"""Broadcast only what has been counted."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

# A broadcast side is held whole by every executor, so it stays in the low hundreds of megabytes.
BROADCAST_ROWS = 500_000


def is_small(df: DataFrame, max_rows: int = BROADCAST_ROWS) -> bool:
    """Whether ``df`` has at most ``max_rows`` rows; the count stops one row later."""
    return df.select(F.lit(1)).limit(max_rows + 1).count() <= max_rows


def broadcast_if_small(df: DataFrame, max_rows: int = BROADCAST_ROWS) -> DataFrame:
    """``df`` marked for broadcast when it is small, else as it is.

    Beyond the bound the join shuffles on its key and adaptive execution splits the hot ones.
    """
    return F.broadcast(df) if is_small(df, max_rows) else df
