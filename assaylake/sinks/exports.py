"""CSV exports of report tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame


def export_csv(df: DataFrame, path: str, order: Sequence = (), limit: int | None = None) -> None:
    """Headered CSV below ``path``: one file for a report-sized table, several for a larger one. Quotes are doubled.

    Adaptive execution merges the rows of a small table into one partition, so nothing is counted beforehand.
    ``limit`` keeps the first rows in ``order``, which it therefore needs.
    """
    if limit is None:
        rows = df.hint("rebalance")
        rows = rows.sortWithinPartitions(*order) if order else rows
    elif order:
        rows = df.orderBy(*order).limit(limit)
    else:
        raise ValueError("a limit needs an order that says which rows are first")
    rows.write.mode("overwrite").option("header", True).option("escape", '"').csv(path)


def export_tables(frames: Mapping[str, DataFrame], folder: str) -> None:
    """Each named table as <folder>/<name>.csv."""
    for name, frame in frames.items():
        export_csv(frame, f"{folder}/{name}.csv")
