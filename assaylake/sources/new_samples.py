"""Files with samples to be scored."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..roles import DEFAULT, Roles


def required_columns(r: Roles = DEFAULT) -> list[str]:
    return [r.sample, r.subject, r.feature, r.value]


def read_new_samples(spark: SparkSession, path: str, r: Roles = DEFAULT) -> DataFrame:
    """The CSV as text; raises when a required column is missing."""
    frame = spark.read.option("header", True).option("escape", '"').csv(path)
    missing = [c for c in required_columns(r) if c not in frame.columns]
    if missing:
        raise ValueError(f"missing required columns: {', '.join(sorted(missing))}")
    return frame
