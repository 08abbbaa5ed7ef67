"""Checks that return the offending rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from ..roles import DEFAULT, Roles


def duplicate_samples(samples: DataFrame, r: Roles = DEFAULT) -> DataFrame:
    """Samples with more than one row, with their distinct files and subjects and the least non-null class."""
    pairs = samples.groupBy(r.sample, r.file, r.subject).agg(F.count("*").alias("_rows"), F.min(r.cls).alias("_cls"))
    return (
        pairs.groupBy(r.sample)
        .agg(
            F.sum("_rows").alias("n_filas"),
            F.count_distinct(r.file).alias("n_file_ids"),
            F.count_distinct(r.subject).alias("n_patient_ids"),
            F.min("_cls").alias(r.cls),
        )
        .filter(F.col("n_filas") > 1)
    )


def duplicate_pairs(long: DataFrame, r: Roles = DEFAULT) -> DataFrame:
    """(sample, feature) pairs with more than one row."""
    return long.groupBy(r.sample, r.feature).agg(F.count("*").alias("n_filas")).filter(F.col("n_filas") > 1)


def domain_check(df: DataFrame, expected: Sequence[str], r: Roles = DEFAULT) -> DataFrame:
    """Classes that are expected but absent, or present but not expected."""
    found = df.select(r.cls).filter(F.col(r.cls).isNotNull()).distinct()
    listed = df.sparkSession.createDataFrame([(c,) for c in expected], f"{r.cls} string").distinct()
    return (
        found.withColumn("_found", F.lit(True))
        .join(listed.withColumn("_listed", F.lit(True)), r.cls, "full_outer")
        .filter(F.col("_found").isNull() | F.col("_listed").isNull())
        .select(r.cls, F.when(F.col("_found").isNull(), "missing").otherwise("unexpected").alias("estado"))
    )


def leakage_check(df: DataFrame, split: str = "split", r: Roles = DEFAULT) -> DataFrame:
    """One row: number of subjects that two splits share, for each pair of splits."""

    def seen(name: str):
        return F.max(F.col(split) == name).alias(name)

    per_subject = df.groupBy(r.subject).agg(seen("train"), seen("validation"), seen("test"))
    return per_subject.agg(
        F.count_if(F.col("train") & F.col("validation")).alias("train_validation"),
        F.count_if(F.col("train") & F.col("test")).alias("train_test"),
        F.count_if(F.col("validation") & F.col("test")).alias("validation_test"),
    )


def shared_values(left: DataFrame, right: DataFrame, column: str) -> DataFrame:
    """Distinct values that both frames have."""
    return left.select(column).intersect(right.select(column))
