"""The rows behind each page and chart."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from ..functions import to_number
from ..roles import DEFAULT, Roles
from .evaluate import SUMMARY_ROWS

# Spellings of the held-out splits.
HELD_OUT = ("test", "validation", "validacion", "val")


def kpis(status: DataFrame, counts: DataFrame, matrix: DataFrame, metrics: DataFrame) -> DataFrame:
    """One row: sources found of sources registered, classes, matrix features and models evaluated."""
    found = status.agg(
        F.concat_ws("/", F.count_if("existe").cast("string"), F.count("*").cast("string")).alias("fuentes")
    )
    return found.select(
        "fuentes",
        counts.agg(F.count("*").alias("n")).scalar().alias("clases"),
        F.lit(max(len(matrix.columns) - 3, 0)).cast("bigint").alias("genes_matriz"),
        metrics.agg(F.count_distinct("modelo").alias("n")).scalar().alias("modelos"),
    )


def class_feed(counts: DataFrame, n: int | None = None, r: Roles = DEFAULT) -> DataFrame:
    """Samples per class, most first; the home page shows the first 20."""
    return _top(counts.select(r.cls, "n_muestras"), "n_muestras", [r.cls], n)


def model_feed(metrics: DataFrame, splits: Sequence[str] | None = HELD_OUT, metric: str = "f1_macro") -> DataFrame:
    """One score by model and split, of the held-out splits or (None) of all."""
    rows = metrics if splits is None else metrics.filter(F.lower("split").isin(*splits))
    return rows.select("modelo", "split", to_number(metric, rows.schema[metric].dataType).alias(metric)).orderBy("modelo", "split")


def accuracy_feed(metrics: DataFrame) -> DataFrame:
    """Balanced accuracy where the table has it, else accuracy, by model and split."""
    return model_feed(metrics, None, "balanced_accuracy" if "balanced_accuracy" in metrics.columns else "accuracy")


def value_feed(stats: DataFrame, n: int | None = 30, r: Roles = DEFAULT) -> DataFrame:
    """Mean value per class, highest first."""
    return _top(stats.select(r.cls, "media_log2_tpm"), "media_log2_tpm", [r.cls], n)


def feature_feed(top: DataFrame, cls: str | None = None, n: int = 25, r: Roles = DEFAULT) -> DataFrame:
    """Features with the highest mean, of one class or of all."""
    rows = top if cls is None else top.filter(F.col(r.cls) == cls)
    return _top(rows, "avg_log2_tpm", [r.cls, r.feature], n)


def class_list(top: DataFrame, r: Roles = DEFAULT) -> DataFrame:
    return top.select(r.cls).filter(F.col(r.cls).isNotNull()).distinct().orderBy(r.cls)


def class_f1_feed(report: DataFrame, n: int = 10) -> DataFrame:
    """Classes with the highest F1, without the summary rows."""
    return _top(report.filter(~F.col("clase").isin(*SUMMARY_ROWS)), "f1-score", ["clase"], n)


def missing_feed(quality: DataFrame, n: int = 25, r: Roles = DEFAULT) -> DataFrame:
    """Classes with the most missing values: null logs and null measures together."""
    missing = (F.col("n_log2_tpm_null") + F.col("n_tpm_null")).alias("n_faltantes")
    return _top(quality.select(r.cls, missing), "n_faltantes", [r.cls], n)


def variable_feed(variable: DataFrame, n: int = 20, r: Roles = DEFAULT) -> DataFrame:
    return _top(variable, "sd_entre_clases", [r.feature, r.feature_name], n)


def _top(df: DataFrame, by: str, ties: Sequence[str], n: int | None) -> DataFrame:
    ordered = df.orderBy(F.col(f"`{by}`").desc_nulls_last(), *ties)
    return ordered if n is None else ordered.limit(n)
