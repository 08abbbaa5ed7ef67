"""A file of new samples to a table of predictions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..models.scoring import score_new
from ..models.storage import load_features, load_model
from ..roles import DEFAULT, Roles
from ..sinks.tables import publish
from ..sources.new_samples import read_new_samples


def score_file(
    spark: SparkSession, path: str, model_path: str, table: str | None = None, fmt: str = "parquet", r: Roles = DEFAULT
) -> DataFrame:
    """Scores of the samples in a CSV under a stored model; published as ``table`` when one is named."""
    features = load_features(spark, model_path)
    scored = score_new(read_new_samples(spark, path, r), load_model(model_path), features, r)
    if table is None:
        return scored
    publish(scored, table, fmt=fmt)
    return spark.table(table)
