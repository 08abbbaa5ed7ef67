from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import PipelineModel
from pyspark.sql import SparkSession


def save_model(spark: SparkSession, model: PipelineModel, path: str, features: Sequence[str] | None = None) -> None:
    """The fitted pipeline below ``path``/model, its feature list next to it."""
    model.write().overwrite().save(f"{path}/model")
    if features is not None:
        listed = spark.createDataFrame(list(enumerate(features)), "place int, feature string")
        listed.coalesce(1).write.mode("overwrite").parquet(f"{path}/features")


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(f"{path}/model")


def load_features(spark: SparkSession, path: str) -> list[str]:
    return [row[0] for row in spark.read.parquet(f"{path}/features").orderBy("place").select("feature").collect()]
