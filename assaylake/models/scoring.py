from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, functions as F

from .. import domain
from ..functions import decode_label, element, vector_values
from ..operators.intake import clean_new_samples
from ..operators.matrix import to_matrix, to_vectors
from ..operators.prepare import restrict_features
from ..roles import DEFAULT, Roles
from .training import label_names


def score_new(df: DataFrame, model: PipelineModel, features: Sequence[str], r: Roles = DEFAULT) -> DataFrame:
    """New samples in long form to one prediction each: class name, its probability, and all probabilities.

    Raises when no row carries a feature of the model.
    """
    known = restrict_features(clean_new_samples(df, r), list(features), r)
    if known.isEmpty():
        raise ValueError("no feature of the input is known to the model")
    keys, unlabelled = [r.sample, r.subject], without_indexer(model)
    if any(type(stage).__name__ == "VectorAssembler" for stage in model.stages):
        matrix = to_matrix(known, features, keys, r=r)
    else:
        matrix = to_vectors(known, features, keys, r=r)
    placed = matrix.withColumn(r.cls, F.lit(domain.UNKNOWN))
    return decode(unlabelled.transform(placed), label_names(model), r)


def without_indexer(model: PipelineModel) -> PipelineModel:
    """The pipeline without its label indexer: a new sample has no label."""
    return PipelineModel(stages=model.stages[1:])


def decode(scored: DataFrame, labels: Sequence[str], r: Roles = DEFAULT) -> DataFrame:
    return scored.withColumn("probability_array", vector_values("probability")).select(
        r.sample,
        r.subject,
        decode_label("prediction", labels).alias("cancer_predicho"),
        element("probability_array", "prediction").alias("probabilidad_predicha"),
        "prediction",
        "probability_array",
    )
