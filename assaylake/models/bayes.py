"""Multinomial naive Bayes by its sufficient statistics.

The model is two aggregates: rows per class, and the sum of each feature per class. Over a long table they need no matrix and
no pass of a trainer: one shuffle of class and feature, combined inside tasks first, whatever the number of samples.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from ..roles import DEFAULT, Roles
from .training import NB_PARAMS, label_names

_SCHEMA = "{cls} string, label int, {feature} string, log_prior double, log_share double"


def naive_bayes_statistics(
    train: DataFrame, features: Sequence[str], smoothing: float = NB_PARAMS["smoothing"], r: Roles = DEFAULT
) -> DataFrame:
    """Per class and feature the log of the smoothed prior and of the smoothed share of the feature.

    ``train`` is long, one row per sample and feature, of samples that have some listed feature; a missing cell is 0. Labels
    go by falling number of samples, then by class, as the label index has them.
    """
    listed = F.broadcast(train.sparkSession.createDataFrame([(f,) for f in features], f"{r.feature} string"))
    held = train.join(listed, r.feature, "left_semi")
    # Samples shrink to one row inside each task before they are counted.
    rows = held.select(r.sample, r.cls).distinct().groupBy(r.cls).agg(F.count("*").alias("n"))
    whole = Window.partitionBy()  # one row per class: a closed list
    prior = F.log((F.col("n") + smoothing) / (F.sum("n").over(whole) + F.count("*").over(whole) * smoothing))
    label = F.row_number().over(Window.orderBy(F.desc("n"), r.cls)) - 1
    classes = rows.select(r.cls, label.alias("label"), prior.alias("log_prior"))
    sums = held.groupBy(r.cls, r.feature).agg(F.sum(r.value).alias("total"))
    total = F.coalesce("total", F.lit(0.0))
    in_class = F.sum(total).over(Window.partitionBy(r.cls))
    # Classes by listed features: both are closed lists.
    grid = classes.withColumn(r.feature, F.explode(F.array(*[F.lit(f) for f in features])))
    return grid.join(sums, [r.cls, r.feature], "left").select(
        r.cls, "label", r.feature, "log_prior", F.log((total + smoothing) / (in_class + len(features) * smoothing)).alias("log_share")
    )


def model_statistics(model: PipelineModel, features: Sequence[str], spark: SparkSession, r: Roles = DEFAULT) -> DataFrame:
    """The same read off a fitted pipeline: as many rows as it has classes times features."""
    fitted, names = model.stages[-1], label_names(model)
    priors, shares = fitted.pi.toArray(), fitted.theta.toArray()
    rows = [
        (name, k, feature, float(priors[k]), float(shares[k][at])) for k, name in enumerate(names) for at, feature in enumerate(features)
    ]
    return spark.createDataFrame(rows, _SCHEMA.format(cls=r.cls, feature=r.feature))
