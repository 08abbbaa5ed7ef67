from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression, NaiveBayes, RandomForestClassifier
from pyspark.ml.feature import StandardScaler, StringIndexer, VectorAssembler
from pyspark.sql import DataFrame, functions as F

from ..functions import vector_values
from ..operators.matrix import take_split
from ..roles import DEFAULT, Roles

# Training parameters of the three classifiers.
LR_PARAMS = {"maxIter": 100, "regParam": 0.1, "elasticNetParam": 0.0, "family": "multinomial"}
RF_PARAMS = {"numTrees": 100, "maxDepth": 8, "maxBins": 32, "seed": 42}
NB_PARAMS = {"smoothing": 1.0, "modelType": "multinomial"}


def index_labels(cls: str) -> StringIndexer:
    """Class names to indexes by falling frequency.

    A class outside the training data is an error here: the extra index for unknown classes would give the
    models one probability more than there are classes. ``known_classes`` drops such rows before scoring.
    """
    return StringIndexer(inputCol=cls, outputCol="label", handleInvalid="error")


def assemble(features: Sequence[str]) -> VectorAssembler:
    return VectorAssembler(inputCols=list(features), outputCol="features_raw", handleInvalid="keep")


def scale() -> StandardScaler:
    return StandardScaler(inputCol="features_raw", outputCol="features_scaled", withMean=False, withStd=True)


def logistic_regression(features: Sequence[str] | None, r: Roles = DEFAULT) -> Pipeline:
    return _pipeline(features, r, LogisticRegression(featuresCol="features_scaled", **LR_PARAMS), scaled=True)


def random_forest(features: Sequence[str] | None, r: Roles = DEFAULT) -> Pipeline:
    return _pipeline(features, r, RandomForestClassifier(featuresCol="features_raw", **RF_PARAMS))


def naive_bayes(features: Sequence[str] | None, r: Roles = DEFAULT) -> Pipeline:
    return _pipeline(features, r, NaiveBayes(featuresCol="features_raw", **NB_PARAMS))


def _pipeline(features, r: Roles, classifier, scaled: bool = False) -> Pipeline:
    # Without a feature list the frame already has a features_raw vector.
    build = [] if features is None else [assemble(features)]
    return Pipeline(stages=[index_labels(r.cls), *build, *([scale()] if scaled else []), classifier])


# Model name -> how its pipeline is built.
PIPELINES = {
    "LogisticRegression": logistic_regression,
    "RandomForest": random_forest,
    "NaiveBayes": naive_bayes,
}


def train_all(
    split: DataFrame,
    features: Sequence[str] | None,
    names: Sequence[str] = tuple(PIPELINES),
    parts: int | None = None,
    r: Roles = DEFAULT,
) -> dict[str, PipelineModel]:
    """The named models, fitted on the train rows, which are kept in memory and on disk meanwhile.

    Training passes over the rows many times and is bound by computing, so they are spread over ``parts`` tasks: by
    default one per core, or as many as the split has where that is more.
    """
    parts = parts or max(split.sparkSession.sparkContext.defaultParallelism, split.rdd.getNumPartitions())
    train = take_split(split, "train").repartition(parts, r.sample).persist()
    try:
        return {name: PIPELINES[name](features, r).fit(train) for name in names}
    finally:
        train.unpersist()


def label_names(model: PipelineModel) -> list[str]:
    """Class names in index order, from the first stage."""
    return list(model.stages[0].labels)


def known_classes(df: DataFrame, model: PipelineModel, r: Roles = DEFAULT) -> DataFrame:
    return df.filter(F.col(r.cls).isin(label_names(model)))


def unknown_classes(df: DataFrame, model: PipelineModel, r: Roles = DEFAULT) -> DataFrame:
    """Rows per class and split that the model has not seen a class of; they cannot be scored. A null class is one."""
    unseen = ~F.coalesce(F.col(r.cls).isin(label_names(model)), F.lit(False))
    return df.filter(unseen).groupBy(r.cls, "split").agg(F.count("*").alias("n"))


def predict(model: PipelineModel, name: str, split: DataFrame, r: Roles = DEFAULT) -> DataFrame:
    """Predictions of one model on all splits at once."""
    scored = model.transform(known_classes(split, model, r))
    return scored.select(
        F.lit(name).alias("modelo"),
        "split",
        r.sample,
        r.subject,
        r.cls,
        F.col("label").cast("int").alias("label"),
        F.col("prediction").cast("int").alias("prediction"),
        vector_values("probability").alias("probability"),
    )


def predict_all(models: Mapping[str, PipelineModel], split: DataFrame, r: Roles = DEFAULT) -> DataFrame:
    return reduce(DataFrame.unionByName, [predict(m, name, split, r) for name, m in models.items()])


def pick(models: Mapping[str, PipelineModel], name: str) -> PipelineModel:
    if name not in models:
        raise KeyError(f"no model named {name!r}; known models: {sorted(models)}")
    return models[name]
