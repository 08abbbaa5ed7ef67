"""Matrix, split, three models, their scores and the choice between them."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, functions as F

from ..models import training
from ..models.storage import save_model
from ..operators import curves, evaluate, matrix, ranking
from ..operators.ordered import join_null_safe
from ..roles import DEFAULT, Roles
from ..session import reliable
from ..sinks.tables import publish


@dataclass(frozen=True)
class Comparison:
    features: list[str]
    split: DataFrame
    models: dict[str, PipelineModel]
    predictions: DataFrame
    labels: list[str]
    metrics: DataFrame
    #: Samples per class and split that no model could score, as training had none of the class.
    unknown: DataFrame

    @property
    def best_name(self) -> str:
        return evaluate.select_best(self.metrics).first()["modelo"]

    def best(self) -> PipelineModel:
        return training.pick(self.models, self.best_name)


def compare_models(
    long: DataFrame,
    n_features: int = 100,
    seed: int = 42,
    names: Sequence[str] = tuple(training.PIPELINES),
    unique: bool = True,
    variable: DataFrame | None = None,
    r: Roles = DEFAULT,
) -> Comparison:
    """Train the named models on the most variable features and score all of them on all splits.

    ``long`` is taken to have one row per sample and feature, as the trusted table has; say so if it has more.
    ``variable`` is a stored ``ranking.variability``, unrounded and uncut, which saves the pass that computes it; one
    with fewer features than asked for is an error.

    The split matrix and the predictions are cut off from their long lineage: both are read many times.
    """
    features = ranking.select_features(ranking.variability(long, r) if variable is None else variable, n_features, r)
    if variable is not None and len(features) < n_features:
        raise ValueError(f"the table of variable features has {len(features)}, {n_features} are asked for")
    split = reliable(matrix.stratified_split(matrix.to_matrix(long, features, unique=unique, r=r), seed, r=r))
    models = training.train_all(split, features, names, r=r)
    labels = training.label_names(next(iter(models.values())))
    predictions = reliable(training.predict_all(models, split, r))
    return Comparison(features, split, models, predictions, labels, evaluate.metrics_table(predictions, len(labels)),
                      training.unknown_classes(_unseen_samples(long, split, labels, r), next(iter(models.values())), r))


def _unseen_samples(long: DataFrame, split: DataFrame, labels: Sequence[str], r: Roles) -> DataFrame:
    """All samples of classes outside ``labels`` with their split.

    One without any of the chosen features has no row in the matrix, so the samples come from the long table. It lies where
    the other samples of its subject do; a subject without a row in the matrix has no split.
    """
    unseen = ~F.coalesce(F.col(r.cls).isin(list(labels)), F.lit(False))
    samples = long.filter(unseen).select(r.sample, r.subject, r.cls).distinct()
    placed = split.filter(unseen).select(r.subject, r.cls, "split").distinct()
    return join_null_safe(samples, placed, [r.subject, r.cls])


def best_model_reports(c: Comparison, r: Roles = DEFAULT) -> dict[str, DataFrame]:
    """Tables about the best model on the test split."""
    test = c.predictions.filter((c.predictions.modelo == c.best_name) & (c.predictions.split == "test"))
    table = evaluate.prediction_table(test, c.labels, r)
    top = evaluate.top_support(test)
    return {
        "refined_reporte_clasificacion_por_clase": evaluate.class_report(test, c.labels),
        "refined_matriz_confusion_mejor_modelo": evaluate.confusion(test, c.labels),
        "refined_predicciones_test_mejor_modelo": table,
        "refined_errores_frecuentes": evaluate.top_errors(table, r.cls, "cancer_predicho"),
        "refined_curvas_roc": curves.roc_points(test, c.labels, top),
        "refined_curvas_pr": curves.pr_points(test, c.labels, top),
    }


def publish_comparison(
    c: Comparison, model_path: str, namespace: str | None = None, fmt: str = "parquet", r: Roles = DEFAULT
) -> None:
    """Matrix, metrics and the best model's tables into the catalog, the best model and its features to storage."""
    frames = {
        "refined_ml_matriz": c.split.drop("split"),
        "refined_metricas_modelos_sparkml": c.metrics,
        "refined_filas_sin_clase_conocida": c.unknown,
        **best_model_reports(c, r),
    }
    for name, frame in frames.items():
        publish(frame, f"{namespace}.{name}" if namespace else name, fmt=fmt)
    save_model(c.split.sparkSession, c.best(), model_path, c.features)
