"""Multiclass scores as aggregates over predictions.

``pred`` has the group columns ``by`` (model and split), ``label`` and ``prediction`` as class indexes, and for the
ranking scores ``probability``, an array with one score per class. Class k is ``labels[k]``.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions import decode_label, error_flag
from ..roles import DEFAULT, Roles
from . import curves

BY = ("modelo", "split")

# Names of the summary rows of the per-class report.
SUMMARY_ROWS = ("accuracy", "macro avg", "weighted avg")


def outcome_counts(pred: DataFrame, by: Sequence[str] = BY) -> DataFrame:
    """Rows per (truth, prediction): all threshold scores derive from this small frame."""
    return pred.groupBy(
        *by, F.col("label").cast("int").alias("label"), F.col("prediction").cast("int").alias("prediction")
    ).agg(F.count("*").alias("n"))


def class_tallies(pred: DataFrame, n_labels: int, by: Sequence[str] = BY) -> DataFrame:
    """tp, support and number of predictions for every listed class, also the ones that never occur."""
    counts = outcome_counts(pred, by)
    zero = F.lit(0).cast("bigint")
    hit = F.when(F.col("label") == F.col("prediction"), F.col("n")).otherwise(zero)
    as_truth = F.struct(F.col("label").alias("k"), hit.alias("tp"), F.col("n").alias("support"), zero.alias("predicted"))
    as_guess = F.struct(F.col("prediction").alias("k"), zero.alias("tp"), zero.alias("support"), F.col("n").alias("predicted"))
    seen = counts.select(*by, F.explode(F.array(as_truth, as_guess)).alias("c")).select(*by, "c.*")
    listed = (
        counts.select(*by)
        .distinct()
        .select(
            *by,
            F.explode(F.sequence(F.lit(0), F.lit(n_labels - 1))).alias("k"),
            zero.alias("tp"),
            zero.alias("support"),
            zero.alias("predicted"),
        )
    )
    return (
        seen.unionByName(listed)
        .groupBy(*by, "k")
        .agg(*[F.sum(c).alias(c) for c in ("tp", "support", "predicted")])
        .filter(F.col("k").between(0, n_labels - 1))
    )


def class_scores(pred: DataFrame, n_labels: int, by: Sequence[str] = BY) -> DataFrame:
    """Precision, recall, F1 and support per listed class; an empty denominator gives 0."""
    tp, support, predicted = F.col("tp"), F.col("support"), F.col("predicted")
    return class_tallies(pred, n_labels, by).select(
        *by,
        "k",
        _ratio(tp, predicted).alias("precision"),
        _ratio(tp, support).alias("recall"),
        _ratio(2 * tp, support + predicted).alias("f1"),
        "support",
    )


def accuracy_metrics(pred: DataFrame, by: Sequence[str] = BY) -> DataFrame:
    """Accuracy, and the mean recall over the classes that occur in the truth."""
    per_truth = (
        outcome_counts(pred, by)
        .groupBy(*by, "label")
        .agg(
            F.sum("n").alias("n"),
            F.sum(F.when(F.col("label") == F.col("prediction"), F.col("n")).otherwise(F.lit(0))).alias("hits"),
        )
    )
    return per_truth.groupBy(*by).agg(
        (F.sum("hits") / F.sum("n")).alias("accuracy"), F.avg(F.col("hits") / F.col("n")).alias("balanced_accuracy")
    )


def prf_metrics(pred: DataFrame, n_labels: int, by: Sequence[str] = BY) -> DataFrame:
    """Precision, recall and F1, averaged over all listed classes and weighted by support."""
    scores = ("precision", "recall", "f1")
    macro = [F.avg(s).alias(f"{s}_macro") for s in scores]
    weighted = [_ratio(F.sum(F.col(s) * F.col("support")), F.sum("support")).alias(f"{s}_weighted") for s in scores]
    return class_scores(pred, n_labels, by).groupBy(*by).agg(*macro, *weighted)


def confusion(pred: DataFrame, labels: Sequence[str], by: Sequence[str] = BY) -> DataFrame:
    """Long confusion matrix with every pair of listed classes, zero cells included."""
    counts = outcome_counts(pred, by)
    indexes = F.sequence(F.lit(0), F.lit(len(labels) - 1))
    cells = (
        counts.select(*by)
        .distinct()
        .select(*by, F.explode(indexes).alias("label"))
        .select(*by, "label", F.explode(indexes).alias("prediction"), F.lit(0).cast("bigint").alias("n"))
    )
    last = len(labels) - 1
    inside = F.col("label").between(0, last) & F.col("prediction").between(0, last)
    return (
        counts.filter(inside)
        .unionByName(cells)
        .groupBy(*by, "label", "prediction")
        .agg(F.sum("n").alias("n"))
        .select(
            *by,
            decode_label("label", labels).alias("true_class"),
            decode_label("prediction", labels).alias("predicted_class"),
            "n",
        )
    )


def confusion_wide(confused: DataFrame, labels: Sequence[str], by: Sequence[str] = BY) -> DataFrame:
    """One row per true class, one column per predicted class, from the long form."""
    labels = list(labels)
    return confused.groupBy(*by, "true_class").pivot("predicted_class", labels).agg(F.sum("n")).fillna(0, labels)


def class_report(pred: DataFrame, labels: Sequence[str], by: Sequence[str] = BY) -> DataFrame:
    """Per-class scores followed by the accuracy, macro and weighted rows; accuracy fills its whole row."""
    scores = class_scores(pred, len(labels), by)
    per_class = scores.select(
        *by,
        decode_label("k", labels).alias("clase"),
        "precision",
        "recall",
        F.col("f1").alias("f1-score"),
        F.col("support").cast("double").alias("support"),
    )
    accuracy = accuracy_metrics(pred, by).select(
        *by,
        F.lit(SUMMARY_ROWS[0]).alias("clase"),
        *[F.col("accuracy").alias(c) for c in ("precision", "recall", "f1-score", "support")],
    )
    means = prf_metrics(pred, len(labels), by).join(
        scores.groupBy(*by).agg(F.sum("support").cast("double").alias("support")), list(by)
    )
    averaged = [
        means.select(
            *by,
            F.lit(name).alias("clase"),
            F.col(f"precision_{kind}").alias("precision"),
            F.col(f"recall_{kind}").alias("recall"),
            F.col(f"f1_{kind}").alias("f1-score"),
            "support",
        )
        for name, kind in zip(SUMMARY_ROWS[1:], ("macro", "weighted"))
    ]
    return reduce(DataFrame.unionByName, [per_class, accuracy, *averaged])


def top_errors(pred: DataFrame, truth: str, predicted: str, by: Sequence[str] = ()) -> DataFrame:
    """(truth, prediction) pairs that are errors, most frequent first."""
    return (
        pred.groupBy(*by, truth, predicted)
        .agg(F.sum(error_flag(truth, predicted)).alias("n_errores"))
        .filter(F.col("n_errores") > 0)
        .orderBy(F.desc("n_errores"), truth, predicted)
    )


def metrics_table(pred: DataFrame, n_labels: int, by: Sequence[str] = BY, gaps: bool = True) -> DataFrame:
    """One row per model and split with the ten scores, and the two train-validation gaps."""
    keys = list(by)
    table = (
        accuracy_metrics(pred, by).join(prf_metrics(pred, n_labels, by), keys).join(curves.rank_metrics(pred, n_labels, by), keys)
    )
    table = table.select(
        *keys, "accuracy", "balanced_accuracy", "precision_macro", "recall_macro", "f1_macro", "precision_weighted",
        "recall_weighted", "f1_weighted", "roc_auc_macro_ovr", "pr_auc_macro_ovr",
    )
    return overfit_gap(table) if gaps else table


def stack_metrics(frames: Sequence[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def overfit_gap(metrics: DataFrame, model: str = "modelo", split: str = "split") -> DataFrame:
    """Metrics with train minus validation of macro F1 and accuracy, repeated on all rows of a model."""

    def at(name: str, score: str) -> Column:
        return F.max(F.when(F.col(split) == name, F.col(score)))

    gaps = metrics.groupBy(model).agg(
        (at("train", "f1_macro") - at("validation", "f1_macro")).alias("gap_f1_macro_train_validation"),
        (at("train", "accuracy") - at("validation", "accuracy")).alias("gap_accuracy_train_validation"),
    )
    return metrics.join(gaps, model, "left")


def select_best(metrics: DataFrame, model: str = "modelo", split: str = "split") -> DataFrame:
    """The validation row of the best model: macro F1, then balanced accuracy, then PR-AUC; a full tie by name."""
    ranking = [F.col(c).desc_nulls_last() for c in ("f1_macro", "balanced_accuracy", "pr_auc_macro_ovr")]
    return metrics.filter(F.col(split) == "validation").orderBy(*ranking, model).limit(1)


def metrics_report(metrics: DataFrame, splits: Sequence[str] = ("validation", "test")) -> DataFrame:
    """Validation and test rows with the reported scores, by split and falling macro F1."""
    return (
        metrics.filter(F.col("split").isin(*splits))
        .select(
            "modelo", "split", "accuracy", "balanced_accuracy", "precision_macro", "recall_macro", "f1_macro",
            "roc_auc_macro_ovr", "pr_auc_macro_ovr", "gap_f1_macro_train_validation",
        )
        .orderBy("split", F.desc("f1_macro"), "modelo")
    )


def prediction_table(pred: DataFrame, labels: Sequence[str], r: Roles = DEFAULT) -> DataFrame:
    """Ids, truth, predicted name and both indexes of each scored sample."""
    return pred.select(
        r.sample,
        r.subject,
        r.cls,
        decode_label("prediction", labels).alias("cancer_predicho"),
        F.col("label").cast("int").alias("label"),
        F.col("prediction").cast("int").alias("prediction"),
    )


def top_support(pred: DataFrame, n: int = 6, by: Sequence[str] = BY) -> DataFrame:
    """The n classes with the most true rows per group."""
    most = Window.partitionBy(*by).orderBy(F.desc("support"), "k")
    return (
        pred.groupBy(*by, F.col("label").cast("int").alias("k"))
        .agg(F.count("*").alias("support"))
        .withColumn("_nth", F.row_number().over(most))
        .filter(F.col("_nth") <= n)
        .drop("_nth")
    )


def _ratio(part: Column, whole: Column) -> Column:
    return F.when(whole == 0, F.lit(0.0)).otherwise(part / whole)
