"""One-vs-rest ranking scores and curves.

Each class ranks all rows by its score. Rows with one score are grouped first, so ties count one half in the ROC
area. The running totals per class are taken in ordered buckets, see ``ordered``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from ..functions import decode_label
from .ordered import BUCKETS, join_null_safe, running_totals

_BY = ("modelo", "split")


def ranked_scores(
    pred: DataFrame,
    n_labels: int,
    by: Sequence[str] = _BY,
    only: DataFrame | None = None,
    buckets: int = BUCKETS,
) -> DataFrame:
    """Per group, class k and distinct score: positives p, negatives q, and their running and group totals.

    ``only`` limits the classes to the (by, k) rows of a small frame.
    """
    per_class = pred.select(*by, "label", F.posexplode("probability").alias("k", "score")).filter(F.col("k") < n_labels)
    if only is not None:
        per_class = per_class.join(F.broadcast(only.select(*by, "k")), [*by, "k"], "left_semi")
    positive = F.col("label").cast("int") == F.col("k")
    tied = per_class.groupBy(*by, "k", "score").agg(
        F.count_if(positive).alias("p"), F.count_if(~positive).alias("q")
    )
    return running_totals(tied, [*by, "k"], ["score"], ["p", "q"], descending=True, buckets=buckets, few_groups=True)


def rank_metrics_by_class(
    pred: DataFrame, n_labels: int, by: Sequence[str] = _BY, only: DataFrame | None = None, buckets: int = BUCKETS
) -> DataFrame:
    """ROC area, average precision and trapezoid PR area per class, null without positives or negatives."""
    p, q = F.col("p").cast("double"), F.col("q").cast("double")
    tp, fp = F.col("cum_p").cast("double"), F.col("cum_q").cast("double")
    positives, negatives = F.max("all_p").cast("double"), F.max("all_q").cast("double")
    precision = tp / (tp + fp)
    before = tp - p + fp - q
    precision_before = F.when(before == 0, F.lit(1.0)).otherwise((tp - p) / before)
    defined = (positives > 0) & (negatives > 0)
    return (
        ranked_scores(pred, n_labels, by, only, buckets)
        .groupBy(*by, "k")
        .agg(
            F.when(defined, F.sum(q * (2 * tp - p)) / (2 * positives * negatives)).alias("roc_auc"),
            F.when(defined, F.sum(p * precision) / positives).alias("average_precision"),
            F.when(defined, F.sum(p * (precision + precision_before) / 2) / positives).alias("pr_area"),
        )
    )


def rank_metrics(pred: DataFrame, n_labels: int, by: Sequence[str] = _BY, buckets: int = BUCKETS) -> DataFrame:
    """Both ranking scores averaged over the listed classes, null if one class leaves them undefined."""

    def macro(score: str):
        return F.when(F.count(score) == n_labels, F.avg(score))

    return (
        rank_metrics_by_class(pred, n_labels, by, buckets=buckets)
        .groupBy(*by)
        .agg(macro("roc_auc").alias("roc_auc_macro_ovr"), macro("average_precision").alias("pr_auc_macro_ovr"))
    )


def roc_auc_ovr(pred: DataFrame, n_labels: int, by: Sequence[str] = _BY, buckets: int = BUCKETS) -> DataFrame:
    return rank_metrics(pred, n_labels, by, buckets).select(*by, "roc_auc_macro_ovr")


def average_precision_ovr(pred: DataFrame, n_labels: int, by: Sequence[str] = _BY, buckets: int = BUCKETS) -> DataFrame:
    return rank_metrics(pred, n_labels, by, buckets).select(*by, "pr_auc_macro_ovr")


def roc_points(
    pred: DataFrame, labels: Sequence[str], only: DataFrame, by: Sequence[str] = _BY, buckets: int = BUCKETS, corners: bool = False
) -> DataFrame:
    """(fpr, tpr) after each distinct score, from (0, 0) on.

    With ``corners`` only the points where the curve turns, and its ends: the same curve, but its rows grow with its turns
    and not with the scores.
    """
    point = F.struct(
        (F.col("cum_q") / F.col("all_q")).alias("fpr"), (F.col("cum_p") / F.col("all_p")).alias("tpr")
    )
    start = F.struct(F.lit(0.0).alias("fpr"), F.lit(0.0).alias("tpr"))
    return _points(pred, labels, only, by, buckets, start, point, corners)


def pr_points(
    pred: DataFrame, labels: Sequence[str], only: DataFrame, by: Sequence[str] = _BY, buckets: int = BUCKETS
) -> DataFrame:
    """(recall, precision) after each distinct score, from (0, 1) on."""
    point = F.struct(
        (F.col("cum_p") / F.col("all_p")).alias("recall"),
        (F.col("cum_p") / (F.col("cum_p") + F.col("cum_q"))).alias("precision"),
    )
    start = F.struct(F.lit(0.0).alias("recall"), F.lit(1.0).alias("precision"))
    return _points(pred, labels, only, by, buckets, start, point)


def curve_areas(
    pred: DataFrame, labels: Sequence[str], only: DataFrame, by: Sequence[str] = _BY, buckets: int = BUCKETS
) -> DataFrame:
    """Trapezoid areas below both curves per class."""
    return rank_metrics_by_class(pred, len(labels), by, only, buckets).select(
        *by, decode_label("k", labels).alias("clase"), "roc_auc", F.col("pr_area").alias("pr_auc")
    )


def _corners(ranked: DataFrame, by: Sequence[str]) -> DataFrame:
    """Ranked scores after which the curve turns or ends.

    A score's step ends where the next one's begins, and no two begin at one place: a join finds the next step, also across
    the ends of buckets, and gives at most one row for each.
    """
    keys = [*by, "k", "cum_p", "cum_q"]
    steps = ranked.select(
        *by, "k", (F.col("cum_p") - F.col("p")).alias("cum_p"), (F.col("cum_q") - F.col("q")).alias("cum_q"),
        F.col("p").alias("_next_p"), F.col("q").alias("_next_q"),
    )
    # Products of whole numbers below 10 ** 18 each.
    whole = lambda c: F.col(c).cast("decimal(18,0)")
    straight = whole("p") * whole("_next_q") == whole("q") * whole("_next_p")
    joined = join_null_safe(ranked, steps, keys)
    return joined.filter(~F.coalesce(straight, F.lit(False))).drop("_next_p", "_next_q")


def _points(pred, labels, only, by, buckets, start, point, corners=False) -> DataFrame:
    # The first distinct score of a class also brings the curve's starting point. A rate without rows to divide
    # by is undefined, so a class without positives or negatives has no curve.
    ranked = ranked_scores(pred, len(labels), by, only, buckets).filter((F.col("all_p") > 0) & (F.col("all_q") > 0))
    ranked = ranked.withColumn("_first", (F.col("cum_p") == F.col("p")) & (F.col("cum_q") == F.col("q")))
    if corners:
        ranked = _corners(ranked, by)
        # The first corner need not be the first score, so the start comes from the ends, of which a curve has one.
        last = (F.col("cum_p") == F.col("all_p")) & (F.col("cum_q") == F.col("all_q"))
        ranked = ranked.withColumn("_first", last)
    return ranked.select(
        *by,
        decode_label("k", labels).alias("clase"),
        F.explode(F.when(F.col("_first"), F.array(start, point)).otherwise(F.array(point))).alias("at"),
    ).select(*by, "clase", "at.*")
