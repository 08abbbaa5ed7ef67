"""Features by level and by variability between classes."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from ..functions import rounded
from ..roles import DEFAULT, Roles


def class_means(long: DataFrame, r: Roles = DEFAULT) -> DataFrame:
    return long.groupBy(r.feature, r.feature_name, r.cls).agg(F.avg(r.value).alias("media_clase"))


def variability(long: DataFrame, r: Roles = DEFAULT) -> DataFrame:
    """Mean, SD and range of a feature's class means, neither rounded nor cut."""
    mean = F.col("media_clase")
    return (
        class_means(long, r)
        .groupBy(r.feature, r.feature_name)
        .agg(
            F.avg(mean).alias("media_global"),
            F.stddev_samp(mean).alias("sd_entre_clases"),
            (F.max(mean) - F.min(mean)).alias("rango_entre_clases"),
        )
    )


def by_variability(variable: DataFrame, n: int, r: Roles = DEFAULT) -> DataFrame:
    """The n features with the largest SD; equal ones by feature id and name."""
    return variable.orderBy(F.col("sd_entre_clases").desc_nulls_last(), r.feature, r.feature_name).limit(n)


def variable_features(long: DataFrame, n: int = 5000, r: Roles = DEFAULT) -> DataFrame:
    top = by_variability(variability(long, r), n, r)
    return top.select(
        r.feature,
        r.feature_name,
        *[rounded(c, 4).alias(c) for c in ("media_global", "sd_entre_clases", "rango_entre_clases")],
    )


def select_features(variable: DataFrame, n: int = 100, r: Roles = DEFAULT) -> list[str]:
    """Ids of the n most variable features: the column list of the matrix, so it must be known to the driver.

    A feature that has several names counts once, with its largest SD.
    """
    once = variable.groupBy(r.feature).agg(F.max("sd_entre_clases").alias("sd_entre_clases"))
    best = once.orderBy(F.col("sd_entre_clases").desc_nulls_last(), r.feature).limit(n)
    return [row[0] for row in best.collect()]


def top_features(long: DataFrame, k: int = 10, r: Roles = DEFAULT) -> DataFrame:
    """The k features with the highest mean in each class.

    The rank filter cuts every task's rows to k per class before the shuffle.
    """
    means = long.groupBy(r.cls, r.feature, r.feature_name).agg(F.avg(r.value).alias("_mean"))
    best = Window.partitionBy(r.cls).orderBy(F.desc("_mean"), r.feature, r.feature_name)
    return (
        means.withColumn("rank_gen", F.row_number().over(best))
        .filter(F.col("rank_gen") <= k)
        .select(
            r.cls,
            F.col("rank_gen").cast("bigint").alias("rank_gen"),
            r.feature,
            r.feature_name,
            rounded("_mean", 4).alias("avg_log2_tpm"),
        )
        .orderBy(r.cls, "rank_gen")
    )
