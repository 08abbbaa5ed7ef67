"""Mergeable statistics: stored once per part of the long table, added up for any set of parts.

``feature_moments`` keeps counts, mean and centred squares per class and feature: quality, variability, top features and the
deviations of a scaler follow from it without another scan of the long table. ``value_sketches`` keeps a KLL sketch of the
values per class and file: quartiles of any set of files follow from merged sketches. Both tables are small beside the long
one, and a part that is loaded anew replaces its rows only.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Window, functions as F

from ..functions import rounded, share_pct
from ..roles import DEFAULT, Roles

#: Size of a sketch. At 800 the rank of a quantile is off by less than 0.6 percent of the rows (99 of 100 times).
SKETCH_K = 800
#: Stated bound on the error in rank, as a share of the rows.
RANK_BOUND = 0.01
_COUNTS = ["n_rows", "n_null_values", "n_null_measures", "n_zero"]


# Moments per class and feature


def feature_moments(long: DataFrame, by: Sequence[str] = (), r: Roles = DEFAULT) -> DataFrame:
    """Per class, feature and feature name (and ``by``, the parts that are loaded on their own): counts of rows, nulls and
    zeros, number of values, their mean and sum of squared distances from it. One pass, combined inside tasks first."""
    value, measure = F.col(r.value), F.col(r.measure)
    return long.groupBy(*by, r.cls, r.feature, r.feature_name).agg(
        F.count("*").alias("n_rows"),
        F.count_if(value.isNull()).alias("n_null_values"),
        F.count_if(measure.isNull()).alias("n_null_measures"),
        F.count_if(measure == 0).alias("n_zero"),
        F.count(value).alias("n"),
        F.avg(value).alias("mean"),
        (F.var_pop(value) * F.count(value)).alias("squares"),
    )


def merge_moments(moments: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The moments of larger groups: counts add up; squares are those inside the parts and those of their means around the
    common mean. Parts without values add nothing."""
    n, mean = F.col("n"), F.col("mean")
    total = F.sum("n")
    common = F.sum(n * mean) / F.when(total > 0, total)
    return moments.groupBy(*keys).agg(
        *[F.sum(c).alias(c) for c in _COUNTS],
        total.alias("n"),
        common.alias("mean"),
        # The squares around the common mean; values are logs, far from where the difference would lose digits.
        (F.sum("squares") + F.sum(n * mean * mean) - F.sum(n * mean) * common).alias("squares"),
    )


def quality_of(moments: DataFrame, r: Roles = DEFAULT) -> DataFrame:
    """``profiles.quality`` from moments."""
    rows, zeros = F.sum("n_rows"), F.sum("n_zero")
    return (
        moments.groupBy(r.cls)
        .agg(
            rows.alias("n_registros"),
            F.sum("n_null_values").alias("n_log2_tpm_null"),
            F.sum("n_null_measures").alias("n_tpm_null"),
            zeros.alias("n_tpm_cero"),
            share_pct(zeros, rows).alias("pct_tpm_cero"),
        )
        .orderBy(F.desc("pct_tpm_cero"), r.cls)
    )


def variability_of(moments: DataFrame, r: Roles = DEFAULT) -> DataFrame:
    """``ranking.variability`` from moments of one row per class, feature and name."""
    mean = F.col("mean")
    return moments.groupBy(r.feature, r.feature_name).agg(
        F.avg(mean).alias("media_global"),
        F.stddev_samp(mean).alias("sd_entre_clases"),
        (F.max(mean) - F.min(mean)).alias("rango_entre_clases"),
    )


def top_features_of(moments: DataFrame, k: int = 10, r: Roles = DEFAULT) -> DataFrame:
    """``ranking.top_features`` from moments."""
    best = Window.partitionBy(r.cls).orderBy(F.desc("mean"), r.feature, r.feature_name)
    return (
        moments.withColumn("rank_gen", F.row_number().over(best).cast("bigint"))
        .filter(F.col("rank_gen") <= k)
        .select(r.cls, "rank_gen", r.feature, r.feature_name, rounded("mean", 4).alias("avg_log2_tpm"))
        .orderBy(r.cls, "rank_gen")
    )


def scaler_deviations(moments: DataFrame, n_samples: int, r: Roles = DEFAULT) -> DataFrame:
    """Per feature the sample SD that a scaler finds in the matrix of ``n_samples`` rows, in which a missing cell is 0."""
    merged = merge_moments(moments, [r.feature])
    n, mean = F.col("n").cast("double"), F.coalesce("mean", F.lit(0.0))
    # Zeros are one more part: so many cells with mean 0.
    between = n * (n_samples - n) / n_samples * mean * mean
    return merged.select(r.feature, F.sqrt((F.coalesce("squares", F.lit(0.0)) + between) / (n_samples - 1)).alias("sd"))


# Sketches per class and file


def value_sketches(long: DataFrame, k: int = SKETCH_K, r: Roles = DEFAULT) -> DataFrame:
    """Per class and file a KLL sketch of the values that are not null; a file without any has no row."""
    held = long.filter(F.col(r.value).isNotNull())
    return held.groupBy(r.cls, r.file).agg(F.kll_sketch_agg_double(r.value, k).alias("sketch"))


def quantiles_of(
    sketches: DataFrame, quantiles: Mapping[str, float], keys: Sequence[str], files: DataFrame | None = None, k: int = SKETCH_K,
    r: Roles = DEFAULT,
) -> DataFrame:
    """Quantiles of the values of a set of files (all of them, or those that ``files`` names) per ``keys``."""
    if files is not None:
        sketches = sketches.join(files.select(r.file).distinct(), r.file, "left_semi")
    merged = sketches.groupBy(*keys).agg(F.kll_merge_agg_double("sketch", k).alias("sketch"))
    return merged.select(
        *keys, F.kll_sketch_get_n_double("sketch").alias("n"),
        *[F.kll_sketch_get_quantile_double("sketch", F.lit(float(q))).alias(name) for name, q in quantiles.items()],
    )


def rank_errors(long: DataFrame, approximate: DataFrame, quantiles: Mapping[str, float], r: Roles = DEFAULT) -> DataFrame:
    """How far each approximate quantile of a class is off, in shares of the class's values: 0 where the quantile asked for
    lies between the share below the value and the share up to it."""
    value = F.col(r.value)
    held = long.filter(value.isNotNull()).join(F.broadcast(approximate.drop("n")), r.cls)
    counted = held.groupBy(r.cls).agg(
        F.count("*").alias("n"),
        *[F.count_if(value < F.col(q)).alias(f"below_{q}") for q in quantiles],
        *[F.count_if(value <= F.col(q)).alias(f"upto_{q}") for q in quantiles],
    )
    parts = []
    for name, q in quantiles.items():
        below, upto = F.col(f"below_{name}") / F.col("n"), F.col(f"upto_{name}") / F.col("n")
        off = F.greatest(below - q, q - upto, F.lit(0.0))
        parts.append(F.struct(F.lit(name).alias("quantile"), off.alias("rank_error")))
    return counted.select(r.cls, "n", F.explode(F.array(*parts)).alias("e")).select(r.cls, "n", "e.quantile", "e.rank_error")
