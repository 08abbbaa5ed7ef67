"""Quality and distribution of the measured values per class."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..functions import rounded, share_pct
from ..roles import DEFAULT, Roles
from .ordered import BUCKETS, exact_quantiles, join_null_safe

# Quartiles of the value distribution.
QUARTILES = {"q1_log2_tpm": 0.25, "mediana_log2_tpm": 0.5, "q3_log2_tpm": 0.75}


def quality(long: DataFrame, r: Roles = DEFAULT) -> DataFrame:
    """Rows, null logs, null measures, zero measures and the share of zeros, per class."""
    rows, zeros = F.count("*"), F.count_if(F.col(r.measure) == 0)
    return (
        long.groupBy(r.cls)
        .agg(
            rows.alias("n_registros"),
            F.count_if(F.col(r.value).isNull()).alias("n_log2_tpm_null"),
            F.count_if(F.col(r.measure).isNull()).alias("n_tpm_null"),
            zeros.alias("n_tpm_cero"),
            share_pct(zeros, rows).alias("pct_tpm_cero"),
        )
        .orderBy(F.desc("pct_tpm_cero"), r.cls)
    )


def detected_features(long: DataFrame, r: Roles = DEFAULT) -> DataFrame:
    """Features with a positive measure per sample, summarised per class."""
    per_sample = long.groupBy(r.sample, r.cls).agg(
        F.count_if(F.col(r.measure) > 0).alias("found"), F.count("*").alias("rows")
    )
    return (
        per_sample.groupBy(r.cls)
        .agg(
            F.count("*").alias("n_muestras"),
            rounded(F.avg("found"), 2).alias("media_genes_detectados"),
            rounded(F.stddev_samp("found"), 2).alias("sd_genes_detectados"),
            F.min("found").alias("min_genes_detectados"),
            F.max("found").alias("max_genes_detectados"),
            rounded(100 * F.avg(F.col("found") / F.col("rows")), 2).alias("pct_promedio_genes_detectados"),
        )
        .orderBy(F.desc("media_genes_detectados"), r.cls)
    )


def value_stats(
    long: DataFrame, exact: bool = False, accuracy: int = 10_000, buckets: int = BUCKETS, r: Roles = DEFAULT
) -> DataFrame:
    """Rows, mean, SD, extremes and quartiles of the value per class, at four decimals.

    Approximate quartiles come from mergeable sketches in the same pass. ``exact`` counts distinct values and
    ranks them in buckets instead.
    """
    value = F.col(r.value)
    ends = [
        F.count("*").alias("n_registros"),
        rounded(F.avg(value), 4).alias("media_log2_tpm"),
        rounded(F.stddev_samp(value), 4).alias("sd_log2_tpm"),
        rounded(F.min(value), 4).alias("min_log2_tpm"),
        rounded(F.max(value), 4).alias("max_log2_tpm"),
    ]
    if exact:
        ranked = exact_quantiles(long, [r.cls], r.value, QUARTILES, buckets, few_groups=True)
        quartiles = ranked.select(r.cls, *[rounded(q, 4).alias(q) for q in QUARTILES])
        stats = join_null_safe(long.groupBy(r.cls).agg(*ends), quartiles, [r.cls])
    else:
        points = F.percentile_approx(value, list(QUARTILES.values()), accuracy).alias("_points")
        stats = long.groupBy(r.cls).agg(*ends, points)
        for at, q in enumerate(QUARTILES):
            stats = stats.withColumn(q, rounded(F.get("_points", F.lit(at)), 4))
    return stats.select(
        r.cls, "n_registros", "media_log2_tpm", "sd_log2_tpm", "min_log2_tpm", *QUARTILES, "max_log2_tpm"
    ).orderBy(r.cls)
