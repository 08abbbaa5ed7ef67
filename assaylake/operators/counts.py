"""Counts, class balance and consistency."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame, Window, functions as F

from ..functions import rounded
from ..roles import DEFAULT, Roles


def _per_sample(long: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Distinct sample-level rows with their row count: a long table shrinks by its features before any shuffle.

    The filter is true for every group. It keeps the optimizer from folding this step into the distinct counts
    above it, which would copy every long row once per counted column.
    """
    return long.groupBy(*columns).agg(F.count("*").alias("_rows")).filter(F.col("_rows") > 0)


def _n(column: str, name: str):
    return F.count_distinct(column).alias(name)


def summary(long: DataFrame, samples: DataFrame, dictionary: DataFrame, r: Roles = DEFAULT) -> DataFrame:
    """One row of eight counts over the long table, the samples table and the feature dictionary."""
    by_sample = _per_sample(long, [r.sample, r.subject, r.cls]).agg(
        F.coalesce(F.sum("_rows"), F.lit(0)).alias("n_registros_long"),
        _n(r.sample, "n_muestras_long"),
        _n(r.subject, "n_pacientes"),
        _n(r.cls, "n_clases"),
    )
    stored = samples.agg(F.count("*").alias("rows"), _n(r.sample, "samples"))
    return by_sample.select(
        "n_registros_long",
        "n_muestras_long",
        stored.select("rows").scalar().alias("n_filas_samples"),
        stored.select("samples").scalar().alias("n_muestras_samples"),
        "n_pacientes",
        "n_clases",
        n_distinct(long, r.feature).scalar().alias("n_genes_long"),
        n_distinct(dictionary, r.feature).scalar().alias("n_genes_diccionario"),
    )


def consistency(long: DataFrame, samples: DataFrame, r: Roles = DEFAULT) -> DataFrame:
    """The five counts that must agree between the long table and the samples table."""
    stored = samples.agg(F.count("*").alias("rows"), _n(r.sample, "samples"))
    by_sample = _per_sample(long, [r.sample, r.subject]).agg(
        _n(r.sample, "muestras_unicas_long"), _n(r.subject, "pacientes_unicos_long")
    )
    return by_sample.select(
        "muestras_unicas_long",
        stored.select("rows").scalar().alias("filas_samples"),
        stored.select("samples").scalar().alias("muestras_unicas_samples"),
        "pacientes_unicos_long",
        n_distinct(long, r.feature).scalar().alias("genes_unicos_long"),
    )


def cardinalities(df: DataFrame, columns: Mapping[str, str] | None = None, r: Roles = DEFAULT) -> DataFrame:
    """One row with the rows of ``df`` and the distinct values of each given column.

    Each column is counted from its own distinct values, so no row is copied once per column.
    """
    columns = columns or {r.sample: "n_muestras", r.subject: "n_pacientes", r.feature: "n_genes"}
    counts = [n_distinct(df, c).scalar().alias(name) for c, name in columns.items()]
    return df.agg(F.count("*").alias("n_registros")).select("n_registros", *counts)


def n_distinct(df: DataFrame, column: str) -> DataFrame:
    """Number of distinct non-null values of one column, as one row."""
    return df.select(column).filter(F.col(column).isNotNull()).distinct().agg(F.count("*").alias("n"))


def files_per_class(metadata: DataFrame, r: Roles = DEFAULT) -> DataFrame:
    return metadata.groupBy(r.cls).agg(F.count("*").alias("n_archivos")).orderBy(F.desc("n_archivos"), r.cls)


def samples_per_class(df: DataFrame, r: Roles = DEFAULT) -> DataFrame:
    """Distinct samples per class, of a long table or of the samples table."""
    pairs = df.select(r.cls, r.sample).distinct()
    return pairs.groupBy(r.cls).agg(F.count(r.sample).alias("n_muestras")).orderBy(F.desc("n_muestras"), r.cls)


def class_counts_samples(samples: DataFrame, r: Roles = DEFAULT) -> DataFrame:
    """Rows and distinct subjects per class of the samples table."""
    return (
        samples.groupBy(r.cls)
        .agg(F.count("*").alias("n_muestras"), _n(r.subject, "n_pacientes"))
        .orderBy(F.desc("n_muestras"), r.cls)
    )


def class_counts(long: DataFrame, r: Roles = DEFAULT) -> DataFrame:
    return _samples_and_subjects(long, [r.cls, r.cls_name], r).orderBy(F.desc("n_muestras"), r.cls, r.cls_name)


def type_counts(long: DataFrame, r: Roles = DEFAULT) -> DataFrame:
    return _samples_and_subjects(long, [r.sample_type], r).orderBy(F.desc("n_muestras"), r.sample_type)


def _samples_and_subjects(long: DataFrame, by: list[str], r: Roles) -> DataFrame:
    return (
        _per_sample(long, [*by, r.sample, r.subject])
        .groupBy(*by)
        .agg(_n(r.sample, "n_muestras"), _n(r.subject, "n_pacientes"))
    )


def class_imbalance(long: DataFrame, r: Roles = DEFAULT) -> DataFrame:
    """Share of each class and the ratio of the largest to the smallest; the window sees one row per class."""
    over_all = Window.partitionBy(F.lit(0))
    n = F.col("n_muestras")
    return (
        long.select(r.cls, r.sample)
        .distinct()
        .groupBy(r.cls)
        .agg(F.count(r.sample).alias("n_muestras"))
        .select(
            r.cls,
            "n_muestras",
            rounded(100 * n / F.sum(n).over(over_all), 2).alias("porcentaje"),
            rounded(F.max(n).over(over_all) / F.min(n).over(over_all), 2).alias("razon_desbalance_global"),
        )
        .orderBy(F.desc("n_muestras"), r.cls)
    )


def samples_per_subject(long: DataFrame, r: Roles = DEFAULT) -> DataFrame:
    """Per class: subjects, subjects with several samples, and the most samples of one subject."""
    per_subject = (
        long.select(r.subject, r.cls, r.sample).distinct().groupBy(r.subject, r.cls).agg(F.count(r.sample).alias("n"))
    )
    return (
        per_subject.groupBy(r.cls)
        .agg(
            F.count("*").alias("n_pacientes"),
            F.count_if(F.col("n") > 1).alias("pacientes_con_mas_de_una_muestra"),
            F.max("n").alias("max_muestras_por_paciente"),
        )
        .orderBy(F.desc("pacientes_con_mas_de_una_muestra"), r.cls)
    )


def split_counts(df: DataFrame, split: str = "split", r: Roles = DEFAULT) -> DataFrame:
    return df.groupBy(split, r.cls).agg(F.count("*").alias("n")).orderBy(split, F.desc("n"), r.cls)


def table_counts(frames: Mapping[str, DataFrame]) -> DataFrame:
    """Rows of each named frame, one row per name."""
    rows = [f.agg(F.count("*").alias("n_filas")).select(F.lit(k).alias("tabla"), "n_filas") for k, f in frames.items()]
    return reduce(DataFrame.unionByName, rows)
