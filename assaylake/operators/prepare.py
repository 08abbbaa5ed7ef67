"""Raw measurements and metadata to one trusted long table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F

from .. import domain
from ..functions import base_id, contains_ci, log2p1, null_to_zero, subject_id
from ..roles import DEFAULT, Roles
from ..session import reliable
from .sizing import broadcast_if_small, is_small


def drop_technical(df: DataFrame, col: str, prefix: str = domain.TECHNICAL_PREFIX) -> DataFrame:
    """Rows whose id does not start with ``prefix``; a null id goes too."""
    return df.filter(~F.col(col).startswith(prefix))


def filter_eq(df: DataFrame, col: str, value) -> DataFrame:
    return df.filter(F.col(col) == F.lit(value))


def filter_domain(df: DataFrame, col: str, values: Sequence[str]) -> DataFrame:
    return df.filter(F.col(col).isin(*values))


def filter_contains(df: DataFrame, col: str, needle: str) -> DataFrame:
    return df.filter(contains_ci(col, needle))


def select_present(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The wanted columns the frame has, in the wanted order."""
    return df.select([c for c in columns if c in df.columns])


def clean_measurements(
    measurements: DataFrame,
    raw_feature: str = "gene_id",
    feature_type: str = domain.FEATURE_TYPE,
    prefix: str = domain.TECHNICAL_PREFIX,
    r: Roles = DEFAULT,
) -> DataFrame:
    """Wanted features only, with base id, null measure as zero, and the log value."""
    kept = filter_eq(drop_technical(measurements, raw_feature, prefix), r.feature_type, feature_type)
    return (
        kept.withColumn(r.feature, base_id(raw_feature))
        .withColumn(r.measure, null_to_zero(r.measure))
        .withColumn(r.value, log2p1(r.measure))
    )


def official_samples(
    metadata: DataFrame,
    classes: Sequence[str],
    needle: str = domain.SAMPLE_TYPE_NEEDLE,
    subject_prefix: int = domain.SUBJECT_PREFIX,
    r: Roles = DEFAULT,
) -> DataFrame:
    """Metadata rows of the listed classes and sample type, with the subject id."""
    kept = filter_contains(filter_domain(metadata, r.cls, classes), r.sample_type, needle)
    named = kept.withColumn(r.subject, subject_id(r.case_submitter, r.sample_submitter, r.sample, subject_prefix))
    return select_present(named, r.sample_columns)


def attach_metadata(measurements: DataFrame, metadata: DataFrame, r: Roles = DEFAULT) -> DataFrame:
    """Measurements with the columns of their file; files without metadata go."""
    return measurements.join(metadata, r.file, "inner")


def candidate_samples(long: DataFrame, r: Roles = DEFAULT) -> DataFrame:
    """Distinct sample rows of a long table or of the metadata."""
    return select_present(long, r.sample_columns).distinct()


def dedupe_samples(candidates: DataFrame, r: Roles = DEFAULT) -> DataFrame:
    """One row per sample: the largest file, an unknown size last, then the smallest file id.

    The filter on the row number lets Spark keep one row per sample and task before the shuffle, so a sample
    with very many files does not meet in one task.
    """
    rest = [F.col(c).asc_nulls_last() for c in candidates.columns if c not in (r.sample, r.file_size, r.file)]
    best_first = Window.partitionBy(r.sample).orderBy(
        F.col(r.file_size).desc_nulls_last(), F.col(r.file).asc_nulls_last(), *rest
    )
    return candidates.withColumn("_nth", F.row_number().over(best_first)).filter(F.col("_nth") == 1).drop("_nth")


def keep_selected(long: DataFrame, chosen: DataFrame, r: Roles = DEFAULT) -> DataFrame:
    """Long rows of the chosen file of each sample."""
    keys = [r.sample, r.file]
    return long.join(broadcast_if_small(chosen.select(*keys)), keys, "left_semi")


def with_rows(metadata: DataFrame, measurements: DataFrame, r: Roles = DEFAULT) -> DataFrame:
    """Metadata of the files that have at least one measurement row."""
    return metadata.join(measurements.select(r.file).distinct(), r.file, "left_semi")


def enforce_grain(long: DataFrame, keys: Sequence[str] | None = None, r: Roles = DEFAULT) -> DataFrame:
    """One row per sample and feature: both measures averaged, the least non-null descriptive value kept."""
    keys = list(keys) if keys is not None else [*[c for c in r.sample_columns if c in long.columns], r.feature]
    described = [c for c in (r.feature_name, r.feature_type, r.source) if c in long.columns and c not in keys]
    measured = [c for c in (r.measure, r.value) if c in long.columns]
    return long.groupBy(*keys).agg(
        *[F.avg(c).alias(c) for c in measured], *[F.min(c).alias(c) for c in described]
    )


def trusted_long(
    measurements: DataFrame,
    chosen: DataFrame,
    raw_feature: str = "gene_id",
    feature_type: str = domain.FEATURE_TYPE,
    r: Roles = DEFAULT,
) -> DataFrame:
    """The trusted long table: one row per sample and feature, from the chosen file of each sample.

    ``chosen`` is the samples table of ``chosen_files``, best read back from where it was stored, because it is
    counted and joined twice. Rows of other files leave first, then file and feature are brought to one row
    each, and the other sample columns are joined on only after that shuffle.
    """
    clean = clean_measurements(measurements, raw_feature, feature_type, r=r)
    slim = select_present(clean, [r.file, *r.feature_columns, r.measure, r.value, r.source])
    few = is_small(chosen)
    files, samples = chosen.select(r.file), chosen
    if few:
        files, samples = F.broadcast(files), F.broadcast(samples)
    grain = enforce_grain(slim.join(files, r.file, "left_semi"), [r.file, r.feature], r)
    return select_present(grain.join(samples, r.file, "inner"), r.long_columns)


def chosen_files(
    clean: DataFrame,
    metadata: DataFrame,
    classes: Sequence[str],
    needle: str = domain.SAMPLE_TYPE_NEEDLE,
    subject_prefix: int = domain.SUBJECT_PREFIX,
    present: DataFrame | None = None,
    r: Roles = DEFAULT,
) -> DataFrame:
    """The samples table: one file per official sample, chosen on the metadata before measurements are joined.

    ``present`` names the files that have rows (a listing of stored files is the cheap way); without it they
    are read off the cleaned measurements, which costs one scan of three columns.
    """
    return choose_listed(metadata, clean if present is None else present, classes, needle, subject_prefix, r)


def choose_listed(
    metadata: DataFrame,
    listed: DataFrame,
    classes: Sequence[str],
    needle: str = domain.SAMPLE_TYPE_NEEDLE,
    subject_prefix: int = domain.SUBJECT_PREFIX,
    r: Roles = DEFAULT,
) -> DataFrame:
    """``chosen_files`` by a listing of the files that are there, without a look into them."""
    official = official_samples(metadata, classes, needle, subject_prefix, r)
    return dedupe_samples(candidate_samples(with_rows(official, listed, r), r), r)


def feature_dictionary(long: DataFrame, r: Roles = DEFAULT) -> DataFrame:
    return select_present(long, r.feature_columns).distinct()


def restrict_features(long: DataFrame, features: DataFrame | Sequence[str], r: Roles = DEFAULT) -> DataFrame:
    """Long rows of the listed features; a frame of features is joined, a list becomes one.

    A frame is cut off from its lineage, which may well be the long table, before it is counted and joined.
    """
    if isinstance(features, DataFrame):
        wanted = broadcast_if_small(reliable(features.select(r.feature).distinct()))
    else:
        wanted = F.broadcast(long.sparkSession.createDataFrame([(f,) for f in features], f"{r.feature} string"))
    return long.join(wanted, r.feature, "left_semi")
