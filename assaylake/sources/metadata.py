"""File metadata: nested listing and its flat form."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

from .. import domain
from ..functions import class_lookup, contains_ci
from ..roles import DEFAULT, Roles
from .tables import bind_columns

_HITS = """array<struct<
    file_id: string, file_name: string, file_size: bigint,
    data_category: string, data_type: string, access: string, analysis: struct<workflow_type: string>,
    cases: array<struct<
        case_id: string, submitter_id: string, project: struct<project_id: string>,
        samples: array<struct<sample_id: string, submitter_id: string, sample_type: string>>>>>>"""

METADATA_SCHEMA = """file_id string, file_name string, file_size bigint, case_id string, case_submitter_id string,
    sample_id string, sample_submitter_id string, sample_type string, project_id string, cancer_type string,
    cancer_name string"""


def read_hits(spark: SparkSession, path: str, multi_line: bool = True) -> DataFrame:
    """Listing documents, one ``hits`` array per row, whether at the top level or under ``data``.

    A file is one document; with ``multi_line`` off every line is one, so that large files can be split.
    """
    raw = (
        spark.read.schema(f"hits {_HITS}, data struct<hits: {_HITS}>")
        .option("multiLine", multi_line)
        .option("recursiveFileLookup", True)
        .json(path)
    )
    return raw.select(F.coalesce("hits", "data.hits").alias("hits"))


def select_files(
    listing: DataFrame,
    projects: Sequence[str],
    category: str = domain.DATA_CATEGORY,
    dtype: str = domain.DATA_TYPE,
    workflow: str = domain.WORKFLOW,
    access: str = domain.ACCESS,
    limit: int | None = None,
) -> DataFrame:
    """Wanted files of a listing frame with one hit per row: all of them, or the first ``limit`` by file id."""
    wanted = listing.filter(
        F.exists("cases", lambda case: case["project"]["project_id"].isin(*projects))
        & (F.col("data_category") == category)
        & (F.col("data_type") == dtype)
        & (F.col("analysis.workflow_type") == workflow)
        & (F.col("access") == access)
    )
    return wanted if limit is None else wanted.orderBy("file_id").limit(limit)


def explode_hits(hits: DataFrame) -> DataFrame:
    """One row per hit, its fields as columns."""
    return hits.select(F.explode("hits").alias("hit")).select("hit.*")


def flatten_metadata(
    listing: DataFrame, projects: Mapping[str, tuple[str, str]], default: str = domain.UNKNOWN, r: Roles = DEFAULT
) -> DataFrame:
    """Flat metadata from one hit per row: its first case and that case's first sample.

    A hit without cases is left out; without samples its sample fields are null.
    """
    case, sample = F.get("cases", F.lit(0)), F.get(F.col("case.samples"), F.lit(0))
    code, name = class_lookup("case.project.project_id", projects, default)
    return (
        listing.filter(F.size("cases") > 0)
        .withColumn("case", case)
        .withColumn("sample", sample)
        .select(
            F.col("file_id").alias(r.file),
            F.col("file_name").alias(r.file_name),
            F.col("file_size").alias(r.file_size),
            F.col("case.case_id").alias(r.case),
            F.col("case.submitter_id").alias(r.case_submitter),
            F.col("sample.sample_id").alias(r.sample),
            F.col("sample.submitter_id").alias(r.sample_submitter),
            F.col("sample.sample_type").alias(r.sample_type),
            F.col("case.project.project_id").alias(r.project),
            code.alias(r.cls),
            name.alias(r.cls_name),
        )
    )


#: Columns without which a row says nothing.
METADATA_KEYS = ("file_id", "sample_id", "cancer_type")


def read_metadata_csv(spark: SparkSession, path: str) -> DataFrame:
    """Metadata from a headered CSV, bound by header name in any order; further columns are left out.

    A missing column is null, a missing key column an error.
    """
    header = spark.read.option("header", True).option("escape", '"').csv(path)
    missing = [c for c in METADATA_KEYS if c not in header.columns]
    if missing:
        raise ValueError(f"missing metadata columns: {', '.join(missing)}")
    return bind_columns(header, METADATA_SCHEMA)


def official_files(
    metadata: DataFrame,
    classes: Sequence[str] = tuple(domain.CLASS_NAMES),
    needle: str = domain.SAMPLE_TYPE_NEEDLE,
    r: Roles = DEFAULT,
) -> DataFrame:
    """Metadata of the closed class list and the wanted sample type."""
    return metadata.filter(F.col(r.cls).isin(*classes) & contains_ci(r.sample_type, needle))
