"""Per-sample measurement files."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from .. import domain
from ..functions import file_id_of
from ..roles import DEFAULT, Roles

RAW_GLOB = "*.tsv"
MEASUREMENT_SCHEMA = """gene_id string, gene_name string, gene_type string, unstranded double,
    stranded_first double, stranded_second double, tpm_unstranded double, fpkm_unstranded double,
    fpkm_uq_unstranded double"""


def read_measurements(
    spark: SparkSession, path: str, glob: str | None = None, needle: str | None = None, r: Roles = DEFAULT
) -> DataFrame:
    """All files below ``path`` as TSV with the file each row came from; lines starting with # are comments.

    ``glob`` and ``needle``, which the name contains in any case, limit the files where others lie in between.
    """
    reader = _reader(spark).option("recursiveFileLookup", True)
    if glob is not None:
        reader = reader.option("pathGlobFilter", glob)
    rows = reader.csv(path).withColumn(r.source, F.col("_metadata.file_path"))
    return rows if needle is None else rows.filter(name_contains(r.source, needle))


def read_paths(spark: SparkSession, paths: Sequence[str], r: Roles = DEFAULT) -> DataFrame:
    """The files at ``paths`` and no others: neither opened nor listed. No paths give an empty frame."""
    if not paths:
        return spark.createDataFrame([], f"{MEASUREMENT_SCHEMA}, {r.source} string")
    # Spark takes paths for patterns.
    plain = [re.sub(r"([\\{}\[\]*?])", r"\\\1", p) for p in paths]
    return _reader(spark).csv(plain).withColumn(r.source, F.col("_metadata.file_path"))


def _reader(spark: SparkSession):
    return spark.read.schema(MEASUREMENT_SCHEMA).option("sep", "\t").option("header", True).option("comment", "#")


def name_contains(path: str, needle: str) -> Column:
    """Whether the file name at the end of a path contains ``needle``, in any case."""
    return F.lower(F.substring_index(path, "/", -1)).contains(needle.lower())


def with_file_id(measurements: DataFrame, r: Roles = DEFAULT) -> DataFrame:
    return measurements.withColumn(r.file, file_id_of(r.source))


def file_id_check(measurements: DataFrame, n: int = 10, r: Roles = DEFAULT) -> DataFrame:
    """A look at n distinct (path, file id) pairs, in path order."""
    return measurements.select(r.source, r.file).distinct().orderBy(r.source, r.file).limit(n)


def list_raw_files(
    spark: SparkSession, path: str, needle: str = domain.RAW_FILE_NEEDLE, glob: str = RAW_GLOB, r: Roles = DEFAULT
) -> DataFrame:
    """(path, length, time of the last change, file id) of the raw files whose name contains ``needle``.

    No file is opened, and Spark lists no file without bytes.
    """
    listed = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", glob)
        .load(path)
        .select("path", "length", F.col("modificationTime").alias("modified"))
    )
    return listed.filter(name_contains("path", needle)).withColumn(r.file, file_id_of("path"))


def one_path_per_file(files: DataFrame, r: Roles = DEFAULT) -> DataFrame:
    """Of several copies of a file the largest, then the one with the greatest path, as the manifest has it."""
    best = F.max(F.struct("length", "path", "modified")).alias("best")
    return files.groupBy(r.file).agg(best).select(r.file, "best.path", "best.length", "best.modified")


def paths_of(files: DataFrame, chosen: DataFrame, r: Roles = DEFAULT) -> list[str]:
    """The paths of the chosen files. They go through the driver, which holds as many in the file index of the scan."""
    return [row[0] for row in files.join(chosen.select(r.file), r.file, "left_semi").select("path").orderBy("path").collect()]


def raw_file_summary(files: DataFrame, n: int = 10) -> tuple[DataFrame, DataFrame]:
    """Number of listed files, and the first n paths."""
    return files.agg(F.count("*").alias("n_archivos")), files.select("path").orderBy("path").limit(n)
