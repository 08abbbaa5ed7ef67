"""Raw files to the trusted tables."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from .. import domain
from ..operators import prepare
from ..roles import DEFAULT, Roles
from ..sinks.tables import publish_path, register_location, write_long
from ..sources.measurements import RAW_GLOB, list_raw_files, one_path_per_file, paths_of, read_paths, with_file_id


@dataclass(frozen=True)
class Trusted:
    long: DataFrame
    samples: DataFrame
    dictionary: DataFrame


def build_trusted(
    spark: SparkSession,
    metadata: DataFrame,
    raw_path: str,
    out: str,
    classes: Sequence[str] = tuple(domain.CLASS_NAMES),
    needle: str = domain.SAMPLE_TYPE_NEEDLE,
    raw_needle: str = domain.RAW_FILE_NEEDLE,
    fmt: str = "parquet",
    glob: str = RAW_GLOB,
    r: Roles = DEFAULT,
) -> Trusted:
    """Choose the files, write the samples table, then the long table by class, then the feature dictionary.

    Every table is read back after it is written, so nothing is computed twice and the checks run on what was
    stored. Only listed files, which have bytes, can be chosen; the listing opens none of them, and afterwards only the
    chosen ones are opened. Of several copies of a file one is read.
    """
    files = one_path_per_file(list_raw_files(spark, raw_path, raw_needle, glob, r), r)
    chosen = prepare.choose_listed(metadata, files, classes, needle, r=r)
    chosen.write.format(fmt).mode("overwrite").save(f"{out}/samples")
    samples = spark.read.format(fmt).load(f"{out}/samples")

    measured = with_file_id(read_paths(spark, paths_of(files, samples, r), r), r)
    write_long(prepare.trusted_long(measured, samples, r=r), f"{out}/long", [r.cls], [r.feature], fmt)
    long = spark.read.format(fmt).load(f"{out}/long")
    prepare.feature_dictionary(long, r).write.format(fmt).mode("overwrite").save(f"{out}/dictionary")
    return Trusted(long, samples, spark.read.format(fmt).load(f"{out}/dictionary"))


def publish_trusted(
    spark: SparkSession, out: str, prefix: str, copy: bool = False, fmt: str = "parquet", r: Roles = DEFAULT
) -> None:
    """The stored trusted tables as catalog tables: registered where they lie, or written once more as a ``copy``."""
    for part, by in (("long", [r.cls]), ("samples", []), ("dictionary", [])):
        if copy:
            publish_path(spark, f"{out}/{part}", f"{prefix}{part}", by, fmt)
        else:
            register_location(spark, f"{prefix}{part}", f"{out}/{part}", fmt)
