"""Raw files to the trusted tables by increments, told by a manifest.

The manifest keeps what was loaded: for each chosen file its samples row, path, length and time of change. A run lists the
raw folder, which opens no file, chooses the files anew, and compares. Only files that are new, changed or newly chosen are
read; only the class partitions they touch are replaced, from the stored rows of the files that stay and the rows read.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F

from .. import domain
from ..operators import prepare
from ..operators.sizing import broadcast_if_small
from ..roles import DEFAULT, Roles
from ..session import reliable
from ..sinks.manifest import ingest_manifest
from ..sources.measurements import RAW_GLOB, list_raw_files, one_path_per_file, read_paths, with_file_id
from .trusted import Trusted

_FILE_FIELDS = ["path", "length", "modified"]


@dataclass(frozen=True)
class Increment:
    trusted: Trusted
    #: State and path of each expected file.
    manifest: DataFrame
    #: Paths that were read, and classes whose partitions were replaced.
    read: list[str]
    classes: list[str]


def ingest(
    spark: SparkSession,
    metadata: DataFrame,
    raw_path: str,
    out: str,
    classes: Sequence[str] = tuple(domain.CLASS_NAMES),
    needle: str = domain.SAMPLE_TYPE_NEEDLE,
    raw_needle: str = domain.RAW_FILE_NEEDLE,
    glob: str = RAW_GLOB,
    subject_prefix: int = domain.SUBJECT_PREFIX,
    r: Roles = DEFAULT,
) -> Increment:
    """Bring the trusted tables below ``out`` to the state of the raw folder; the result is that of a full build.

    The manifest is written last. A run that stops before has replaced some partitions by their new content; the next
    run finds the old manifest, reads the same files again and comes to the same tables. One run at a time writes to
    ``out``.
    """
    files = reliable(one_path_per_file(list_raw_files(spark, raw_path, raw_needle, glob, r), r))
    chosen = prepare.choose_listed(metadata, files, classes, needle, subject_prefix, r)
    now = reliable(chosen.join(files, r.file).select(*r.sample_columns, *_FILE_FIELDS))
    before = _stored(spark, f"{out}/manifest", now)
    added, removed = reliable(now.exceptAll(before)), reliable(before.exceptAll(now))
    # As many as the closed list of classes has.
    touched = sorted(row[0] for row in added.select(r.cls).union(removed.select(r.cls)).distinct().collect())
    paths = [row[0] for row in added.select("path").orderBy("path").collect()]
    if touched:
        _replace_partitions(spark, now, added, paths, touched, out, r)
        now.select(*r.sample_columns).write.mode("overwrite").parquet(f"{out}/samples")
        long = spark.read.parquet(f"{out}/long")
        prepare.feature_dictionary(long, r).write.mode("overwrite").parquet(f"{out}/dictionary")
        now.write.mode("overwrite").parquet(f"{out}/manifest")
    stored = Trusted(*(spark.read.parquet(f"{out}/{part}") for part in ("long", "samples", "dictionary"))) if touched or paths or _there(spark, f"{out}/long") else None
    if stored is None:
        empty = spark.createDataFrame([], prepare.trusted_long(with_file_id(read_paths(spark, [], r), r), now, r=r).schema)
        stored = Trusted(empty, now.select(*r.sample_columns), prepare.feature_dictionary(empty, r))
    return Increment(stored, ingest_manifest(metadata, files, r), paths, touched)


def _replace_partitions(
    spark: SparkSession, now: DataFrame, added: DataFrame, paths: list[str], touched: list[str], out: str, r: Roles
) -> None:
    fresh = prepare.trusted_long(with_file_id(read_paths(spark, paths, r), r), added.select(*r.sample_columns), r=r)
    rows = fresh
    if _there(spark, f"{out}/long"):
        # What stays of the touched classes: stored rows of files that are chosen as before. Other partitions are not read.
        same = broadcast_if_small(now.join(added.select(r.file), r.file, "left_anti").select(r.file))
        held = spark.read.schema(fresh.schema).parquet(f"{out}/long").filter(F.col(r.cls).isin(touched))
        rows = held.join(same, r.file, "left_semi").select(fresh.columns).unionByName(fresh)
    gathered = rows.hint("rebalance", r.cls).sortWithinPartitions(r.cls, r.feature)
    writer = gathered.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(r.cls)
    writer.parquet(f"{out}/long")
    # A class without a file any more has no row that would replace its partition.
    filled = {row[0] for row in now.select(r.cls).distinct().collect()}
    for cls in set(touched) - filled:
        _drop_partition(spark, f"{out}/long", r.cls, cls)


def _drop_partition(spark: SparkSession, path: str, column: str, value: str) -> None:
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path, f"{column}={value}")
    folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)


def _there(spark: SparkSession, path: str) -> bool:
    try:
        spark.read.schema("x int").parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return False
    return True


def _stored(spark: SparkSession, path: str, like: DataFrame) -> DataFrame:
    """The stored table cut off from its files, which are replaced later; empty before the first run."""
    return reliable(spark.read.schema(like.schema).parquet(path)) if _there(spark, path) else spark.createDataFrame([], like.schema)
