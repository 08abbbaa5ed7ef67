"""Catalog tables and partitioned storage. The format is an argument: delta where it is installed, else parquet."""

from __future__ import annotations

import re
import time
import uuid
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession

from ..roles import DEFAULT, Roles


#: How a version of a published table is named: the name, the time of writing in milliseconds, and some random digits.
VERSION_PATTERN = r"__v\d{13}_[0-9a-f]{8}$"
_VERSION = re.compile(VERSION_PATTERN)


def is_version(name: str) -> bool:
    """Whether a catalog name is that of a version behind a published name."""
    return _VERSION.search(name) is not None


def publish(df: DataFrame, name: str, by: Sequence[str] = (), fmt: str = "parquet", keep: int = 1) -> None:
    """Replace the rows and the schema that are read under ``name``, in one step for its readers.

    Delta replaces a table in one commit. For other formats the rows are written as a table of their own, a version, and
    ``name`` is a view of the latest: there is no moment without it, a write that fails leaves it as it was, and ``df`` may
    read it. The ``keep`` versions before stay for those who began to read them; older ones are dropped. One writer at a time
    publishes under a name. A table that has the name already becomes the first version; only then the name is away for the
    time between two calls of the catalog.
    """
    spark = df.sparkSession
    writer = df.write.format(fmt).mode("overwrite").option("overwriteSchema", "true")
    writer = writer.partitionBy(*by) if by else writer
    if fmt == "delta":
        writer.saveAsTable(name)
        return
    version = f"{name}__v{int(time.time() * 1000):013d}_{uuid.uuid4().hex[:8]}"
    try:
        writer.saveAsTable(version)
        # Versions do not change, so what the catalog says of their rows stays true.
        spark.sql(f"ANALYZE TABLE {version} COMPUTE STATISTICS")
        if spark.catalog.tableExists(name) and spark.catalog.getTable(name).tableType != "VIEW":
            spark.sql(f"ALTER TABLE {name} RENAME TO {name}__v{0:013d}_{uuid.uuid4().hex[:8]}")
        spark.sql(f"CREATE OR REPLACE VIEW {name} AS SELECT * FROM {version}")
    except Exception:
        spark.sql(f"DROP TABLE IF EXISTS {version}")
        raise
    for old in versions(spark, name)[: -1 - keep]:
        spark.sql(f"DROP TABLE IF EXISTS {old}")


def versions(spark: SparkSession, name: str) -> list[str]:
    """The versions behind a published name, the oldest first."""
    space, _, base = name.rpartition(".")
    within = f" IN {space}" if space else ""
    found = [row["tableName"] for row in spark.sql(f"SHOW TABLES{within} LIKE '{base.lower()}__v*'").collect()]
    own = sorted(x for x in found if is_version(x) and _VERSION.sub("", x) == base.lower())
    return [f"{space}.{x}" if space else x for x in own]


def unpublish(spark: SparkSession, name: str) -> None:
    """Remove a published name and its versions."""
    if spark.catalog.tableExists(name):
        spark.sql(f"DROP {'VIEW' if spark.catalog.getTable(name).tableType == 'VIEW' else 'TABLE'} {name}")
    for version in versions(spark, name):
        spark.sql(f"DROP TABLE IF EXISTS {version}")


def write_long(
    df: DataFrame, path: str, by: Sequence[str], sort: Sequence[str] = (), fmt: str = "parquet"
) -> None:
    """Write partitioned by ``by``.

    Rows are gathered by partition value; adaptive execution cuts a value with many rows into several even
    tasks and files and merges the small ones. ``sort`` orders the rows inside each file, so that a filter on
    those columns skips row groups.
    """
    gathered = df.hint("rebalance", *by)
    if sort:
        gathered = gathered.sortWithinPartitions(*by, *sort)
    gathered.write.format(fmt).mode("overwrite").partitionBy(*by).save(path)


#: Rows of a bucket, about, and buckets at most (Spark allows 100,000): beyond, buckets grow. One task sorts a bucket's rows,
#: of some 400 bytes each, so a bucket takes about 200 MB of a task's memory.
BUCKET_ROWS, MOST_BUCKETS = 500_000, 50_000


def write_by_sample(
    df: DataFrame, name: str, path: str, buckets: int | None = None, bloom: bool = True, r: Roles = DEFAULT
) -> DataFrame:
    """The long table as a catalog table over ``path``, dealt by sample and sorted by feature inside each bucket.

    One shuffle now saves one in each plan that works sample by sample (features per sample, distinct samples, choice of a
    file, matrix): a sample's rows lie in one file, and Spark reads a bucket as one partition. A sample has a bounded number of
    rows, so buckets are even. Features are contiguous, so a filter on one skips row groups by their ends, and by their
    dictionaries where its id lies between them; a row group whose dictionary would be too large gets a bloom filter.
    """
    spark = df.sparkSession
    if buckets is None:
        buckets = min(MOST_BUCKETS, max(1, -(-df.count() // BUCKET_ROWS)))
    # As many partitions as buckets, by the same hash: a task writes one file.
    gathered = df.repartition(buckets, r.sample).sortWithinPartitions(r.feature, r.sample)
    writer = gathered.write.format("parquet").mode("overwrite").option("path", path)
    if bloom:
        writer = writer.option(f"parquet.bloom.filter.enabled#{r.feature}", "true")
    writer.bucketBy(buckets, r.sample).sortBy(r.feature, r.sample).saveAsTable(name)
    return spark.table(name)


def publish_path(spark: SparkSession, path: str, name: str, by: Sequence[str] = (), fmt: str = "parquet") -> None:
    """Publish stored rows as a catalog table with the same partitioning."""
    stored = spark.read.format(fmt).load(path)
    publish(stored.hint("rebalance", *by) if by else stored, name, by, fmt)


def register_location(spark: SparkSession, name: str, path: str, fmt: str = "parquet") -> None:
    """Make an existing location a catalog table without moving its rows."""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} USING {fmt} LOCATION '{path}'")
    partitioned = any(c.isPartition for c in spark.catalog.listColumns(name))
    if partitioned and fmt != "delta":
        spark.catalog.recoverPartitions(name)


def register_locations(spark: SparkSession, locations: Mapping[str, str], fmt: str = "parquet") -> None:
    for name, path in locations.items():
        register_location(spark, name, path, fmt)
