"""Session settings the jobs rely on."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Adaptive execution sizes the shuffles; a hot join key is split even where the split costs one more shuffle.
_ADAPTIVE = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
}


#: Tasks that list folders, for each core. Spark would start one for each folder, up to 10,000, and a start costs more than
#: to list some hundred folders.
LISTING_TASKS = 4


def tune(spark: SparkSession) -> SparkSession:
    """Switch on skew handling for this session, and let a task list many folders; every other sizing stays as the cluster has it."""
    for key, value in _ADAPTIVE.items():
        spark.conf.set(key, value)
    listing = max(32, LISTING_TASKS * spark.sparkContext.defaultParallelism)
    spark.conf.set("spark.sql.sources.parallelPartitionDiscovery.parallelism", str(listing))
    return spark


def local_session(cpus: int | str = 8, memory: str = "12g", app: str = "assaylake") -> SparkSession:
    """A session for tests and the bench: one JVM with the shuffle width set to its cores."""
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", str(cpus))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.warehouse.dir", os.path.join(tempfile.gettempdir(), "assaylake-warehouse"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return tune(ensure_shared_folder(spark))


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors share: the context's checkpoint folder, else the one ``spark.checkpoint.dir`` names."""
    own = spark.sparkContext.getCheckpointDir()
    # The context adds a folder named by a UUID to the one that was set; raw files are told by the UUID in their path.
    folder = own.rsplit("/", 1)[0] if own else spark.conf.get("spark.checkpoint.dir", None)
    if folder is None:
        raise RuntimeError("no shared folder: set spark.checkpoint.dir, or call sparkContext.setCheckpointDir")
    return folder


def ensure_shared_folder(spark: SparkSession) -> SparkSession:
    """For local sessions that name no shared folder, such as tests: give them one below the working folder's temp."""
    context = spark.sparkContext
    if context.getCheckpointDir() is None and spark.conf.get("spark.checkpoint.dir", None) is None:
        if context.master.startswith("local") and not context.master.startswith("local-cluster"):
            context.setCheckpointDir(tempfile.mkdtemp(prefix="assaylake-"))
    return spark


def scratch_folder(spark: SparkSession, purpose: str) -> str:
    """A path of its own below the shared folder, for tables that one run stores and reads back."""
    return f"{shared_folder(spark)}/{purpose}-{uuid.uuid4().hex}"


def reliable(df: DataFrame) -> DataFrame:
    """``df`` written to the shared folder and cut off from its lineage."""
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_folder(df.sparkSession))
    return df.checkpoint()
