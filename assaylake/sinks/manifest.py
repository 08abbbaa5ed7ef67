"""What of the expected files has arrived."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..roles import DEFAULT, Roles


def ingest_manifest(metadata: DataFrame, listing: DataFrame, r: Roles = DEFAULT) -> DataFrame:
    """One row per expected file with its state and path.

    ``listing`` has (file id, path, length). A file is there when it has bytes, empty when it has none, missing
    when it is not listed. Several copies of a file count once, the largest first.
    """
    arrived = listing.groupBy(r.file).agg(
        F.max(F.struct(F.col("length"), F.col("path"))).alias("_best")
    )
    size = F.col("_best.length")
    state = F.when(size > 0, "present").when(size.isNotNull(), "empty").otherwise("missing")
    return metadata.select(r.file, r.file_name).join(arrived, r.file, "left").select(
        r.file, r.file_name, state.alias("estado_descarga"), F.col("_best.path").alias("ruta_local")
    )


def manifest_states(manifest: DataFrame) -> DataFrame:
    return (
        manifest.groupBy("estado_descarga")
        .agg(F.count("*").alias("n_archivos"))
        .orderBy(F.desc("n_archivos"), "estado_descarga")
    )
