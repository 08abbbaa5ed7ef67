"""Stored tables: by path, by catalog name, and by logical key."""

from __future__ import annotations

import re
from collections.abc import Callable, Mapping
from dataclasses import dataclass
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from ..sinks.tables import VERSION_PATTERN, is_version


@dataclass(frozen=True)
class TableEntry:
    """Where a refined table lives: its name, which is also its CSV folder or file name, and its schema.

    Without a schema the columns are those of the header, as text: the matrix has one per chosen feature.
    """

    name: str
    schema: str | None


_METRICS = """modelo string, split string, accuracy double, balanced_accuracy double, precision_macro double,
    recall_macro double, f1_macro double, precision_weighted double, recall_weighted double, f1_weighted double,
    roc_auc_macro_ovr double, pr_auc_macro_ovr double, gap_f1_macro_train_validation double,
    gap_accuracy_train_validation double"""

# Logical keys of the refined tables and the names they are stored under.
REFINED = {
    "calidad_datos": TableEntry(
        "refined_calidad_datos",
        "cancer_type string, n_registros bigint, n_log2_tpm_null bigint, n_tpm_null bigint, n_tpm_cero bigint, "
        "pct_tpm_cero double",
    ),
    "conteo_clases": TableEntry(
        "refined_conteo_clases", "cancer_type string, cancer_name string, n_muestras bigint, n_pacientes bigint"
    ),
    "expresion_global": TableEntry(
        "refined_expresion_global",
        "cancer_type string, n_registros bigint, media_log2_tpm double, sd_log2_tpm double, min_log2_tpm double, "
        "q1_log2_tpm double, mediana_log2_tpm double, q3_log2_tpm double, max_log2_tpm double",
    ),
    "resumen_general": TableEntry(
        "refined_resumen_general",
        "n_registros_long bigint, n_muestras_long bigint, n_filas_samples bigint, n_muestras_samples bigint, "
        "n_pacientes bigint, n_clases bigint, n_genes_long bigint, n_genes_diccionario bigint",
    ),
    "top_genes": TableEntry(
        "refined_top_genes_por_clase",
        "cancer_type string, rank_gen bigint, gene_id_base string, gene_name string, avg_log2_tpm double",
    ),
    "metricas": TableEntry("refined_metricas_modelos_sparkml", _METRICS),
    "matriz_genes": TableEntry("refined_ml_matriz", None),
}


def read_path(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    return spark.read.format(fmt).load(path)


def read_table(spark: SparkSession, name: str) -> DataFrame:
    return spark.table(name)


def table_or_compute(spark: SparkSession, name: str, compute: Callable[[], DataFrame]) -> DataFrame:
    """The stored table if the catalog has it, else what ``compute`` gives."""
    return spark.table(name) if spark.catalog.tableExists(name) else compute()


def read_csv_table(spark: SparkSession, path: str, schema: str | None = None) -> DataFrame:
    """A headered CSV bound to ``schema`` by header name; an empty frame when the path does not exist."""
    header = _csv_if_there(spark, path)
    if header is None:
        return spark.createDataFrame([], schema or "struct<>")
    if schema is None:
        return header
    return bind_columns(header, schema)


def bind_columns(frame: DataFrame, schema: str) -> DataFrame:
    """The columns of ``schema`` by name, cast to their types; those that ``frame`` lacks are null."""
    present = set(frame.columns)
    return frame.select(
        *[
            (F.col(f"`{f.name}`").try_cast(f.dataType) if f.name in present else F.lit(None).cast(f.dataType)).alias(f.name)
            for f in T.StructType.fromDDL(schema)
        ]
    )


def load_refined(
    spark: SparkSession,
    key: str,
    mode: str = "table",
    folder: str | None = None,
    limit: int | None = None,
    registry: Mapping[str, TableEntry] = REFINED,
    namespace: str | None = None,
) -> DataFrame:
    """A refined table by logical key, from the catalog or from its CSV below ``folder``."""
    if key not in registry:
        raise KeyError(f"no refined table is registered under {key!r}; known keys: {sorted(registry)}")
    entry = registry[key]
    if mode == "csv":
        frame = read_csv_table(spark, f"{folder}/{entry.name}.csv", entry.schema)
    else:
        frame = spark.table(_qualified(entry.name, namespace))
    return frame if limit is None else frame.limit(limit)


def table_status(
    spark: SparkSession,
    mode: str = "table",
    folder: str | None = None,
    registry: Mapping[str, TableEntry] = REFINED,
    namespace: str | None = None,
) -> DataFrame:
    """One row per registered table: key, name, mode, whether it exists, rows, columns and origin.

    Rows come from the catalog's statistics where it has them (of published tables it always has), else from a count.
    """
    rows = []
    for key, entry in registry.items():
        origin = f"{folder}/{entry.name}.csv" if mode == "csv" else _qualified(entry.name, namespace)
        frame = _existing(spark, mode, origin)
        about = [F.lit(key).alias("clave"), F.lit(entry.name).alias("tabla"), F.lit(mode).alias("modo")]
        found, width = F.lit(frame is not None).alias("existe"), 0 if frame is None else len(frame.columns)
        known = 0 if frame is None else stored_count(spark, origin) if mode != "csv" else None
        if known is None:
            counted = frame.agg(F.count("*").alias("filas"))
        else:
            counted = spark.range(1).select(F.lit(known).cast("bigint").alias("filas"))
        rows.append(
            counted.select(*about, found, "filas", F.lit(width).cast("bigint").alias("columnas"), F.lit(origin).alias("origen"))
        )
    return reduce(DataFrame.unionByName, rows)


def stored_count(spark: SparkSession, name: str) -> int | None:
    """Rows of a catalog table as its statistics have them, without a scan; None where there are none.

    Spark drops the statistics of a table that it writes to, so those that are there are true. Of a published name the
    version behind it is asked.
    """
    about = {row["col_name"]: row["data_type"] for row in spark.sql(f"DESCRIBE TABLE EXTENDED {name}").collect()}
    if about.get("Type") == "VIEW":
        behind = re.fullmatch(r"SELECT \* FROM (\S+)", about.get("View Text") or "")
        return stored_count(spark, behind[1]) if behind and is_version(behind[1]) else None
    counted = re.search(r"(\d+) rows", about.get("Statistics") or "")
    return int(counted[1]) if counted else None


def find_tables(spark: SparkSession, pattern: str, namespace: str | None = None) -> DataFrame:
    """Catalog tables whose name matches ``pattern`` (* is a wildcard), without the versions behind published ones."""
    within = f" IN {namespace}" if namespace else ""
    found = spark.sql(f"SHOW TABLES{within} LIKE '{pattern}'").select("tableName")
    return found.filter(~F.col("tableName").rlike(VERSION_PATTERN)).orderBy("tableName")


def _existing(spark: SparkSession, mode: str, origin: str) -> DataFrame | None:
    if mode == "csv":
        return _csv_if_there(spark, origin)
    return spark.table(origin) if spark.catalog.tableExists(origin) else None


def _csv_if_there(spark: SparkSession, path: str) -> DataFrame | None:
    try:
        return spark.read.option("header", True).option("escape", '"').csv(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def _qualified(name: str, namespace: str | None) -> str:
    return f"{namespace}.{name}" if namespace else name
