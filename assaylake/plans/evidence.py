"""CSV evidence of a run."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..operators import evaluate
from ..roles import DEFAULT, Roles
from ..sinks.exports import export_csv
from ..sources.metadata import official_files

# How many predictions the evidence shows.
SHOWN_PREDICTIONS = 200


def export_ingest(metadata: DataFrame, manifest: DataFrame, folder: str, r: Roles = DEFAULT) -> None:
    """All metadata, the official part of it, and the manifest."""
    export_csv(metadata, f"{folder}/metadatos_completo.csv", order=[r.file])
    export_csv(official_files(metadata, r=r), f"{folder}/metadatos_oficial.csv", order=[r.file])
    export_csv(manifest, f"{folder}/manifest_descargas.csv", order=[r.file])


def export_results(
    metrics: DataFrame, class_counts: DataFrame, predictions: DataFrame, folder: str, r: Roles = DEFAULT
) -> None:
    """Report metrics, class counts and the first predictions by sample id."""
    report = evaluate.metrics_report(metrics)
    export_csv(report, f"{folder}/app_tabla_metricas.csv", order=["split", F.desc("f1_macro"), "modelo"])
    export_csv(class_counts, f"{folder}/app_conteo_clases.csv", order=[F.desc("n_muestras"), r.cls])
    export_csv(predictions, f"{folder}/app_predicciones_muestra.csv", order=[r.sample], limit=SHOWN_PREDICTIONS)
