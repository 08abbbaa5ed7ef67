"""Trusted tables to the refined report tables."""

from __future__ import annotations

from pyspark.sql import DataFrame

from ..operators import counts, profiles, ranking
from ..roles import DEFAULT, Roles
from ..sinks.tables import publish
from .trusted import Trusted


def refined_frames(trusted: Trusted, r: Roles = DEFAULT) -> dict[str, DataFrame]:
    """Table name -> report; each is one plan over the trusted tables."""
    long, samples, dictionary = trusted.long, trusted.samples, trusted.dictionary
    return {
        "refined_resumen_general": counts.summary(long, samples, dictionary, r),
        "refined_conteo_clases": counts.class_counts(long, r),
        "refined_desbalance_clases": counts.class_imbalance(long, r),
        "refined_tipos_muestra": counts.type_counts(long, r),
        "refined_calidad_datos": profiles.quality(long, r),
        "refined_genes_detectados_muestra": profiles.detected_features(long, r),
        "refined_expresion_global": profiles.value_stats(long, r=r),
        "refined_top_genes_por_clase": ranking.top_features(long, r=r),
        "refined_genes_mas_variables": ranking.variable_features(long, r=r),
        "refined_muestras_por_paciente": counts.samples_per_subject(long, r),
    }


def publish_refined(trusted: Trusted, namespace: str | None = None, fmt: str = "parquet", r: Roles = DEFAULT) -> None:
    for name, frame in refined_frames(trusted, r).items():
        publish(frame, f"{namespace}.{name}" if namespace else name, fmt=fmt)
