import uuid

import pytest

from assaylake import domain
from assaylake.operators import checks, counts
from assaylake.plans import evidence, modelling, refined, scoring, trusted
from assaylake.sinks import manifest
from assaylake.sources import measurements, metadata, tables

HEADER = "gene_id\tgene_name\tgene_type\tunstranded\tstranded_first\tstranded_second\ttpm_unstranded\tfpkm_unstranded\tfpkm_uq_unstranded"


def uid(i):
    return f"{i:08x}-0000-4000-8000-{i:012x}"


@pytest.fixture(scope="module")
def lake(spark, tmp_path_factory):
    """Six files of five samples: s0 has two, the file of s4 is empty, s3 is of no listed class."""
    root = tmp_path_factory.mktemp("lake")
    rows = []
    for i, (sample, cls, size) in enumerate(
        [("s0", "OV", 5), ("s0", "OV", 9), ("s1", "OV", 3), ("s2", "GBM", 3), ("s3", "ZZ", 3), ("s4", "GBM", 3)]
    ):
        folder = root / "raw" / uid(i)
        folder.mkdir(parents=True)
        lines = ["# a comment", HEADER, "N_unmapped\t\t\t1\t1\t1\t\t\t"]
        for g in range(3):
            for version in (1, 2) if g == 0 else (1,):
                lines.append(f"ENSG{g}.{version}\tname{g}\tprotein_coding\t1\t1\t1\t{(i + g) * version}\t1\t1")
        lines.append("ENSG9.1\tother\tlncRNA\t1\t1\t1\t9\t1\t1")
        text = "" if sample == "s4" else "\n".join(lines) + "\n"
        (folder / f"{uid(i)}.rna_seq.augmented_star_gene_counts.tsv").write_text(text)
        rows.append((uid(i), f"{i}.tsv", size, f"c{sample}", f"p-{sample}", sample, f"{sample}-sub", "Primary Tumor", f"PRJ-{cls}", cls, cls.lower()))
    meta = spark.createDataFrame(rows, metadata.METADATA_SCHEMA)
    made = trusted.build_trusted(spark, meta, str(root / "raw"), str(root / "trusted"))
    return root, meta, made


def test_long_table(lake, rows):
    root, _, made = lake
    assert rows(made.samples.select("sample_id", "file_id")) == [("s0", uid(1)), ("s1", uid(2)), ("s2", uid(3))]
    assert made.long.count() == 9 and made.dictionary.count() == 3
    assert checks.duplicate_pairs(made.long).count() == 0
    first = made.long.filter("sample_id = 's0' and gene_id_base = 'ENSG0'").first()
    assert first["tpm_unstranded"] == 1.5 and first["gene_name"] == "name0" and uid(1) in first["source_file"]
    assert {p.name for p in (root / "trusted" / "long").iterdir() if p.is_dir()} == {"cancer_type=OV", "cancer_type=GBM"}
    assert rows(counts.consistency(made.long, made.samples)) == [(3, 3, 3, 3, 3)]


def test_manifest_of_the_lake(spark, lake, rows):
    root, meta, _ = lake
    found = measurements.list_raw_files(spark, str(root / "raw"))
    states = manifest.manifest_states(manifest.ingest_manifest(meta, found))
    assert rows(states) == [("missing", 1), ("present", 5)]


def test_publish_and_read_back(spark, lake, rows):
    root, _, made = lake
    space = f"db_{uuid.uuid4().hex}"
    spark.sql(f"CREATE DATABASE {space}")
    try:
        refined.publish_refined(made, space)
        trusted.publish_trusted(spark, str(root / "trusted"), f"{space}.trusted_")
        trusted.publish_trusted(spark, str(root / "trusted"), f"{space}.copied_", copy=True)
        for kind in ("trusted", "copied"):
            assert spark.table(f"{space}.{kind}_long").count() == 9
            assert spark.table(f"{space}.{kind}_samples").count() == spark.table(f"{space}.{kind}_dictionary").count() == 3
        assert rows(tables.load_refined(spark, "conteo_clases", namespace=space)) == [("GBM", "gbm", 1, 1), ("OV", "ov", 2, 2)]
        status = {r["clave"]: r["existe"] for r in tables.table_status(spark, namespace=space).collect()}
        assert not status.pop("metricas") and not status.pop("matriz_genes") and all(status.values())
        assert tables.find_tables(spark, "refined_*", space).count() == 10
        top = tables.load_refined(spark, "top_genes", namespace=space)
        assert top.groupBy("cancer_type").count().filter("count > 10").count() == 0
        assert set(top.columns) == {"cancer_type", "rank_gen", "gene_id_base", "gene_name", "avg_log2_tpm"}
    finally:
        spark.sql(f"DROP DATABASE {space} CASCADE")


def test_class_list_is_closed(lake, rows):
    _, _, made = lake
    unexpected = checks.domain_check(made.samples, list(domain.CLASS_NAMES)).filter("estado = 'unexpected'")
    assert unexpected.count() == 0


def test_ingest_evidence(spark, lake, tmp_path):
    root, meta, _ = lake
    found = manifest.ingest_manifest(meta, measurements.list_raw_files(spark, str(root / "raw")))
    evidence.export_ingest(meta, found, str(tmp_path))

    def lines(name):
        return sum(1 for _ in spark.read.text(str(tmp_path / name)).collect())

    assert lines("metadatos_completo.csv") == 7
    assert lines("metadatos_oficial.csv") == 6
    assert lines("manifest_descargas.csv") == 7


def test_models_from_stored_tables_to_scored_file(spark, tmp_path, rows):
    """Published comparison, stored model, scored file and result evidence, on well separated classes."""
    cells = [
        (f"{c}{i}", f"p{c}{i}", c, g, g.lower(), (3.0 if g[1] == c else 0.5) + (i % 7) / 10)
        for c in "ABC" for i in range(40) for g in ("gA", "gB", "gC")
    ]
    long = spark.createDataFrame(
        cells, "sample_id string, patient_id string, cancer_type string, gene_id_base string, gene_name string, log2_tpm double"
    )
    compared = modelling.compare_models(long, n_features=3, names=["LogisticRegression", "NaiveBayes"])
    space = f"db_{uuid.uuid4().hex}"
    spark.sql(f"CREATE DATABASE {space}")
    try:
        modelling.publish_comparison(compared, str(tmp_path / "model"), space)
        assert tables.load_refined(spark, "metricas", namespace=space).count() == 6
        assert len(tables.load_refined(spark, "matriz_genes", namespace=space).columns) == 6
        predictions = spark.table(f"{space}.refined_predicciones_test_mejor_modelo")
        evidence.export_results(compared.metrics, long.groupBy("cancer_type").count().withColumnRenamed("count", "n_muestras"), predictions, str(tmp_path))
        shown = spark.read.option("header", True).csv(str(tmp_path / "app_predicciones_muestra.csv"))
        assert shown.count() == predictions.count()
        assert spark.read.option("header", True).csv(str(tmp_path / "app_tabla_metricas.csv")).count() == 4
        (tmp_path / "new.csv").write_text("sample_id,patient_id,gene_id_base,log2_tpm\nx,px,gB,3.2\nx,px,gA,0.6\nx,px,zz,1\nx,px,gC,bad\n")
        scored = scoring.score_file(spark, str(tmp_path / "new.csv"), str(tmp_path / "model"), f"{space}.predicciones")
        assert rows(scored.select("sample_id", "patient_id", "cancer_predicho")) == [("x", "px", "B")]
        assert scored.columns == ["sample_id", "patient_id", "cancer_predicho", "probabilidad_predicha", "prediction", "probability_array"]
    finally:
        spark.sql(f"DROP DATABASE {space} CASCADE")


def test_features_from_the_stored_table(spark):
    cells = [(f"s{i}", f"p{i}", "AB"[i % 2], g, g, float(i % 2) * (g == "g1") + i % 3) for i in range(40) for g in ("g1", "g2")]
    long = spark.createDataFrame(
        cells, "sample_id string, patient_id string, cancer_type string, gene_id_base string, gene_name string, log2_tpm double"
    )
    stored = spark.createDataFrame([("g2", "g2", 9.0), ("g1", "g1", 1.0)], "gene_id_base string, gene_name string, sd_entre_clases double")
    compared = modelling.compare_models(long, 1, names=["NaiveBayes"], variable=stored)
    assert compared.features == ["g2"]
