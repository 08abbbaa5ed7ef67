import json

import pytest

from assaylake import domain
from assaylake.sources import measurements, metadata, new_samples, tables

U1 = "11111111-2222-3333-4444-555555555555"
U2 = "aaaaaaaa-bbbb-cccc-dddd-eeeeeeeeeeee"


def hit(file_id, cases, access="open", workflow=domain.WORKFLOW):
    return {
        "file_id": file_id, "file_name": f"{file_id}.tsv", "file_size": 10, "access": access,
        "data_category": domain.DATA_CATEGORY, "data_type": domain.DATA_TYPE,
        "analysis": {"workflow_type": workflow}, "cases": cases,
    }


def case(case_id, samples, project="PRJ-OV"):
    return {"case_id": case_id, "submitter_id": f"sub-{case_id}", "project": {"project_id": project}, "samples": samples}


def sample(sample_id):
    return {"sample_id": sample_id, "submitter_id": f"sub-{sample_id}", "sample_type": "Primary Tumor"}


@pytest.fixture
def hits(spark, tmp_path):
    listed = [
        hit("f1", [case("c1", [sample("s1"), sample("s2")]), case("c2", [sample("s3")])]),
        hit("f2", []),
        hit("f3", [case("c3", [])]),
        hit("f4", [case("c4", [sample("s4")], project="PRJ-XX")]),
    ]
    (tmp_path / "top.json").write_text(json.dumps({"hits": listed[:2]}, indent=1))
    (tmp_path / "nested.json").write_text(json.dumps({"data": {"hits": listed[2:]}}))
    return metadata.explode_hits(metadata.read_hits(spark, str(tmp_path)))


def test_flatten(hits, rows):
    flat = metadata.flatten_metadata(hits, domain.study_projects("PRJ-"))
    got = {r["file_id"]: r.asDict() for r in flat.collect()}
    assert set(got) == {"f1", "f3", "f4"}
    assert (got["f1"]["case_id"], got["f1"]["sample_id"], got["f1"]["cancer_type"]) == ("c1", "s1", "OV")
    assert got["f3"]["sample_id"] is None and got["f3"]["sample_type"] is None
    assert got["f4"]["cancer_type"] == got["f4"]["cancer_name"] == domain.UNKNOWN


def test_select_files(spark, hits, rows):
    assert rows(metadata.select_files(hits, ["PRJ-OV"]).select("file_id")) == [("f1",), ("f3",)]
    assert rows(metadata.select_files(hits, ["PRJ-OV"], limit=1).select("file_id")) == [("f1",)]
    assert metadata.select_files(hits, ["PRJ-OV"], access="controlled").count() == 0


def test_metadata_csv_and_official_files(spark, tmp_path, rows):
    head = "file_id,file_name,file_size,case_id,case_submitter_id,sample_id,sample_submitter_id,sample_type,project_id,cancer_type,cancer_name"
    body = ["a,a.tsv,5,c,cs,s,ss,PRIMARY tumor,P,OV,Ov", "b,b.tsv,,c,cs,s,ss,,P,OV,Ov", "c,c.tsv,7,c,cs,s,ss,Primary Tumor,P,ZZ,Zz"]
    (tmp_path / "m.csv").write_text("\n".join([head, *body]))
    frame = metadata.read_metadata_csv(spark, str(tmp_path / "m.csv"))
    assert dict(frame.dtypes)["file_size"] == "bigint"
    assert rows(metadata.official_files(frame).select("file_id", "file_size")) == [("a", 5)]


@pytest.fixture
def raw(tmp_path):
    header = "gene_id\tgene_name\tgene_type\tunstranded\tstranded_first\tstranded_second\ttpm_unstranded\tfpkm_unstranded\tfpkm_uq_unstranded"
    line = "{}\t{}\t{}\t1\t1\t1\t{}\t1\t1"
    one = ["# gene-model: v36", header, line.format("N_unmapped", "", "", ""), line.format("G1.1", "A", "protein_coding", "3.0"),
           line.format("G1.2", "A", "protein_coding", ""), line.format("G2.1", "B", "lncRNA", "1.0")]
    two = [header, line.format("G1", "A", "protein_coding", "0.0")]
    for uid, lines, name in ((U1, one, "x.rna_seq.augmented_star_gene_counts.tsv"), (U2, two, "y.RNA_seq.augmented_star_gene_counts.tsv")):
        (tmp_path / uid).mkdir()
        (tmp_path / uid / name).write_text("\n".join(lines) + "\n")
    (tmp_path / U2 / "notes.tsv").write_text("")
    return str(tmp_path)


def test_measurements(spark, raw, rows):
    frame = measurements.with_file_id(measurements.read_measurements(spark, raw))
    assert rows(frame.select("file_id", "gene_id", "tpm_unstranded")) == sorted(
        [(U1, "N_unmapped", None), (U1, "G1.1", 3.0), (U1, "G1.2", None), (U1, "G2.1", 1.0), (U2, "G1", 0.0)], key=repr
    )
    assert [r["file_id"] for r in measurements.file_id_check(frame).collect()] == [U1, U2]
    assert measurements.file_id_check(frame, 1).count() == 1


def test_listing_opens_no_file(spark, raw):
    files = measurements.list_raw_files(spark, raw)
    assert {r["file_id"] for r in files.collect()} == {U1, U2}
    count, first = measurements.raw_file_summary(files, 1)
    assert count.first()[0] == 2 and first.count() == 1
    assert "content" not in files.columns


def test_new_samples_contract(spark, tmp_path):
    (tmp_path / "ok.csv").write_text("sample_id,patient_id,gene_id_base,log2_tpm\ns,p,g,1.5\n")
    (tmp_path / "bad.csv").write_text("sample_id,gene_id_base\ns,g\n")
    assert dict(new_samples.read_new_samples(spark, str(tmp_path / "ok.csv")).dtypes)["log2_tpm"] == "string"
    with pytest.raises(ValueError, match="log2_tpm, patient_id"):
        new_samples.read_new_samples(spark, str(tmp_path / "bad.csv"))


def test_refined_by_key(spark, tmp_path, rows):
    (tmp_path / "refined_conteo_clases.csv").write_text(
        "cancer_type,cancer_name,n_muestras,n_pacientes\nOV,Ov,3,2\nGBM,Gbm,x,1\n"
    )
    folder = str(tmp_path)
    got = tables.load_refined(spark, "conteo_clases", "csv", folder)
    assert rows(got) == [("GBM", "Gbm", None, 1), ("OV", "Ov", 3, 2)]
    assert tables.load_refined(spark, "conteo_clases", "csv", folder, limit=1).count() == 1
    missing = tables.load_refined(spark, "metricas", "csv", folder)
    assert missing.count() == 0 and len(missing.columns) == 14
    with pytest.raises(KeyError):
        tables.load_refined(spark, "nothing", "csv", folder)
    status = {r["clave"]: (r["existe"], r["filas"], r["columnas"]) for r in tables.table_status(spark, "csv", folder).collect()}
    assert status["conteo_clases"] == (True, 2, 4)
    assert status["metricas"] == (False, 0, 0)
    assert len(status) == 7
    assert tables.load_refined(spark, "matriz_genes", "csv", folder).columns == []
    (tmp_path / "refined_ml_matriz.csv").write_text("sample_id,patient_id,cancer_type,G1\ns,p,OV,1.5\n")
    assert tables.load_refined(spark, "matriz_genes", "csv", folder).columns[-1] == "G1"


def test_table_or_compute(spark):
    made = tables.table_or_compute(spark, "assaylake_not_there", lambda: spark.range(3))
    assert made.count() == 3
    status = tables.table_status(spark)
    assert status.filter("existe").count() == 0


def test_many_folders_are_listed_by_few_tasks(spark, tmp_path):
    """A folder a file, as raw files come: listing starts a few tasks for each core, not one for each folder."""
    for i in range(400):
        (tmp_path / f"folder{i}").mkdir()
        (tmp_path / f"folder{i}" / "part-a.tsv").write_text("gene_id\n")
    context, group = spark.sparkContext, f"listing-{tmp_path.name}"
    context.setJobGroup(group, "listing")
    try:
        assert measurements.list_raw_files(spark, str(tmp_path), "part-").count() == 400
    finally:
        context.setLocalProperty("spark.jobGroup.id", None)
    tracker = context.statusTracker()
    stages = [s for job in tracker.getJobIdsForGroup(group) for s in tracker.getJobInfo(job).stageIds]
    tasks = [info.numTasks for s in stages if (info := tracker.getStageInfo(s))]
    assert 1 < max(tasks) <= max(32, 4 * context.defaultParallelism) < 400
