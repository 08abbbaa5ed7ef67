"""Cases that once gave wrong results."""

import uuid

import pytest
from pyspark.sql import functions as F

from assaylake.functions import to_number
from assaylake.models import scoring, training
from assaylake.operators import intake, matrix, ordered, ranking
from assaylake.plans import modelling, trusted
from assaylake.roles import Roles
from assaylake.session import scratch_folder, shared_folder
from assaylake.sinks import exports, tables
from assaylake.sources import metadata, new_samples, tables as stored


def test_no_cap_on_listed_files(spark):
    hit = "named_struct('file_id', string(id), 'cases', array(named_struct('project', named_struct('project_id', 'P'))))"
    listed = spark.range(20_500).select(F.expr(hit).alias("hit")).select("hit.*", F.lit("c").alias("data_category"), F.lit("t").alias("data_type"),
        F.struct(F.lit("w").alias("workflow_type")).alias("analysis"), F.lit("open").alias("access"))
    assert metadata.select_files(listed, ["P"], "c", "t", "w", "open").count() == 20_500
    assert metadata.select_files(listed, ["P"], "c", "t", "w", "open", limit=3).count() == 3


def test_metadata_csv_is_bound_by_name(spark, tmp_path):
    path = tmp_path / "meta.csv"
    path.write_text('project_id,file_size,extra,sample_id,file_id,cancer_type,file_name\nP1,5,x,S1,F1,A,"a ""b"", c"\n')
    row = metadata.read_metadata_csv(spark, str(path)).first()
    assert (row.file_id, row.sample_id, row.project_id, row.file_size, row.cancer_type, row.case_id) == ("F1", "S1", "P1", 5, "A", None)
    assert row.file_name == 'a "b", c'
    path.write_text("project_id,file_id\nP1,F1\n")
    with pytest.raises(ValueError, match="sample_id"):
        metadata.read_metadata_csv(spark, str(path))


def test_files_beside_the_raw_ones_are_not_read(spark, tmp_path):
    file_id = str(uuid.UUID(int=7))
    folder = tmp_path / "raw" / file_id
    folder.mkdir(parents=True)
    head = "gene_id\tgene_name\tgene_type\tunstranded\tstranded_first\tstranded_second\ttpm_unstranded\tfpkm_unstranded\tfpkm_uq_unstranded\n"
    for name, value in (("x.rna_seq.augmented_star_gene_counts.tsv", 3), ("backup.tsv", 1023), ("x.rna_seq.augmented_star_gene_counts.tsv.bak", 99)):
        (folder / name).write_text(f"# comment\n{head}G1.1\tg1\tprotein_coding\t1\t1\t1\t{value}\t1\t1\n")
    meta = spark.createDataFrame([(file_id, "n", 5, "c", "subject-0001-x", "s", "sub", "Primary Tumor", "P", "BRCA", "Breast")], metadata.METADATA_SCHEMA)
    made = trusted.build_trusted(spark, meta, str(tmp_path / "raw"), str(tmp_path / "out"))
    assert [r.tpm_unstranded for r in made.long.collect()] == [3.0]


def test_new_samples_under_other_names(spark):
    r = Roles(sample="probe", subject="person", feature="trait", value="level", cls="kind")
    rows = [(f"s{i}", f"p{i}", t, float(i % 2) * 3 + j, "ab"[i % 2]) for i in range(8) for j, t in enumerate(("t1", "t2"))]
    long = spark.createDataFrame(rows, "probe string, person string, trait string, level double, kind string")
    wide = matrix.to_matrix(long, ["t1", "t2"], r=r).withColumn("split", F.lit("train"))
    model = training.train_all(wide, ["t1", "t2"], ["NaiveBayes"], r=r)["NaiveBayes"]
    # The uploaded cell comes twice; its mean counts.
    new = spark.createDataFrame([("n", "q", "t1", "0"), ("n", "q", "t1", "6"), ("n", "q", "t2", "4")], "probe string, person string, trait string, level string")
    assert scoring.score_new(new, model, ["t1", "t2"], r).select("probe", "person").collect() == [("n", "q")]


def test_a_feature_with_two_names_counts_once(spark):
    variable = spark.createDataFrame([("g1", "a", 3.0), ("g1", "b", 2.0), ("g2", "c", 1.0)], "gene_id_base string, gene_name string, sd_entre_clases double")
    assert ranking.select_features(variable, 2) == ["g1", "g2"]
    with pytest.raises(ValueError, match="more than once"):
        matrix.to_matrix(variable, ["g1", "g1"])
    with pytest.raises(ValueError, match="more than once"):
        matrix.to_vectors(variable, ["g1", "g1"])


def test_a_short_table_of_features_is_an_error(spark):
    variable = spark.createDataFrame([("g1", "a", 3.0)], "gene_id_base string, gene_name string, sd_entre_clases double")
    with pytest.raises(ValueError, match="2 are asked for"):
        modelling.compare_models(None, n_features=2, variable=variable)


@pytest.mark.parametrize("by", [(), ("k",)])
def test_publish_over_its_own_source(spark, by):
    name = f"t_{uuid.uuid4().hex}"
    try:
        tables.publish(spark.range(10).withColumn("k", F.col("id") % 2), name, by)
        tables.publish(spark.table(name).filter("id > 6"), name, by)
        assert sorted(r.id for r in spark.table(name).collect()) == [7, 8, 9]
        with pytest.raises(Exception):
            tables.publish(spark.range(3).select(F.expr("raise_error('no')").alias("id"), F.lit(1).alias("k")), name, by)
        assert spark.table(name).count() == 3
        assert len(tables.versions(spark, name)) == 2
    finally:
        tables.unpublish(spark, name)


def test_fractional_running_totals(spark):
    df = spark.createDataFrame([("a", i, 0.5) for i in range(10)], "k string, v int, w double")
    got = ordered.running_totals(df, ["k"], ["v"], ["w"], buckets=3).orderBy("v").collect()
    assert [r.cum_w for r in got] == [0.5 * (i + 1) for i in range(10)] and {r.all_w for r in got} == {5.0}


def test_buckets_grow_with_the_group(spark, monkeypatch):
    monkeypatch.setattr(ordered, "ROWS", 50)
    sizes = {}
    for n in (1_000, 10_000):
        df = spark.range(n).select(F.lit("a").alias("k"), F.col("id").alias("v"), F.lit(1).alias("n"))
        placed = ordered._place_by_sample(df, ["k"], "v", ["n"], 8, False).groupBy("_bucket").count().collect()
        sizes[n] = (len(placed), max(r["count"] for r in placed))
        got = ordered.running_totals(df, ["k"], ["v"], ["n"], buckets=8)
        assert got.filter("cum_n <> v + 1").count() == 0
    assert sizes[10_000][0] > 5 * sizes[1_000][0] and sizes[10_000][1] < 1_000


def test_dots_in_names_of_new_samples(spark, tmp_path):
    path = tmp_path / "new.csv"
    path.write_text("sample_id,patient_id,gene_id_base,log2_tpm,a.b\ns,p,g,1,x\n")
    assert new_samples.read_new_samples(spark, str(path)).columns[-1] == "a.b"


def test_empty_names_fit_nothing():
    assert intake.find_column(["%%", "Sample ID"], ["sample"]) == "Sample ID"
    assert intake.find_column(["%%"], ["sample"]) is None
    assert intake.find_column(["abc"], ["--"]) is None
    assert intake.find_column(["sample_id_2", "other", "Sample-Id"], ["x", "sample id"]) == "Sample-Id"


@pytest.mark.parametrize("name, plain", [("Año (nº 2)", "ano_no_2"), ("  A--b__C ", "a_b_c"), ("ﬁle", "file"), ("日本", ""), ("x²", "x2")])
def test_standard_names(name, plain):
    assert intake.standard_name(name) == plain


def test_numbers_are_not_read_as_text(spark):
    df = spark.createDataFrame([(1, 2.5, "3"), (None, float("nan"), "x")], "a int, b double, c string")
    got = df.select(*(to_number(f.name, f.dataType).alias(f.name) for f in df.schema)).collect()
    assert [tuple(r) for r in got] == [(1.0, 2.5, 3.0), (None, None, None)]
    plan = intake.profile_columns(df.select("a", "b"))._jdf.queryExecution().toString()
    assert "RLIKE" not in plan
    checked = intake.validate_new_samples(spark.createDataFrame([("s", "p", "g", 1.0)], "sample_id string, patient_id string, gene_id_base string, log2_tpm double"))
    assert "Expand" not in checked._jdf.queryExecution().toString() and checked.first().valido


def test_quotes_in_exports(spark, tmp_path):
    df = spark.createDataFrame([('say "x", then \\',)], "t string")
    exports.export_csv(df, str(tmp_path / "e"))
    assert [r.t for r in stored.read_csv_table(spark, str(tmp_path / "e"), "t string").collect()] == ['say "x", then \\']
    text = next((tmp_path / "e").glob("part-*.csv")).read_text()
    assert '"say ""x"", then' in text


def test_shared_folder_is_the_checkpoint_folder(spark):
    assert spark.sparkContext.getCheckpointDir().startswith(f"{shared_folder(spark)}/")
    assert scratch_folder(spark, "a") != scratch_folder(spark, "a")
