import pytest
from pyspark.sql import functions as F

from assaylake.operators import checks, prepare
from assaylake.roles import DEFAULT as R

META = "file_id string, file_name string, file_size bigint, case_id string, case_submitter_id string, sample_id string, sample_submitter_id string, sample_type string, project_id string, cancer_type string, cancer_name string"
MEAS = "file_id string, gene_id string, gene_name string, gene_type string, tpm_unstranded double, source_file string"


def meta_row(file, sample, size=1, cls="OV", kind="Primary Tumor", case="case"):
    return (file, f"{file}.tsv", size, "c", case, sample, f"{sample}-long-submitter", kind, "P", cls, cls.lower() if cls else None)


@pytest.fixture
def metadata(spark):
    return spark.createDataFrame(
        [
            meta_row("f1", "s1", 5), meta_row("f2", "s1", 9), meta_row("f3", "s1", None),
            meta_row("f5", "s2", 4), meta_row("f4", "s2", 4), meta_row("f6", "s3", None, kind="primary TUMOR - again"),
            meta_row("f7", "s4", 3, kind=None), meta_row("f8", "s5", 3, cls="ZZ"), meta_row("f9", "s6", 3, kind="Normal"),
        ],
        META,
    )


@pytest.fixture
def measurements(spark):
    files = ["f1", "f2", "f3", "f4", "f5", "f7", "f8", "f9"]
    rows = [(f, "G1.1", "b", "protein_coding", 3.0, f"/{f}") for f in files]
    rows += [("f2", "G1.2", "a", "protein_coding", None, "/f2"), ("f2", "G1.3", None, "protein_coding", 1.0, "/f2")]
    rows += [("f2", "N_x", None, None, 1.0, "/f2"), ("f2", "G2", "c", "lncRNA", 1.0, "/f2"), ("f2", None, "c", "protein_coding", 1.0, "/f2")]
    return spark.createDataFrame(rows, MEAS)


def test_clean_drops_technical_null_and_other_types(measurements, rows):
    clean = prepare.clean_measurements(measurements).filter("file_id = 'f2'")
    assert rows(clean.select(R.feature, R.measure, R.value)) == [("G1", 0.0, 0.0), ("G1", 1.0, 1.0), ("G1", 3.0, 2.0)]


def test_dedupe_prefers_large_then_known_then_id(metadata, rows):
    got = prepare.dedupe_samples(prepare.candidate_samples(metadata))
    assert rows(got.select("sample_id", "file_id")) == [
        ("s1", "f2"), ("s2", "f4"), ("s3", "f6"), ("s4", "f7"), ("s5", "f8"), ("s6", "f9")
    ]


def test_files_without_rows_are_not_chosen(spark, metadata, measurements, rows):
    clean = prepare.clean_measurements(measurements)
    got = prepare.chosen_files(clean, metadata, ["OV"])
    assert rows(got.select("sample_id", "file_id")) == [("s1", "f2"), ("s2", "f4")]
    listed = spark.createDataFrame([("f1",), ("f6",)], "file_id string")
    assert rows(prepare.chosen_files(clean, metadata, ["OV"], present=listed).select("file_id")) == [("f1",), ("f6",)]


@pytest.mark.parametrize("parts", [2, 7])
def test_trusted_long_equals_the_row_level_way(metadata, measurements, rows, parts):
    measurements, metadata = measurements.repartition(parts), metadata.repartition(parts)
    clean = prepare.clean_measurements(measurements)
    chosen = prepare.chosen_files(clean, metadata, ["OV"])
    long = prepare.trusted_long(measurements, chosen)
    official = prepare.official_samples(metadata, ["OV"])
    joined = prepare.attach_metadata(clean, official)
    plain = prepare.enforce_grain(
        prepare.select_present(prepare.keep_selected(joined, chosen), R.long_columns)
    ).select(R.long_columns)
    assert long.columns == R.long_columns
    assert rows(long) == rows(plain)
    assert checks.duplicate_pairs(long).count() == 0
    s1 = long.filter("sample_id = 's1'").first()
    assert (s1[R.measure], s1[R.value], s1[R.feature_name]) == (pytest.approx(4 / 3), 1.0, "a")


def test_unbounded_side_is_shuffled_not_broadcast(metadata, measurements, rows, monkeypatch):
    from assaylake.operators import sizing

    clean = prepare.clean_measurements(measurements)
    chosen = prepare.chosen_files(clean, metadata, ["OV"])
    want = rows(prepare.trusted_long(measurements, chosen))
    monkeypatch.setattr(prepare, "is_small", lambda df: False)
    spark = metadata.sparkSession
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plain = prepare.trusted_long(measurements, chosen)
        assert rows(plain) == want
        assert "Broadcast" not in plain._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert not sizing.is_small(spark.range(5), 4) and sizing.is_small(spark.range(4), 4)


def test_select_present_and_restrict(spark, measurements):
    assert prepare.select_present(measurements, ["nope", "gene_id", "file_id"]).columns == ["gene_id", "file_id"]
    clean = prepare.clean_measurements(measurements)
    assert prepare.restrict_features(clean, ["G1"]).count() == clean.count()
    assert prepare.restrict_features(clean, ["G9"]).count() == 0
    frame = spark.createDataFrame([("G1",), ("G1",)], "gene_id_base string")
    assert prepare.restrict_features(clean, frame).count() == clean.count()


def test_feature_dictionary_keeps_both_names(measurements, rows):
    names = prepare.feature_dictionary(prepare.clean_measurements(measurements))
    assert rows(names.select(R.feature_name)) == [("a",), ("b",), (None,)]
