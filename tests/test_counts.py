import pytest

from assaylake.operators import checks, counts, profiles, ranking
from assaylake.roles import DEFAULT as R

LONG = "sample_id string, patient_id string, cancer_type string, cancer_name string, sample_type string, gene_id_base string, gene_name string, gene_type string, tpm_unstranded double, log2_tpm double"


def row(sample, subject, cls, feature, measure, value, kind="Primary Tumor"):
    return (sample, subject, cls, cls and cls.lower(), kind, feature, feature.lower(), "protein_coding", measure, value)


@pytest.fixture
def long(spark):
    return spark.createDataFrame(
        [
            row("s1", "p1", "A", "G1", 3.0, 2.0), row("s1", "p1", "A", "G2", 0.0, 0.0),
            row("s2", "p1", "A", "G1", 1.0, 1.0, "Other"), row("s2", "p1", "A", "G2", None, None, "Other"),
            row("s3", "p2", "A", "G1", 7.0, 3.0),
            row("s4", "p3", "B", "G1", 0.0, 0.0), row("s4", "p3", "B", "G2", 0.0, 0.0),
        ],
        LONG,
    )


def test_summary_and_consistency(long, rows):
    samples = long.select("sample_id", "patient_id", "cancer_type").distinct()
    dictionary = long.select("gene_id_base").distinct()
    assert rows(counts.summary(long, samples, dictionary)) == [(7, 4, 4, 4, 3, 2, 2, 2)]
    assert rows(counts.consistency(long, samples)) == [(4, 4, 4, 3, 2)]
    assert rows(counts.cardinalities(long)) == [(7, 4, 3, 2)]
    assert rows(counts.table_counts({"a": long, "b": samples})) == [("a", 7), ("b", 4)]


def test_summary_of_nothing(long, rows):
    none = long.limit(0)
    assert rows(counts.summary(none, none, none)) == [(0,) * 8]


def test_class_tables(long, rows):
    assert rows(counts.class_counts(long), sort=False) == [("A", "a", 3, 2), ("B", "b", 1, 1)]
    assert rows(counts.class_imbalance(long), sort=False) == [("A", 3, 75.0, 3.0), ("B", 1, 25.0, 3.0)]
    assert rows(counts.type_counts(long), sort=False) == [("Primary Tumor", 3, 3), ("Other", 1, 1)]
    assert rows(counts.samples_per_subject(long), sort=False) == [("A", 2, 1, 2), ("B", 1, 0, 1)]
    assert rows(counts.samples_per_class(long), sort=False) == [("A", 3), ("B", 1)]
    assert rows(counts.files_per_class(long), sort=False) == [("A", 5), ("B", 2)]


def test_quality_and_detected(long, rows):
    assert rows(profiles.quality(long), sort=False) == [("B", 2, 0, 0, 2, 100.0), ("A", 5, 1, 1, 1, 20.0)]
    assert rows(profiles.detected_features(long), sort=False) == [
        ("A", 3, 1.0, 0.0, 1, 1, 66.67), ("B", 1, 0.0, None, 0, 0, 0.0)
    ]


def test_value_stats_exact_and_approximate_agree_here(long, rows):
    exact = rows(profiles.value_stats(long, exact=True))
    assert exact == [("A", 5, 1.5, 1.291, 0.0, 0.0, 1.0, 2.0, 3.0), ("B", 2, 0.0, 0.0, 0.0, 0.0, 0.0, 0.0, 0.0)]
    assert rows(profiles.value_stats(long)) == exact


def test_null_class_is_a_group_of_its_own(spark, rows):
    frame = spark.createDataFrame([row("s", "p", None, "G1", 3.0, 2.0), row("t", "p", "A", "G1", 3.0, 1.0)], LONG)
    assert rows(profiles.value_stats(frame, exact=True).select("cancer_type", "mediana_log2_tpm")) == [("A", 1.0), (None, 2.0)]


def test_rankings(long, rows):
    assert rows(ranking.top_features(long, 1), sort=False) == [("A", 1, "G1", "g1", 2.0), ("B", 1, "G1", "g1", 0.0)]
    assert rows(ranking.variable_features(long, 1)) == [("G1", "g1", 1.0, 1.4142, 2.0)]
    assert ranking.select_features(ranking.variability(long), 2) == ["G1", "G2"]


def test_top_features_break_ties_by_id(spark, rows):
    tied = spark.createDataFrame([row("s", "p", "A", g, 1.0, 1.0) for g in ("G3", "G1", "G2")], LONG)
    assert [r[2] for r in rows(ranking.top_features(tied.repartition(3), 2), sort=False)] == ["G1", "G2"]


def test_checks(spark, long, rows):
    assert rows(checks.duplicate_pairs(long.union(long.filter("sample_id = 's3'")))) == [("s3", "G1", 2)]
    samples = spark.createDataFrame(
        [("s", "f1", "p1", None), ("s", "f2", "p1", "B"), ("s", "f2", "p2", "A"), ("t", "f3", "p3", "A")],
        "sample_id string, file_id string, patient_id string, cancer_type string",
    )
    assert rows(checks.duplicate_samples(samples)) == [("s", 3, 2, 2, "A")]
    assert rows(checks.domain_check(long, ["A", "C"])) == [("B", "unexpected"), ("C", "missing")]
    split = spark.createDataFrame(
        [("p1", "train"), ("p1", "test"), ("p2", "train"), ("p3", "validation"), ("p3", "test"), ("p3", "test")],
        "patient_id string, split string",
    )
    assert rows(checks.leakage_check(split)) == [(0, 1, 1)]
    assert rows(checks.shared_values(split.filter("split = 'train'"), split.filter("split = 'test'"), R.subject)) == [("p1",)]
