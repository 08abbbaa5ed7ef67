"""The plans that matter at scale keep their shape."""

import io
import re
from contextlib import redirect_stdout

import pytest
from pyspark.sql import functions as F

from assaylake import bind
from assaylake.operators import counts, curves, matrix, prepare, profiles, ranking
from assaylake.sinks.tables import write_long


def plan(df, executed=False):
    if executed:
        df.collect()
    out = io.StringIO()
    with redirect_stdout(out):
        df.explain("simple")
    return re.sub(r"#\d+L?", "", out.getvalue()).split("== Initial Plan ==")[0]


@pytest.fixture(scope="module")
def stored(spark, sf, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("stored") / "long")
    write_long(bind.long(spark, sf), path, ["cancer_type"], ["gene_id_base"])
    return spark.read.parquet(path)


def test_reports_read_only_their_columns(stored):
    text = plan(profiles.quality(stored))
    assert "ReadSchema: struct<tpm_unstranded:double,log2_tpm:double>" in text
    assert text.count("Exchange hashpartitioning") == 1


def test_class_filter_prunes_partitions_and_feature_filter_reaches_the_scan(stored):
    text = plan(stored.filter("cancer_type = 'BUILDING' and gene_id_base = 'Brand#1'").select("log2_tpm"))
    assert "PartitionFilters: [isnotnull(cancer_type), (cancer_type = BUILDING)]" in text
    assert "EqualTo(gene_id_base,Brand" in text


def test_sample_counts_shrink_the_long_table_first(stored):
    text = plan(counts.class_counts(stored))
    lowest = [line for line in text.splitlines() if "HashAggregate" in line or "Expand" in line]
    assert "Expand" not in lowest[-1] and "Expand" not in lowest[-2]


def test_top_k_is_cut_before_the_shuffle(stored):
    text = plan(ranking.top_features(stored))
    assert re.search(r"Exchange hashpartitioning\(cancer_type, \d+\)[^\n]*\n[^\n]*WindowGroupLimit", text)


def test_one_file_per_sample_is_cut_before_the_shuffle(spark, sf):
    text = plan(prepare.dedupe_samples(bind.candidates(spark, sf)))
    assert re.search(r"Exchange hashpartitioning\(sample_id, \d+\)[^\n]*\n[^\n]*WindowGroupLimit", text)


def test_pivot_of_a_unique_table_has_one_shuffle(stored):
    text = plan(matrix.to_matrix(stored, ["Brand#1", "Brand#2"], unique=True))
    assert text.count("Exchange") == 1


def test_ranking_scores_scan_once(spark, sf):
    text = plan(curves.rank_metrics(bind.scored(spark, sf), 10), executed=True)
    assert text.count("FileScan") == 1 and "ReusedExchange" in text
    assert "CartesianProduct" not in text and "NestedLoop" not in text


def test_exact_quantiles_share_one_shuffle_of_the_values(stored):
    text = plan(profiles.value_stats(stored, exact=True), executed=True)
    assert text.count("FileScan") == 2 and "ReusedExchange" in text


def test_split_ranks_inside_class_and_bucket(spark, sf):
    rows = bind.samples(spark, sf).select("sample_id", "patient_id", "cancer_type")
    text = plan(matrix.split_subjects(rows), executed=True)
    assert re.search(r"Exchange hashpartitioning\(cancer_type, _bucket", text)
    assert "ReusedExchange" in text


def test_no_python_workers(stored):
    frames = [counts.class_counts(stored), profiles.value_stats(stored, exact=True), ranking.variable_features(stored)]
    for frame in frames:
        assert "Python" not in plan(frame) and "Arrow" not in plan(frame)


@pytest.mark.parametrize("parts", [2, 7])
def test_hot_sample_and_hot_cell(spark, rows, parts):
    """A third of all files belong to one sample, and a third of all rows to one cell."""
    files = [(f"f{i}", "hot" if i % 3 == 0 else f"s{i}", i % 50) for i in range(600)]
    candidates = spark.createDataFrame(files, "file_id string, sample_id string, file_size bigint").repartition(parts)
    chosen = prepare.dedupe_samples(candidates)
    assert chosen.count() == 401
    best = min((-s, f) for f, name, s in files if name == "hot")[1]
    assert rows(chosen.filter("sample_id = 'hot'").select("file_id")) == [(best,)]
    cells = spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, "f").otherwise(F.concat(F.lit("f"), "id")).alias("file_id"),
        F.lit("G").alias("gene_id_base"),
        F.col("id").cast("double").alias("log2_tpm"),
    )
    grain = prepare.enforce_grain(cells.repartition(parts), ["file_id", "gene_id_base"])
    assert grain.count() == 2001
    assert grain.filter("file_id = 'f'").first()["log2_tpm"] == pytest.approx(sum(range(0, 3000, 3)) / 1000)
