import math
import statistics

import pytest
from pyspark.sql import functions as F

from assaylake import bind
from assaylake.operators import matrix, moments, profiles, ranking

LONG = "cancer_type string, gene_id_base string, gene_name string, file_id string, sample_id string, tpm_unstranded double, log2_tpm double"


@pytest.fixture(scope="module")
def small(spark):
    rows = [("A", f"g{i % 3}", f"n{i % 3}", f"f{i % 4}", f"s{i % 4}", float(i % 5), 10.0 + i % 7) for i in range(60)]
    rows += [("B", "g0", "n0", "f9", "s9", None, None), ("B", "g1", "n1", "f9", "s9", 0.0, 1.5), ("C", "g2", "n2", "f8", "s8", None, None)]
    return spark.createDataFrame(rows, LONG)


def close(a, b):
    return all(x == y or isinstance(x, float) and isinstance(y, float) and math.isclose(x, y, abs_tol=1e-9) for r, s in zip(a, b, strict=True) for x, y in zip(r, s, strict=True))


def ordered(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_merged_parts_equal_the_whole(small):
    keys = ["cancer_type", "gene_id_base", "gene_name"]
    whole = moments.feature_moments(small)
    merged = moments.merge_moments(moments.feature_moments(small, ["file_id"]), keys)
    assert merged.columns == whole.columns and close(ordered(whole.orderBy(keys)), ordered(merged.orderBy(keys)))
    row = merged.filter("cancer_type = 'A' and gene_id_base = 'g0'").first()
    values = [10.0 + i % 7 for i in range(60) if i % 3 == 0]
    assert math.isclose(row["mean"], statistics.mean(values)) and math.isclose(row["squares"], statistics.pvariance(values) * 20)
    assert merged.filter("cancer_type = 'C'").select("n", "mean").collect() == [(0, None)]


def test_reports_equal_those_from_the_long_table(small):
    found = moments.feature_moments(small)
    assert ordered(moments.quality_of(found)) == ordered(profiles.quality(small))
    assert close(ordered(moments.variability_of(found)), ordered(ranking.variability(small)))
    assert ordered(moments.top_features_of(found, 2)) == ordered(ranking.top_features(small, 2))


def test_scaler_deviations_equal_those_of_the_matrix(spark, sf):
    long = bind.long(spark, sf)
    features = ["Brand#1", "Brand#2", "Brand#3"]
    wide = matrix.to_matrix(long, features, unique=True)
    n = bind.samples(spark, sf).count()
    missing = n - wide.count()  # samples without any of these features have no row in this matrix
    values = {f: [r[f] for r in wide.select(f).collect()] + [0.0] * missing for f in features}
    got = {r.gene_id_base: r.sd for r in moments.scaler_deviations(moments.feature_moments(long), n).collect()}
    assert all(math.isclose(got[f], statistics.stdev(values[f]), rel_tol=1e-9) for f in features)


def test_moments_scan_the_long_table_once_for_all_reports(small, tmp_path):
    moments.feature_moments(small).write.parquet(str(tmp_path / "m"))
    stored = small.sparkSession.read.parquet(str(tmp_path / "m"))
    for report in (moments.quality_of(stored), moments.variability_of(stored), moments.top_features_of(stored)):
        assert all("/m/" in f for f in report.inputFiles())


def test_sketches_of_any_set_of_files(spark):
    rows = spark.range(30_000).select(
        F.lit("A").alias("cancer_type"), (F.col("id") % 30).cast("string").alias("file_id"),
        F.when(F.col("id") % 11 > 0, (F.xxhash64("id") % 1000) / 7.0).alias("log2_tpm"),
    )
    sketches = moments.value_sketches(rows)
    assert sketches.count() == 30
    few = rows.filter("file_id < '2'").select("file_id").distinct()
    for files, held in ((None, rows), (few, rows.filter("file_id < '2'"))):
        found = moments.quantiles_of(sketches, profiles.QUARTILES, ["cancer_type"], files)
        assert found.first()["n"] == held.filter("log2_tpm is not null").count()
        errors = [r.rank_error for r in moments.rank_errors(held, found, profiles.QUARTILES).collect()]
        assert len(errors) == 3 and max(errors) <= moments.RANK_BOUND
    exact = found.select("cancer_type", "n", F.lit(-1e9).alias("q1_log2_tpm"), F.lit(1e9).alias("mediana_log2_tpm"), "q3_log2_tpm")
    off = {r.quantile: r.rank_error for r in moments.rank_errors(held, exact, profiles.QUARTILES).collect()}
    assert off["q1_log2_tpm"] == 0.25 and off["mediana_log2_tpm"] == 0.5
