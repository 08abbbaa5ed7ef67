import hashlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from assaylake.functions import vector_values
from assaylake.operators import checks, counts, matrix

LONG = "sample_id string, patient_id string, cancer_type string, gene_id_base string, log2_tpm double"


@pytest.fixture
def long(spark):
    return spark.createDataFrame(
        [("s1", "p1", "A", "G1", 1.0), ("s1", "p1", "A", "G1", 3.0), ("s1", "p1", "A", "G9", 5.0),
         ("s2", "p1", "A", "G2", 4.0), ("s3", "p2", "B", "G1", None), ("s4", "p2", "B", "G9", 1.0)],
        LONG,
    )


def test_matrix_order_mean_and_missing(long, rows):
    wide = matrix.to_matrix(long, ["G2", "G1"])
    assert wide.columns == ["sample_id", "patient_id", "cancer_type", "G2", "G1"]
    assert rows(wide) == [("s1", "p1", "A", 0.0, 2.0), ("s2", "p1", "A", 4.0, 0.0), ("s3", "p2", "B", 0.0, 0.0)]


def test_vectors_hold_the_matrix(long, rows):
    vectors = matrix.to_vectors(long, ["G2", "G1"]).select("sample_id", vector_values("features_raw").alias("v"))
    assert {r["sample_id"]: r["v"] for r in vectors.collect()} == {"s1": [0.0, 2.0], "s2": [4.0, 0.0], "s3": [0.0, 0.0]}


@pytest.mark.parametrize("block", [1, 2, 3, 7, 256])
def test_vector_blocks(spark, block):
    """Cells of all, some and no blocks of a sample, for blocks that divide the features and that do not."""
    features = [f"F{i}" for i in range(7)]
    cells = [("all", "p", "A", f, float(i + 1)) for i, f in enumerate(features)]
    cells += [("last", "p", "A", "F6", 9.0), ("middle", "p", "A", "F3", 4.0), ("null", "p", "A", "F0", None)]
    long = spark.createDataFrame(cells, LONG)
    want = {"all": [1.0, 2.0, 3.0, 4.0, 5.0, 6.0, 7.0], "last": [0.0] * 6 + [9.0], "middle": [0.0] * 3 + [4.0] + [0.0] * 3, "null": [0.0] * 7}
    for unique in (True, False):
        vectors = matrix.to_vectors(long, features, unique=unique, block=block)
        got = {r[0]: r[1] for r in vectors.select("sample_id", vector_values("features_raw")).collect()}
        assert got == want


def subjects(spark, sizes):
    rows = [(f"{c}-{i}-{j}", f"{c}-{i}", c) for c, n in sizes.items() for i in range(n) for j in range(1 + i % 2)]
    return spark.createDataFrame(rows, "sample_id string, patient_id string, cancer_type string")


@pytest.mark.parametrize("seed", [42, 7])
def test_split_is_the_rank_share_of_the_hash(spark, seed):
    sizes = {"one": 1, "two": 2, "twenty": 20, "many": 700}
    df = subjects(spark, sizes)
    got = {(r["patient_id"], r["cancer_type"]): r["split"] for r in matrix.split_subjects(df, seed).collect()}
    by_class = defaultdict(list)
    for c, n in sizes.items():
        by_class[c] = sorted((hashlib.md5(f"{c}-{i}-{seed}".encode()).hexdigest(), f"{c}-{i}") for i in range(n))
    for c, ordered in by_class.items():
        for rank, (_, subject) in enumerate(ordered, 1):
            share = rank / len(ordered)
            want = "train" if share <= 0.7 else "validation" if share <= 0.85 else "test"
            assert got[(subject, c)] == want
    assert Counter(v for (s, c), v in got.items() if c == "twenty") == {"train": 14, "validation": 3, "test": 3}
    assert got[("one-0", "one")] == "test"


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_no_subject_in_two_splits(spark, rows, seed):
    split = matrix.stratified_split(subjects(spark, {"a": 30, "b": 11}), seed)
    assert rows(checks.leakage_check(split)) == [(0, 0, 0)]
    assert split.count() == subjects(spark, {"a": 30, "b": 11}).count()


def test_split_does_not_depend_on_partitioning(spark, rows):
    df = subjects(spark, {"a": 50, "b": 9})
    assert rows(matrix.stratified_split(df.repartition(2))) == rows(matrix.stratified_split(df.repartition(7)))


def test_subject_in_two_classes_is_not_multiplied_but_reported(spark, rows):
    df = subjects(spark, {"a": 40, "b": 13}).withColumn("patient_id", F.regexp_replace("patient_id", "^[ab]", "x"))
    split = matrix.stratified_split(df)
    assert split.count() == df.count()
    assert sum(rows(checks.leakage_check(split))[0]) > 0


def test_take_and_count(spark, rows):
    split = matrix.stratified_split(subjects(spark, {"twenty": 20}))
    assert "split" not in matrix.take_split(split, "test").columns
    assert {r[0] for r in rows(counts.split_counts(split))} == {"train", "validation", "test"}
