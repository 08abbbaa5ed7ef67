import zlib

from pyspark.sql import functions as F

from assaylake.llm import quality, queries


def test_held_out_accuracy(spark, documents):
    """Learnt from two thirds of the labels, measured on the others."""
    sf = "/root/testdata/sf0.1"
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    got = queries.op4_quality(spark, sf).collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in got)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in got)
    held = [(r.predicted, labels[r.doc_id]) for r in got if r.held_out and r.doc_id in labels]
    good, bad = ([p == y for p, y in held if y == k] for k in (1, 0))
    assert sum(good) / len(good) > 0.97 and sum(bad) / len(bad) > 0.9
    # Calibrated: the mean score is close to the share of good texts.
    scores = [r.score for r in got if r.held_out and r.doc_id in labels]
    assert abs(sum(scores) / len(scores) - sum(y for _, y in held) / len(held)) < 0.03


def test_odd_rows(spark, odd, empty, documents, sf):
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    model = quality.fit_quality(documents, quality.training_labels(labels))
    scored = quality.score_quality(odd, model)
    assert scored.columns == odd.columns and dict(scored.dtypes)["score"] == "double"
    rows = scored.collect()
    assert len(rows) == odd.count() and all(0 <= r.score <= 1 for r in rows)
    assert len({r.score for r in rows if not r.text}) == 1
    assert quality.score_quality(empty, model).collect() == []
    assert quality.keep_good(empty, labels).collect() == []


def test_columns_named_like_the_plan(spark, documents, sf):
    """Columns of names that the plan uses change nothing and come back as they were."""
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    names = ["y", "o", "n", "quality", "score", "_quality"]
    own = documents.select("*", *(F.lit(f"own {n}").alias(n) for n in names))
    assert quality.sample_labelled(own, labels, 10, 20_000) == quality.sample_labelled(documents, labels, 10, 20_000)
    kept = quality.keep_good(own, labels)
    assert kept.columns == own.columns
    got = kept.collect()
    assert all(r[n] == f"own {n}" for r in got for n in names)
    model = quality.fit_quality(documents, quality.training_labels(labels))
    scored = quality.score_quality(documents, model).where("score >= 0.5")
    assert sorted(r.doc_id for r in got) == sorted(r.doc_id for r in scored.select("doc_id").collect())


def test_one_class_and_none(spark, odd):
    labels = lambda rows: spark.createDataFrame(rows, "doc_id long, quality int")
    only = quality.fit_quality(odd, labels([(4, 1), (9, 1), (None, 1), (5, None), (99, 0)]))
    assert all(r.score > 0.5 for r in quality.score_quality(odd, only).collect())
    none = quality.fit_quality(odd, labels([]))
    assert {r.score for r in quality.score_quality(odd, none).collect()} == {0.5}


def test_sample_is_bounded(spark, documents, sf):
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    drawn = quality.sample_labelled(documents, labels, per_class=10, max_bytes=20_000)
    assert all(len(t) <= 10 and sum(map(len, t)) <= 20_000 for t in drawn.values())
