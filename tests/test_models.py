import random

import pytest
from pyspark.sql import functions as F

from assaylake.models import scoring, storage, training
from assaylake.operators import evaluate, matrix
from assaylake.plans import modelling

FEATURES = ["G1", "G2", "G3", "G4"]


def values(spark, seed=3):
    """Three classes of unequal size, each with its own raised feature; G4 carries nothing."""
    rnd = random.Random(seed)
    out = []
    for cls, n in (("A", 60), ("B", 40), ("C", 30)):
        for i in range(n):
            for at, g in enumerate(FEATURES):
                out.append((f"{cls}{i}", f"p{cls}{i // 2}", cls, g, g.lower(), (3.0 if "ABC"[at % 3] == cls and at < 3 else 1.0) + rnd.random()))
    return spark.createDataFrame(out, "sample_id string, patient_id string, cancer_type string, gene_id_base string, gene_name string, log2_tpm double")


@pytest.fixture(scope="module")
def compared(spark):
    return modelling.compare_models(values(spark), n_features=3)


def test_comparison(compared):
    assert set(compared.features) == {"G1", "G2", "G3"}
    assert compared.labels == ["A", "B", "C"]
    rows = {(r["modelo"], r["split"]): r for r in compared.metrics.collect()}
    assert len(rows) == 9
    for (model, split), r in rows.items():
        assert r["roc_auc_macro_ovr"] is not None and r["pr_auc_macro_ovr"] is not None
        assert r["f1_macro"] > (0.6 if model == "NaiveBayes" else 0.95)
    assert compared.best_name in training.PIPELINES
    assert compared.best() is compared.models[compared.best_name]
    with pytest.raises(KeyError):
        training.pick(compared.models, "nothing")


def test_pipelines_have_the_stated_parameters(compared):
    lr = compared.models["LogisticRegression"].stages[-1]
    assert (lr.getMaxIter(), lr.getRegParam(), lr.getElasticNetParam(), lr.getFamily()) == (100, 0.1, 0.0, "multinomial")
    assert lr.getFeaturesCol() == "features_scaled"
    rf = compared.models["RandomForest"].stages[-1]
    assert (rf.getNumTrees, rf.getMaxDepth(), rf.getMaxBins(), rf.getSeed()) == (100, 8, 32, 42)
    nb = compared.models["NaiveBayes"].stages[-1]
    assert (nb.getSmoothing(), nb.getModelType()) == (1.0, "multinomial")


def test_reports_of_the_best_model(compared):
    reports = modelling.best_model_reports(compared)
    table = reports["refined_predicciones_test_mejor_modelo"]
    assert table.columns == ["sample_id", "patient_id", "cancer_type", "cancer_predicho", "label", "prediction"]
    n = compared.split.filter("split = 'test'").count()
    assert table.count() == n
    assert reports["refined_matriz_confusion_mejor_modelo"].agg(F.sum("n")).first()[0] == n
    assert reports["refined_reporte_clasificacion_por_clase"].count() == 6
    assert reports["refined_curvas_roc"].select("clase").distinct().count() == 3


def test_unknown_classes_are_set_aside(spark, compared):
    model = compared.models["NaiveBayes"]
    odd = compared.split.limit(1).withColumn("cancer_type", F.lit("Z"))
    mixed = compared.split.unionByName(odd)
    assert training.predict(model, "m", mixed).count() == compared.split.count()
    assert [tuple(r) for r in training.unknown_classes(mixed, model).collect()] == [("Z", odd.first()["split"], 1)]
    assert compared.unknown.count() == 0


def test_unknown_classes_count_samples_without_a_chosen_feature(spark):
    long = values(spark)
    odd = [(f"Z{i}", "pZ", "Z", g, g.lower(), 1.5) for i in range(3) for g in (FEATURES if i < 2 else FEATURES[3:])]
    odd.append(("Z9", "pZ9", "Z", "G4", "g4", 1.5))
    found = modelling.compare_models(long.unionByName(spark.createDataFrame(odd, long.schema)), n_features=3, names=["NaiveBayes"])
    assert "G4" not in found.features
    assert sorted(map(tuple, found.unknown.collect()), key=repr) == [("Z", "test", 3), ("Z", None, 1)]


def test_store_load_and_score(spark, compared, tmp_path):
    path = str(tmp_path / "best")
    storage.save_model(spark, compared.models["LogisticRegression"], path, compared.features)
    storage.save_model(spark, compared.models["LogisticRegression"], path, compared.features)
    model, features = storage.load_model(path), storage.load_features(spark, path)
    assert features == compared.features and training.label_names(model) == ["A", "B", "C"]
    new = values(spark, seed=9).filter("sample_id in ('A1', 'B1', 'C1')").select(
        "sample_id", "patient_id", "gene_id_base", F.col("log2_tpm").cast("string").alias("log2_tpm")
    )
    got = {r["sample_id"]: r for r in scoring.score_new(new, model, features).collect()}
    assert {k: r["cancer_predicho"] for k, r in got.items()} == {"A1": "A", "B1": "B", "C1": "C"}
    for r in got.values():
        assert len(r["probability_array"]) == 3 and sum(r["probability_array"]) == pytest.approx(1.0)
        assert r["probabilidad_predicha"] == r["probability_array"][int(r["prediction"])] == max(r["probability_array"])
    with pytest.raises(ValueError):
        scoring.score_new(new.withColumn("gene_id_base", F.lit("zzz")), model, features)


def test_vectors_train_the_same_model(spark):
    long = values(spark)
    wide = matrix.stratified_split(matrix.to_matrix(long, FEATURES))
    vectors = matrix.stratified_split(matrix.to_vectors(long, FEATURES))
    by_columns = training.train_all(wide, FEATURES, ["NaiveBayes"])["NaiveBayes"]
    by_vectors = training.train_all(vectors, None, ["NaiveBayes"])["NaiveBayes"]
    assert by_columns.stages[-1].theta.toArray() == pytest.approx(by_vectors.stages[-1].theta.toArray())
    scores = evaluate.accuracy_metrics(training.predict(by_vectors, "m", vectors))
    assert scores.count() == 3
    new = long.select("sample_id", "patient_id", "gene_id_base", F.col("log2_tpm").cast("string").alias("log2_tpm"))
    assert scoring.score_new(new, by_vectors, FEATURES).count() == 130
