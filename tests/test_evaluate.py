import random

import pytest
from pyspark.sql import functions as F

from assaylake.operators import curves, evaluate

PRED = "modelo string, split string, sample_id string, patient_id string, cancer_type string, label int, prediction int, probability array<double>"


def predictions(n, k, seed, model="m", split="test", ties=True, absent=()):
    rnd = random.Random(seed)
    out = []
    for i in range(n):
        label = rnd.choice([c for c in range(k) if c not in absent])
        scores = [round(rnd.random(), 1 if ties else 6) for _ in range(k)]
        out.append((model, split, f"s{i}", f"p{i}", f"c{label}", label, scores.index(max(scores)), scores))
    return out


def frame(spark, data):
    return spark.createDataFrame(data, PRED)


def names(k):
    return [f"c{i}" for i in range(k)]


def class_scores(data, k):
    """Precision, recall, F1 and support from their definitions."""
    out = []
    for c in range(k):
        tp = sum(r[5] == c and r[6] == c for r in data)
        predicted, support = sum(r[6] == c for r in data), sum(r[5] == c for r in data)
        p, rec = (tp / predicted if predicted else 0.0), (tp / support if support else 0.0)
        out.append((p, rec, 2 * p * rec / (p + rec) if p + rec else 0.0, support))
    return out


def pairwise_auc(data, c):
    pos = [r[7][c] for r in data if r[5] == c]
    neg = [r[7][c] for r in data if r[5] != c]
    if not pos or not neg:
        return None
    return sum((a > b) + 0.5 * (a == b) for a in pos for b in neg) / (len(pos) * len(neg))


def average_precision(data, c):
    total = sum(r[5] == c for r in data)
    if not total or total == len(data):
        return None
    area = 0.0
    for t in sorted({r[7][c] for r in data}, reverse=True):
        chosen = [r for r in data if r[7][c] >= t]
        hits, new = sum(r[5] == c for r in chosen), sum(r[5] == c and r[7][c] == t for r in data)
        area += new / total * hits / len(chosen)
    return area


@pytest.mark.parametrize("seed, absent", [(1, ()), (2, (3,)), (3, (0, 1))])
def test_threshold_scores(spark, seed, absent):
    data = predictions(120, 4, seed, absent=absent)
    pred, want = frame(spark, data), class_scores(data, 4)
    prf = evaluate.prf_metrics(pred, 4).first()
    for at, score in enumerate(("precision", "recall", "f1")):
        assert prf[f"{score}_macro"] == pytest.approx(sum(w[at] for w in want) / 4)
        assert prf[f"{score}_weighted"] == pytest.approx(sum(w[at] * w[3] for w in want) / 120)
    acc = evaluate.accuracy_metrics(pred).first()
    assert acc["accuracy"] == pytest.approx(sum(r[5] == r[6] for r in data) / 120)
    seen = [w[1] for w in want if w[3]]
    assert acc["balanced_accuracy"] == pytest.approx(sum(seen) / len(seen))
    if not absent:
        assert acc["balanced_accuracy"] == pytest.approx(prf["recall_macro"])


@pytest.mark.parametrize("buckets", [1, 5, 64])
def test_ranking_scores_against_pairs(spark, buckets):
    data = predictions(150, 3, 5)
    for r in curves.rank_metrics_by_class(frame(spark, data), 3, buckets=buckets).collect():
        assert r["roc_auc"] == pytest.approx(pairwise_auc(data, r["k"]))
        assert r["average_precision"] == pytest.approx(average_precision(data, r["k"]))


def test_ranking_scores_of_several_models_and_splits(spark):
    parts = {(m, s): predictions(60, 3, hash((m, s)) % 97, m, s, ties=False) for m in ("a", "b") for s in ("train", "test")}
    got = curves.rank_metrics(frame(spark, sum(parts.values(), [])).repartition(5), 3).collect()
    assert len(got) == 4
    for r in got:
        data = parts[(r["modelo"], r["split"])]
        assert r["roc_auc_macro_ovr"] == pytest.approx(sum(pairwise_auc(data, c) for c in range(3)) / 3)
        assert r["pr_auc_macro_ovr"] == pytest.approx(sum(average_precision(data, c) for c in range(3)) / 3)


def test_perfect_and_constant_scorers(spark):
    perfect = [("p", "test", "s", "p", "c", i % 2, i % 2, [float(i % 2 == 0), float(i % 2 == 1)]) for i in range(10)]
    constant = [("c", "test", "s", "p", "c", i % 2, 0, [0.5, 0.5]) for i in range(10)]
    got = {r["modelo"]: r for r in curves.rank_metrics(frame(spark, perfect + constant), 2).collect()}
    assert got["p"]["roc_auc_macro_ovr"] == 1.0 and got["p"]["pr_auc_macro_ovr"] == 1.0
    assert got["c"]["roc_auc_macro_ovr"] == 0.5 and got["c"]["pr_auc_macro_ovr"] == 0.5


def test_undefined_ranking_scores_are_null(spark):
    r = curves.rank_metrics(frame(spark, predictions(40, 3, 9, absent=(2,))), 3).first()
    assert r["roc_auc_macro_ovr"] is None and r["pr_auc_macro_ovr"] is None
    single = [("m", "test", "s", "p", "c", 0, 0, [0.4, 0.6])] * 3
    assert curves.roc_auc_ovr(frame(spark, single), 2).first()[2] is None


def test_confusion_has_all_cells(spark):
    data = predictions(80, 4, 11, absent=(2,))
    long = evaluate.confusion(frame(spark, data), names(4))
    cells = {(r["true_class"], r["predicted_class"]): r["n"] for r in long.collect()}
    assert len(cells) == 16 and sum(cells.values()) == 80
    assert cells[("c2", "c0")] == 0
    assert cells[("c0", "c1")] == sum(r[5] == 0 and r[6] == 1 for r in data)
    wide = {r["true_class"]: r for r in evaluate.confusion_wide(long, names(4)).collect()}
    assert wide["c0"]["c1"] == cells[("c0", "c1")] and len(wide) == 4


def test_prediction_outside_the_labels(spark):
    data = [("m", "test", "s", "p", "c0", 0, 7, [0.1, 0.9]), ("m", "test", "s", "p", "c1", 1, 1, [0.1, 0.9])]
    pred = frame(spark, data)
    assert evaluate.accuracy_metrics(pred).first()["accuracy"] == 0.5
    assert evaluate.prf_metrics(pred, 2).first()["recall_macro"] == 0.5
    assert sum(r["n"] for r in evaluate.confusion(pred, names(2)).collect()) == 1
    assert {r["cancer_predicho"] for r in evaluate.prediction_table(pred, names(2)).collect()} == {"DESCONOCIDO", "c1"}


def test_class_report(spark):
    data = predictions(90, 3, 13)
    rows = {r["clase"]: r for r in evaluate.class_report(frame(spark, data), names(3)).collect()}
    assert set(rows) == {"c0", "c1", "c2", "accuracy", "macro avg", "weighted avg"}
    for c, want in enumerate(class_scores(data, 3)):
        r = rows[f"c{c}"]
        assert (r["precision"], r["recall"], r["f1-score"], r["support"]) == pytest.approx(want)
    assert rows["accuracy"]["support"] == rows["accuracy"]["precision"]
    assert rows["macro avg"]["support"] == rows["weighted avg"]["support"] == 90


def test_top_errors(spark, rows):
    data = [("m", "t", "s", "p", "c0", 0, 1, []), ("m", "t", "s", "p", "c0", 0, 1, []), ("m", "t", "s", "p", "c1", 1, 0, []), ("m", "t", "s", "p", "c1", 1, 1, [])]
    table = evaluate.prediction_table(frame(spark, data), names(2))
    assert rows(evaluate.top_errors(table, "cancer_type", "cancer_predicho"), sort=False) == [("c0", "c1", 2), ("c1", "c0", 1)]


def test_curves_start_and_end(spark):
    data = predictions(100, 4, 17)
    pred = frame(spark, data)
    top = evaluate.top_support(pred, 2)
    assert top.count() == 2
    roc = curves.roc_points(pred, names(4), top)
    assert roc.select("clase").distinct().count() == 2
    for cls in [r[0] for r in roc.select("clase").distinct().collect()]:
        points = sorted((r["fpr"], r["tpr"]) for r in roc.filter(F.col("clase") == cls).collect())
        assert points[0] == (0.0, 0.0) and points[-1] == (1.0, 1.0)
        area = sum((b[0] - a[0]) * (a[1] + b[1]) / 2 for a, b in zip(points, points[1:]))
        assert area == pytest.approx(pairwise_auc(data, int(cls[1:])))
    pr = [(r["recall"], r["precision"]) for r in curves.pr_points(pred, names(4), top).collect()]
    assert pr.count((0.0, 1.0)) >= 2
    areas = curves.curve_areas(pred, names(4), top).collect()
    assert {r["roc_auc"] == pytest.approx(pairwise_auc(data, int(r["clase"][1:]))) for r in areas} == {True}


def metrics(spark, rows):
    schema = "modelo string, split string, accuracy double, balanced_accuracy double, f1_macro double, pr_auc_macro_ovr double"
    return spark.createDataFrame(rows, schema)


def test_gap_and_choice(spark):
    table = metrics(spark, [
        ("a", "train", 0.9, 0.9, 0.9, None), ("a", "validation", 0.8, 0.8, 0.7, None), ("a", "test", 0.8, 0.8, 0.7, None),
        ("b", "validation", 0.8, 0.8, 0.7, 0.4), ("c", "validation", 0.8, 0.7, 0.7, 0.9), ("c", "train", 0.8, 0.7, 0.7, 0.9),
    ])
    gaps = {(r["modelo"], r["split"]): r["gap_f1_macro_train_validation"] for r in evaluate.overfit_gap(table).collect()}
    assert gaps[("a", "test")] == pytest.approx(0.2) and gaps[("b", "validation")] is None
    assert gaps[("c", "train")] == pytest.approx(0.0)
    assert evaluate.select_best(table).first()["modelo"] == "b"
    assert evaluate.stack_metrics([table, table]).count() == 12


def test_metrics_table_columns(spark):
    data = sum((predictions(40, 3, s, "m", name) for s, name in enumerate(("train", "validation", "test"))), [])
    table = evaluate.metrics_table(frame(spark, data), 3)
    assert table.columns[:2] == ["modelo", "split"] and len(table.columns) == 14 and table.count() == 3
    report = evaluate.metrics_report(table).collect()
    assert [r["split"] for r in report] == ["test", "validation"]


@pytest.mark.parametrize("buckets", [1, 3, 50])
def test_corners_are_the_turns_of_the_curve(spark, buckets):
    import random

    rng, classes = random.Random(5), 3
    data = [("m", "s", rng.randrange(classes), [rng.randrange(25) / 25 for _ in range(classes)]) for _ in range(300)]
    data += [("m", None, i % 2, [0.5, 0.5, 0.5]) for i in range(6)] + [("m", "clear", i % 3, [float(i % 3 == k) + i / 1000 for k in range(3)]) for i in range(90)]
    pred = spark.createDataFrame(data, "modelo string, split string, label int, probability array<double>")
    only = spark.createDataFrame([("m", s, k) for s in ("s", "clear") for k in range(classes)], "modelo string, split string, k int")
    labels = ["c0", "c1", "c2"]

    def curves_of(corners):
        out = {}
        for r in curves.roc_points(pred, labels, only, buckets=buckets, corners=corners).collect():
            out.setdefault((r.split, r.clase), set()).add((r.fpr, r.tpr))
        return {k: sorted(v) for k, v in out.items()}

    every, turns = curves_of(False), curves_of(True)
    area = lambda at: sum((x2 - x1) * (y1 + y2) / 2 for (x1, y1), (x2, y2) in zip(at, at[1:]))
    assert set(every) == set(turns) and len(every) == 6
    for key, points in every.items():
        kept = turns[key]
        assert set(kept) <= set(points) and kept[0] == (0, 0) and kept[-1] == (1, 1)
        assert area(kept) == pytest.approx(area(points), abs=1e-12)
        cross = [(b[0] - a[0]) * (c[1] - b[1]) - (b[1] - a[1]) * (c[0] - b[0]) for a, b, c in zip(kept, kept[1:], kept[2:])]
        assert all(abs(x) > 1e-12 for x in cross)
    assert all(len(turns["clear", c]) == 3 and len(every["clear", c]) > 60 for c in labels)
