import re
from collections import Counter

import numpy as np
import public_tokenizers
import pytest

import corpus_pipeline
from assaylake.llm import pieces, quality, registry
from test_neardup import _plain as plain_groups
from test_repeats import _plain as plain_repeats

import __spark_entry__ as entry


def test_all_operators_are_registered():
    names = sorted(registry.QUERIES, key=lambda q: int(re.match(r"op(\d+)_", q)[1]))
    assert [int(re.match(r"op(\d+)_", q)[1]) for q in names] == list(range(1, 14))
    assert set(registry.ORACLE_SQL) <= set(registry.QUERIES) <= set(entry.queries())
    assert "pipeline" in entry.queries()
    assert [f.__name__ for _, f in corpus_pipeline.STAGES] == ["keep_quality", "drop_near_copies", "cut_repeats", "mix_sources", "encode_pieces"]


@pytest.fixture(scope="module")
def stages(spark, sf, documents):
    """The rows before the first stage and after each."""
    found, docs = [[r.asDict() for r in documents.collect()]], documents
    for name, stage in corpus_pipeline.STAGES:
        docs = corpus_pipeline.stored(stage(spark, docs, sf), "test")
        if "text" in docs.columns:
            assert docs.columns == documents.columns and dict(docs.dtypes) == dict(documents.dtypes)
        found.append([r.asDict() for r in docs.collect()])
    return found


def test_quality_stage(spark, sf, documents, stages):
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    model = quality.fit_quality(documents, quality.training_labels(labels))
    texts = [(r["text"] or "").encode() for r in stages[0]]
    good = quality._curve(quality._features(iter(texts), model), model.weights) >= 0.5
    assert {r["doc_id"] for r in stages[1]} == {r["doc_id"] for r, g in zip(stages[0], good) if g}
    of = {r.doc_id: r.quality for r in labels.collect()}
    kept = {r["doc_id"] for r in stages[1]}
    right = [i in kept for i, y in of.items() if y == 1]
    assert sum(right) / len(right) > 0.9


def test_near_copies_stage(stages):
    rows = sorted(stages[1], key=lambda r: r["doc_id"])
    _, groups = plain_groups([r["text"] for r in rows], k=5)
    assert {r["doc_id"]: r["text"] for r in stages[2]} == {rows[g]["doc_id"]: rows[g]["text"] for g in set(groups)}


def test_repeats_stage(stages):
    rows = stages[2]
    texts = [(r["text"] or "").encode() for r in rows]
    removed = {r["doc_id"]: p[1] for r, p in zip(rows, plain_repeats(texts, corpus_pipeline.PASSAGE_BYTES))}
    after = {r["doc_id"]: r for r in stages[3]}
    assert after.keys() == removed.keys()
    for r, t in zip(rows, texts):
        left = (after[r["doc_id"]]["text"] or "").encode()
        # Characters that lose a byte go whole: at most three more bytes at either end of a cut.
        assert len(t) - removed[r["doc_id"]] >= len(left) >= len(t) - removed[r["doc_id"]] - 6 * (removed[r["doc_id"]] > 0) * 20
        assert removed[r["doc_id"]] or left == t
        assert after[r["doc_id"]]["n_chars"] == len(left.decode())


def test_mixing_stage(stages):
    before, times = {r["doc_id"]: r for r in stages[3]}, Counter(r["doc_id"] for r in stages[4])
    assert times.keys() <= before.keys() and max(times.values()) <= 3
    assert all(r == before[r["doc_id"]] for r in stages[4])
    size = lambda rows: sum(len(r["text"].split()) for r in rows if r["text"])
    assert abs(size(stages[4]) - size(stages[3])) < 0.25 * size(stages[3])


def test_ids_stage(spark, sf, stages):
    coder = pieces.encoder(public_tokenizers.path("piece_bpe_32k.model"))
    want = sorted((r["doc_id"], np.frombuffer(coder.encode(r["text"] or ""), "<u4").tolist()) for r in stages[4])
    assert sorted((r["doc_id"], r["ids"]) for r in stages[5]) == want
    assert all(r["n_tokens"] == len(r["ids"]) for r in stages[5])
    ran = corpus_pipeline.run(spark, sf)
    assert sorted((r.doc_id, r.ids) for r in ran.collect()) == want


def test_stages_take_odd_and_empty_tables(spark, sf, odd, empty):
    for docs in (odd, empty):
        for _, stage in corpus_pipeline.STAGES:
            docs = corpus_pipeline.stored(stage(spark, docs, sf), "test")
        assert docs.columns[0] == "doc_id" and "ids" in docs.columns
    assert docs.isEmpty()
