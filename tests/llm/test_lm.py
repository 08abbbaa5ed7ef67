import math
import re
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from assaylake.llm import lm, queries


def _tokens(text):
    return re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or "")) + ["</s>"]


def _plain(docs):
    """(text, trains) one by one: tokens, known ones, training tokens, base score and score."""
    words, pairs, contexts = Counter(), Counter(), Counter()
    for text, trains in docs:
        if trains:
            t = _tokens(text)
            words.update(t)
            pairs.update(zip(["<s>", *t], t))
            contexts.update(["<s>", *t[:-1]])
    n, v, arcs = sum(words.values()), len(words), Counter(a for a, _ in pairs)
    once, twice = (sum(c == m for c in pairs.values()) for m in (1, 2))
    d = once / (once + 2 * twice) if once and twice else 0.5
    for text, _ in docs:
        t, base, score = _tokens(text), 0.0, 0.0
        for a, b in zip(["<s>", *t], t):
            root = (words[b] + 1) / (n + v + 1)
            base += math.log10(root)
            held = d * arcs[a] / contexts[a] if contexts[a] else 1.0
            score += math.log10(max(pairs[a, b] - d, 0) / max(contexts[a], 1) + held * root)
        yield len(t), sum(words[x] > 0 for x in t), n, base, score


def _same(got, want):
    assert len(got) == len(want)
    for a, b in zip(got, want):
        assert a[:3] == b[:3] and a[3:] == pytest.approx(b[3:], rel=1e-9)


def _scores(frame):
    return [tuple(r)[1:] for r in sorted(frame.collect(), key=repr)]


def test_query_equals_plain_model(spark, sf, documents):
    docs = sorted((r.doc_id, r.text) for r in documents.collect())
    want = list(_plain([(t, zlib.crc32(str(i).encode()) % 7 != 2) for i, t in docs]))
    got = {r.doc_id: r for r in queries.op10_lm(spark, sf).collect()}
    _same([tuple(got[i][c] for c in ("n_tokens", "n_known", "train_tokens", "base_score", "score")) for i, _ in docs], want)
    assert all(got[i].held_out == (zlib.crc32(str(i).encode()) % 7 == 2) for i, _ in docs)
    held = [r for r in got.values() if r.held_out]
    assert sum(r.score for r in held) > sum(r.base_score for r in held)  # the contexts help on texts not learnt from


def test_odd_rows(odd, empty):
    frame = odd.withColumn("at", F.monotonically_increasing_id())
    rows = [(r.at, r.text, r.doc_id is not None and r.doc_id % 2 == 0) for r in frame.collect()]
    scored = lm.score_texts(frame, F.col("doc_id") % 2 == 0)
    got = {r["at"]: (r.n_tokens, r.n_known, r.train_tokens, r.base_score, r.score) for r in scored.collect()}
    _same([got[a] for a, _, _ in rows], list(_plain([(t, y) for _, t, y in rows])))
    assert "node" in scored.columns and scored.columns.count("score") == 1
    assert lm.score_texts(empty, F.lit(True)).collect() == []


def test_nothing_to_learn_from(odd):
    for r in lm.score_texts(odd, F.lit(False)).collect():
        assert (r.n_known, r.train_tokens, r.base_score, r.score) == (0, 0, 0.0, 0.0)
