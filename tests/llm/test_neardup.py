import random
import re
from collections import Counter

from assaylake.llm import neardup, queries
from assaylake.llm.shingles import signatures


def _words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def _sets(texts, k):
    for t in texts:
        w = _words(t)
        yield frozenset(tuple(w[i : i + k]) for i in range(len(w) - k + 1)) if len(w) >= k else frozenset([tuple(w)] if w else [])


def _plain(texts, k=2, similarity=80):
    """Place of the first member of each text's group, by comparing every pair that shares a shingle."""
    sets, holders = list(_sets(texts, k)), {}
    group = list(range(len(sets)))

    def top(x):
        while group[x] != x:
            x = group[x]
        return x

    for i, s in enumerate(sets):
        for j, n in Counter(j for x in s for j in holders.get(x, ())).items():
            if 100 * n >= similarity * (len(s) + len(sets[j]) - n):
                a, b = sorted((top(i), top(j)))
                group[b] = a
        for x in s:
            holders.setdefault(x, []).append(i)
    return [len(s) for s in sets], [top(i) for i in range(len(sets))]


def test_query_equals_all_pairs(spark, sf, documents, rows):
    docs = sorted((r.doc_id, r.text) for r in documents.collect())
    sizes, groups = _plain([t for _, t in docs])
    want = [(i, n, docs[g][0], g == at) for at, ((i, _), n, g) in enumerate(zip(docs, sizes, groups))]
    assert rows(queries.op8_neardup(spark, sf)) == sorted(want, key=repr)


def test_chain_of_near_copies(spark):
    """Links join a chain whose ends are not similar; a group's hub is not linked with all of it."""
    words = [f"w{i}" for i in range(100)]
    texts = [" ".join([f"v{j}" for j in range(6 * i)] + words[6 * i :]) for i in range(12)]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = neardup.near_duplicates(frame, k=2, similarity=80).collect()
    _, groups = _plain(texts)
    assert {r.doc_id: r.component_id for r in found} == dict(enumerate(groups)) and set(groups) == {0}


def test_large_buckets_equal_all_pairs(spark, monkeypatch):
    """Copies of two texts, altered lightly or heavily, in buckets that take the core of their group instead of pairs."""
    monkeypatch.setattr(neardup, "SMALL", 4)
    monkeypatch.setattr(neardup, "RARE", 3)
    monkeypatch.setattr(neardup, "SHARE", 16)
    rng = random.Random(5)
    bases, texts = [[f"{c}{i}" for i in range(60)] for c in "ab"], []
    for i in range(160):
        words = list(bases[i % 2])
        for at in rng.sample(range(60), rng.choice([1, 2, 3, 5, 8, 12])):
            words[at] = f"r{rng.randrange(12)}"
        texts.append(" ".join(words[: rng.choice([60, 60, 60, 50])]))
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = neardup.near_duplicates(frame, k=2, similarity=80).collect()
    _, groups = _plain(texts)
    assert 20 < len(set(groups)) < 120
    assert {r.doc_id: r.component_id for r in found} == dict(enumerate(groups))


def test_odd_rows(odd, empty):
    found = {(r.doc_id, r.n_shingles): r for r in neardup.near_duplicates(odd, k=2).collect()}
    assert found[1, 0].component_id == 1 and found[3, 0].kept and found[2, 0].kept
    assert [r for r in found.values() if r.doc_id == 5][0].component_id == 4
    assert {r.component_id for r in found.values() if r.doc_id is None} == {4, 6}
    assert neardup.near_duplicates(empty).collect() == []
    assert neardup.keep_one(empty).collect() == []


def test_one_of_each_group_stays(odd):
    kept = neardup.keep_one(odd, k=5)
    assert kept.columns == odd.columns
    got = kept.collect()
    assert {(r.doc_id, r.text, r.node) for r in got} <= {(r.doc_id, r.text, r.node) for r in odd.collect()}
    assert sorted(r.doc_id for r in got if r.doc_id is not None) == [1, 2, 3, 4, 6, 7, 9, 10, 11, 12]  # 8 shares the passage with 7
    # A null id counts as larger than all others.
    assert not any(r.doc_id is None for r in got)


def test_signatures_estimate_the_similarity():
    import numpy as np

    shared = np.random.default_rng(1).integers(0, 2**63, 1200, np.uint64)
    value = np.concatenate((shared[:1000], shared[200:]))
    of = np.repeat([0, 1], 1000)
    made = signatures(value, of, 2, 960)
    assert abs((made[0] == made[1]).mean() - 800 / 1200) < 0.06
