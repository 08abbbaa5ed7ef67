import re
from collections import defaultdict
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from assaylake.llm import mixing, queries


def _targets(sizes, weights=(1, 2, 3), most=3):
    """Shares by weight; what is above the cap is dealt again until nothing is."""
    order = sorted((s for s in sizes if s is not None)) + [None] * (None in sizes)
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    target, open_, rest = {}, set(order), Fraction(sum(sizes.values()))
    while open_:
        total = sum(weight[s] for s in open_)
        above = {s for s in open_ if rest * weight[s] / total > most * sizes[s]}
        if not above:
            target |= {s: float(rest * weight[s] / total) for s in open_}
            break
        for s in above:
            target[s] = float(most * sizes[s])
            rest -= most * sizes[s]
        open_ -= above
    return target


def _size(text):
    return len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))


@pytest.mark.parametrize("sf", ["/root/testdata/sf0.001", "/root/testdata/sf0.1"])
def test_query_hits_its_targets(spark, sf):
    docs = {r.doc_id: r for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    of = defaultdict(int)
    for r in docs.values():
        of[r.source] += _size(r.text)
    target, taken = _targets(of), defaultdict(int)
    got = queries.op9_mixing(spark, sf).collect()
    assert len(got) == len(docs)
    for r in got:
        source = docs[r.doc_id].source
        assert (r.size, r.source_size) == (_size(docs[r.doc_id].text), of[source]) and r.target == pytest.approx(target[source])
        assert r.taken <= 3 * r.size and (not r.size or r.taken % r.size == 0)
        taken[source] += r.taken
    if sf.endswith("0.1"):
        assert all(abs(taken[s] - target[s]) < 0.15 * target[s] for s in of)
    assert sorted(map(tuple, got)) == sorted(map(tuple, queries.op9_mixing(spark, sf).collect()))


def test_cap_cascades(spark):
    """The excess of one source pushes another over its cap."""
    rows = [(i, "w " * n, s) for i, (s, n) in enumerate([("a", 1000), ("b", 10), ("c", 700), ("d", 5), (None, 3)])]
    sizes = spark.createDataFrame(rows, "doc_id long, text string, source string").select("source", mixing.word_count("text").alias("size"))
    got = {r.source: r.target for r in mixing.source_targets(sizes).collect()}
    assert got == pytest.approx(_targets({"a": 1000, "b": 10, "c": 700, "d": 5, None: 3}))


def test_columns_named_like_the_plan(odd):
    names = ["rate", "of", "target", "document", "col", "_rate", "_of", "_copy", "source_size"]
    own = odd.select("*", *(F.lit(f"own {n}").alias(n) for n in names))
    mixed = mixing.mix(own)
    assert mixed.columns == own.columns
    got = mixed.collect()
    assert len(got) == mixing.mix(odd).count() and all(r[n] == f"own {n}" for r in got for n in names)


def test_odd_rows(odd, empty):
    planned = mixing.plan_mix(odd).collect()
    of = defaultdict(int)
    for r in odd.collect():
        of[r.source] += _size(r.text)
    assert len(planned) == odd.count() and {r.source: r.target for r in planned} == pytest.approx(_targets(of))
    mixed = mixing.mix(odd)
    assert mixed.columns == odd.columns and mixed.count() == sum(r.n_copies for r in planned)
    assert mixing.plan_mix(empty).collect() == [] and mixing.mix(empty).collect() == []
