import re
from collections import Counter, defaultdict

import duckdb
import pytest
from pyspark.sql import functions as F

from assaylake.llm import queries, registry, setm


def plain(rows, longest, least, pct, top):
    """Phrases counted one by one; ``rows`` are (lang, text)."""
    f, n = Counter(), Counter()
    for lang, text in rows:
        lang, text = "und" if lang is None else lang, re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split("[.,;:!?\n\x0b\x0c\r]", text):
            words = tuple(re.findall("[^ \t]+", piece))
            n[lang] += len(words)
            for k in range(1, longest + 1):
                f.update((lang, words[i : i + k]) for i in range(len(words) - k + 1))
    found = defaultdict(list)
    for (lang, words), a in f.items():
        m = len(words)
        if m < 2 or a < least:
            continue
        around = [b for (of, w), b in f.items() if of == lang and len(w) > m and b >= least and any(w[i : i + m] == words for i in range(len(w)))]
        if any(100 * b >= pct * a for b in around):
            continue
        score, _, left, right = min((10**6 * a * a // (x * y), k, x, y) for k in range(1, m) for x, y in [(f[lang, words[:k]], f[lang, words[k:]])])
        found[lang].append((-score, -a, " ".join(words).encode(), left, right))
    return sorted(
        (lang, rank, phrase.decode(), -a, left, right, n[lang], -score)
        for lang, rows in found.items() for rank, (score, a, phrase, left, right) in enumerate(sorted(rows)[:top], start=1)
    )


TEXTS = [
    ("en", "New York city, New York state. new york"), ("en", "a a a a a a\ta"), (None, "São Paulo São Paulo; são paulo"), ("und", "São Paulo"),
    ("en", None), (None, None), ("en", ""), ("en", " \t.,;\n"), ("fr", "New York\x0bNew\x0cYork\rNew York"), ("fr", "x\x85y z x\x85y z new york"),
    ("en", "New York city, New York state. new york"), ("de", "." * 50 + "eins zwei drei vier fünf " * 40 + "?"), ("de", "eins zwei"),
]


@pytest.mark.parametrize("chunk_bytes", [1, 90, 1 << 20])
@pytest.mark.parametrize("longest, least, pct, top", [(3, 2, 50, 2000), (2, 1, 50, 3), (5, 3, 80, None)])
def test_equals_counting_one_by_one(spark, chunk_bytes, longest, least, pct, top):
    frame = spark.createDataFrame(TEXTS, "lang string, text string").withColumns({c: F.lit("x") for c in ("word", "chunk", "n", "left", "gid", "f")})
    got = setm.mine_phrases(frame.repartition(3), longest=longest, least=least, absorbed_pct=pct, top=top, chunk_bytes=chunk_bytes)
    assert got.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    assert sorted(tuple(r) for r in got.collect()) == plain(TEXTS, longest, least, pct, top)


def test_odd_rows_and_no_rows(spark, odd, empty):
    texts = odd.withColumn("lang", F.col("source"))
    got = setm.mine_phrases(texts, least=30)
    want = plain([(r.lang, r.text) for r in texts.collect()], 3, 30, 50, 2000)
    assert sorted(tuple(r) for r in got.collect()) == want and want
    assert setm.mine_phrases(empty.withColumn("lang", F.lit("en"))).collect() == []


def test_scores_beyond_64_bits(spark):
    big = 3_000_000_000_000
    row = spark.createDataFrame([(big, big, big), (big - 1, big, big)], "a long, l long, r long").select(setm._score(F.col("a"), F.col("l"), F.col("r")))
    assert [r[0] for r in row.collect()] == [1_000_000, 10**6 * (big - 1) ** 2 // big**2]


def test_relations_are_sorted_and_groups_are_sent_once_a_chunk(spark, documents):
    relation = setm.word_occurrences(documents, chunk_bytes=100_000)
    assert relation.count() > 3
    for row in relation.select("lang", "word", "n", "relation").collect():
        piece, pos, group = setm._unpacked(row.relation)
        order = list(zip(piece.tolist(), pos.tolist(), strict=True))
        assert order == sorted(set(order)) and len(set(zip(row.lang, row.word, strict=True))) == len(row.word)
        assert Counter(group.tolist()) == dict(enumerate(row.n))


def test_query_equals_sql(spark, sf):
    db = duckdb.connect()
    db.execute(f"CREATE VIEW documents AS SELECT * FROM '{sf}/documents.parquet'")
    got = queries.op11_phrases(spark, sf)
    want = db.execute(f"SELECT {', '.join(got.columns)} FROM ({registry.ORACLE_SQL['op11_phrases']})").fetchall()
    assert sorted(tuple(r) for r in got.collect()) == sorted(want)


def test_a_chunk_of_many_frequent_groups_is_sent_in_rows(spark, documents, monkeypatch):
    """Every group is frequent; Spark gets no array of them, and no relation is shuffled."""
    monkeypatch.setattr(setm, "SENT", 1000)
    relation = setm.word_occurrences(documents, chunk_bytes=100_000)
    frequent = setm.frequent_groups(relation, ["lang", "word"], 1)
    assert frequent.count() == relation.select(F.sum(F.size("word"))).first()[0] > 1000
    longer = setm.next_relation(relation, frequent)
    assert longer.collect() and not any(kind.startswith("array") for _, kind in longer.dtypes)
    plan = longer._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert "collect_list" not in plan and plan.count("Exchange hashpartitioning") == 1
    for row in longer.collect():
        groups = setm._unpacked_groups(row.groups)
        assert [len(g) for g in groups.values()] == [row.size] * 3
        assert Counter(setm._unpacked(row.relation)[2].tolist()) == dict(enumerate(groups["n"].to_pylist()))


def test_no_task_ranks_a_language(spark):
    """The best of each part of a language are ranked again, and no others."""
    words = [f"w{i}" for i in range(60)]
    rows = [("en", f"{a} {b}") for i, a in enumerate(words) for b in words[: i + 1]]
    got = setm.mine_phrases(spark.createDataFrame(rows, "lang string, text string"), longest=2, least=1, top=5)
    assert sorted(tuple(r) for r in got.collect()) == plain(rows, 2, 1, 50, 5)
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert re.search(r"pmod\(xxhash64\(phrase", plan)
