import gc
import weakref

import numpy as np
import pytest

from assaylake.llm import balltree, nndescent, queries
from assaylake.llm.graph import components

SCHEMA = "vec_id long, embedding array<float>, label int, n_links string"
NAN, INF = float("nan"), float("inf")


@pytest.fixture(scope="module")
def vectors(spark):
    """Clusters, copies, vectors of no use, repeated ids; one cluster is larger than a neighbour list."""
    g = np.random.default_rng(5)
    rows, at = [], 0
    for size, spread in ((40, 0.02), (3, 0.05), (2, 0.05), (1, 0), (1, 0)):
        centre = g.standard_normal(12)
        for _ in range(size):
            rows.append((at, (centre + spread * g.standard_normal(12)).tolist(), 1, "x"))
            at += 1
    rows += [(at + i, g.standard_normal(12).tolist(), 0, None) for i in range(150)]
    rows += [(300, rows[41][1], 1, "x"), (301, [2 * x for x in rows[41][1]], 1, "x"), (300, rows[41][1], 1, "x")]
    rows += [(400, None, 1, "x"), (401, [0.0] * 12, 1, "x"), (402, [NAN] * 12, 1, "x"), (403, [1.0, None] * 6, 1, "x"), (404, [], 1, "x"),
             (405, [INF] + [1.0] * 11, 1, "x"), (None, rows[0][1], 1, "x"), (406, [1.0, 2.0], 1, "x")]
    return spark.createDataFrame(rows, SCHEMA)


def _unit(rows):
    usable = [r for r in rows if r.vec_id is not None and r.embedding and len(r.embedding) == 12
              and all(x is not None and np.isfinite(x) for x in r.embedding) and any(r.embedding)]
    m = np.array([r.embedding for r in usable], float)
    return usable, m / np.linalg.norm(m, axis=1, keepdims=True)


def test_links_equal_all_pairs(vectors):
    rows = vectors.collect()
    usable, unit = _unit(rows)
    linked = unit @ unit.T >= 0.9
    np.fill_diagonal(linked, False)
    reach = linked | np.eye(len(usable), dtype=bool)
    for _ in range(8):
        reach = reach @ reach
    want = sorted((r.vec_id, int(linked[i].sum()), min(usable[j].vec_id for j in np.flatnonzero(reach[i]))) for i, r in enumerate(usable))
    found = nndescent.near_vectors(vectors)
    assert found.columns == ["vec_id", "label", "n_links", "component_id", "kept", "audited_recall"]
    got = found.collect()
    assert len(got) == len(rows) and got[0].audited_recall == 1.0
    own = {r.vec_id for r in usable}
    assert sorted((r.vec_id, r.n_links, r.component_id) for r in got if r.vec_id in own) == want
    for r in got:
        assert r.kept == (r.vec_id is not None and r.vec_id == r.component_id)
        if r.vec_id not in own:
            assert (r.n_links, r.component_id) == (0, r.vec_id)


def test_vectors_of_two_lengths(spark):
    """Each length links among itself, also where its vectors are few, and its recall is audited."""
    g = np.random.default_rng(6)
    rows = [(0, [1.0, 0.0]), (2, [1.0, 0.0, 0.0]), (1, [1.0, 0.0]), (3, [1.0, 0.0, 0.0]), (4, [1.0, 0.1, 0.0]), (5, [0.0, 0.0, 1.0])]
    for d, size in ((5, 30), (9, 20)):
        centre = g.standard_normal(d)
        rows += [(100 * d + i, (centre + 0.02 * g.standard_normal(d)).tolist()) for i in range(size)]
    got = {r.vec_id: r for r in nndescent.near_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()}
    assert [(got[i].n_links, got[i].component_id) for i in range(6)] == [(1, 0), (1, 0), (2, 2), (2, 2), (2, 2), (0, 5)]
    assert {(got[500 + i].n_links, got[500 + i].component_id) for i in range(30)} == {(29, 500)}
    assert {(got[900 + i].n_links, got[900 + i].component_id) for i in range(20)} == {(19, 900)}
    assert got[0].audited_recall == 1.0


def test_groups_larger_than_a_cell(vectors, monkeypatch):
    monkeypatch.setattr(nndescent, "CELL", 7)
    got = {r.vec_id: r.n_links for r in nndescent.near_vectors(vectors).collect()}
    assert [got[i] for i in range(40)] == [39] * 40


def test_small_tight_groups_are_whole(spark):
    """Groups of 5 to 12 near copies, so that every bucket and meeting offers the same few neighbours."""
    g = np.random.default_rng(11)
    m = []
    for size in (*range(5, 13),) * 5:
        centre = g.standard_normal(16)
        m += [centre + 0.05 * g.standard_normal(16) for _ in range(size)]
    m = np.array([*m, *g.standard_normal((300, 16))])
    unit = m / np.linalg.norm(m, axis=1, keepdims=True)
    linked = unit @ unit.T >= 0.9
    np.fill_diagonal(linked, False)
    table = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(m)], "vec_id long, embedding array<double>")
    got = {r.vec_id: r.n_links for r in nndescent.near_vectors(table).collect()}
    assert [got[i] for i in range(len(m))] == linked.sum(1).tolist()


def test_audit_sees_losses_beside_a_large_group(spark):
    """All 200 vectors of one group are found whole, and none of 40 pairs."""
    g = np.random.default_rng(12)
    m = [g.standard_normal(16)] * 200
    m = [v + 0.01 * g.standard_normal(16) for v in m]
    for _ in range(40):
        centre = g.standard_normal(16)
        m += [centre, centre + 0.02 * g.standard_normal(16)]
    rows = spark.createDataFrame([(i, v.tolist(), 1) for i, v in enumerate(m)], "id long, vector array<double>, copies long")
    nodes = spark.createDataFrame([(i, 199, 0) for i in range(200)], "id long, n_links long, component long")
    assert nndescent.audit(rows, nodes, 0.9) == 0.0


def test_codes_grow_with_the_table():
    assert nndescent._trees(100, 0.9) == nndescent.TREES
    for n in (10**5, 10**6, 10**7):
        same = (1 - np.arccos(0.9) / np.pi) ** nndescent._bits(n)
        assert 1 - (1 - same) ** nndescent._trees(n, 0.9) >= nndescent.RECALL


def test_search_fails_if_the_audit_never_passes(spark, monkeypatch):
    monkeypatch.setattr(nndescent, "AGAIN", 0)
    monkeypatch.setattr(nndescent, "audit", lambda *_: 0.5)
    rows = spark.createDataFrame([(0, [1.0, 0.0]), (1, [1.0, 0.1])], "vec_id long, embedding array<double>")
    with pytest.raises(RuntimeError, match="recall"):
        nndescent.near_vectors(rows)


def test_recall_on_a_table(spark):
    sf = "/root/testdata/sf0.1"
    rows = spark.read.parquet(f"{sf}/embeddings.parquet").collect()
    m = np.array([r.embedding for r in rows], float)
    unit = m / np.linalg.norm(m, axis=1, keepdims=True)
    linked = unit @ unit.T >= 0.9
    np.fill_diagonal(linked, False)
    got = {r.vec_id: r.n_links for r in queries.op3_neighbours(spark, sf).collect()}
    found = np.array([got[r.vec_id] for r in rows])
    assert (found <= linked.sum(1)).all() and found.sum() >= 0.9 * linked.sum()


def test_empty_tables(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert nndescent.near_vectors(none).collect() == []
    assert balltree.top_products(none, lambda i: i % 2 == 0, k=5).collect() == []


def test_products_equal_all_pairs(vectors):
    """Small shards and blocks, so that bounds, waves and merging all take part."""
    found = balltree.top_products(vectors, lambda i: i % 3 == 0, k=5, shard_rows=30, query_rows=16)
    whole = {}
    for r in vectors.collect():
        if r.vec_id is not None and r.embedding and all(x is not None and np.isfinite(x) for x in r.embedding):
            whole.setdefault(r.vec_id, np.floor(256 * np.array(r.embedding, float)).astype(int))
    want = []
    for q, v in whole.items():
        if q % 3 == 0:
            best = sorted((-int(v @ w), i) for i, w in whole.items() if i != q and len(w) == len(v))[:5]
            want += [(q, n, i, -s) for n, (s, i) in enumerate(best, 1)]
    assert sorted(tuple(r) for r in found.collect()) == sorted(want)


def test_products_beyond_doubles_and_longs(spark):
    rows = [(0, [3e15, 1.0]), (1, [3e15, 3.0]), (2, [-3e15, 3.0]), (3, [1e30, 1.0])]
    found = balltree.top_products(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), lambda i: i == 0, k=3, scale=1.0)
    assert [tuple(r)[1:] for r in found.orderBy("rank").collect()] == [(1, 1, 2**63 - 1), (2, 3, 2**63 - 1), (3, 2, -(2**63))]
    one = balltree.products(np.array([[2.0**31, 1.0]]), np.array([[2.0**31, 1.0]]))
    assert one.tolist() == [[2**62 + 1]]


def test_bounds_hold():
    g = np.random.default_rng(3)
    points, queries_ = np.floor(256 * g.standard_normal((500, 8))), np.floor(256 * g.standard_normal((20, 8)))
    search = balltree.Search(np.arange(20), queries_, np.full(20, np.iinfo(np.int64).min), 5)

    def check(ball):
        rows = ball.rows if ball.rows is not None else np.concatenate([check(c) for c in ball.children])
        assert (search.reach(ball, np.arange(20)) >= (queries_ @ points[rows].T).max(1)).all()
        return rows

    assert sorted(check(balltree.ball_tree(points, 20))) == list(range(500))


def test_components(spark):
    edges = [(i, i + 1) for i in range(50)] + [(100, 60), (60, 70), (7, 7), (200, 201)]
    got = {r.node: r.component for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {i: 0 for i in range(51)} | {60: 60, 70: 60, 100: 60, 200: 200, 201: 200}
    assert components(spark.createDataFrame([], "a long, b long")).isEmpty()


def _final_plan(frame):
    frame.collect()
    return frame._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]


def test_query_blocks_are_not_broadcast(vectors):
    """A block of queries comes once for each shard: many times what Spark takes it for."""
    found = balltree.top_products(vectors, lambda i: i % 3 == 0, k=5, shard_rows=30, query_rows=16)
    assert "HashJoin [d" not in _final_plan(found)


def test_no_tree_keeps_its_vectors():
    """Nothing refers back to a tree that is done with: a worker builds very many."""
    vectors = np.random.default_rng(4).standard_normal((300, 4))
    gc.collect()
    gc.disable()
    try:
        seen = weakref.ref(vectors)
        balltree.ball_tree(vectors, 20)
        del vectors
        assert seen() is None
    finally:
        gc.enable()


def test_coded_vectors_are_not_broadcast(vectors):
    """A vector comes once for each code: many times what Spark takes it for."""
    rows = vectors.where("vec_id < 40").selectExpr("vec_id AS id", "embedding AS vector", "1L AS copies", "vec_id % 2 AS `group`")
    bridges = nndescent._proposals(rows, 40, list(range(12)), apart=0.9)
    assert "Join [id" not in _final_plan(bridges)
    assert {(r.u - r.v) % 2 for r in bridges.collect()} == {1}
    assert "HashJoin [_vector" not in _final_plan(nndescent.near_vectors(vectors))
