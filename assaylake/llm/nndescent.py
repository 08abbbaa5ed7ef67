"""Embedding near-dedup by NN-descent.

A neighbour graph starts from buckets of random hyperplane codes and is refined in rounds: the neighbours of a vector,
in both directions, are compared with one another, so neighbours of neighbours find each other. Rounds end when they
bring hardly any new link (cosine at or above the threshold). Lists only join vectors to groups, as pairs far down in
both rankings may stand in no list: linked vectors look for links into other groups until there are none in any bucket,
and then every group, small or large, is compared as a whole in cells of bounded size and counted, not listed. The links
of a sample of vectors, compared with all vectors, tell the recall; if it is too low, the search goes on with further
codes.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from itertools import count

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window as W, functions as F

from .common import small_batches, sort_merged, stored
from .graph import components
from .vectors import matrix, usable

THRESHOLD = 0.9
#: Neighbours in a list; hyperplane codes of the start at least; vectors that share a code, about, and are compared at most at once.
NEIGHBOURS, TREES, BUCKET, CHUNK = 8, 12, 48, 1024
#: Neighbours that a bucket proposes to a vector.
PROPOSED = 4
#: Vectors of a cell, of which all pairs of a group are compared.
CELL = 512
#: Vectors of the audit, the recall it asks for, and how often codes are added before a search fails.
AUDITED, RECALL, AGAIN = 512, 0.97, 8
_PAIRS = "u long, v long, similarity double"
_PAIRS_SCHEMA = pa.schema([("u", pa.int64()), ("v", pa.int64()), ("similarity", pa.float64())])


def _units(vectors: pa.Array | pa.ChunkedArray) -> np.ndarray:
    """Rows scaled to length 1, in doubles; scaled by the largest component first, so squares stay finite."""
    rows = matrix(vectors.combine_chunks() if isinstance(vectors, pa.ChunkedArray) else vectors)
    rows = rows / np.abs(rows).max(1, keepdims=True)
    return rows / np.sqrt((rows**2).sum(1, keepdims=True))


def _alike(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """The parts of a batch whose vectors are of one length."""
    lengths = pc.list_value_length(batch.column("vector")).to_numpy()
    for d in np.unique(lengths):
        yield batch if (lengths == d).all() else batch.take(pa.array(np.flatnonzero(lengths == d)))


def _codes(rows: DataFrame, trees: list[int], bits: int, *along: str) -> DataFrame:
    """Each vector once per tree, with the columns ``along``; its code is its length and the signs of ``bits`` random projections."""
    small_batches(rows.sparkSession)
    kinds, kept = dict(rows.dtypes), ["id", "vector", *along]
    schema = ", ".join(["tree int, code long", *(f"{c} {kinds[c]}" for c in kept)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in (p for batch in batches for p in _alike(batch)):
            units, n = _units(part.column("vector")), part.num_rows
            for tree in trees:
                planes = np.random.default_rng(1000 + tree).standard_normal((units.shape[1], bits))
                code = ((units @ planes > 0) << np.arange(bits)).sum(1) + (units.shape[1] << bits)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([tree] * n, pa.int32()), pa.array(code), *(part.column(c) for c in kept)], ["tree", "code", *kept]
                )

    return rows.select(*kept).mapInArrow(run, schema)


def _grouped(rows: DataFrame, keys: list[str], n_rows: int, compare: Callable[[pa.Table], Iterator[tuple]], schema: str, arrow: pa.Schema, share: int = 4096) -> DataFrame:
    """``compare`` for the rows of each value of ``keys``; many values share a call into Python, of about ``share`` rows."""
    parts = max(1, n_rows // share)

    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by([(k, "ascending") for k in keys])
        numbers = [table.column(k).to_numpy() for k in keys]
        new = np.any([np.concatenate(([True], n[1:] != n[:-1])) for n in numbers], 0)
        cuts = np.append(np.flatnonzero(new), table.num_rows)
        found = [pa.record_batch(list(map(pa.array, out)), schema=arrow) for a, b in zip(cuts[:-1], cuts[1:], strict=True) for out in compare(table.slice(a, b - a))]
        return pa.Table.from_batches(found, arrow)

    return rows.withColumn("part", F.pmod(F.xxhash64(*keys), F.lit(parts))).groupBy("part").applyInArrow(run, schema)


def _best(similar: np.ndarray, ids: np.ndarray, most: int, bar: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For each row its ``most`` greatest entries above its bar, as pairs of ids."""
    most = min(most, similar.shape[1])
    top = np.argpartition(-similar, most - 1, axis=1)[:, :most]
    values = np.take_along_axis(similar, top, 1)
    use = (values > bar[:, None]) & np.isfinite(values)
    return np.broadcast_to(ids[:, None], top.shape)[use], ids[top][use], values[use]


def _bits(n: int) -> int:
    return max(1, int(np.log2(max(n, 2) / BUCKET)))


def _trees(n: int, threshold: float) -> int:
    """Codes, the more the longer they are, so that a pair just at the threshold shares one with a probability of ``RECALL``."""
    same = (1 - np.arccos(np.clip(threshold, -1, 1)) / np.pi) ** _bits(n)
    return TREES if same >= 1 else max(TREES, int(np.ceil(np.log(1 - RECALL) / np.log1p(-same))))


def _proposals(rows: DataFrame, n: int, trees: list[int], apart: float | None = None) -> DataFrame:
    """Pairs from buckets of equal codes. A bucket of very many vectors is dealt in chunks by a hash. With ``apart``, a
    threshold, rows carry a ``group`` and pairs are links between different groups."""
    coded = _codes(rows, trees, _bits(n), *(["group"] if apart is not None else []))
    full = coded.groupBy("tree", "code").agg(F.count("*").alias("m")).where(F.col("m") > CHUNK)
    chunk = F.coalesce(F.pmod(F.xxhash64("id", "tree"), F.ceil(F.col("m") / CHUNK)), F.lit(0)).cast("long")
    dealt = coded.join(full, ["tree", "code"], "left").withColumn("chunk", chunk).drop("m")

    def compare(table: pa.Table) -> Iterator[tuple]:
        if table.num_rows < 2:
            return
        ids, units = table.column("id").to_numpy(), _units(table.column("vector"))
        for i in range(0, len(ids), 2 * CHUNK):
            own = slice(i, i + 2 * CHUNK)
            similar = units[own] @ units[own].T
            np.fill_diagonal(similar, -np.inf)
            if apart is not None:
                group = table.column("group").to_numpy()[own]
                similar[(group[:, None] == group[None, :]) | (similar < apart)] = -np.inf
            yield _best(similar, ids[own], PROPOSED, np.full(len(ids[own]), -np.inf))

    return _grouped(dealt, ["tree", "code", "chunk"], n * len(trees), compare, _PAIRS, _PAIRS_SCHEMA)


def _lists(pairs: DataFrame, most: int = NEIGHBOURS) -> DataFrame:
    """The ``most`` nearest of the proposed neighbours of each vector."""
    rank = F.row_number().over(W.partitionBy("u").orderBy(F.desc("similarity"), "v"))
    return pairs.groupBy("u", "v").agg(F.max("similarity").alias("similarity")).withColumn("rank", rank).where(F.col("rank") <= most)


def _refined(rows: DataFrame, lists: DataFrame, n: int, turn: int) -> DataFrame:
    """Proposals of one round: at each vector its neighbours in both directions meet, and those pairs are proposed that
    beat the last entry of a list. Very many neighbours are dealt in chunks, anew in each round."""
    meet = lists.select(F.col("u").alias("at"), F.col("v").alias("id")).union(lists.select(F.col("v").alias("at"), F.col("u").alias("id"))).distinct()
    last = lists.groupBy("u").agg(F.max("rank").alias("n"), F.min("similarity").alias("bar"))
    bars = last.select(F.col("u").alias("of"), F.when(F.col("n") == NEIGHBOURS, F.col("bar")).otherwise(-1.0).alias("bar"))
    known = rows.select("id", "vector").join(bars, F.col("id") == F.col("of"), "left").select("id", "vector", F.coalesce("bar", F.lit(-1.0)).alias("bar"))
    wide = meet.groupBy("at").agg(F.count("*").alias("m")).where("m > 64")
    chunk = F.coalesce(F.pmod(F.xxhash64("id", F.lit(turn)), F.ceil(F.col("m") / 64)), F.lit(0)).cast("long")
    dealt = meet.join(wide, "at", "left").withColumn("chunk", chunk).drop("m").join(sort_merged(known), "id")

    def compare(table: pa.Table) -> Iterator[tuple]:
        if table.num_rows < 2:
            return
        ids, units = table.column("id").to_numpy(), _units(table.column("vector"))
        similar = units @ units.T
        np.fill_diagonal(similar, -np.inf)
        yield _best(similar, ids, 2, table.column("bar").to_numpy())

    return _grouped(dealt, ["at", "chunk"], 2 * n * NEIGHBOURS, compare, _PAIRS, _PAIRS_SCHEMA)


def _progress(lists: DataFrame, threshold: float) -> tuple[int, int]:
    """Links in all lists, and in those that are not saturated, whose last neighbour is no link."""
    each = lists.groupBy("u").agg(F.count_if(F.col("similarity") >= threshold).alias("links"))
    every, still_open = each.agg(F.sum("links"), F.sum(F.when(F.col("links") < NEIGHBOURS, F.col("links")))).first()
    return every or 0, still_open or 0


def _graph(rows: DataFrame, n: int, trees: list[int], before: DataFrame | None, threshold: float) -> DataFrame:
    """Neighbour lists (``u``, ``v``, ``similarity``, ``rank``), refined until a round brings hardly a new link. Saturated
    lists gain none, so new links are measured by the others alone."""
    proposed = _proposals(rows, n, trees)
    if before is not None:
        proposed = proposed.union(before.select("u", "v", "similarity"))
    lists = stored(_lists(proposed), "lists")
    links, _ = _progress(lists, threshold)
    for turn in count():
        better = _refined(rows, lists, n, turn).union(lists.select("u", "v", "similarity"))
        lists = stored(_lists(better), "lists")
        now, still_open = _progress(lists, threshold)
        if now - links <= 0.001 * still_open:
            break
        links = now
    return lists


@dataclass(frozen=True)
class Links:
    #: ``id``, ``n_links`` (other vectors linked), ``component`` for each different vector that has a link.
    nodes: DataFrame
    #: Pairs ``u`` < ``v`` of different vectors that hold the groups together; not all links of a group.
    pairs: DataFrame


def _linked(rows: DataFrame, n: int, lists: DataFrame, threshold: float, trees: list[int], before: Links | None = None) -> Links:
    """Groups from neighbour lists, from links between groups and from those of an earlier search; the links within each
    group are counted from its vectors."""
    both = lists.where(F.col("similarity") >= threshold).select(F.least("u", "v").alias("a"), F.greatest("u", "v").alias("b"))
    if before is not None:
        both = both.union(before.pairs)
    both = stored(both.distinct(), "links")
    while True:
        labels = components(both)
        members = stored(rows.join(labels.withColumnRenamed("node", "id"), "id"), "members")
        bridges = _proposals(members.withColumnRenamed("component", "group"), max(n, 2), trees, apart=threshold)
        bridges = stored(bridges.select(F.least("u", "v").alias("a"), F.greatest("u", "v").alias("b")).distinct(), "bridges")
        if bridges.isEmpty():
            break
        both = stored(both.union(bridges).distinct(), "links")
    nodes = _cells(members, threshold).join(labels, "node").select(F.col("node").alias("id"), "n_links", "component")
    return Links(stored(nodes, "linked"), both.select(F.col("a").alias("u"), F.col("b").alias("v")))


def _cells(members: DataFrame, threshold: float) -> DataFrame:
    """``node`` and ``n_links`` within its group: every pair of cells of a group is one comparison. Small groups share
    a call into Python."""
    sizes = members.groupBy("component").agg(F.ceil(F.count("*") / CELL).cast("int").alias("cells"), F.count("*").alias("m"))
    n_rows = sizes.agg(F.sum(F.col("m") * F.col("cells"))).first()[0] or 0
    cell = F.pmod(F.xxhash64("id"), F.col("cells")).cast("int")
    # A vector of cell c takes part in the pairs (c, d) for all d from c on, and in (d, c) for all d before.
    pair = F.explode(F.transform(F.sequence(F.lit(0), F.col("cells") - 1), lambda d: F.struct(F.least("cell", d).alias("low"), F.greatest("cell", d).alias("high"))))
    dealt = members.join(sizes.drop("m"), "component").withColumn("cell", cell).withColumn("pair", pair).select(
        "component", F.col("pair.low").alias("low"), F.col("pair.high").alias("high"), "cell", "id", "vector", "copies"
    )
    schema = pa.schema([("node", pa.int64()), ("n_links", pa.int64())])

    def compare(table: pa.Table) -> Iterator[tuple]:
        ids, units, copies = table.column("id").to_numpy(), _units(table.column("vector")), table.column("copies").to_numpy()
        low, high, cells = table.column("low")[0].as_py(), table.column("high")[0].as_py(), table.column("cell").to_numpy()
        left, right = np.flatnonzero(cells == low), np.flatnonzero(cells == high)
        linked = units[left] @ units[right].T >= threshold
        if low == high:
            np.fill_diagonal(linked, False)
            nodes, counts = ids[left], linked @ copies[right]
        else:
            nodes = np.concatenate((ids[left], ids[right]))
            counts = np.concatenate((linked @ copies[right], linked.T @ copies[left]))
        yield nodes, counts.astype(np.int64)

    counts = _grouped(dealt, ["component", "low", "high"], n_rows, compare, "node long, n_links long", schema, 2 * CELL)
    return counts.groupBy("node").agg(F.sum("n_links").alias("n_links"))


def audit(rows: DataFrame, nodes: DataFrame, threshold: float, sample: int = AUDITED) -> float:
    """Of the links that a vector has with all vectors, the share that was found, in the mean over a sample of vectors
    with links. Vectors with more links than a list holds count apart, and the lesser mean is taken, so that no large
    group hides losses elsewhere; 1 without any links."""
    chosen = rows.orderBy(F.xxhash64("id", F.lit("audit")), "id").limit(sample).select("id", "vector").collect()
    if not chosen:
        return 1.0
    ids, lengths = np.array([r.id for r in chosen]), np.array([len(r.vector) for r in chosen])
    # By length: the places in the sample, and the vectors.
    of = {int(d): np.flatnonzero(lengths == d) for d in np.unique(lengths)}
    units_of = {d: _units(pa.array([chosen[i].vector for i in at], pa.list_(pa.float64()))) for d, at in of.items()}

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        true, others = np.zeros(len(ids), np.int64), np.zeros(len(ids), np.int64)
        for part in (p for batch in batches for p in _alike(batch)):
            d = len(part.column("vector")[0])
            if d in of:
                linked = _units(part.column("vector")) @ units_of[d].T >= threshold
                linked &= part.column("id").to_numpy()[:, None] != ids[of[d]][None, :]
                true[of[d]] += (linked * part.column("copies").to_numpy()[:, None]).sum(0)
                others[of[d]] += linked.sum(0)
        yield pa.RecordBatch.from_arrays([pa.array(ids), pa.array(true), pa.array(others)], ["id", "n_true", "n_others"])

    small_batches(rows.sparkSession)
    true = rows.select("id", "vector", "copies").mapInArrow(compare, "id long, n_true long, n_others long")
    true = true.groupBy("id").agg(F.sum("n_true").alias("n_true"), F.sum("n_others").alias("n_others")).where("n_true > 0")
    share = F.least("n_true", F.coalesce("n_links", F.lit(0))) / F.col("n_true")
    means = true.join(nodes.select("id", "n_links"), "id", "left").groupBy(F.col("n_others") > NEIGHBOURS).agg(F.avg(share).alias("mean"))
    return min((r["mean"] for r in means.collect()), default=1.0)


def near_vectors(vectors: DataFrame, threshold: float = THRESHOLD, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """All columns of ``vectors`` but the vector, with ``n_links``, ``component_id``, ``kept`` and ``audited_recall``.

    Vectors link if their cosine, in doubles, is at least ``threshold``; every link is computed from the vectors. Equal
    vectors count as one in the search and as links of each other in the result. Vectors that are null, empty or zero or
    hold null or non-finite components link with nothing, as do rows without an id; vectors of different lengths have no
    cosine, so those of each length link among themselves. Rows that repeat an id are vectors of their own.
    """
    good = F.col("id").isNotNull() & usable("vector") & F.exists("vector", lambda x: x != 0)
    slim = vectors.select(F.col(f"`{key}`").cast("long").alias("id"), F.col(f"`{vector}`").alias("vector")).where(good)
    # The number of a different vector is its least id; a vector that shares it with another gets a number of its own.
    different = slim.groupBy("vector").agg(F.min("id").alias("first"), F.count("*").alias("copies"))
    order = F.row_number().over(W.partitionBy("first").orderBy("vector"))
    numbered = stored(different.withColumn("nth", order).withColumn("id", F.when(F.col("nth") == 1, F.col("first")).otherwise(-F.abs(F.xxhash64("vector")) - 1)), "different")
    rows = numbered.select("id", "vector", "copies")
    n = rows.count()
    lists, links, recall, width = None, None, 0.0, _trees(n, threshold)
    for again in range(AGAIN + 1):
        trees = list(range(again * width, (again + 1) * width))
        lists = _graph(rows, n, trees, lists, threshold)
        links = _linked(rows, n, lists, threshold, trees, links)
        recall = audit(rows, links.nodes, threshold)
        if recall >= RECALL:
            break
    else:
        raise RuntimeError(f"the audit finds a recall of {recall:.4f} after {(AGAIN + 1) * width} codes, below {RECALL}")
    firsts = numbered.select("id", "first")
    groups = links.nodes.join(firsts, "id")
    least = groups.groupBy("component").agg(F.min("first").alias("least"))
    of = numbered.select("id", "vector", "first", "copies").join(groups.join(least, "component").select("id", "n_links", "least"), "id", "left")
    of = of.select("vector", (F.coalesce("n_links", F.lit(0)) + F.col("copies") - 1).alias("n_links"), F.coalesce("least", "first").alias("component_id"))
    names = [c for c in vectors.columns if c not in (vector, "n_links", "component_id", "kept", "audited_recall")]
    own = vectors.select(*(F.col(f"`{c}`") for c in names), F.when(F.col(f"`{key}`").isNotNull(), F.col(f"`{vector}`")).alias("_vector"))
    joined = own.join(sort_merged(of), F.col("_vector") == F.col("vector"), "left").drop("vector", "_vector")
    component = F.coalesce("component_id", F.col(f"`{key}`").cast("long"))
    return joined.select(
        *(F.col(f"`{c}`") for c in names), F.coalesce("n_links", F.lit(0)).alias("n_links"), component.alias("component_id"),
        F.coalesce(component == F.col(f"`{key}`"), F.lit(False)).alias("kept"), F.lit(recall).alias("audited_recall"),
    )
