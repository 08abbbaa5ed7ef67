"""MinHash near-dedup: circulant signatures, banding, exact Jaccard verification, connected groups.

Texts with equal shingle sets count as one. Signatures of the different sets come from two permutations, one of them
circularly shifted; sets that agree in all coordinates of a band share a bucket. A bucket of m sets is not turned into
m * m pairs: its members are first compared with one of them (exactly, on the full sets), the one that shares most
buckets with others. Where this leaves several groups in a bucket, members outside the main one are still to be told
from the rest. A small bucket compares them pair by pair. A large one looks at its core, the shingles that more than
``RARE`` of the members have: two sets that share nothing outside the core have at most the smaller part of it in
common, which rules nearly all pairs out; those that do share something outside it meet at that shingle, which no more
than ``RARE`` members have. So the pairs grow with the members and not with their square.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from .blocks import SMALL_BLOCK_BYTES, Block, Blocks, make_blocks
from .common import stored
from .graph import components
from .shingles import band_keys, set_keys, shingle_sets, signatures

#: Coordinates of a signature, and of a band. Of two sets at a similarity of 0.8, 5 pairs in a million share no band.
COORDINATES, BAND = 240, 6
#: Least similarity, in hundredths.
SIMILARITY = 80
#: Members up to which a bucket that still has several groups compares them pair by pair.
SMALL = 32
#: Members up to which a shingle of a large bucket lies outside its core.
RARE = 16
#: Rows of a group's members that meet the rest in one task, about.
SHARE = 8192
#: The column with what the search knows of a document, and its fields.
_OWN = "_llm_sets"
_FIELDS = ("node", "local", "n_shingles", "hi", "lo", "bands")
_DDL = f"{_OWN} struct<node:long,local:long,n_shingles:long,hi:long,lo:long,bands:array<long>>"


def _signed(values: np.ndarray) -> pa.Array:
    return pa.array(np.ascontiguousarray(values).view(np.int64))


def _sets(blocks: Blocks, kept: T.StructType, k: int, coordinates: int, band: int) -> DataFrame:
    """One row per document: its columns, node, set size and name, and the band keys of the first of equal sets."""

    def work(block: Block) -> Iterator[pa.RecordBatch]:
        n_docs, nodes = len(block.ends), block.nodes
        value, of = shingle_sets(block, k)
        n, hi, lo = set_keys(value, of, n_docs)
        _, first, back = np.unique(np.stack((hi, lo), 1), axis=0, return_index=True, return_inverse=True)
        local = first[back.ravel()]
        leads = (local == np.arange(n_docs)) & (n > 0)
        chosen = leads[of]
        keys = band_keys(signatures(value[chosen], of[chosen], n_docs, coordinates), band)
        width = np.where(leads, keys.shape[1], 0)
        offsets = pa.array(np.concatenate(([0], np.cumsum(width))).astype(np.int32), mask=np.append(~leads, False))
        bands = pa.ListArray.from_arrays(offsets, _signed(keys[leads].ravel()))
        columns = (pa.array(nodes), pa.array(nodes[local]), pa.array(n), _signed(hi), _signed(lo), bands)
        rows = block.rows.combine_chunks().append_column(_OWN, pa.StructArray.from_arrays(list(columns), list(_FIELDS)))
        yield from rows.to_batches()

    return blocks.each(work, T.StructType([*kept, *T.StructType.fromDDL(_DDL)]))


def _full_sets(blocks: Blocks, nodes: DataFrame, k: int) -> DataFrame:
    """``node`` and ``shingles``, the full set, of some nodes."""

    def work(block: Block, places: np.ndarray) -> Iterator[pa.RecordBatch]:
        value, of = shingle_sets(block.only(places), k)
        ends = np.cumsum(np.bincount(of, minlength=len(places)))
        offsets = pa.array(np.concatenate(([0], ends)).astype(np.int32))
        yield pa.RecordBatch.from_arrays([pa.array(block.nodes[places]), pa.ListArray.from_arrays(offsets, _signed(value))], ["node", "shingles"])

    return blocks.each_of(work, "node long, shingles array<long>", nodes)


def _verified(blocks: Blocks, pairs: DataFrame, k: int, similarity: int) -> DataFrame:
    """The pairs (``a``, ``b`` with sizes ``n_a``, ``n_b``) whose full sets are similar enough, stored."""
    high, low = F.greatest("n_a", "n_b"), F.least("n_a", "n_b")
    pairs = stored(pairs.where(100 * low >= similarity * high), "pairs")
    nodes = pairs.select(F.col("a").alias("node")).distinct().union(pairs.select(F.col("b").alias("node")).distinct())
    sets = stored(_full_sets(blocks, nodes.distinct(), k), "sets")
    of = lambda side: sets.select(F.col("node").alias(side), F.col("shingles").alias(f"s_{side}"))
    common = F.size(F.array_intersect("s_a", "s_b"))
    similar = 100 * common >= similarity * (F.col("n_a") + F.col("n_b") - common)
    return stored(pairs.join(of("a"), "a").join(of("b"), "b").where(similar).select("a", "b"), "links")


def _first_pairs(members: DataFrame) -> DataFrame:
    """Each bucket's lead with each other member; a pair that several buckets have comes once. The lead is the member that
    meets most others over all its buckets, so the least altered of many near copies leads most of theirs."""
    met = members.groupBy("node").agg(F.sum("m").alias("met"))
    leads = members.join(met, "node").groupBy("key").agg(F.min(F.struct(-F.col("met"), "node", "n")).alias("lead"))
    pairs = members.join(leads, "key").where("node <> lead.node").select(F.struct("node", "n").alias("x"), F.struct("lead.node", "lead.n").alias("y"))
    return _ordered_pairs(pairs)


def _groups(members: DataFrame, links: DataFrame) -> DataFrame:
    """The members of those buckets that lie in several groups, each with its group and the bucket's main one."""
    found = components(links).select(F.col("node").alias("of"), F.col("component").alias("found"))
    labelled = members.join(found, F.col("node") == F.col("of"), "left").select(*members.columns, F.coalesce("found", "node").alias("component"))
    sizes = labelled.groupBy("key", "component").agg(F.count("*").alias("m"))
    several = sizes.groupBy("key").agg(F.count("*").alias("groups"), F.max(F.struct("m", "component")).alias("largest"))
    several = several.where("groups > 1").select("key", F.col("largest.component").alias("main"))
    return stored(labelled.join(several, "key"), "groups")


def _ordered_pairs(sides: DataFrame) -> DataFrame:
    """Different pairs of ``x`` and ``y``, the smaller node first."""
    a, b = F.struct("x.node", "x.n"), F.struct("y.node", "y.n")
    pairs = sides.select(F.least(a, b).alias("a"), F.greatest(a, b).alias("b")).distinct()
    return pairs.select(F.col("a.node").alias("a"), F.col("b.node").alias("b"), F.col("a.n").alias("n_a"), F.col("b.n").alias("n_b"))


#: Sides of a pair that may link two groups: the first outside the main one, and no pair of two outside it twice.
_APART = "x.component <> y.component AND x.component <> x.main AND (y.component = y.main OR x.node < y.node)"


def _enough(common: Column, similarity: int) -> Column:
    """Whether sets with at most so many shingles in common may be similar enough."""
    return (100 + similarity) * common >= similarity * (F.col("x.n") + F.col("y.n"))


def _small_pairs(grouped: DataFrame, similarity: int) -> DataFrame:
    """Pairs of small buckets that may link two of their groups."""
    side = F.struct("node", "n", "component", "main")
    small = grouped.where(F.col("m") <= SMALL)
    x, y = (small.select("key", side.alias(name)) for name in ("x", "y"))
    return x.where("x.component <> x.main").join(y, "key").where(_APART).where(_enough(F.least("x.n", "y.n"), similarity)).select("x", "y")


def _large_pairs(blocks: Blocks, grouped: DataFrame, k: int, similarity: int) -> DataFrame:
    """Pairs of large buckets that may link two groups; buckets with the same main group are taken as one."""
    large = stored(grouped.where(F.col("m") > SMALL).select("main", "node", "n", "component").distinct(), "large")
    sets = _full_sets(blocks, large.select("node").distinct(), k)
    held = large.select("main", "node").join(sets, "node").select("main", "node", F.explode("shingles").alias("s"))
    rare = held.groupBy("main", "s").agg(F.count("*").alias("holders")).where(F.col("holders") <= RARE)
    loose = stored(held.join(rare, ["main", "s"]), "loose")
    outside = loose.groupBy("main", "node").agg(F.count("*").alias("loose"))
    sides = large.join(outside, ["main", "node"], "left").withColumn("core", F.col("n") - F.coalesce("loose", F.lit(0))).drop("loose")
    sides = stored(sides, "sides")
    side = F.struct("node", "n", "component", "main", "core")
    # Nothing in common outside the core: either set has at least the similarity's share of its shingles in it.
    full = sides.where(100 * F.col("core") >= similarity * F.col("n"))
    whole = full.groupBy("main").agg(F.min("n").alias("least"), F.ceil(F.count("*") / SHARE).alias("parts"))
    full = full.join(whole, "main")
    x = full.where((F.col("component") != F.col("main")) & ((100 + similarity) * F.col("core") >= similarity * (F.col("n") + F.col("least"))))
    x = x.select("main", side.alias("x"), F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"))
    y = full.select("main", side.alias("y"), F.pmod(F.xxhash64("node"), "parts").alias("part"))
    core = F.least("x.core", "y.core")
    inside = x.join(y, ["main", "part"]).where(_APART).where(_enough(core, similarity)).select("x", "y")
    # Something in common outside it: they meet at a shingle that few have; how many such they share completes the bound.
    shared = loose.where("holders > 1").select("main", "s", "node")
    meeting = shared.withColumnRenamed("node", "a").join(shared.withColumnRenamed("node", "b"), ["main", "s"]).where("a <> b")
    meeting = meeting.groupBy("main", "a", "b").agg(F.count("*").alias("r"))
    x, y = sides.select("main", F.col("node").alias("a"), side.alias("x")), sides.select("main", F.col("node").alias("b"), side.alias("y"))
    met = meeting.join(x, ["main", "a"]).join(y, ["main", "b"]).where(_APART).where(_enough(core + F.col("r"), similarity)).select("x", "y")
    slim = lambda pairs: pairs.select(*(F.struct(f"{c}.node", f"{c}.n").alias(c) for c in ("x", "y")))
    return slim(inside).union(slim(met))


def _links(blocks: Blocks, sets: DataFrame, k: int, similarity: int) -> DataFrame:
    """Links between sets that join all similar ones into groups; every linked pair is verified."""
    members = sets.select("node", "n", F.explode("bands").alias("key"))
    buckets = members.groupBy("key").agg(F.count("*").alias("m")).where("m > 1")
    members = stored(members.join(buckets, "key"), "members")
    links = _verified(blocks, _first_pairs(members), k, similarity)
    grouped = _groups(members, links)
    slim = _small_pairs(grouped, similarity).select(*(F.struct(f"{c}.node", f"{c}.n").alias(c) for c in ("x", "y")))
    rest = _ordered_pairs(slim.union(_large_pairs(blocks, grouped, k, similarity)))
    return stored(links.union(_verified(blocks, rest, k, similarity)), "links")


@dataclass(frozen=True)
class _Grouped:
    blocks: Blocks
    #: One row per document: its columns, and a struct with ``node``, ``n_shingles`` and ``local``, the first node of its
    #: block with an equal set.
    rows: DataFrame
    #: ``local`` and ``component``; documents without shingles have no row.
    groups: DataFrame


def _grouped(documents: DataFrame, text: str, k: int, similarity: int, coordinates: int, band: int) -> _Grouped:
    slim = documents.select(*(F.col(f"`{c}`") for c in documents.columns if c != text), F.col(f"`{text}`"))
    blocks = make_blocks(slim, text, SMALL_BLOCK_BYTES)
    rows = stored(_sets(blocks, slim.drop(text).schema, k, coordinates, band), "rows")
    # Equal sets within a block have one leading node; equal sets of different blocks meet here, one row per block.
    leading = rows.select(f"{_OWN}.*").where("bands IS NOT NULL").select("node", "hi", "lo", F.col("n_shingles").alias("n"), "bands")
    least = leading.groupBy("hi", "lo").agg(F.min("node").alias("set"))
    same = stored(leading.select("node", "hi", "lo").join(least, ["hi", "lo"]).select("node", "set"), "same")
    sets = stored(leading.join(same.where("node = set").select("node"), "node", "left_semi").select("node", "n", "bands"), "sets")
    found = components(_links(blocks, sets, k, similarity)).select(F.col("node").alias("set"), "component")
    groups = same.join(found, "set", "left").select(F.col("node").alias("local"), F.coalesce("component", "set").alias("component"))
    return _Grouped(blocks, rows, stored(groups, "groups"))


def _least(of: _Grouped, what: Column) -> DataFrame:
    """The least ``what`` of each group, per leading node: rows of equal sets are reduced within their block first."""
    own = of.rows.groupBy(F.col(f"{_OWN}.local").alias("local")).agg(F.min(what).alias("least"))
    groups = of.groups.join(own, "local")
    return groups.join(groups.groupBy("component").agg(F.min("least").alias("all")), "component").select("local", F.col("all").alias("least"))


def near_duplicates(
    documents: DataFrame, key: str = "doc_id", text: str = "text", k: int = 5, similarity: int = SIMILARITY,
    coordinates: int = COORDINATES, band: int = BAND,
) -> DataFrame:
    """All columns of ``documents`` but the text, with ``n_shingles`` (size of the set of ``k``-word shingles),
    ``component_id`` (least ``key`` of the group that links of at least ``similarity`` hundredths connect) and
    ``kept`` (whether ``key`` is that one).

    Words are parted by ASCII white space, A-Z in lower case. A text with fewer than ``k`` words has its whole
    sequence as its only shingle; null, empty and blank texts have none and form groups of their own. Rows with equal
    ids are rows of their own and, with equal texts, one group. A null key counts as larger than all others.
    """
    of = _grouped(documents, text, k, similarity, coordinates, band)
    names = [c for c in documents.columns if c not in (text, "n_shingles", "component_id", "kept")]
    least = _least(of, F.col(f"`{key}`")).withColumnRenamed("least", "_llm_least")
    component = F.coalesce("_llm_least", F.col(f"`{key}`"))
    return of.rows.join(least, F.col(f"{_OWN}.local") == least["local"], "left").select(
        *(of.rows[f"`{c}`"] for c in names), F.col(f"{_OWN}.n_shingles").alias("n_shingles"), component.alias("component_id"),
        F.coalesce(component == of.rows[f"`{key}`"], F.lit(False)).alias("kept"),
    )


def keep_one(documents: DataFrame, key: str = "doc_id", text: str = "text", k: int = 5, similarity: int = SIMILARITY) -> DataFrame:
    """``documents`` without near duplicates: of each group the row with the least key stays, whole and unchanged."""
    of = _grouped(documents, text, k, similarity, COORDINATES, BAND)
    blocks, key_of = of.blocks, F.col(f"`{key}`")
    first = _least(of, F.struct(key_of.isNull().alias("none"), key_of.alias("key"), F.col(f"{_OWN}.node").alias("node")))
    wanted = first.select(F.col("least.node").alias("node")).distinct().union(of.rows.select(f"{_OWN}.*").where("n_shingles = 0").select("node"))
    names = documents.columns

    def work(block: Block, places: np.ndarray) -> Iterator[pa.RecordBatch]:
        part = block.only(places)
        raw, ends = part.data.tobytes(), part.ends.tolist()
        texts = [None if none else raw[a:b].decode() for a, b, none in zip([0, *ends], ends, part.nulls.tolist())]
        texts = pa.array(texts, pa.string())
        rows = block.rows.take(pa.array(places)).append_column(text, texts)
        yield from rows.select(names).combine_chunks().to_batches()

    return blocks.each_of(work, documents.schema, wanted)
