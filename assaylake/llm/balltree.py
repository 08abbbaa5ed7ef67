"""Exact top-k search by inner product: a ball tree per shard, branch and bound, a shared k-th score.

Vectors are dealt to shards of bounded size; each shard is a tree of balls (centre, radius). For a query q no vector of a
ball can score above q . centre + |q| * radius. A block of queries descends a tree together: a node is left to the
queries whose k-th score so far it may still beat, the child with the higher bounds first. In a first wave each block
of queries searches one shard; with the k-th scores found there it goes to all others.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window as W, functions as F

from .common import release_memory, small_batches, sort_merged, stored
from .vectors import matrix, one_per_id

SHARD_ROWS, QUERY_ROWS, LEAF_ROWS = 8192, 512, 64
_LONG = np.iinfo(np.int64)
_FOUND = "query_id long, vec_id long, score long"
_FOUND_SCHEMA = pa.schema([(n, pa.int64()) for n in ("query_id", "vec_id", "score")])


def whole_numbers(vectors: np.ndarray, scale: float) -> np.ndarray:
    """floor(scale * x), still as doubles; each is a whole number."""
    return np.floor(scale * vectors)


@dataclass(frozen=True)
class Ball:
    centre: np.ndarray
    radius: float
    #: Rows of the shard in a leaf; two balls in an inner node.
    rows: np.ndarray | None
    children: tuple[Ball, ...] = ()


def ball_tree(vectors: np.ndarray, leaf_rows: int = LEAF_ROWS) -> Ball:
    """Halves at the median along the component that varies most, down to leaves of ``leaf_rows`` at most."""
    return _ball(vectors, np.arange(len(vectors)), leaf_rows)


def _ball(vectors: np.ndarray, rows: np.ndarray, leaf_rows: int) -> Ball:
    own = vectors[rows]
    centre = own.mean(0)
    radius = float(np.sqrt(((own - centre) ** 2).sum(1).max()))
    if len(rows) <= leaf_rows or radius == 0:
        return Ball(centre, radius, rows)
    axis = int(np.argmax(own.max(0) - own.min(0)))
    order = np.argsort(own[:, axis], kind="stable")
    half, own = len(rows) // 2, None
    return Ball(centre, radius, None, (_ball(vectors, rows[order[:half]], leaf_rows), _ball(vectors, rows[order[half:]], leaf_rows)))


def products(queries: np.ndarray, vectors: np.ndarray) -> np.ndarray:
    """Inner products of whole numbers, exact; what a long cannot hold becomes the nearest long."""
    size = float(np.abs(queries).max(initial=0)) * float(np.abs(vectors).max(initial=0)) * queries.shape[1]
    if size < 2.0**53:
        return (queries @ vectors.T).astype(np.int64)
    whole = lambda m: np.array([[int(x) for x in row] for row in m], object).reshape(m.shape)
    return np.clip(whole(queries) @ whole(vectors).T, _LONG.min, _LONG.max).astype(np.int64)


class Search:
    """The best ``k`` of the vectors seen so far for each query of a block; ties go to the smaller id."""

    def __init__(self, query_ids: np.ndarray, queries: np.ndarray, least: np.ndarray, k: int) -> None:
        self.query_ids, self.queries, self.k = query_ids, queries, k
        self.norms = np.sqrt((queries**2).sum(1))
        #: A k-th score already known elsewhere: nothing below it is of use.
        self.least = least
        self.scores = np.full((len(queries), k), _LONG.min)
        self.ids = np.full((len(queries), k), _LONG.max)
        self.n = np.zeros(len(queries), np.int64)

    def bar(self, of: np.ndarray) -> np.ndarray:
        own = np.where(self.n[of] >= self.k, self.scores[of, -1], _LONG.min)
        return np.maximum(own, self.least[of])

    def reach(self, ball: Ball, of: np.ndarray) -> np.ndarray:
        """An upper bound of what each query can score in a ball, with room for rounding."""
        bound = self.queries[of] @ ball.centre + self.norms[of] * ball.radius
        return bound + 1e-9 * self.norms[of] * (np.sqrt((ball.centre**2).sum()) + ball.radius) + 1

    def visit(self, ball: Ball, of: np.ndarray, ids: np.ndarray, vectors: np.ndarray) -> None:
        of = of[self.reach(ball, of) >= self.bar(of)]
        if not len(of):
            return
        if ball.rows is None:
            for child in sorted(ball.children, key=lambda c: -self.reach(c, of).mean()):
                self.visit(child, of, ids, vectors)
            return
        for i in range(0, len(ball.rows), LEAF_ROWS):  # equal vectors may fill a large leaf
            self._add(of, ids[ball.rows[i : i + LEAF_ROWS]], vectors[ball.rows[i : i + LEAF_ROWS]])

    def _add(self, of: np.ndarray, ids: np.ndarray, vectors: np.ndarray) -> None:
        scores = products(self.queries[of], vectors)
        use = (scores >= self.bar(of)[:, None]) & (ids[None, :] != self.query_ids[of][:, None])
        any_ = use.any(1)
        of, scores, use = of[any_], scores[any_], use[any_]
        if not len(of):
            return
        all_scores = np.concatenate((self.scores[of], np.where(use, scores, _LONG.min)), 1)
        all_ids = np.concatenate((self.ids[of], np.where(use, ids[None, :], _LONG.max)), 1)
        by_id = np.argsort(all_ids, axis=1, kind="stable")
        all_scores, all_ids = np.take_along_axis(all_scores, by_id, 1), np.take_along_axis(all_ids, by_id, 1)
        # The complement reverses the order of all longs, the least one included.
        best = np.argsort(~all_scores, axis=1, kind="stable")[:, : self.k]
        self.scores[of], self.ids[of] = np.take_along_axis(all_scores, best, 1), np.take_along_axis(all_ids, best, 1)
        self.n[of] = np.minimum(self.n[of] + use.sum(1), self.k)

    def results(self) -> pa.RecordBatch:
        rows, ranks = np.nonzero(np.arange(self.k)[None, :] < self.n[:, None])
        return pa.RecordBatch.from_arrays(
            [pa.array(self.query_ids[rows]), pa.array(self.ids[rows, ranks]), pa.array(self.scores[rows, ranks])], schema=_FOUND_SCHEMA
        )


def _searched(pairs: DataFrame, k: int, scale: float) -> DataFrame:
    """Each row has a block of queries and a shard; both are of bounded size."""
    small_batches(pairs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                queries, shard = batch.column("queries")[i].values, batch.column("rows")[i].values
                ids, vectors = shard.field("id").to_numpy(), whole_numbers(matrix(shard.field("vector")), scale)
                least = queries.field("least").fill_null(_LONG.min).to_numpy(zero_copy_only=False)
                search = Search(queries.field("id").to_numpy(), whole_numbers(matrix(queries.field("vector")), scale), least, k)
                search.visit(ball_tree(vectors), np.arange(len(least)), ids, vectors)
                yield search.results()
                release_memory()

    return pairs.select("queries", "rows").mapInArrow(run, _FOUND)


def _dealt(rows: DataFrame, into: str, parts: int, *columns: str) -> DataFrame:
    """Vectors of equal length in parts, by a hash of the id."""
    part = F.pmod(F.xxhash64("id"), F.lit(parts)).cast("int").alias("part")
    return rows.groupBy("d", part).agg(F.collect_list(F.struct("id", "vector", *columns)).alias(into))


def top_products(
    vectors: DataFrame, is_query, k: int, scale: float = 256.0, key: str = "vec_id", vector: str = "embedding",
    shard_rows: int = SHARD_ROWS, query_rows: int = QUERY_ROWS,
) -> DataFrame:
    """For each vector whose id satisfies ``is_query`` (a function of the id column) its ``k`` best others: ``query_id``,
    ``rank``, ``vec_id``, ``score``.

    Components count as floor(``scale`` * component). The score is their exact inner product, saturated at the ends of
    a long; ties go to the smaller id. Vectors that are null or empty or hold null or non-finite components, and rows
    without an id, take no part; vectors are compared with those of their own length; of rows that repeat an id one
    counts. A query with fewer than ``k`` others has all of them; without any it has no row.
    """
    rows = stored(one_per_id(vectors, key, vector).withColumn("d", F.size("vector")), "vectors")
    queries = rows.where(is_query(F.col("id")))
    n_shards, n_blocks = (max(1, -(-df.count() // size)) for df, size in ((rows, shard_rows), (queries, query_rows)))
    shards = stored(_dealt(rows, "rows", n_shards).withColumnRenamed("part", "shard"), "shards")

    def paired(asked: DataFrame, first: bool) -> DataFrame:
        """In the first wave the shard that the block's number names; then all others."""
        own = F.pmod("part", F.lit(n_shards))
        others = F.filter(F.sequence(F.lit(0), F.lit(n_shards - 1)), lambda s: s != own)
        blocks = _dealt(asked, "queries", n_blocks, "least")
        return blocks.withColumn("shard", F.explode(F.array(own) if first else others)).join(sort_merged(shards), ["d", "shard"])

    start = stored(_searched(paired(queries.withColumn("least", F.lit(None).cast("long")), True), k, scale), "wave")
    bars = start.groupBy("query_id").agg(F.min("score").alias("least"), F.count("*").alias("n")).where(F.col("n") == k)
    asked = queries.join(bars.select(F.col("query_id").alias("id"), "least"), "id", "left")
    found = start.unionAll(_searched(paired(asked, False), k, scale))
    rank = F.row_number().over(W.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
