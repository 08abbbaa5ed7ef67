"""Phrase collocation mining by SETM: set-oriented mining over relations of occurrences.

The relation of length k has one row per occurrence of a group of k words: its piece, the position in the piece, and the
group. It is stored in sorted order of piece and position, chunk by chunk; a piece never leaves its chunk. A round

- counts the groups: a chunk sends each of its distinct groups once, with how often it has it, and Spark sums over chunks;
- semi-joins: occurrences of groups that are not frequent leave the relation before it grows on, at each chunk that is
  cogrouped with its frequent groups;
- merge-joins what is left with itself on piece and the next position. Two groups of k words that overlap in k - 1 make one
  of k + 1, named by the pair of its parts, and the new relation comes out in sorted order.

What crosses the network are distinct groups of chunks, never occurrences; a group that occurs everywhere sends one row per
chunk. Relations lie in buckets of chunks, so the frequent groups come to their chunk and no relation is shuffled. A
group's number is the lowest place at which a chunk sent it, so no numbering pass is needed and a rerun of a lost task
gives the same numbers.

A chunk may have a million groups and more, all of them frequent. Spark has them as plain rows or as one packed value of the
chunk, never as an array: it would make an object of each element.

Odd rows: a null text is empty, a null language is ``und`` and one with texts of that name; repeated rows count as often as
they stand; an empty table has no phrases. Further columns are left out.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window, functions as F

from ..operators.sizing import broadcast_if_small
from .blocks import bucketed, squeeze, unsqueeze
from .common import release_memory, small_batches, sort_merged, stored, text_parts

#: Bytes of text of a chunk; a longer text is a chunk of its own. A worker needs some 20 times as much where all groups are frequent.
CHUNK_BYTES = 8 << 20
#: Bytes of text of a bucket of chunks, and buckets at most: beyond, a bucket has several chunks.
BUCKET_BYTES, MOST_BUCKETS = 16 << 20, 20_000
#: Groups of a chunk that are sent at once; parts of a language that are ranked apart.
SENT, PARTS = 1 << 16, 16
#: Frequent groups of a task that are packed at once.
TOLD = 1 << 20
#: A group's number is its chunk's number and, in so many bits, its place among the chunk's groups.
_PLACE_BITS = 28
#: A chunk's number is its task's and, in so many bits, its place in the task.
_CHUNK_BITS = 12
_NO_LANGUAGE = "und"

# The bytes that part pieces and those that part words.
_PIECE_ENDS = np.isin(np.arange(256), [*b".,;:!?", *range(0x0A, 0x0E)])
_BLANKS = np.isin(np.arange(256), [*b" \t"])
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 0x20

_WORDS = "chunk long, lang array<string>, word array<string>, n array<int>, relation binary"
_WORDS_SCHEMA = pa.schema([
    ("chunk", pa.int64()), ("lang", pa.list_(pa.string())), ("word", pa.list_(pa.string())), ("n", pa.list_(pa.int32())), ("relation", pa.binary()),
])
#: ``groups`` holds left, right and n of ``size`` groups.
_GROUPS = "chunk long, groups binary, size int, relation binary"
_GROUPS_SCHEMA = pa.schema([("chunk", pa.int64()), ("groups", pa.binary()), ("size", pa.int32()), ("relation", pa.binary())])


def _packed(piece: np.ndarray, pos: np.ndarray, group: np.ndarray) -> bytes:
    """A sorted relation; pieces as steps, which are mostly 0."""
    steps = np.diff(piece, prepend=0)
    return squeeze(b"".join(x.astype(np.int32).tobytes() for x in (steps, pos, group)), 3)


def _unpacked(blob: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    steps, pos, group = np.frombuffer(unsqueeze(blob), np.int32).reshape(3, -1)
    return np.cumsum(steps), pos, group


def _packed_groups(left: np.ndarray, right: np.ndarray, n: np.ndarray) -> bytes:
    return squeeze(b"".join(x.tobytes() for x in (left.astype(np.int64), right.astype(np.int64), n.astype(np.int32))), 3)


def _unpacked_groups(blob: bytes) -> dict[str, pa.Array]:
    data = unsqueeze(blob)
    size = len(data) // 20
    return {
        "left": pa.array(np.frombuffer(data, np.int64, size)), "right": pa.array(np.frombuffer(data, np.int64, size, 8 * size)),
        "n": pa.array(np.frombuffer(data, np.int32, size, 16 * size)),
    }


def _list(values) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), values if isinstance(values, pa.Array) else pa.array(values))


# The relation of single words


def _first_relation(number: int, langs: list[str | None], data: np.ndarray, ends: np.ndarray) -> pa.RecordBatch:
    """Occurrences of words in a chunk: texts one after another, where each ends, and the language of each."""
    data = _LOWER[data]
    inside = ~(_PIECE_ENDS | _BLANKS)[data]
    begins = inside.copy()
    begins[1:] &= ~inside[:-1]
    starts = np.concatenate(([0], ends[:-1])).astype(np.int64)
    filled = starts[ends > starts]
    begins[filled] = inside[filled]
    at = np.flatnonzero(begins)
    # A word is what stands inside from its start on, up to the next start.
    offsets = np.concatenate(([0], np.cumsum(np.add.reduceat(inside, at, dtype=np.int64) if len(at) else at)))
    words = pa.LargeBinaryArray.from_buffers(
        pa.large_binary(), len(at), [None, pa.py_buffer(offsets.astype(np.int64).tobytes()), pa.py_buffer(data[inside].tobytes())]
    ).dictionary_encode()
    breaks = np.sort(np.concatenate((np.flatnonzero(_PIECE_ENDS[data]), filled)))
    piece = np.searchsorted(breaks, at, side="right")
    new = np.ones(len(at), bool)
    new[1:] = piece[1:] != piece[:-1]
    firsts = np.flatnonzero(new)
    pos = np.arange(len(at)) - np.repeat(firsts, np.diff(np.append(firsts, len(at))))
    named = pa.array([x if x is not None else _NO_LANGUAGE for x in langs], pa.string()).dictionary_encode()
    lang = named.indices.to_numpy().astype(np.int64)[np.searchsorted(ends, at, side="right")]
    n_words = max(1, len(words.dictionary))
    keys, group, counts = np.unique(lang * n_words + words.indices.to_numpy(), return_inverse=True, return_counts=True)
    spelt = words.dictionary.cast(pa.large_string()).take(pa.array(keys % n_words)).cast(pa.string())
    columns = [_list(named.dictionary.take(pa.array(keys // n_words))), _list(spelt), _list(counts.astype(np.int32))]
    return pa.RecordBatch.from_arrays([pa.array([number]), *columns, pa.array([_packed(piece, pos, group)], pa.binary())], schema=_WORDS_SCHEMA)


def word_occurrences(documents: DataFrame, text: str = "text", lang: str = "lang", chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """The stored relation of words, one row per chunk: its distinct words with language and count, and their occurrences."""
    small_batches(documents.sparkSession)
    chosen = documents.select(F.col(f"`{lang}`").cast("string").alias("lang"), F.col(f"`{text}`").cast("string").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, langs, parts, ends, held = TaskContext.get().partitionId() << _CHUNK_BITS, [], [], [], 0

        def close() -> pa.RecordBatch:
            return _first_relation(number, langs, np.concatenate(parts), np.concatenate(ends))

        for batch in batches:
            data, stops = text_parts(batch.column("text"))
            begin = 0
            while begin < batch.num_rows:
                base = int(stops[begin - 1]) if begin else 0
                # Texts up to the one with which the chunk reaches its size, that one included.
                stop = min(int(np.searchsorted(stops, base + chunk_bytes - held)) + 1, batch.num_rows)
                parts.append(data[base : int(stops[stop - 1])].copy())
                ends.append(stops[begin:stop] - base + held)
                langs += batch.column("lang").slice(begin, stop - begin).to_pylist()
                held, begin = held + len(parts[-1]), stop
                if held >= chunk_bytes:
                    yield close()
                    number, langs, parts, ends, held = number + 1, [], [], [], 0
                    release_memory()
        if langs:
            yield close()
        release_memory()

    return _stored_relation(chosen.mapInArrow(run, _WORDS), _buckets(chosen))


def _buckets(chosen: DataFrame) -> int:
    n_bytes = chosen.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    return min(MOST_BUCKETS, max(1, -(-n_bytes // BUCKET_BYTES)))


def _stored_relation(df: DataFrame, buckets: int) -> DataFrame:
    return bucketed(df, "chunk", buckets, compression="zstd")


# Group-count, semi-join, merge-join


def _sent(relation: DataFrame, by: list[str]) -> DataFrame:
    """A row for each group of a chunk: ``own``, the columns ``by`` and ``n``, from the arrays or the packed groups of a relation."""
    packed = "groups" in relation.columns
    kinds = dict(relation.dtypes)
    schema = ", ".join(["own long", *(f"{c} {'long' if packed else kinds[c][6:-1]}" for c in by), "n int"])
    small_batches(relation.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                groups = _unpacked_groups(batch.column("groups")[i].as_py()) if packed else {c: batch.column(c)[i].values for c in (*by, "n")}
                first = batch.column("chunk")[i].as_py() << _PLACE_BITS
                for at in range(0, len(groups["n"]), SENT):
                    part = [groups[c].slice(at, SENT) for c in (*by, "n")]
                    yield pa.RecordBatch.from_arrays([pa.array(first + at + np.arange(len(part[0]))), *part], ["own", *by, "n"])
                release_memory()

    return relation.select("chunk", *(["groups"] if packed else [*by, "n"])).mapInArrow(run, schema)


def frequent_groups(relation: DataFrame, by: list[str], least: int) -> DataFrame:
    """Groups with at least ``least`` occurrences, stored, one row per chunk that has the group: ``own`` (chunk and place of
    the group in it), ``gid`` (the least of them) and ``f``, its occurrences. The columns ``by``, which name a group, are
    given in the row whose own number is the group's, else null.
    """
    same = Window.partitionBy(*by)
    counted = _sent(relation, by).withColumns({"f": F.sum("n").over(same), "gid": F.min("own").over(same)})
    named = [F.when(F.col("own") == F.col("gid"), F.col(c)).alias(c) for c in by]
    return stored(counted.where(F.col("f") >= least).select("own", "gid", "f", *named), "setm-frequent")


def _planes(numbers: np.ndarray) -> bytes:
    """The first bytes of all numbers, then the second ones and so on: those that hardly vary cost nothing when squeezed."""
    return numbers.view(np.uint8).reshape(len(numbers), -1).T.tobytes()


def _from_planes(data: bytes, kind: type) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(np.dtype(kind).itemsize, -1).T).view(kind).ravel()


def _told(frequent: DataFrame) -> DataFrame:
    """``chunk`` and ``told``, places of groups in the chunk in ascending order and their numbers, packed; several rows a chunk."""

    def packed(own: np.ndarray, gid: np.ndarray) -> pa.RecordBatch:
        order = np.argsort(own)
        own, gid = own[order], gid[order]
        chunk, at = own >> _PLACE_BITS, (own & ((1 << _PLACE_BITS) - 1)).astype(np.int32)
        cuts = np.flatnonzero(np.append(True, chunk[1:] != chunk[:-1]))
        blobs = [
            squeeze(_planes(np.diff(at[a:b], prepend=np.int32(0))) + _planes(gid[a:b]))
            for a, b in zip(cuts, np.append(cuts[1:], len(own)), strict=True)
        ]
        return pa.RecordBatch.from_arrays([pa.array(chunk[cuts]), pa.array(blobs, pa.binary())], ["chunk", "told"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0
        for batch in batches:
            held.append([batch.column(c).to_numpy() for c in ("own", "gid")])
            n += batch.num_rows
            if n >= TOLD:
                yield packed(*map(np.concatenate, zip(*held, strict=True)))
                held, n = [], 0
        if n:
            yield packed(*map(np.concatenate, zip(*held, strict=True)))
        release_memory()

    small_batches(frequent.sparkSession)
    return frequent.select("own", "gid").mapInArrow(run, "chunk long, told binary")


def next_relation(relation: DataFrame, frequent: DataFrame) -> DataFrame:
    """The relation of the next length, not stored: occurrences of frequent groups, merge-joined with themselves."""
    size = F.col("size") if "size" in relation.columns else F.size("n").alias("size")

    def run(own: pa.Table, told: pa.Table) -> pa.Table:
        if not own.num_rows or not told.num_rows:
            return _GROUPS_SCHEMA.empty_table()
        joined = _joined(*(own.column(c)[0].as_py() for c in ("chunk", "relation", "size")), told)
        release_memory()
        return pa.Table.from_batches([joined])

    return relation.select("chunk", "relation", size).groupBy("chunk").cogroup(_told(frequent).groupBy("chunk")).applyInArrow(run, _GROUPS)


def _joined(chunk: int, blob: bytes, size: int, told: pa.Table) -> pa.RecordBatch:
    piece, pos, group = _unpacked(blob)
    gid = np.full(size, -1, np.int64)
    for part in told.column("told"):
        data = unsqueeze(part.as_py())
        cut = len(data) // 12 * 4
        gid[np.cumsum(_from_planes(data[:cut], np.int32))] = _from_planes(data[cut:], np.int64)
    del told, blob
    kept = gid[group] >= 0
    piece, pos, group = piece[kept], pos[kept], group[kept].astype(np.int64)
    # Both sides are one relation, sorted by piece and position and with one row for each: the partner at the next
    # position of the piece can only be the next row.
    at = np.flatnonzero((piece[1:] == piece[:-1]) & (pos[1:] == pos[:-1] + 1))
    pairs, place, counts = np.unique(group[at] * size + group[at + 1], return_inverse=True, return_counts=True)
    del group, kept
    own = _packed(piece[at], pos[at], place)
    del piece, pos, at, place
    groups = _packed_groups(gid[pairs // size], gid[pairs % size], counts)
    return pa.RecordBatch.from_arrays([pa.array([chunk]), pa.array([groups], pa.binary()), pa.array([len(pairs)], pa.int32()), pa.array([own], pa.binary())], schema=_GROUPS_SCHEMA)


# Phrases and their scores


def _named(frequent: DataFrame) -> DataFrame:
    return frequent.where("own = gid").drop("own")


def _score(a: Column, left: Column, right: Column) -> Column:
    """floor(1000000 a a / (left right)): decimals of 38 digits hold the products of counts below 10 ** 16."""
    exact = lambda c: c.cast("decimal(16,0)")
    return F.call_function("div", F.lit(1_000_000).cast("decimal(7,0)") * (exact(a) * exact(a)), exact(left) * exact(right))


def mine_phrases(
    documents: DataFrame, text: str = "text", lang: str = "lang", longest: int = 3, least: int = 10, absorbed_pct: int = 50,
    top: int | None = 2000, chunk_bytes: int = CHUNK_BYTES,
) -> DataFrame:
    """Phrases of 2 to ``longest`` words that stand together at least ``least`` times in a language's pieces.

    Per phrase: a (occurrences), l and r (occurrences of the two parts of its lowest-scoring cut, the earliest of equal
    ones), n (words of the language), score. A phrase that lies in a longer one with at least ``absorbed_pct`` percent of its
    occurrences is left out. ``top`` keeps the best of each language by score, occurrences and phrase; None keeps all.
    """
    relation = word_occurrences(documents, text, lang, chunk_bytes)
    frequent = frequent_groups(relation, ["lang", "word"], least)
    n_words = broadcast_if_small(stored(_sent(relation, ["lang"]).groupBy("lang").agg(F.sum("n").alias("n")), "setm-words"))
    buckets = _buckets(documents.select(F.col(f"`{text}`").alias("text")))
    ones = F.array("f")
    groups = _named(frequent).select("gid", "lang", F.col("word").alias("phrase"), F.col("word").alias("last"), "f", ones.alias("firsts"), ones.alias("lasts"))
    found: list[DataFrame] = []
    for length in range(2, longest + 1):
        relation = _stored_relation(next_relation(relation, frequent), buckets)
        frequent = frequent_groups(relation, ["left", "right"], least)
        part = lambda side, *named: sort_merged(groups.select(F.col("gid").alias(side), *[F.col(c).alias(f"{side}_{c}") for c in named]))  # noqa: E731, B023
        longer = _named(frequent).join(part("left", "lang", "phrase", "firsts"), "left").join(part("right", "last", "lasts"), "right")
        # Occurrences of the phrase's first one, two, ... words, and of its last ones.
        longer = stored(longer.select(
            "gid", "left", "right", F.col("left_lang").alias("lang"), F.concat_ws(" ", "left_phrase", "right_last").alias("phrase"),
            F.col("right_last").alias("last"), "f", F.concat("left_firsts", ones).alias("firsts"), F.concat("right_lasts", ones).alias("lasts"),
        ), "setm-groups")
        if found:
            found[-1] = _unabsorbed(found[-1], longer, absorbed_pct)
        found.append(longer)
        groups = longer
    return _reported(found, n_words, top)


def _unabsorbed(groups: DataFrame, longer: DataFrame, pct: int) -> DataFrame:
    """Groups of which no longer one has ``pct`` percent of the occurrences. Looking one word further is enough: a phrase
    between the two occurs no less often than the longer."""
    around = longer.select(F.explode(F.array("left", "right")).alias("gid"), "f").groupBy("gid").agg(F.max("f").alias("around"))
    return groups.join(around, "gid", "left").where(~F.coalesce(100 * F.col("around") >= pct * F.col("f"), F.lit(False))).drop("around")


def _reported(found: list[DataFrame], n_words: DataFrame, top: int | None) -> DataFrame:
    parts = []
    for length, groups in enumerate(found, start=2):
        cuts = [
            F.struct(_score(F.col("f"), left, right).alias("score"), F.lit(k).alias("k"), left.alias("l"), right.alias("r"))
            for k in range(1, length)
            for left, right in [(F.get("firsts", F.lit(k - 1)), F.get("lasts", F.lit(length - k - 1)))]
        ]
        parts.append(groups.select("lang", "phrase", F.col("f").alias("a"), F.array_min(F.array(*cuts)).alias("cut")))
    phrases = parts[0]
    for part in parts[1:]:
        phrases = phrases.unionByName(part)
    order = [F.desc("cut.score"), F.desc("a"), F.col("phrase")]
    if top is not None:  # a language has very many phrases; what is not among the best of its part is not among the best
        part = Window.partitionBy("lang", F.pmod(F.xxhash64("phrase"), F.lit(PARTS))).orderBy(*order)
        phrases = phrases.withColumn("rank", F.row_number().over(part)).where(F.col("rank") <= top)
    ranked = phrases.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long"))
    ranked = ranked if top is None else ranked.where(F.col("rank") <= top)
    return ranked.join(n_words, "lang").select("lang", "rank", "phrase", "a", "cut.l", "cut.r", "n", "cut.score")
