"""Blocks of documents, and counting of keys over all blocks.

A block is one row: the texts of some documents as one compressed blob, where each ends, and all other columns as
an Arrow stream. Several passes over the same texts read it; a pass sends keys to be counted over the whole corpus
and gets the counts back block by block. The table of blocks is bucketed by block number, so that answers join it
without moving a text.

Keys are 64-bit hashes. A block sends its distinct keys, sorted, in one piece per range of hash values; hashes spread
evenly, so no piece is hot, however often a key occurs: a key costs one entry per block that has it.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import cache, reduce

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from ..session import scratch_folder
from .common import release_memory, small_batches, stored, text_parts

#: Bytes of text after which a block is closed. A longer document is a block of its own.
BLOCK_BYTES = 4 << 20
#: For operators that run in one session with others, whose workers hold memory of their own.
SMALL_BLOCK_BYTES = 2 << 20
#: Bytes of text whose blocks share a bucket, and whose keys share a range of hash values.
BUCKET_BYTES, RANGE_BYTES = 8 << 20, 16 << 20
#: Buckets at most, as Spark sets a bound; beyond it more blocks share a bucket, which are still worked on one by one.
MAX_BUCKETS = 50_000
#: What a document counts besides its text, so that very many empty ones fill a block too.
_ROW_BYTES = 32
#: A document's node is its block's number and, in so many bits, its place in the block.
NODE_BITS = 20
_NULLS = "_llm_null"
_BLOCK = "block long, rows binary, ends binary, text binary"
_SCHEMA = pa.schema([("block", pa.int64()), ("rows", pa.binary()), ("ends", pa.binary()), ("text", pa.binary())])
ANSWERS = "block long, part int, answer binary"
_ANSWERS = pa.schema([("block", pa.int64()), ("part", pa.int32()), ("answer", pa.binary())])


def squeeze(data: bytes, level: int = 1) -> bytes:
    return zstandard.ZstdCompressor(level=level).compress(data)


def unsqueeze(data: bytes) -> bytes:
    return zstandard.ZstdDecompressor().decompress(data)


@dataclass(frozen=True)
class Block:
    number: int
    #: All columns but the text, one row per document.
    rows: pa.Table
    #: The texts' bytes one after another, and where each ends.
    data: np.ndarray
    ends: np.ndarray
    #: What each counting pass answered, by part.
    answers: tuple[dict[int, bytes], ...]
    #: Which texts are null.
    nulls: np.ndarray

    def only(self, places: np.ndarray) -> Block:
        """A block of some of the documents, without their rows."""
        lengths = (self.ends - self.starts)[places]
        ends = np.cumsum(lengths)
        at = np.repeat(self.starts[places] - (ends - lengths), lengths) + np.arange(ends[-1] if len(ends) else 0)
        return Block(self.number, self.rows.slice(0, 0), self.data[at], ends, (), self.nulls[places])

    @property
    def nodes(self) -> np.ndarray:
        """A number for each document that no other row has, whatever ids the rows carry."""
        return (self.number << NODE_BITS) + np.arange(len(self.ends))

    @property
    def starts(self) -> np.ndarray:
        return np.concatenate(([0], self.ends[:-1])).astype(np.int64)


@dataclass(frozen=True)
class Blocks:
    frame: DataFrame
    #: How many ranges the keys are counted in.
    parts: int

    def each(self, work: Callable[[Block], Iterator[pa.RecordBatch]], schema, *answers: DataFrame) -> DataFrame:
        """What ``work`` yields for each block; each block comes with what it was answered, answer by answer."""
        frame = self.frame.withColumn("answers", F.lit(None).cast("array<struct<ask:int,part:int,answer:binary>>"))
        if answers:
            every = reduce(DataFrame.unionAll, (a.withColumn("ask", F.lit(i)) for i, a in enumerate(answers)))
            told = every.where("block IS NOT NULL").groupBy("block").agg(F.collect_list(F.struct("ask", "part", "answer")).alias("answers"))
            frame = self.frame.join(told, "block", "left")
        small_batches(self.frame.sparkSession)
        n = len(answers)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for i in range(batch.num_rows):
                    yield from work(_unpacked(batch.slice(i, 1), n))
                    release_memory()

        return frame.mapInArrow(run, schema)

    def each_of(self, work: Callable[[Block, np.ndarray], Iterator[pa.RecordBatch]], schema, nodes: DataFrame) -> DataFrame:
        """What ``work`` yields for each block that holds some of ``nodes``, and the places of these in the block."""
        place = F.col("node").bitwiseAND(F.lit((1 << NODE_BITS) - 1)).cast("int")
        wanted = nodes.groupBy(F.shiftright("node", NODE_BITS).alias("block")).agg(F.sort_array(F.collect_set(place)).alias("places"))
        small_batches(self.frame.sparkSession)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for i in range(batch.num_rows):
                    row = batch.slice(i, 1)
                    places = np.array(row.column("places")[0].as_py(), np.int64)
                    yield from work(_unpacked(row.select(_SCHEMA.names), 0), places)
                    release_memory()

        return self.frame.join(wanted, "block").mapInArrow(run, schema)

    def ask(self, keys: Callable[[Block], tuple[np.ndarray, ...]], *answers: DataFrame) -> DataFrame:
        """Requests: ``keys`` gives a block's distinct keys in ascending order and a weight for each. If it also gives
        a second hash for each, keys are pairs of both, in ascending order of both."""
        parts = self.parts

        def requests(block: Block) -> Iterator[pa.RecordBatch]:
            found, weights, *second = keys(block)
            cuts = np.append(np.searchsorted(found, part_starts(parts)), len(found))
            rows = [
                (p, block.number, found[a:b].tobytes(), squeeze(weights[a:b].astype(np.uint32).tobytes()), *(x[a:b].tobytes() for x in second))
                for p, (a, b) in enumerate(zip(cuts[:-1], cuts[1:], strict=True)) if b > a
            ]
            yield pa.RecordBatch.from_pylist([dict(zip(_REQUESTS.names, r, strict=False)) for r in rows], _REQUESTS)

        return self.each(requests, REQUESTS, *answers)


REQUESTS = "part int, block long, keys binary, weights binary, second binary"
_REQUESTS = pa.schema([("part", pa.int32()), ("block", pa.int64()), *((n, pa.binary()) for n in ("keys", "weights", "second"))])


def part_starts(parts: int) -> np.ndarray:
    """Where each of ``parts`` equal ranges of the 64-bit numbers begins."""
    return np.array([(i << 64) // parts for i in range(parts)], np.uint64)


def _unpacked(row: pa.RecordBatch, n_answers: int) -> Block:
    of = {name: row.column(name)[0] for name in row.schema.names}
    answers: tuple[dict[int, bytes], ...] = tuple({} for _ in range(n_answers))
    for a in (of["answers"].as_py() or []) if n_answers else []:
        answers[a["ask"]][a["part"]] = a["answer"]
    rows = pa.ipc.open_stream(unsqueeze(of["rows"].as_py())).read_all()
    return Block(
        of["block"].as_py(),
        rows.drop_columns([_NULLS]),
        np.frombuffer(unsqueeze(of["text"].as_py()), np.uint8),
        np.frombuffer(unsqueeze(of["ends"].as_py()), np.int64),
        answers,
        rows.column(_NULLS).to_numpy(),
    )


def make_blocks(documents: DataFrame, text: str = "text", block_bytes: int = BLOCK_BYTES) -> Blocks:
    """The documents as stored blocks; a null text counts as empty. Columns of any name and type travel along."""
    spark = documents.sparkSession
    small_batches(spark)
    n_bytes = documents.agg(F.sum(F.octet_length(F.col(f"`{text}`")))).first()[0] or 0

    def pack(number: int, rows: list[pa.RecordBatch], texts: list[np.ndarray], ends: list[np.ndarray]) -> pa.RecordBatch:
        sink = pa.BufferOutputStream()
        with pa.ipc.new_stream(sink, rows[0].schema) as stream:
            for batch in rows:
                stream.write_batch(batch)
        shifted, base = [], 0
        for part, end in zip(texts, ends, strict=True):
            shifted.append(end + base)
            base += len(part)
        blobs = (sink.getvalue().to_pybytes(), np.concatenate(shifted).astype(np.int64).tobytes(), b"".join(p.tobytes() for p in texts))
        return pa.RecordBatch.from_arrays([pa.array([number]), *(pa.array([squeeze(b)], pa.binary()) for b in blobs)], schema=_SCHEMA)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, rows, texts, ends, held = TaskContext.get().partitionId() << NODE_BITS, [], [], [], 0
        for batch in batches:
            at = batch.schema.get_field_index(text)
            data, stops = text_parts(batch.column(at))
            others = batch.select([n for n in batch.schema.names if n != text]).append_column(_NULLS, batch.column(at).is_null())
            begin = 0
            while begin < batch.num_rows:
                base = int(stops[begin - 1]) if begin else 0
                # Documents up to the one with which the block reaches its size, that one included.
                stop = min(int(np.searchsorted(stops, base + block_bytes - held)) + 1, batch.num_rows)
                rows.append(others.slice(begin, stop - begin))
                texts.append(data[base : int(stops[stop - 1])].copy())
                ends.append(stops[begin:stop] - base)
                held += len(texts[-1]) + _ROW_BYTES * (stop - begin)
                begin = stop
                if held >= block_bytes:
                    yield pack(number, rows, texts, ends)
                    number, rows, texts, ends, held = number + 1, [], [], [], 0
        if rows:
            yield pack(number, rows, texts, ends)

    buckets = min(max(1, -(-n_bytes // BUCKET_BYTES)), MAX_BUCKETS)
    frame = bucketed(documents.mapInArrow(run, _BLOCK), "block", buckets)
    return Blocks(frame, max(8, n_bytes // RANGE_BYTES))


def bucketed(df: DataFrame, key: str, buckets: int, compression: str = "none") -> DataFrame:
    """``df`` written to the shared folder in buckets of ``key`` and read back. Its catalog entry does not stay."""
    spark, name = df.sparkSession, f"llm_{uuid.uuid4().hex}"
    writer = df.write.format("parquet").option("path", scratch_folder(spark, "llm-blocks")).option("compression", compression)
    writer.bucketBy(buckets, key).saveAsTable(name)
    frame = spark.table(name)
    frame.schema  # resolved, so that it reads the files and not the name
    spark.sql(f"DROP TABLE {name}")
    return frame


def count_keys(requests: DataFrame) -> DataFrame:
    """Answers to requests, stored: for each key of a block twice the sum of its weights over all blocks, plus one
    in the first block that gave it a weight, which so owns the key.

    A further row per part with a null block has six numbers: keys with a weight, their sum, and the keys whose sum
    is one, two, three and four.
    """

    def count(group: pa.Table) -> pa.Table:
        part = group.column("part")[0].as_py()
        group = group.sort_by("block")
        keys = [np.frombuffer(k.as_py(), np.uint64) for k in group.column("keys")]
        weights = np.concatenate([np.frombuffer(unsqueeze(w.as_py()), np.uint32) for w in group.column("weights")])
        joined = np.concatenate(keys)
        second = [np.frombuffer(k.as_py(), np.uint64) for k in group.column("second") if k.is_valid]
        order, new = _ranked(joined, np.concatenate(second) if second else None)
        key_of, w = np.cumsum(new) - 1, weights[order].astype(np.int64)
        sums = np.bincount(key_of, w).astype(np.int64)
        # The order is stable, so of each key's entries with a weight the first is of the first block.
        given = np.flatnonzero(w > 0)
        firsts = given[np.concatenate(([True], key_of[given][1:] != key_of[given][:-1]))] if len(given) else given
        owned = np.zeros(len(joined), np.int64)
        owned[firsts] = 1
        told = np.empty(len(joined), np.uint64)
        told[order] = (2 * sums[key_of] + owned).astype(np.uint64)
        cuts = np.cumsum([0, *map(len, keys)])
        stats = np.array([(sums > 0).sum(), sums.sum(), *((sums == n).sum() for n in (1, 2, 3, 4))], np.int64)
        answers = [_packed(told[a:b]) for a, b in zip(cuts[:-1], cuts[1:], strict=True)] + [stats.tobytes()]
        blocks = [*group.column("block").to_pylist(), None]
        release_memory()
        return pa.table([pa.array(blocks, pa.int64()), pa.array([part] * len(blocks), pa.int32()), pa.array(answers, pa.binary())], schema=_ANSWERS)

    return stored(requests.groupBy("part").applyInArrow(count, ANSWERS), "answers")


def _ranked(keys: np.ndarray, second: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """A stable order of keys, or of pairs of keys, and where in it a new one begins."""
    order = np.argsort(keys, kind="stable") if second is None else np.lexsort((second, keys))
    new = np.ones(len(keys), bool)
    for of in (keys,) if second is None else (keys, second):
        ranked = of[order]
        differs = ranked[1:] != ranked[:-1]
        new[1:] = differs if of is keys else new[1:] | differs
    return order, new


def tally(weights: np.ndarray, keys: np.ndarray, second: np.ndarray | None = None) -> tuple[tuple[np.ndarray, ...], np.ndarray]:
    """What a block asks about: distinct keys in ascending order with summed weights (and second hashes), and the
    place of each given key among them."""
    order, new = _ranked(keys, second)
    place = np.empty(len(keys), np.int64)
    place[order] = np.cumsum(new) - 1
    heads = order[new]
    sums = np.bincount(place, weights, minlength=len(heads)).astype(np.int64)
    return (keys[heads], sums) if second is None else (keys[heads], sums, second[heads]), place


def _packed(counts: np.ndarray) -> bytes:
    wide = bool(len(counts)) and int(counts.max()) >= 2**32
    return bytes([wide]) + squeeze(counts.astype(np.uint64 if wide else np.uint32).tobytes())


def _unpacked_counts(blob: bytes) -> np.ndarray:
    return np.frombuffer(unsqueeze(blob[1:]), np.uint64 if blob[0] else np.uint32).astype(np.int64)


def answered(block: Block, ask: int) -> tuple[np.ndarray, np.ndarray]:
    """For the keys a block asked about, in ascending order: the sums over all blocks, and whether it owns the key."""
    told = [_unpacked_counts(a) for _, a in sorted(block.answers[ask].items())]
    told = np.concatenate(told) if told else np.empty(0, np.int64)
    return told >> 1, (told & 1).astype(bool)


def totals(answers: DataFrame) -> np.ndarray:
    """The six numbers of ``count_keys`` summed over all parts; there is one row per part."""
    names = [f"n{i}" for i in range(6)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            told = np.frombuffer(b"".join(batch.column(0).to_pylist()), np.int64).reshape(-1, len(names))
            yield pa.RecordBatch.from_arrays([pa.array([n]) for n in told.sum(0)], names)

    parts = answers.where("block IS NULL").select("answer").mapInArrow(run, ", ".join(f"{n} long" for n in names))
    return np.array([n or 0 for n in parts.agg(*(F.sum(n) for n in names)).first()], np.int64)


# Hashes of spans


_ODD = 0x9E3779B97F4A7C15
_INVERSE = pow(_ODD, -1, 1 << 64)
_SALTS = np.random.default_rng(20240229).integers(0, 2**63, (2, 256), np.uint64) * np.uint64(2) + np.uint64(1)
#: Places that are worked on at once. A worker so holds no array of the size of a block but those that it returns.
STEP = 1 << 16


@cache
def _powers(base: int) -> tuple[np.ndarray, np.ndarray]:
    """The powers of a number up to ``STEP``, and those at its multiples: the product of one of each is any power."""
    held = []
    for factor in (base, pow(base, STEP, 1 << 64)):
        powers = np.full(STEP, factor, np.uint64)
        powers[0] = 1
        held.append(np.cumprod(powers))
    return held[0], held[1]


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of the 64-bit numbers that spreads their bits."""
    x = x.astype(np.uint64, copy=True)
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        x ^= x >> np.uint64(shift)
        x *= np.uint64(factor)
    return x ^ (x >> np.uint64(31))


def prefix_hashes(data: np.ndarray, salt: int = 0) -> np.ndarray:
    """Sums from which the hash of any span of ``data`` follows; all arithmetic is modulo 2**64."""
    out = np.zeros(len(data) + 1, np.uint64)
    low, high = _powers(_ODD)
    for turn, at in enumerate(range(0, len(data), STEP)):
        part = _SALTS[salt][data[at : at + STEP]]
        part *= low[: len(part)]
        np.cumsum(part, out=part)
        part *= high[turn]
        np.add(part, out[at], out=out[at + 1 : at + 1 + len(part)])
    return out


def span_hashes(prefix: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of the spans [start, end), equal for equal bytes wherever they stand."""
    low, high = _powers(_INVERSE)
    spans = prefix[ends] - prefix[starts]
    spans *= low[starts % STEP]
    spans *= high[starts // STEP]
    return mixed(spans + (ends - starts).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))


_SPACE = np.isin(np.arange(256), [0x20, *range(0x09, 0x0E)])
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 0x20


def words(block: Block) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hash of each word of a block (A-Z in lower case, parted by ASCII white space), the document of each word, and
    the number of words per document."""
    data, n_docs = _LOWER[block.data], len(block.ends)
    inside = ~_SPACE[data]
    begins = inside.copy()
    begins[1:] &= ~inside[:-1]
    first = block.starts[(block.ends > block.starts)]
    begins[first] = inside[first]
    stops = np.zeros(len(data), bool)
    stops[:-1] = inside[:-1] & (~inside[1:] | begins[1:])
    if len(data):
        stops[-1] = inside[-1]
    starts, ends = np.flatnonzero(begins), np.flatnonzero(stops) + 1
    doc = np.searchsorted(block.ends, starts, side="right")
    return span_hashes(prefix_hashes(data), starts, ends), doc, np.bincount(doc, minlength=n_docs)
