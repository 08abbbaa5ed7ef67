"""Token-ID output: documents as ids, in ascending order of their ids, in segments coded by ``rans``.

A segment file is a row of a Parquet dataset: where it stands (``part``, ``seq``), how many ids it has, the ids of its
documents and their lengths, and the coded ids. Spark commits the rows, so a lost executor leaves no half files.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterable, Iterator
from functools import cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window as W, functions as F

from . import rans
from .align import byte_alphabet
from .blocks import squeeze, unsqueeze
from .common import as_bytes, small_batches

#: Ids after which a segment is closed; a document is never parted. Bytes of text that one task writes.
SEGMENT_IDS = 2_000_000
PART_BYTES = 16 << 20
#: Words of late whose ids a worker remembers; it also keeps as many earlier ones.
REMEMBERED = 300_000
#: Bytes of text whose new words are learnt together.
LEARNT_BYTES = 1 << 18
_SEGMENT = "part int, seq int, n_tokens long, n_docs long, docs binary, payload binary"
_SCHEMA = pa.schema(
    [("part", pa.int32()), ("seq", pa.int32()), ("n_tokens", pa.int64()), ("n_docs", pa.int64()), ("docs", pa.binary()), ("payload", pa.binary())]
)
_DOCS = pa.schema([("key", pa.int64()), ("n", pa.int64())])
_MARKS = b".,;:!?%&$*#|-()\""
#: Words of small letters below U+0100, and words that end in a letter of that range.
_LETTERS = re.compile(rb"(?:[a-z]|\xc3[\x9f-\xb6\xb8-\xbf])+")
_LETTER_LAST = re.compile(rb"(?:[A-Za-z]|\xc3[\x80-\x96\x98-\xb6\xb8-\xbf])\Z")


class WordCoder:
    """Ids of texts by a tokenizer that drops white space and whose tokens never reach over it.

    Texts are parted at ASCII white space and each different word is handed to the tokenizer once. Marks after a
    letter begin a token of their own, so a word and the marks after it are remembered apart. Words of small Latin
    letters are one token before merging, whatever the steps before make of them, and go to the merges alone.
    """

    def __init__(self, path: str, remembered: int = REMEMBERED) -> None:
        import tokenizers

        self.tokenizer = tokenizers.Tokenizer.from_file(path)
        self.remembered = remembered
        # Special tokens are matched as they are written, so a word that is one but for its case must keep its case.
        self.special = [t.content.lower().encode() for t in self.tokenizer.get_added_tokens_decoder().values()]
        # Words of late, and those before them, which are forgotten next.
        self.known: dict[bytes, bytes] = {}
        self.older: dict[bytes, bytes] = {}
        # The merges alone, which read bytes in the alphabet of byte-level vocabularies; ids that end a word.
        self.merges = tokenizers.Tokenizer(self.tokenizer.model)
        self.merges.pre_tokenizer = tokenizers.pre_tokenizers.WhitespaceSplit()
        self.letters = {b: c for c, b in byte_alphabet().items()}
        suffix, vocabulary = getattr(self.tokenizer.model, "end_of_word_suffix", None), self.tokenizer.get_vocab()
        self.ends = np.zeros(max(vocabulary.values(), default=0) + 1, bool)
        self.ends[[i for token, i in vocabulary.items() if suffix and token.endswith(suffix)]] = True

    def _learn(self, words: list[bytes]) -> None:
        plain = [w for w in words if _LETTERS.fullmatch(w)]
        if not self._merged(plain):
            self._whole(words)
        elif len(plain) < len(words):
            self._whole([w for w in words if w not in self.known])

    def _merged(self, words: list[bytes]) -> bool:
        """Joined by spaces, some thousand at a time; a word is over where an id ends one. False if that can't be told."""
        for i in range(0, len(words), 4096):
            batch = words[i : i + 4096]
            ids = np.array(self.merges.encode_batch_fast([b" ".join(batch).decode("latin-1").translate(self.letters | {0x20: " "})], add_special_tokens=False)[0].ids, "<u4")
            cuts = [0, *(4 * (np.flatnonzero(self.ends[ids]) + 1)).tolist()]
            if len(cuts) != len(batch) + 1 or cuts[-1] != 4 * len(ids):
                return False
            raw = ids.tobytes()
            self.known.update(zip(batch, (raw[a:b] for a, b in zip(cuts, cuts[1:], strict=False)), strict=True))
        return True

    def _whole(self, words: list[bytes]) -> None:
        """Joined by spaces, a few hundred at a time; where a token stands tells whose it is."""
        for i in range(0, len(words), 256):
            batch = [w.decode() for w in words[i : i + 256]]
            coded = self.tokenizer.encode(" ".join(batch), add_special_tokens=False)
            ids = np.array(coded.ids, "<u4")
            starts = np.concatenate(([0], np.cumsum([len(w) + 1 for w in batch])[:-1]))
            owner = np.searchsorted(starts, [a for a, _ in coded.offsets], side="right") if len(ids) else np.empty(0, np.int64)
            cuts = np.searchsorted(owner, np.arange(1, len(batch) + 2))
            raw = ids.tobytes()
            for j, word in enumerate(words[i : i + 256]):
                self.known[word] = raw[4 * cuts[j] : 4 * cuts[j + 1]]

    def _cased(self, text: bytes) -> bytes:
        """The text in lower case, where that leaves the ids as they are: below U+0100, where nothing composes, beside
        words with special tokens."""
        if text.isascii():
            lower = text.lower()
        else:
            chars = text.decode()
            try:
                chars.encode("latin-1")
            except UnicodeEncodeError:
                return text
            lower = chars.lower().encode()
        if not any(t in lower for t in self.special):
            return lower
        keep = lambda word: any(t in word.lower() for t in self.special)
        return b" ".join(w if keep(w) else w.decode().lower().encode() for w in text.split())

    def encode(self, text: bytes) -> bytes:
        """The ids of a text as little-endian 32-bit numbers."""
        return next(self.encode_all([text]))

    def encode_all(self, texts: Iterable[bytes]) -> Iterator[bytes]:
        """As ``encode``, text by text; the new words of some texts are learnt at once."""
        waiting, held = [], 0
        for text in texts:
            waiting.append(self._cased(text).split())
            held += len(text)
            if held >= LEARNT_BYTES:
                yield from self._known(waiting)
                waiting, held = [], 0
        yield from self._known(waiting)

    def _known(self, texts: list[list[bytes]]) -> list[bytes]:
        known = self.known
        if len(known) > self.remembered:
            self.older, self.known = known, {}
            known = self.known
        # What these texts need, apart: most look-ups so meet a small table.
        near = dict.fromkeys(chain.from_iterable(texts))
        near.update(zip(near, map(known.get, near), strict=True))
        fresh = {word for word, ids in near.items() if ids is None}
        if fresh:
            back = fresh & self.older.keys()
            known.update(zip(back, map(self.older.__getitem__, back), strict=True))
            parted = {}
            for word in fresh - back:
                core = word.rstrip(_MARKS)
                if core != word and _LETTER_LAST.search(core):
                    parted[word] = (core, word[len(core) :])
            needed = (fresh - back - parted.keys()).union(*parted.values())
            for word in needed & self.older.keys():
                known[word] = self.older[word]
            self._learn([w for w in needed if w not in known])
            for word, (core, marks) in parted.items():
                known[word] = known[core] + known[marks]
            near.update(zip(fresh, map(known.__getitem__, fresh), strict=True))
        return [b"".join(map(near.__getitem__, text)) for text in texts]


@cache
def coder(path: str) -> WordCoder:
    return WordCoder(path)


def write_tokens(documents: DataFrame, path: str, tokenizer: str, end: int, key: str = "doc_id", text: str = "text") -> None:
    """Write the ids of every whole text, each followed by ``end``, to ``path`` in ascending order of ``key``.

    A null or empty text is the end alone. A null key comes first; rows of equal keys follow one another in the order of
    a hash of their texts. An empty table writes a dataset without rows.
    """
    small_batches(documents.sparkSession)
    slim = documents.select(F.col(f"`{key}`").cast("long").alias("key"), F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text"))
    n_bytes = slim.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    tie = F.xxhash64("text")
    ordered = slim.repartitionByRange(max(1, -(-n_bytes // PART_BYTES)), "key", tie).sortWithinPartitions("key", tie)
    last = np.array([end], "<u4").tobytes()

    def segments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, seq, coded = TaskContext.get().partitionId(), 0, coder(tokenizer)
        keys, parts, held = [], [], 0
        for batch in batches:
            for k, ids in zip(batch.column("key").to_pylist(), coded.encode_all(as_bytes(batch.column("text"))), strict=True):
                keys.append(k)
                parts.append(ids + last)
                held += len(parts[-1])
                if held >= 4 * SEGMENT_IDS:
                    yield _segment(part, seq, keys, parts)
                    seq, keys, parts, held = seq + 1, [], [], 0
        if keys:
            yield _segment(part, seq, keys, parts)

    ordered.mapInArrow(segments, _SEGMENT).write.option("compression", "none").parquet(path)


def _segment(part: int, seq: int, keys: list, parts: list[bytes]) -> pa.RecordBatch:
    ids = np.frombuffer(b"".join(parts), "<u4")
    sink = pa.BufferOutputStream()
    docs = pa.table([pa.array(keys, pa.int64()), pa.array([len(p) // 4 for p in parts])], schema=_DOCS)
    with pa.ipc.new_stream(sink, _DOCS) as stream:
        stream.write_table(docs)
    row = {"part": part, "seq": seq, "n_tokens": len(ids), "n_docs": len(keys),
           "docs": squeeze(sink.getvalue().to_pybytes(), 3), "payload": rans.encode(ids)}
    return pa.RecordBatch.from_pylist([row], _SCHEMA)


def segment_starts(segments: DataFrame) -> DataFrame:
    """``part``, ``seq`` and how many ids all earlier segments have. Only totals of parts meet in one task."""
    parts = segments.groupBy("part").agg(F.sum("n_tokens").alias("n"))
    before = F.sum("n").over(W.orderBy("part").rowsBetween(W.unboundedPreceding, -1))
    parts = parts.select(F.col("part").alias("of"), F.coalesce(before, F.lit(0)).alias("base"))
    inner = F.sum("n_tokens").over(W.partitionBy("part").orderBy("seq").rowsBetween(W.unboundedPreceding, -1))
    placed = segments.select("part", "seq", F.coalesce(inner, F.lit(0)).alias("inner"))
    return placed.join(parts, F.col("part") == F.col("of")).select("part", "seq", (F.col("base") + F.col("inner")).alias("start"))


def _each_document(segments: DataFrame, schema: str, row_of) -> DataFrame:
    small_batches(segments.sparkSession)
    arrow = pa.schema([("part", pa.int32()), ("seq", pa.int32()), ("key", pa.int64()), ("offset", pa.int64()), ("n_tokens", pa.int64()), *row_of[0]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                docs = pa.ipc.open_stream(unsqueeze(row["docs"])).read_all()
                n = docs.column("n").to_numpy()
                ends = np.cumsum(n)
                values = row_of[1](rans.decode(row["payload"]).astype("<u4"), ends - n, ends)
                m = len(n)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([row["part"]] * m, pa.int32()), pa.array([row["seq"]] * m, pa.int32()),
                     docs.column("key").combine_chunks(), pa.array(ends - n), pa.array(n), values], schema=arrow)

    return segments.select("part", "seq", "docs", "payload").mapInArrow(run, f"part int, seq int, key long, offset long, n_tokens long, {schema}")


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """The files read back, one row per document: ``key``, ``start`` (ids of all documents before), ``n_tokens``, ``ids``.

    Segments are decoded in parallel; one that is damaged raises an error.
    """
    segments = spark.read.schema(_SEGMENT).parquet(path)

    def lists(ids: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> pa.Array:
        return pa.ListArray.from_arrays(pa.array(np.append(starts, ends[-1]).astype(np.int32)), pa.array(ids.astype(np.int64)))

    found = _each_document(segments, "ids array<long>", ([("ids", pa.list_(pa.int64()))], lists))
    return _placed(found, segments).select("key", "start", "n_tokens", "ids")


def read_checksums(spark: SparkSession, path: str) -> DataFrame:
    """As ``read_tokens``, with ``ids_crc32`` (of the ids as little-endian unsigned 32-bit numbers) in place of the ids."""
    segments = spark.read.schema(_SEGMENT).parquet(path)

    def sums(ids: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> pa.Array:
        raw = ids.tobytes()
        return pa.array([zlib.crc32(raw[4 * a : 4 * b]) for a, b in zip(starts.tolist(), ends.tolist(), strict=True)], pa.int64())

    found = _each_document(segments, "ids_crc32 long", ([("ids_crc32", pa.int64())], sums))
    return _placed(found, segments).select("key", "start", "n_tokens", "ids_crc32")


def _placed(found: DataFrame, segments: DataFrame) -> DataFrame:
    return found.join(segment_starts(segments.select("part", "seq", "n_tokens")), ["part", "seq"]).withColumn("start", F.col("start") + F.col("offset"))
