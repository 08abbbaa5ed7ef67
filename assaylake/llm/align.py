"""Cross-tokenizer alignment by products of sparse incidence matrices.

A tokenizer's tokens over a text are the rows of a matrix whose columns are the text's bytes: a one where the token covers
the byte. With A and B for two tokenizers, A·Bᵀ has an entry for each pair of tokens that share bytes, and its value says how
many: the overlap links. Where tokens of both end on the same byte the text is cut into groups; the matrices of tokens by
group give, multiplied in the same way, the shared-group links. Matrices are kept in compressed sparse rows (``Rows``),
made by hand of numpy arrays; ``product`` multiplies them row by row after Gustavson. A block of documents is one
block-diagonal matrix, so no link crosses documents.

How often two ids are linked is counted over the corpus: a block sends each of its pairs once with a number, the sums are
taken by Spark, and each block gets back the sums of its own pairs. Blocks lie in a bucketed table, so an answer meets its
block without moving it. A pair sends one row per block that has it, however hot it is.

Odd rows: a null or empty text has no tokens. Nor has one whose tokens do not spell it: the bytes of each tokenizer's tokens
must join to a space and the text. A null key and repeated keys are kept. Further columns are left out.
"""

from __future__ import annotations

import hashlib
import os
import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache
from itertools import chain, pairwise

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F, types as T

from ..operators.sizing import broadcast_if_small
from .blocks import bucketed, squeeze, unsqueeze
from .common import release_memory, small_batches, stored

#: Bytes of text of a block. Tokens take some forty times the room of their text while they are aligned.
BLOCK_BYTES = 2 << 20
#: Bytes of text of a bucket of blocks, and buckets at most: beyond, a bucket has several blocks.
BUCKET_BYTES, MOST_BUCKETS = 16 << 20, 20_000
#: Characters of text that a tokenizer gets at once; a longer text is cut where no token can reach across.
SECTION = 1 << 18
_SAFE_CUT = re.compile("(?<=[A-Za-z]) (?=[A-Za-z])")
#: Units (words, roughly) of late whose ids a worker remembers; it also keeps as many earlier ones. Longer units are not parted off.
REMEMBERED, LONGEST_UNIT = 150_000, 100
_UNIT, _MEETING = re.compile(" ?[^ \n]+|\n"), re.compile(r"\s(?:\s|\Z)")
_ID = np.dtype("<u4")


# Matrices in compressed sparse rows


@dataclass(frozen=True)
class Rows:
    """Row i has its entries at places starts[i] to starts[i + 1] of ``columns`` and ``values``; columns ascend in a row."""

    starts: np.ndarray
    columns: np.ndarray
    values: np.ndarray
    width: int

    @property
    def height(self) -> int:
        return len(self.starts) - 1

    @property
    def row_of(self) -> np.ndarray:
        """The row of each entry."""
        return np.repeat(np.arange(self.height, dtype=self.columns.dtype), np.diff(self.starts))

    def transposed(self) -> Rows:
        """Entries by column; a counting sort, so rows ascend within each."""
        if len(self.columns) < 2 or np.all(self.columns[1:] > self.columns[:-1]):
            order = slice(None)
        else:
            order = np.argsort(self.columns, kind="stable")
        starts = np.concatenate(([0], np.cumsum(np.bincount(self.columns, minlength=self.width))))
        return Rows(starts, self.row_of[order], self.values[order], self.height)


def incidence(lengths: np.ndarray) -> Rows:
    """Tokens by bytes: tokens follow one another, each covers as many bytes as it is long."""
    ends = np.cumsum(lengths)
    n = int(ends[-1]) if len(ends) else 0
    return Rows(np.concatenate(([0], ends)), np.arange(n, dtype=index_type(n)), np.ones(n, np.int32), n)


def index_type(n: int) -> type:
    """The narrower of two kinds of numbers that counts to ``n``: what is done byte by byte takes half the room and less time."""
    return np.int32 if n < 1 << 31 else np.int64


def membership(groups: np.ndarray, n_groups: int) -> Rows:
    """Tokens by groups: each token lies in one."""
    return Rows(np.arange(len(groups) + 1), groups, np.ones(len(groups), np.int32), n_groups)


def product(a: Rows, b: Rows) -> Rows:
    """a·b: each row of the result is the sum of b's rows at the columns of a's row, weighted by a's values."""
    sizes_b = np.diff(b.starts)
    # The entries of b's rows, one after another in the order in which a's entries name them.
    if np.all(sizes_b == 1):
        row, column = a.row_of, b.columns[a.columns] if len(b.columns) else b.columns[:0]
        value = a.values * b.values[a.columns] if _small(a.values) and _small(b.values) else a.values.astype(np.int64) * b.values[a.columns]
    else:
        of_b = sizes_b[a.columns]
        ends = np.cumsum(of_b)
        at = np.arange(int(ends[-1]) if len(ends) else 0) + np.repeat(b.starts[a.columns] - (ends - of_b), of_b)
        row, column = np.repeat(a.row_of, of_b), b.columns[at]
        value = np.repeat(a.values, of_b).astype(np.int64) * b.values[at]
    n = len(row)
    new = np.ones(n, bool)
    same = row[1:] == row[:-1]
    if np.any(same & (column[1:] < column[:-1])) or np.any(row[1:] < row[:-1]):
        order = np.lexsort((column, row))
        row, column, value = row[order], column[order], value[order]
        same = row[1:] == row[:-1]
    new[1:] = ~(same & (column[1:] == column[:-1]))
    firsts = np.flatnonzero(new)
    sums = np.add.reduceat(value, firsts, dtype=np.int64) if n else value.astype(np.int64)
    starts = np.concatenate(([0], np.cumsum(np.bincount(row[firsts], minlength=a.height))))
    return Rows(starts, column[firsts], sums, b.width)


def _small(values: np.ndarray) -> bool:
    """Whether products of two such values fit into 32 bits."""
    return values.dtype == np.int32 and (not len(values) or -(1 << 15) < int(values.min()) and int(values.max()) < 1 << 15)


def product_sizes(a: Rows, b: Rows) -> np.ndarray:
    """Entries that each row of a·b adds up, without making them."""
    of_b = np.concatenate(([0], np.cumsum(np.diff(b.starts)[a.columns])))
    return of_b[a.starts[1:]] - of_b[a.starts[:-1]]


# Tokens and their bytes


class Spelling:
    """The bytes of each id, for many ids at once."""

    def __init__(self, spelled: list[bytes]) -> None:
        self.data = np.frombuffer(b"".join(spelled), np.uint8)
        self.lengths = np.array([len(s) for s in spelled], np.int64)
        self.starts = np.cumsum(self.lengths) - self.lengths

    def join(self, ids: np.ndarray) -> np.ndarray:
        lengths = self.lengths[ids]
        ends = np.cumsum(lengths)
        at = np.arange(int(ends[-1]) if len(ends) else 0) + np.repeat(self.starts[ids] - (ends - lengths), lengths)
        return self.data[at]


def byte_alphabet() -> dict[str, int]:
    """The characters that stand for bytes in byte-level vocabularies: printable ones for themselves, the others by rank."""
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in printable]
    return {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(others)}


class ByteLevel:
    """A byte-level tokenizer's ids of a space and a text, special tokens read as plain text."""

    def __init__(self, path: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark already runs a task per core
        import tokenizers

        self.tokenizer = tokenizers.Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        byte_of, spelled = byte_alphabet(), [b""] * self.tokenizer.get_vocab_size()
        for token, i in self.tokenizer.get_vocab().items():
            # An added token with characters outside the alphabet stands for its own text.
            spelled[i] = bytes(byte_of[c] for c in token) if all(c in byte_of for c in token) else token.encode()
        self.spelling = Spelling(spelled)
        # Units of late and their ids, and those before them, which are forgotten next.
        self.known: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    def ids(self, texts: list[str]) -> list[list[int] | np.ndarray]:
        parted = [units(f" {t}") for t in texts]
        whole = [i for i, found in enumerate(parted) if found is None]
        out: list = self._remembered([found or [] for found in parted])
        for i, ids in zip(whole, self._plain([f" {texts[i]}" for i in whole]), strict=True):
            out[i] = ids
        return out

    def _plain(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _remembered(self, texts: list[list[str]]) -> list[np.ndarray]:
        if len(self.known) > REMEMBERED:
            self.older, self.known = self.known, {}
        near = dict.fromkeys(chain.from_iterable(texts))
        near.update(zip(near, map(self.known.get, near), strict=True))
        fresh = {unit for unit, ids in near.items() if ids is None}
        if fresh:
            back = fresh & self.older.keys()
            found = dict(zip(back, map(self.older.__getitem__, back), strict=True))
            found |= self._learnt([unit for unit in fresh if unit not in back])
            self.known.update(found)
            near.update(found)
        return [np.frombuffer(b"".join(map(near.__getitem__, text)), _ID) for text in texts]

    def _learnt(self, fresh: list[str]) -> dict[str, bytes]:
        """Units with a space before them are encoded as one text; the bytes that its tokens spell tell whose they are."""
        spaced, others = [u for u in fresh if u[0] == " "], [u for u in fresh if u[0] != " "]
        ids = np.array(self._plain(["".join(spaced)])[0], _ID)
        ends, own = np.cumsum(self.spelling.lengths[ids]), np.cumsum([len(u.encode()) for u in spaced], dtype=np.int64)
        cuts = np.searchsorted(ends, own, side="right")
        if not np.array_equal(ends[cuts - 1] if len(ids) else ends, own):
            spaced, others, cuts = [], fresh, cuts[:0]
        raw, cuts = ids.tobytes(), [0, *(4 * cuts).tolist()]
        found = dict(zip(spaced, (raw[a:b] for a, b in pairwise(cuts)), strict=True))
        found.update(zip(others, (np.array(x, _ID).tobytes() for x in self._plain(others)), strict=True))
        return found


def units(text: str) -> list[str] | None:
    """A text parted at single spaces and line feeds, where a byte-level tokenizer's tokens end: a space goes with what follows.
    None for a text where white space meets white space or its end, or with a unit too long to be remembered."""
    if _MEETING.search(text):
        return None
    parts = _UNIT.findall(text)
    return None if parts and len(max(parts, key=len)) > LONGEST_UNIT else parts


class PieceModel:
    """A SentencePiece model's ids of a text; the model puts the space before it."""

    def __init__(self, path: str) -> None:
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        pieces = range(self.model.get_piece_size())
        self.spelling = Spelling([
            bytes([int(self.model.id_to_piece(i)[3:5], 16)]) if self.model.is_byte(i) else self.model.id_to_piece(i).replace("▁", " ").encode()
            for i in pieces
        ])

    def ids(self, texts: list[str]) -> list[list[int]]:
        return self.model.encode(texts, num_threads=1)


@cache
def tokenizer(path: str) -> ByteLevel | PieceModel:
    return PieceModel(path) if path.endswith(".model") else ByteLevel(path)


def sections(text: str, size: int | None = None) -> list[str]:
    """Parts of a text that tokens cannot reach across, joined by single spaces: cut at spaces between ASCII letters."""
    size, parts, begin = SECTION if size is None else size, [], 0
    while len(text) - begin > size and (found := _SAFE_CUT.search(text, begin + size)):
        parts.append(text[begin : found.start()])
        begin = found.end()
    return [*parts, text[begin:]]


def _encoded(coder: ByteLevel | PieceModel, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """The ids of all texts one after another, and how many each has. What the library makes besides ids is big, so it gets
    some sections at a time."""
    ids, counts, waiting, held = [], np.zeros(len(texts), np.int64), [], 0

    def flush() -> None:
        for (at, _), found in zip(waiting, coder.ids([s for _, s in waiting]), strict=True):
            ids.append(np.array(found, np.int64))
            counts[at] += len(found)
        waiting.clear()

    for at, text in enumerate(texts):
        for section in sections(text) if text else ():
            waiting.append((at, section))
            held += len(section)
            if held >= SECTION:
                flush()
                held = 0
    flush()
    return np.concatenate(ids) if ids else np.empty(0, np.int64), counts


# Alignment of a block of documents


@dataclass(frozen=True)
class Aligned:
    """Two tokenizations of a block of texts: ids, tokens per document, groups, and links in the order of the text."""

    a_ids: np.ndarray
    b_ids: np.ndarray
    n_a: np.ndarray
    n_b: np.ndarray
    #: Of each token its group, counted through the block; groups per document.
    a_groups: np.ndarray
    b_groups: np.ndarray
    n_groups: np.ndarray
    #: Overlap links: places of the tokens, bytes shared, whether their ranges end together.
    link_a: np.ndarray
    link_b: np.ndarray
    shared: np.ndarray
    together: np.ndarray

    def digests(self) -> list[str]:
        """SHA-256 of the written groups of each document; empty without tokens."""
        n_groups = int(self.n_groups.sum())
        in_a, in_b = np.bincount(self.a_groups, minlength=n_groups), np.bincount(self.b_groups, minlength=n_groups)
        # Written order: A's tokens of a group, then B's.
        place = np.concatenate((
            np.arange(len(self.a_ids)) + (np.cumsum(in_b) - in_b)[self.a_groups], np.arange(len(self.b_ids)) + np.cumsum(in_a)[self.b_groups],
        ))
        last = np.concatenate((np.append(self.a_groups[1:] != self.a_groups[:-1], [True] * bool(len(self.a_ids))),
                               np.append(self.b_groups[1:] != self.b_groups[:-1], [True] * bool(len(self.b_ids)))))
        mark = np.where(last, np.repeat([ord("|"), ord(";")], [len(self.a_ids), len(self.b_ids)]), ord(","))
        ids, marks = np.empty(len(place), np.int64), np.empty(len(place), np.uint8)
        ids[place], marks[place] = np.concatenate((self.a_ids, self.b_ids)), mark
        digits, width = _decimals(ids)
        digits[np.arange(len(ids)), width] = marks
        data = digits[np.arange(digits.shape[1]) <= width[:, None]].tobytes()
        token_ends = np.concatenate(([0], np.cumsum(width + 1)))
        ends = token_ends[np.cumsum(self.n_a + self.n_b)]
        return [hashlib.sha256(data[a : b - 1]).hexdigest() if b > a else "" for a, b in zip([0, *ends[:-1]], ends, strict=True)]

    def n_shared_group(self) -> np.ndarray:
        """Shared-group links of each A token: what the product of the group matrices has in its row."""
        n = int(self.n_groups.sum())
        return product_sizes(membership(self.a_groups, n), membership(self.b_groups, n).transposed())


def shared_group_links(found: Aligned) -> Rows:
    """The shared-group links themselves, A tokens by B tokens."""
    n = int(found.n_groups.sum())
    return product(membership(found.a_groups, n), membership(found.b_groups, n).transposed())


def _decimals(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The decimal digits of ids, one row each, with room for one character more, and how many each has."""
    digits, width = _numbers(int(ids.max()).bit_length() if len(ids) else 1)
    return digits[ids], width[ids]


@cache
def _numbers(bits: int) -> tuple[np.ndarray, np.ndarray]:
    """The digits of all numbers below 2 ** bits: ids are below the size of a vocabulary."""
    n, most = np.arange(1 << bits), len(str((1 << bits) - 1))
    width = np.sum([n >= 10**k for k in range(1, most)], axis=0).astype(np.int64) + 1 if most > 1 else np.ones(len(n), np.int64)
    out = np.zeros((len(n), most + 1), np.uint8)
    for k in range(most):
        has = width > k
        out[n[has], (width - 1 - k)[has]] = n[has] // 10**k % 10 + ord("0")
    return out, width


def align(texts: list[str], a: ByteLevel | PieceModel, b: ByteLevel | PieceModel) -> Aligned:
    """The alignment of each text with a space before it."""
    expected = [f" {t}".encode() if t else b"" for t in texts]
    sizes = np.array([len(e) for e in expected], np.int64)
    data = np.frombuffer(b"".join(expected), np.uint8)
    coded, spelt = [], np.ones(len(texts), bool)
    for coder in (a, b):
        ids, counts = _encoded(coder, texts)
        doc = np.repeat(np.arange(len(texts)), counts)
        joined, n_bytes = coder.spelling.join(ids), np.bincount(doc, coder.spelling.lengths[ids], len(texts)).astype(np.int64)
        spelt &= n_bytes == sizes
        if len(joined) == len(data) and np.array_equal(n_bytes, sizes):
            wrong = np.flatnonzero(joined != data)
            spelt[np.searchsorted(np.cumsum(sizes), wrong, side="right")] = False
        else:
            ends, own = np.cumsum(n_bytes), np.cumsum(sizes)
            for at in np.flatnonzero(spelt):
                spelt[at] = np.array_equal(joined[ends[at] - n_bytes[at] : ends[at]], data[own[at] - sizes[at] : own[at]])
        coded.append((coder, ids, counts, doc))
    parts = []
    for coder, ids, counts, doc in coded:
        kept = ids[spelt[doc]]
        parts.append((kept, np.where(spelt, counts, 0), coder.spelling.lengths[kept]))
    (a_ids, n_a, a_long), (b_ids, n_b, b_long) = parts
    matrix_a, matrix_b = incidence(a_long), incidence(b_long)
    overlap = product(matrix_a, matrix_b.transposed())
    a_ends, b_ends = matrix_a.starts[1:], matrix_b.starts[1:]
    common = np.zeros(matrix_a.width + 1, bool)
    common[a_ends] = True
    ends_b = np.zeros(matrix_a.width + 1, bool)
    ends_b[b_ends] = True
    common &= ends_b
    # The group of a token: how many common ends lie before its end.
    before = np.cumsum(common) - common
    per_doc = np.add.reduceat(np.append(common[1:], [False]), np.minimum(np.cumsum(np.where(spelt, sizes, 0)) - np.where(spelt, sizes, 0), matrix_a.width)) if len(texts) else np.empty(0)
    n_groups = np.where(spelt & (sizes > 0), per_doc, 0).astype(np.int64)
    link_a = overlap.row_of
    return Aligned(
        a_ids, b_ids, n_a, n_b, before[a_ends], before[b_ends], n_groups, link_a, overlap.columns, overlap.values,
        a_ends[link_a] == b_ends[overlap.columns],
    )


# Over a corpus


_STORED = "block long, a array<int>, b array<int>, n array<int>, documents binary, links binary"
_SCHEMA = pa.schema([
    ("block", pa.int64()), *((name, pa.list_(pa.int32())) for name in ("a", "b", "n")), ("documents", pa.binary()), ("links", pa.binary()),
])


def _block_row(number: int, keys: pa.Array, texts: list[str], a: ByteLevel | PieceModel, b: ByteLevel | PieceModel) -> pa.RecordBatch:
    found = align(texts, a, b)
    linked_a, linked_b = found.link_a[found.together], found.link_b[found.together]
    pair = (found.a_ids[linked_a] << 32) | found.b_ids[linked_b]
    pairs, place, counts = np.unique(pair, return_inverse=True, return_counts=True)
    doc_of_a = np.repeat(np.arange(len(texts)), found.n_a)
    n_links = np.bincount(doc_of_a[linked_a], minlength=len(texts))
    overlaps = np.bincount(doc_of_a[found.link_a], minlength=len(texts))
    in_groups = np.bincount(doc_of_a, found.n_shared_group(), len(texts)).astype(np.int64)
    rows = pa.table({
        "key": keys, "n_a": found.n_a, "n_b": found.n_b, "n_groups": found.n_groups, "n_links": n_links.astype(np.int64),
        "n_overlaps": overlaps.astype(np.int64), "n_in_groups": in_groups, "groups_sha256": found.digests(),
    })
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, rows.schema) as stream:
        stream.write_table(rows)
    arrays = [pa.array([x.astype(np.int32)]) for x in (pairs >> 32, pairs & 0xFFFFFFFF, counts)]
    blobs = [pa.array([squeeze(x)], pa.binary()) for x in (sink.getvalue().to_pybytes(), place.astype(np.int32).tobytes())]
    return pa.RecordBatch.from_arrays([pa.array([number]), *arrays, *blobs], schema=_SCHEMA)


def align_blocks(documents: DataFrame, model_a: str, model_b: str, key: str, text: str = "text", block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Blocks of aligned documents, stored in buckets: each with its pairs of linked ids and how often it has each."""
    small_batches(documents.sparkSession, block_bytes)
    chosen = documents.select(F.col(f"`{key}`").alias("key"), F.col(f"`{text}`").alias("text"))
    n_bytes = chosen.agg(F.sum(F.octet_length("text"))).first()[0] or 0

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a, b, number = tokenizer(model_a), tokenizer(model_b), TaskContext.get().partitionId() << 32
        keys, texts, held = [], [], 0
        for batch in batches:
            begin = 0
            for at, t in enumerate(batch.column("text").to_pylist()):
                texts.append(t or "")
                held += len(texts[-1]) + 64
                if held >= block_bytes or at == batch.num_rows - 1:
                    keys.append(batch.column("key").slice(begin, at + 1 - begin))
                    begin = at + 1
                if held >= block_bytes:
                    yield _block_row(number, pa.concat_arrays(keys), texts, a, b)
                    number, keys, texts, held = number + 1, [], [], 0
                    release_memory()
        if texts:
            yield _block_row(number, pa.concat_arrays(keys), texts, a, b)
        release_memory()

    return bucketed(chosen.mapInArrow(run, _STORED), "block", min(MOST_BUCKETS, max(1, -(-n_bytes // BUCKET_BYTES))))


def pair_counts(blocks: DataFrame) -> DataFrame:
    """How often ids a and b are linked in the corpus, and whether no other a is linked more often with b."""
    pairs = blocks.select(F.explode(F.arrays_zip("a", "b", "n")).alias("p")).groupBy("p.a", "p.b").agg(F.sum("p.n").alias("count"))
    # Stored, as it is read twice: at most one row per pair of ids of the two vocabularies.
    pairs = stored(pairs, "align-pairs")
    most = pairs.groupBy("b").agg(F.max("count").alias("most"))
    return pairs.join(broadcast_if_small(most), "b").select("a", "b", "count", (F.col("count") == F.col("most")).alias("best"))


def align_documents(documents: DataFrame, model_a: str, model_b: str, key: str, text: str = "text", block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Per document its tokens under both tokenizers, its groups and their digest, overlap links, shared-group links, links
    whose ranges end together, how many of those are the corpus's most frequent of their B id, and the sum of their counts.

    A tokenizer is a ``.model`` of SentencePiece or a byte-level ``.json``. The column ``key`` keeps its name and type.
    """
    blocks = align_blocks(documents, model_a, model_b, key, text, block_bytes)
    asked = blocks.select("block", F.posexplode(F.arrays_zip("a", "b")).alias("at", "p")).select("block", "at", "p.a", "p.b")
    told = asked.join(broadcast_if_small(stored(pair_counts(blocks), "align-counts")), ["a", "b"])
    told = told.groupBy("block").agg(F.collect_list(F.struct("at", "count", "best")).alias("told"))
    names = ["n_a", "n_b", "n_groups", "n_links", "n_overlaps", "n_in_groups", "n_best", "count_sum"]
    schema = T.StructType([
        T.StructField(key, documents.schema[key].dataType), *(T.StructField(n, T.LongType()) for n in names), T.StructField("groups_sha256", T.StringType()),
    ])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                yield from _finished(batch.slice(i, 1), [key, *names, "groups_sha256"])
                release_memory()

    small_batches(documents.sparkSession)
    return blocks.select("block", "documents", "links").join(told, "block", "left").mapInArrow(run, schema)


def _finished(row: pa.RecordBatch, names: list[str]) -> Iterator[pa.RecordBatch]:
    rows = pa.ipc.open_stream(unsqueeze(row.column("documents")[0].as_py())).read_all()
    place = np.frombuffer(unsqueeze(row.column("links")[0].as_py()), np.int32)
    told = row.column("told")[0].values
    counts, best = np.zeros(len(told) if told is not None else 0, np.int64), np.zeros(len(told) if told is not None else 0, np.int64)
    if told is not None:
        at = told.field("at").to_numpy()
        counts[at], best[at] = told.field("count").to_numpy(), told.field("best").to_numpy(zero_copy_only=False)
    doc = np.repeat(np.arange(rows.num_rows), rows.column("n_links").to_numpy())
    rows = rows.append_column("n_best", pa.array(np.bincount(doc, best[place], rows.num_rows).astype(np.int64)))
    sums = np.concatenate(([0], np.cumsum(counts[place])))  # whole numbers: weights of bincount are floating
    ends = np.cumsum(rows.column("n_links").to_numpy())
    rows = rows.append_column("count_sum", pa.array(sums[ends] - sums[ends - rows.column("n_links").to_numpy()]))
    yield from rows.select(["key", *names[1:]]).rename_columns(names).combine_chunks().to_batches()
