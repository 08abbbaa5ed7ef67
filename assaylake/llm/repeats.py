"""Suffix-array dedup: bytes covered by long strings that occur more than once, from merged shard transforms.

Each block of documents is a shard. Its texts are read in a coarser alphabet: a cut is set after every eight bytes
whose hash is small, so equal strings are cut alike, and the phrase between two cuts is one symbol. The suffixes that
begin at cuts, sorted, with the phrase before each, are the shard's transform.

The transforms are merged by refining their interleave, never by sorting suffixes of different shards: in a round each
shard names the intervals that its suffixes stand in, and learns how many suffixes of all shards share each interval.
An interval of one suffix has a common prefix shorter than the round's depth with every other; it is settled and leaves
the merge. The rest are refined in the next round: one phrase deep, then all phrases within a window of ``width``
bytes, then these with the bytes before and after them (the end of the phrase before, and the common prefix within
the phrase after). What then still shares an interval is a repeated string. Where an interval at the second depth
falls apart in the third, its windows are compared one by one, byte offset by byte offset.

A window is known by its phrases wherever it stands: cuts depend on eight bytes only, those of a window on no byte
outside. The last two rounds decide with 128-bit hashes.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property, partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from .blocks import BLOCK_BYTES, SMALL_BLOCK_BYTES, STEP, Block, Blocks, answered, count_keys, make_blocks, prefix_hashes, span_hashes, tally

#: Bytes that a repeated string has at least.
WIDTH = 400
#: Bytes that decide a cut, and the mean length of a phrase.
_GRAM, PHRASE = 8, 48
_FACTOR = np.uint64(0xC6BC279692B5C323)
_SPANS = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))


@dataclass(frozen=True)
class _Shard:
    """A block's cuts, phrases and segments. A segment is a range of window starts with the same cuts inside."""

    block: Block
    width: int
    prefix: np.ndarray
    #: Hash of the phrase after each cut; phrases that do not end in their document have no repeats.
    cuts: np.ndarray
    whole: np.ndarray
    #: First and last window start, index of the first and last cut inside.
    first: np.ndarray
    last: np.ndarray
    begin: np.ndarray
    end: np.ndarray

    def spans(self, starts: np.ndarray, ends: np.ndarray, salt: int = 0) -> np.ndarray:
        return span_hashes(self.prefix if not salt else self.second, starts, ends)

    @cached_property
    def second(self) -> np.ndarray:
        return prefix_hashes(self.block.data, 1)

    # Round by round: the requests, and what the answers leave.

    def phrases(self) -> tuple[tuple[np.ndarray, ...], np.ndarray]:
        at = np.flatnonzero(self.whole)
        hashes = self.spans(self.cuts[at], self.cuts[at + 1]) if len(at) else np.empty(0, np.uint64)
        return tally(np.ones(len(at)), hashes)

    def runs(self) -> np.ndarray:
        """Segments with two cuts or more, all of whose phrases are repeated."""
        told, _ = answered(self.block, 0)
        _, place = self.phrases()
        single = np.ones(len(self.cuts), np.int64)
        single[np.flatnonzero(self.whole)[told[place] > 1]] = 0
        before = np.concatenate(([0], np.cumsum(single)))
        many = np.flatnonzero(self.end > self.begin)
        return many[before[self.end[many]] == before[self.begin[many]]]

    def run_keys(self, of: np.ndarray) -> tuple[tuple[np.ndarray, ...], np.ndarray]:
        return tally(np.ones(len(of)), self.spans(self.cuts[self.begin[of]], self.cuts[self.end[of]]))

    def repeated_runs(self) -> tuple[np.ndarray, np.ndarray]:
        """Segments whose phrases stand together elsewhere too, and in how many places."""
        of = self.runs()
        told, _ = answered(self.block, 1)
        _, place = self.run_keys(of)
        kept = told[place] > 1
        return of[kept], told[place][kept]

    def span_keys(self, of: np.ndarray) -> tuple[tuple[np.ndarray, ...], np.ndarray]:
        starts, ends = self.first[of], self.last[of] + self.width
        offset = (self.cuts[self.begin[of]] - starts).astype(np.uint64) * np.uint64(0xA0761D6478BD642F)
        return tally(np.ones(len(of)), self.spans(starts, ends) ^ offset, self.spans(starts, ends, 1))

    def settled(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Segments all of whose windows are repeated; segments to be compared window by window, and their weights:
        one, or two where the segment speaks for equal ones elsewhere."""
        of, together = self.repeated_runs()
        told, owned = answered(self.block, 2)
        _, place = self.span_keys(of)
        equal = told[place] > 1
        heads = np.zeros(len(of), bool)
        heads[np.unique(place, return_index=True)[1]] = True  # of equal ones within the block, one speaks
        speaks = equal & owned[place] & heads & (told[place] < together)
        alone = np.flatnonzero(self.end <= self.begin)  # too few cuts to name a run
        fine = np.concatenate((of[~equal], of[speaks], alone)).astype(np.int64)
        weights = np.concatenate((np.ones((~equal).sum()), np.full(speaks.sum(), 2), np.ones(len(alone))))
        return of[equal], fine, weights

    def windows(self, fine: np.ndarray) -> np.ndarray:
        """The window starts of some segments, one after another."""
        n = self.last[fine] - self.first[fine] + 1
        return np.repeat(self.first[fine] - np.cumsum(n) + n, n) + np.arange(n.sum())

    def window_keys(self, fine: np.ndarray, weights: np.ndarray) -> tuple[tuple[np.ndarray, ...], np.ndarray]:
        at = self.windows(fine)
        each = np.repeat(weights, self.last[fine] - self.first[fine] + 1)
        return tally(each, self.spans(at, at + self.width), self.spans(at, at + self.width, 1))

    def covered(self) -> np.ndarray:
        """Whether each byte lies in a repeated window."""
        equal, fine, weights = self.settled()
        at = self.windows(fine)
        told, _ = answered(self.block, 3)
        _, place = self.window_keys(fine, weights)
        at = at[told[place] > 1]
        n = len(self.block.data) + 1
        open_ = np.bincount(np.concatenate((self.first[equal], at)), minlength=n)
        open_ -= np.bincount(np.concatenate((self.last[equal], at)) + self.width, minlength=n)
        return np.cumsum(open_, out=open_)[:-1] > 0


def _shard(block: Block, width: int) -> _Shard:
    data, starts, ends = block.data, block.starts, block.ends
    grams = np.ndarray((max(len(data) - _GRAM + 1, 0),), "<u8", data.tobytes(), strides=(1,)) if len(data) >= _GRAM else np.empty(0, np.uint64)
    small = [np.flatnonzero(grams[at : at + STEP] * _FACTOR < np.uint64((1 << 64) // PHRASE)) + at for at in range(0, len(grams), STEP)]
    cuts = np.concatenate([np.empty(0, np.int64), *small]) + _GRAM
    doc = np.searchsorted(ends, cuts - _GRAM, side="right")
    inside = cuts <= ends[doc] if len(cuts) else np.empty(0, bool)
    cuts, doc = cuts[inside], doc[inside]
    whole = np.zeros(len(cuts), bool)
    whole[:-1] = doc[1:] == doc[:-1]
    # Window starts at which the first or the last cut inside changes.
    long = ends - starts >= width
    opens = np.concatenate((cuts - _GRAM + 1, cuts - width))
    of = np.concatenate((doc, doc))
    valid = (opens > starts[of]) & (opens <= ends[of] - width) if len(of) else np.empty(0, bool)
    first = np.unique(np.concatenate((starts[long], opens[valid])).astype(np.int64))
    home = np.searchsorted(ends, first, side="right")
    last = np.concatenate((first[1:] - 1, [np.iinfo(np.int64).max]))[: len(first)]
    last = np.minimum(last, ends[home] - width)
    begin = np.searchsorted(cuts, first + _GRAM)
    end = np.searchsorted(cuts, first + width, side="right") - 1
    return _Shard(block, width, prefix_hashes(data), cuts, whole, first, last, begin, end)


def _ask_phrases(block: Block, width: int) -> tuple[np.ndarray, ...]:
    return _shard(block, width).phrases()[0]


def _ask_runs(block: Block, width: int) -> tuple[np.ndarray, ...]:
    shard = _shard(block, width)
    return shard.run_keys(shard.runs())[0]


def _ask_spans(block: Block, width: int) -> tuple[np.ndarray, ...]:
    shard = _shard(block, width)
    return shard.span_keys(shard.repeated_runs()[0])[0]


def _ask_windows(block: Block, width: int) -> tuple[np.ndarray, ...]:
    shard = _shard(block, width)
    return shard.window_keys(*shard.settled()[1:])[0]


RESULT = ("n_bytes", "n_removed", "n_spans", "spans", "kept")
_RESULT_DDL = "n_bytes long, n_removed long, n_spans long, spans array<struct<start:long,end:long>>, kept binary"


def _answered_blocks(documents: DataFrame, kept: list[str], text: str, width: int, block_bytes: int) -> tuple[Blocks, list[DataFrame]]:
    """The documents as blocks, and the answers of the four rounds."""
    blocks = make_blocks(documents.select(*(F.col(f"`{c}`") for c in kept), F.col(f"`{text}`")), text, block_bytes)
    answers: list[DataFrame] = []
    for ask in (_ask_phrases, _ask_runs, _ask_spans, _ask_windows):
        answers.append(count_keys(blocks.ask(partial(ask, width=width), *answers)))
    return blocks, answers


def find_repeats(documents: DataFrame, text: str = "text", width: int = WIDTH, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """All columns of ``documents`` but the text, and for each document: ``n_bytes``, ``n_removed``, ``n_spans``,
    ``spans`` (array of start and end in bytes) and ``kept`` (the remaining bytes).

    A byte goes if it lies in a string of ``width`` bytes that starts anywhere else too, in the same document
    or in another; all its occurrences go, and all are judged on the input. Texts are bytes of UTF-8, a null text is
    empty and keeps null; texts shorter than ``width`` keep all. A row that occurs twice is a copy of itself, so both lose their
    text if it is long enough. Columns named like a result are replaced.
    """
    kept = [c for c in documents.columns if c not in (*RESULT, text)]
    blocks, answers = _answered_blocks(documents, kept, text, width, block_bytes)

    def cut(block: Block) -> Iterator[pa.RecordBatch]:
        gone = _shard(block, width).covered()
        out: dict[str, list] = {name: [] for name in RESULT}
        for start, end, none in zip(block.starts.tolist(), block.ends.tolist(), block.nulls.tolist(), strict=True):
            mask = gone[start:end]
            edge = np.flatnonzero(np.diff(np.concatenate(([0], mask.view(np.int8), [0]))))
            out["n_bytes"].append(end - start)
            out["n_removed"].append(int(mask.sum()))
            out["n_spans"].append(len(edge) // 2)
            out["spans"].append([{"start": a, "end": b} for a, b in edge.reshape(-1, 2).tolist()])
            out["kept"].append(None if none else block.data[start:end][~mask].tobytes())
        rows = block.rows.combine_chunks()
        for name, kind in zip(RESULT, (pa.int64(), pa.int64(), pa.int64(), _SPANS, pa.binary()), strict=True):
            rows = rows.append_column(name, pa.array(out[name], kind))
        yield from rows.to_batches()

    schema = T.StructType([*documents.select(*(F.col(f"`{c}`") for c in kept)).schema, *T.StructType.fromDDL(_RESULT_DDL)])
    return blocks.each(cut, schema, *answers)


def remove_repeats(documents: DataFrame, text: str = "text", width: int = WIDTH) -> DataFrame:
    """``documents`` with the repeated bytes cut out of the texts. A character that loses a byte goes whole."""
    # Cut and decoded by one worker: a second one for each task would hold as much memory again.
    names = documents.columns
    blocks, answers = _answered_blocks(documents, [c for c in names if c != text], text, width, SMALL_BLOCK_BYTES)

    def cut(block: Block) -> Iterator[pa.RecordBatch]:
        stays = ~_shard(block, width).covered()
        left = (block.data[a:b][stays[a:b]].tobytes().decode("utf-8", "ignore") for a, b in zip(block.starts.tolist(), block.ends.tolist(), strict=True))
        texts = pa.array([None if none else t for t, none in zip(left, block.nulls.tolist(), strict=True)], pa.string())
        yield from block.rows.append_column(text, texts).select(names).combine_chunks().to_batches()

    return blocks.each(cut, documents.schema, *answers)
