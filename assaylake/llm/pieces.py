"""SentencePiece encoding and decoding by streaming Viterbi.

The pieces of a model and their scores span a lattice over a text; encoding takes the path with the greatest sum of
scores. Text is read once, from left to right. At each place only those boundaries survive from which some
piece could still reach on, so the window is never longer than the longest piece; whenever the backpointer paths of all
survivors run through one boundary, the ids before it are final and leave the window.

The scores are taken as they stand in the model, whatever it was trained as. Of equally good paths the one whose
last piece is longer wins. A character that is no piece costs ten more than the worst piece and becomes its bytes, if the
model has byte pieces, else the unknown id. As in the library, a space stands before the text and spaces are shown by
the mark U+2581; nothing else is normalised.
"""

from __future__ import annotations

from array import array
from collections.abc import Iterable, Iterator
from functools import cache
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from .common import release_memory, small_batches

MARK = "▁"
#: Word forms of late whose ids a worker remembers; it also keeps as many earlier ones.
REMEMBERED = 100_000
_ID = np.dtype("<u4")


class Pieces:
    """The vocabulary of a model: a trie of its pieces with ids and scores, and how ids read as bytes."""

    def __init__(self, pieces: list[tuple[str, float]], byte_ids: dict[int, int], unknown: int, skipped: Iterable[int] = ()) -> None:
        """``pieces`` by id; ``byte_ids`` from byte to id; ``skipped``: ids that stand for no text, such as the end."""
        self.unknown, self.byte_ids = unknown, byte_ids
        special = {unknown, *byte_ids.values(), *skipped}
        normal = [(text, score, i) for i, (text, score) in enumerate(pieces) if i not in special and text]
        #: From a character to what follows it in some piece (a node like this one, or None), and the id and score of
        #: the piece that ends with it (-1 if none does).
        self.root: dict = _node(sorted(normal), 0)
        self.longest = max((len(text) for text, _, _ in normal), default=1)
        self.worst = min((score for _, score, _ in normal), default=0.0) - 10
        #: Pairs of characters that stand together in some piece: between any two others all paths meet.
        self.pairs = {text[j : j + 2] for text, _, _ in normal for j in range(len(text) - 1)}
        #: Whether all paths meet before each space that follows another character, and on both sides of a line feed.
        self.parted = all(p[1] != MARK or p == MARK * 2 for p in self.pairs) and not any("\n" in p for p in self.pairs)
        self.text = [b"" if i in special else t.encode() for i, (t, _) in enumerate(pieces)]
        for byte, i in byte_ids.items():
            self.text[i] = bytes([byte])
        self.text[unknown] = " ⁇ ".encode()

    @classmethod
    def load(cls, path: str) -> Pieces:
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        n = range(model.get_piece_size())
        byte_ids = {int(model.id_to_piece(i)[3:5], 16): i for i in n if model.is_byte(i)}
        skipped = [i for i in n if model.is_control(i) or model.is_unused(i)]
        return cls([(model.id_to_piece(i), model.get_score(i)) for i in n], byte_ids, model.unk_id(), skipped)

    def stream(self, chars: Iterable[str]) -> Iterator[int]:
        """Ids of a stream of characters (spaces as marks), each as soon as it is final."""
        root, worst, span = self.root, self.worst, 4 * self.longest
        # Since the last final boundary: the characters, and for each boundary the best score, the boundary before it
        # and the piece between (-1 for an unknown character).
        held: list[str] = []
        score, before, piece = [0.0], [0], [-1]
        alive: list[tuple[int, dict]] = []  # where pieces under way start, in ascending order, and their trie nodes
        for char in chars:
            place = len(held)
            held.append(char)
            alive.append((place, root))
            top, come, chosen, reached = score[place] + worst, place, -1, []
            for start, node in alive:
                step = node.get(char)
                if step is None:
                    continue
                deeper, end, gain = step
                if end >= 0:
                    total = score[start] + gain
                    if total > top or chosen < 0 and total == top:
                        top, come, chosen = total, start, end
                if deeper is not None:
                    reached.append((start, deeper))
            score.append(top)
            before.append(come)
            piece.append(chosen)
            alive = reached
            if not alive:
                yield from self._between(held, before, piece, place + 1)
                held, score, before, piece = [], [top], [0], [-1]
                continue
            if place < span or place % self.longest:
                continue
            meet = _meeting(before, place + 1, [start for start, _ in alive])
            yield from self._between(held, before, piece, meet)
            del held[:meet], score[:meet], before[:meet], piece[:meet]
            before = [max(b - meet, 0) for b in before]
            alive = [(start - meet, node) for start, node in alive]
        yield from self._between(held, before, piece, len(held))

    def _between(self, held: list[str], before: list[int], piece: list[int], at: int) -> list[int]:
        out: list[int] = []
        while at > 0:
            come = before[at]
            if piece[at] >= 0:
                out.append(piece[at])
            else:
                out += reversed([self.byte_ids[b] for b in held[come].encode()] if self.byte_ids else [self.unknown])
            at = come
        out.reverse()
        return out

    def decode(self, ids: Iterable[int]) -> str:
        """The text of ids; bytes that are no UTF-8 read as U+FFFD, and the space before the text goes."""
        raw = b"".join(map(self.text.__getitem__, ids))
        return raw.decode("utf-8", "replace").replace(MARK, " ").removeprefix(" ")


def _node(pieces: list[tuple[str, float, int]], depth: int) -> dict:
    """The trie node of pieces in ascending order that agree in their first ``depth`` characters and are longer."""
    node = {}
    for char, group in groupby(pieces, lambda p: p[0][depth]):
        alike = list(group)
        ends = [(i, score) for text, score, i in alike if len(text) == depth + 1]
        longer = [p for p in alike if len(p[0]) > depth + 1]
        node[char] = (_node(longer, depth + 1) if longer else None, *(ends[-1] if ends else (-1, 0.0)))
    return node


def _meeting(before: list[int], place: int, survivors: list[int]) -> int:
    """The latest boundary on the best paths to ``place`` and to all survivors."""
    meet = place
    for at in survivors:
        while at != meet:
            if at > meet:
                at = before[at]
            else:
                meet = before[meet]
    return meet


class Encoder:
    """Ids of whole texts. Where all paths are known to meet, at word ends, what stands between is remembered."""

    def __init__(self, pieces: Pieces, remembered: int = REMEMBERED) -> None:
        self.pieces, self.remembered = pieces, remembered
        # Word forms of late, and those before them, which are forgotten next.
        self.known: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        self.feed = self._fresh("\n")

    def _fresh(self, text: str) -> bytes:
        return array("I", self.pieces.stream(text)).tobytes()

    def _word(self, word: str) -> bytes:
        """Parted once more where no piece has both characters, so that "word" and "word," share their work."""
        known, older = self.known, self.older
        ids = known.get(word) or older.get(word)
        if ids is None:
            pairs, at, parts = self.pieces.pairs, 0, []
            for i in range(1, len(word)):
                if word[i - 1 : i + 1] not in pairs:
                    parts.append(word[at:i])
                    at = i
            parts.append(word[at:])
            for i, part in enumerate(parts):
                ids = known.get(part) or older.get(part) or self._fresh(part)
                known[part] = parts[i] = ids
            ids = b"".join(parts)
        known[word] = ids
        return ids

    def encode(self, text: str) -> bytes:
        """The ids as little-endian 32-bit numbers; none for an empty text."""
        if not text:
            return b""
        text = f" {text}".replace(" ", MARK)
        if not self.pieces.parted:
            return self._fresh(text)
        if len(self.known) > self.remembered:
            self.older, self.known = self.known, {}
        out, known = [], self.known
        for i, line in enumerate(text.split("\n")):
            if i:
                out.append(self.feed)
            if MARK * 2 in line or line.endswith(MARK):
                words, spaces = [], 0
                for j, word in enumerate(line.split(MARK)):
                    spaces += j > 0
                    if word:
                        words.append(MARK * spaces + word)
                        spaces = 0
                words += [MARK * spaces] if spaces else []
            else:
                first, *rest = line.split(MARK)
                words = [first] if first else []
                words += [MARK + w for w in rest]
            for word in words:
                if word not in known:
                    self._word(word)
            out += [known[w] for w in words]
        return b"".join(out)


@cache
def encoder(path: str, remembered: int = REMEMBERED) -> Encoder:
    return Encoder(Pieces.load(path), remembered)


def encode_texts(
    documents: DataFrame, model: str, text: str = "text", into: str = "ids", binary: bool = False, remembered: int = REMEMBERED
) -> DataFrame:
    """``documents`` with the ids of each whole text: an array, or little-endian 32-bit numbers if ``binary``.

    ``model`` is the path of a SentencePiece model. A null or empty text has no ids. ``into`` replaces a column of that
    name. ``remembered`` trades a worker's memory (some 250 bytes a word form) for time; the ids are the same.
    """
    small_batches(documents.sparkSession)

    def encode(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        release_memory()
        coder = encoder(model, remembered)
        for batch in batches:
            release_memory()
            parts = [coder.encode(t.as_py() or "") for t in batch]
            if binary:
                yield pa.array(parts, pa.binary())
                continue
            ends = np.cumsum([0, *map(len, parts)]) // _ID.itemsize
            ids = np.frombuffer(b"".join(parts), _ID).astype(np.int32)
            yield pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(ids))

    kind = "binary" if binary else "array<int>"
    return documents.withColumn(into, F.arrow_udf(encode, kind, F.ArrowUDFType.SCALAR_ITER)(F.col(f"`{text}`")))


def decoded(model: str, ids: str = "ids") -> Column:
    """The text of the ids that ``encode_texts`` gives, in either form; empty for null ids."""

    def decode(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        pieces = encoder(model).pieces
        for batch in batches:
            of = (lambda x: np.frombuffer(x.as_py() or b"", _ID)) if pa.types.is_binary(batch.type) else lambda x: x.values.to_numpy() if x.is_valid else []
            yield pa.array([pieces.decode(np.asarray(of(x)).tolist()) for x in batch], pa.string())

    return F.arrow_udf(decode, "string", F.ArrowUDFType.SCALAR_ITER)(F.col(f"`{ids}`"))
