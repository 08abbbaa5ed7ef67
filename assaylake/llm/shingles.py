"""Word shingles of the documents of a block, and circulant MinHash signatures of their sets."""

from __future__ import annotations

from functools import cache

import numpy as np

from .blocks import Block, mixed, words

#: Size of the universe that the first permutation deals the shingles to, and over which the second one runs.
UNIVERSE_BITS = 20
_CHUNK = 4_096


def shingle_sets(block: Block, k: int) -> tuple[np.ndarray, np.ndarray]:
    """All distinct ``k``-word shingles: hash and document, by document, then hash. A text with fewer words has its
    whole sequence of words as the only one; without words it has none."""
    word, doc, per_doc = words(block)
    first = np.concatenate(([0], np.cumsum(per_doc)[:-1])).astype(np.int64)
    n_of = np.maximum(per_doc - k + 1, np.minimum(per_doc, 1))
    of = np.repeat(np.arange(len(per_doc)), n_of)
    at = first[of] + np.arange(len(of)) - np.repeat(np.cumsum(n_of) - n_of, n_of)
    stop = first[of] + per_doc[of]
    value = np.zeros(len(of), np.uint64)
    for j in range(k):
        inside = at + j < stop
        step = mixed(value * np.uint64(0xD1342543DE82EF95) + word[np.minimum(at + j, max(len(word) - 1, 0))]) if len(word) else value
        value = np.where(inside, step, value)
    order = np.lexsort((value, of))
    value, of = value[order], of[order]
    new = np.ones(len(value), bool)
    new[1:] = (value[1:] != value[:-1]) | (of[1:] != of[:-1])
    return value[new], of[new]


def set_keys(value: np.ndarray, of: np.ndarray, n_docs: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Size and a 128-bit name of each document's set; equal sets have equal names."""
    n = np.bincount(of, minlength=n_docs)
    names = []
    for salt in (0x2545F4914F6CDD1D, 0x9E6C63D0876A9A47):
        total = np.concatenate((np.zeros(1, np.uint64), np.cumsum(mixed(value ^ np.uint64(salt)))))
        ends = np.cumsum(n)
        names.append(mixed(total[ends] - total[ends - n] + n.astype(np.uint64)))
    return n, names[0], names[1]


@cache
def _circulant(coordinates: int) -> np.ndarray:
    """Row x: the second permutation at x, x + 1, ..., going round at the end of the universe."""
    ring = np.random.default_rng(8).permutation(1 << UNIVERSE_BITS).astype(np.uint32)
    ring = np.concatenate((ring, ring[:coordinates]))
    return np.lib.stride_tricks.sliding_window_view(ring, coordinates)


def signatures(value: np.ndarray, of: np.ndarray, n_docs: int, coordinates: int) -> np.ndarray:
    """Circulant MinHash: the first permutation places each shingle, the second, shifted by k, ranks the places for
    coordinate k; a coordinate is the least rank in the set. ``of`` is in ascending order."""
    place = (mixed(value ^ np.uint64(0x8EBC6AF09C88C6E3)) >> np.uint64(64 - UNIVERSE_BITS)).astype(np.int64)
    shifted, out = _circulant(coordinates), np.full((n_docs, coordinates), np.iinfo(np.uint32).max, np.uint32)
    for i in range(0, len(place), _CHUNK):
        ranks, owner = shifted[place[i : i + _CHUNK]], of[i : i + _CHUNK]
        heads = np.flatnonzero(np.concatenate(([True], owner[1:] != owner[:-1])))
        docs = owner[heads]
        out[docs] = np.minimum(out[docs], np.minimum.reduceat(ranks, heads, axis=0))
    return out


def band_keys(signature: np.ndarray, rows: int) -> np.ndarray:
    """One 64-bit key for each band of ``rows`` coordinates; keys of different bands never meet by design."""
    n, coordinates = signature.shape
    bands = coordinates // rows
    key = np.broadcast_to(np.arange(bands, dtype=np.uint64) * np.uint64(0x632BE59BD9B4E019), (n, bands)).copy()
    for r in range(rows):
        key = mixed((key * np.uint64(0xD1342543DE82EF95) + signature[:, r::rows][:, :bands]).ravel()).reshape(n, bands)
    return key
