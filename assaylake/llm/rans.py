"""Static range asymmetric numeral system over token ids.

A segment holds the ids of many documents. One frequency table serves all its blocks; a block has its own lanes, each
a 32-bit state that takes in 16-bit words, and the words of a block's lanes are interleaved in one stream. The
directory gives each block's first states and word offset (its checkpoint) and the checksum of its ids, so blocks can be
decoded in parallel, alone, and in any order. Blocks of a segment are coded side by side as one array.

Layout: magic, then nine little-endian numbers of 64 bits (ids, lanes, block length, lengths of six parts), then the
parts: table (symbols, frequencies), words per block, first states, escaped ids per block, checksums, words; the
first five are compressed, and escaped ids follow the words.
"""

from __future__ import annotations

import zlib

import numpy as np

from .blocks import squeeze, unsqueeze

MAGIC = b"RANSIDS1"
#: Frequencies add up to 2**16; a table has at most so many symbols, rarer ids are escaped.
_BITS = 16
_TOTAL, _LOW = 1 << _BITS, np.uint64(1 << 16)
MOST_SYMBOLS = 60_000
LANES, BLOCK = 32, 16_384
_CRC = "<u4"


def frequencies(counts: np.ndarray) -> np.ndarray:
    """Counts scaled to add up to 2**16, each at least 1; what rounding leaves goes to the largest."""
    spare = _TOTAL - len(counts)
    scaled = 1 + np.floor(counts * (spare / counts.sum())).astype(np.int64)
    scaled[np.argmax(counts)] += _TOTAL - scaled.sum()
    return scaled


def _ranked(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The distinct ids in ascending order, the place of each id among them, and how often each occurs."""
    if ids.max() >= 1 << 22:
        return np.unique(ids, return_inverse=True, return_counts=True)
    counts = np.bincount(ids)
    symbols = np.flatnonzero(counts)
    place = np.zeros(len(counts), np.int64)
    place[symbols] = np.arange(len(symbols))
    return symbols.astype(np.uint32), place[ids], counts[symbols]


def encode(ids: np.ndarray, block: int = BLOCK, lanes: int = LANES) -> bytes:
    """A segment of ids, which are unsigned 32-bit numbers."""
    ids = np.ascontiguousarray(ids, np.uint32)
    n = len(ids)
    if not n:
        return MAGIC + np.zeros(9, "<i8").tobytes()
    symbols, at, counts = _ranked(ids)
    escaped = np.zeros(0, np.uint32)
    if len(symbols) > MOST_SYMBOLS:
        common = np.sort(np.argsort(-counts, kind="stable")[:MOST_SYMBOLS])
        place = np.full(len(symbols), MOST_SYMBOLS)
        place[common] = np.arange(MOST_SYMBOLS)
        at = place[at]
        escaped = ids[at == MOST_SYMBOLS]
        counts = np.append(counts[common], len(escaped))
        symbols = symbols[common]
    has_escape = bool(len(escaped))
    block = min(block, -(-n // lanes) * lanes)
    blocks = -(-n // block)
    padded = np.full(blocks * block, np.argmax(counts), np.int64)
    padded[:n] = at
    grid = padded.reshape(blocks, block // lanes, lanes)
    freq = frequencies(counts)
    f64, start = freq.astype(np.uint64), np.concatenate(([0], np.cumsum(freq)[:-1])).astype(np.uint64)
    real = freq.astype(np.float64)
    steps = grid.shape[1]
    state = np.full((blocks, lanes), _LOW, np.uint64)
    words = np.empty((steps, blocks, lanes), np.uint16)
    given = np.empty((steps, blocks, lanes), bool)
    for t in range(steps - 1, -1, -1):
        s = grid[:, t, :]
        f = f64[s]
        full = state >= (f << np.uint64(16))
        words[t], given[t] = state, full  # the low 16 bits
        state = np.where(full, state >> np.uint64(16), state)
        q = (state / real[s]).astype(np.uint64)
        state = (q << np.uint64(_BITS)) + (state - q * f) + start[s]
    of_block = given.transpose(1, 0, 2)
    stream = words.transpose(1, 0, 2)[of_block]
    bounds = np.arange(0, n, block)
    escapes = np.add.reduceat((at == MOST_SYMBOLS).astype(np.int64), bounds) if has_escape else np.zeros(blocks, np.int64)
    sums = np.array([zlib.crc32(ids[i : i + block].astype(_CRC).tobytes()) for i in bounds], np.uint32)
    table = np.concatenate(([len(symbols), has_escape], symbols, freq)).astype("<u4")
    parts = [table, of_block.sum((1, 2)).astype("<u4"), state.astype("<u4"), escapes.astype("<u4"), sums.astype("<u4")]
    blobs = [squeeze(p.tobytes(), 3) for p in parts] + [stream.astype("<u2").tobytes()]
    head = np.array([n, lanes, block, *map(len, blobs)], "<i8")
    return MAGIC + head.tobytes() + b"".join(blobs) + escaped.astype("<u4").tobytes()


def decode(segment: bytes) -> np.ndarray:
    """All ids of a segment. A segment that is cut short or altered raises a ValueError."""
    if segment[:8] != MAGIC:
        raise ValueError("not a segment of token ids")
    n, lanes, block, *lengths = np.frombuffer(segment, "<i8", 9, 8).tolist()
    if not n:
        return np.zeros(0, np.uint32)
    cuts = np.cumsum([8 + 72, *lengths])
    blobs = [segment[a:b] for a, b in zip(cuts[:-1], cuts[1:], strict=True)]
    table, sizes, states, escapes, sums = (np.frombuffer(unsqueeze(b), "<u4").astype(np.int64) for b in blobs[:5])
    stream, escaped = np.frombuffer(blobs[5], "<u2").astype(np.uint64), np.frombuffer(segment, "<u4", offset=int(cuts[-1]))
    if len(stream) != sizes.sum() or len(escaped) != escapes.sum():
        raise ValueError("a segment of token ids is cut short")
    n_symbols, has_escape = int(table[0]), bool(table[1])
    symbols, freq = table[2 : 2 + n_symbols].astype(np.uint32), table[2 + n_symbols :]
    of = np.repeat(np.arange(len(freq)), freq)
    f64, start = freq.astype(np.uint64), np.concatenate(([0], np.cumsum(freq)[:-1])).astype(np.uint64)
    blocks = len(sizes)
    state = states.astype(np.uint64).reshape(blocks, lanes)
    at = (np.cumsum(sizes) - sizes).astype(np.int64)
    stream = np.append(stream, np.uint64(0))
    out = np.empty((blocks, block // lanes, lanes), np.int64)
    low = np.uint64(_TOTAL - 1)
    for t in range(block // lanes):
        slot = state & low
        s = of[slot.astype(np.int64)]
        out[:, t, :] = s
        state = f64[s] * (state >> np.uint64(_BITS)) + slot - start[s]
        short = state < _LOW
        taken = np.cumsum(short, axis=1)
        place = np.minimum(at[:, None] + taken - 1, len(stream) - 1)
        state = np.where(short, (state << np.uint64(16)) | stream[place], state)
        at = at + taken[:, -1]
    if (state != _LOW).any():  # where every lane began to be coded
        raise ValueError("a segment of token ids is damaged")
    flat = out.reshape(-1)[:n]
    if has_escape:
        ids = np.append(symbols, np.uint32(0))[flat]
        ids[flat == n_symbols] = escaped
    else:
        ids = symbols[flat]
    for i, told in enumerate(sums.tolist()):
        if zlib.crc32(ids[i * block : (i + 1) * block].astype(_CRC).tobytes()) != told:
            raise ValueError(f"block {i} of a segment of token ids fails its checksum")
    return ids
