"""Vectorised work on Arrow batches of texts: words, hashes, n-grams.

Texts are handled as UTF-8 bytes straight from the Arrow buffers. A word is a
run of bytes outside ``[\\x20\\x09-\\x0D]``. A word's hash is its XXH64, an
n-gram's a 64-bit polynomial of its words' hashes with a final mix; both are
equal in every process.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash

BLOCK_BYTES = 1 << 19
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_BYTE_BASE = 0x9E3779B97F4A7C15 | 1
_GRAM_BASE = 0xC2B2AE3D27D4EB4F | 1
_MASK = (1 << 64) - 1
_powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def powers(base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """base**i and base**-i modulo 2**64 for i < n."""
    have = _powers.get(base)
    if have is None or len(have[0]) < n:
        size = max(1 << 16, 1 << (n - 1).bit_length())
        out = []
        for b in (base, pow(base, -1, 1 << 64)):
            p = np.full(size, b, dtype=np.uint64)
            p[0] = 1
            out.append(np.multiply.accumulate(p))
        have = _powers[base] = (out[0], out[1])
    return have[0][:n], have[1][:n]


def mix(h: np.ndarray) -> np.ndarray:
    """Spread every input bit over the 64 output bits (murmur finaliser)."""
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xFF51AFD7ED558CCD)
    h ^= h >> np.uint64(33)
    h *= np.uint64(0xC4CEB9FE1A85EC53)
    h ^= h >> np.uint64(33)
    return h


@dataclass
class Block:
    """Consecutive rows of one batch: rows ``lo`` to ``hi`` and their bytes;
    ``offsets`` has hi - lo + 1 entries, from 0."""

    lo: int
    hi: int
    data: np.ndarray
    offsets: np.ndarray

    def text(self, i: int) -> bytes:
        return self.data[self.offsets[i]:self.offsets[i + 1]].tobytes()


def blocks(texts: pa.Array, block_bytes: int = BLOCK_BYTES) -> Iterator[Block]:
    """Split a string or binary column (null counts as empty) into blocks of
    about ``block_bytes``; a longer text is a block of its own. Bytes need not
    be valid UTF-8: a piece of a text may begin or end inside a character."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    arr = pc.fill_null(texts.cast(pa.large_binary()), b"")
    n = len(arr)
    bufs = arr.buffers()
    off = np.frombuffer(bufs[1], dtype=np.int64)[arr.offset:arr.offset + n + 1] if n else np.zeros(1, np.int64)
    data = np.frombuffer(bufs[2], dtype=np.uint8) if bufs[2] is not None and bufs[2].size else np.zeros(0, np.uint8)
    lo = 0
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(off, off[lo] + block_bytes, side="right")) - 1)
        yield Block(lo, hi, data[off[lo]:off[hi]], off[lo:hi + 1] - off[lo])
        lo = hi


@dataclass
class Words:
    start: np.ndarray
    end: np.ndarray
    bounds: np.ndarray      # words of row i: bounds[i] to bounds[i + 1]

    @property
    def row(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.bounds) - 1), np.diff(self.bounds))


def words(b: Block) -> Words:
    n = len(b.data)
    inside = np.zeros(n + 2, dtype=bool)
    np.logical_not(_SPACE[b.data], out=inside[1:-1])
    cut = np.zeros(n + 1, dtype=bool)
    cut[b.offsets] = True
    here, before = inside[1:], inside[:-1]
    start = np.flatnonzero(here[:n] & (~before[:n] | cut[:n]))
    end = np.flatnonzero(before[1:] & (~here[1:] | cut[1:])) + 1
    return Words(start, end, np.searchsorted(start, b.offsets))


def word_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """XXH64 of each byte range; each different one is hashed once."""
    which, first = word_ids(data, start, end)
    own = (xxhash.xxh64_intdigest(x) for x in strings(data, start[first], end[first]))
    return np.fromiter(own, np.uint64, len(first))[which]


def word_ids(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(number of each byte range, first range of each number): equal numbers
    for equal bytes and no others, counted from 0 in order of appearance."""
    size = end - start
    bound = np.concatenate(([0], np.cumsum(size)))
    inside = np.zeros(len(data) + 1, dtype=np.int8)
    inside[start] += 1
    inside[end] -= 1
    flat = data[np.cumsum(inside[:-1], dtype=np.int8) > 0] if len(data) else data
    arr = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(start),
                                           [None, pa.py_buffer(bound), pa.py_buffer(np.ascontiguousarray(flat))])
    which = arr.dictionary_encode().indices.to_numpy(zero_copy_only=False).astype(np.int64)
    first = np.zeros(int(which.max()) + 1 if len(which) else 0, dtype=np.int64)
    first[which[::-1]] = np.arange(len(which))[::-1]
    return which, first


def join_words(b: Block, w: Words, keep: np.ndarray) -> pa.Array:
    """The kept words of each row, joined by one space."""
    kept = np.flatnonzero(keep)
    size = w.end[kept] - w.start[kept] + 1
    bound = np.concatenate(([0], np.cumsum(size)))
    at = np.repeat(w.start[kept] - bound[:-1], size) + np.arange(bound[-1])
    flat = np.append(b.data, np.uint8(32))[at]
    flat[bound[1:] - 1] = 32
    row = np.searchsorted(kept, w.bounds)
    some = np.diff(row) > 0
    drop = np.ones(len(flat), dtype=bool)
    drop[bound[row[1:][some]] - 1] = False
    offsets = bound[row] - np.concatenate(([0], np.cumsum(some)))
    text = pa.LargeStringArray.from_buffers(len(some), pa.py_buffer(offsets.astype(np.int64)),
                                            pa.py_buffer(flat[drop]))
    return text.cast(pa.string())


def gram_hashes(values: np.ndarray, k: int) -> np.ndarray:
    """Hash of values[i : i + k] for every i <= len(values) - k."""
    n = len(values)
    if n < k:
        return np.zeros(0, dtype=np.uint64)
    p, inv = powers(_GRAM_BASE, n + 1)
    acc = np.zeros(n + 1, dtype=np.uint64)
    np.cumsum(values * p[:-1], out=acc[1:])
    return mix((acc[k:] - acc[:-k]) * inv[:n - k + 1])


def sliding_min(values: np.ndarray, w: int) -> np.ndarray:
    """Minimum of values[i : i + w] for every i <= len(values) - w."""
    out, span = values, 1
    while span * 2 <= w:
        out = np.minimum(out[:-span], out[span:])
        span *= 2
    if span < w:
        out = np.minimum(out[:len(values) - w + 1], out[w - span:w - span + len(values) - w + 1])
    return out


def runs(mask: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and end of each run of True."""
    edge = np.diff(np.concatenate(([0], mask.astype(np.int8), [0])))
    return np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)


def signed(h: np.ndarray) -> np.ndarray:
    return h.view(np.int64)


def strings(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> list[bytes]:
    raw = data.tobytes()
    return [raw[s:e] for s, e in zip(start.tolist(), end.tolist())]
