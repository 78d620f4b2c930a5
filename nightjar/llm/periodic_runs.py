"""Maximal repetitions (runs) of the words of each document, by string
synchronising sets.

A run is a stretch of words with smallest period q, at least two periods
long, that no neighbouring word extends keeping period q. All runs are found:

1. Periods up to 8 come from comparing the words with themselves shifted.
2. For each dyadic scale t (3, 6, 12, ...) the periods in [3t, 6t). Every
   position has an id, the hash of its next t words; position i is selected if
   the smallest id of the positions i to i + t is at one of the two ends.
   Whether i is selected depends on the words [i, i + 2t) alone (its
   context), so a run that repeats after q selects i and i + q alike. Selected
   positions with equal contexts, less than 6t apart, propose their distance
   as a period. Any t neighbouring positions have a selected one unless the
   words there have a period of t/3 or less; positions inside such highly
   periodic regions (runs of earlier scales) have no id. Equal contexts are
   then over t/3 apart, so a position has at most 18 partners.
3. A run of period q in [3t, 6t) without a selected position in its first
   period starts with a period that is itself highly periodic, of some period
   p <= t/3. Its two halves lie in two neighbouring runs of period p that
   touch, with the same root; q is fixed modulo p by the phases of the two,
   and every such q is proposed.
4. A proposed (position, period) is extended both ways by binary search over
   prefix hashes, and the words are compared: where they differ (a hash
   collision) the extension is done again word by word.

Words are numbered by their bytes, never by a hash. Rows of a block are
worked on together, each ended by a number of its own, longest rows first, so
a large scale looks only at the rows that are long enough.

Defined cases: a null text has no words and no runs; repeated rows and null
ids are treated like any other row; an empty table gives an empty result;
columns beyond doc_id and text are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from nightjar.llm.tables import documents
from nightjar.llm.textbytes import blocks, join_words, mix, powers, runs, sliding_min, word_ids, words

MIN_LENGTH = 12
SMALL = 8                            # periods found by shifting
_BASE = 0xD1B54A32D192ED03
_NONE = np.uint64(2**64 - 1)
_COMPARE = 1 << 21                   # words compared at once

RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])
SCHEMA = "doc_id long, n_words long, runs array<struct<start:long,length:long,period:long>>, collapsed string"


class Sequence:
    """Numbers of words with hashes of all their stretches."""

    def __init__(self, tokens: np.ndarray):
        self.t = tokens
        n = len(tokens)
        p, self.inv = powers(_BASE, n + 1)
        self.acc = np.zeros(n + 1, dtype=np.uint64)
        np.cumsum(mix(tokens.astype(np.uint64) + np.uint64(0x9E3779B9)) * p[:n], out=self.acc[1:])

    def hashes(self, start, size) -> np.ndarray:
        return mix((self.acc[start + size] - self.acc[start]) * self.inv[start])

    def _reach(self, i, j, most, back: bool) -> np.ndarray:
        """Longest equal stretches before (``back``) or from i and j, by hash;
        never too short, as equal words have equal hashes."""
        lo, hi = np.zeros_like(i), most.copy()
        acc, inv = self.acc, self.inv
        while True:
            open_ = np.flatnonzero(lo < hi)
            if not len(open_):
                return lo
            mid = (lo[open_] + hi[open_] + 1) >> 1
            a, b = i[open_], j[open_]
            if back:
                a, b = a - mid, b - mid
            same = (acc[a + mid] - acc[a]) * inv[a] == (acc[b + mid] - acc[b]) * inv[b]
            lo[open_] = np.where(same, mid, lo[open_])
            hi[open_] = np.where(same, hi[open_], mid - 1)

    def equal(self, start, end, period) -> np.ndarray:
        """Whether words [start, end - period) equal those ``period`` later."""
        out = np.ones(len(start), dtype=bool)
        size = end - period - start
        for lo, hi in _shares(size):
            n = size[lo:hi]
            bound = np.cumsum(n) - n
            at = np.repeat(start[lo:hi] - bound, n) + np.arange(n.sum())
            wrong = self.t[at] != self.t[at + np.repeat(period[lo:hi], n)]
            out[lo + np.repeat(np.arange(hi - lo), n)[wrong]] = False
        return out

    def extended(self, i: np.ndarray, period: np.ndarray) -> np.ndarray:
        """Rows (start, end, period) of the maximal stretches with
        ``period`` around i, at least two periods long, each once."""
        if not len(i):
            return np.zeros((0, 3), dtype=np.int64)
        j = i + period
        start = i - self._reach(i, j, i, True)
        end = j + self._reach(i, j, len(self.t) - j, False)
        long = end - start >= 2 * period
        seed = i[long]
        found, which = np.unique(np.column_stack((start, end, period))[long], axis=0, return_inverse=True)
        good = self.equal(*found.T)
        if good.all():
            return found
        again = np.flatnonzero(~good[which.ravel()])
        exact = {self._by_word(int(seed[k]), *map(int, found[which.ravel()[k]])) for k in again}
        exact = [r for r in exact if r[1] - r[0] >= 2 * r[2]]
        return np.unique(np.concatenate((found[good], np.array(exact, dtype=np.int64).reshape(-1, 3))), axis=0)

    def _by_word(self, i: int, start: int, end: int, period: int) -> tuple[int, int, int]:
        after = self.t[i:end - period] != self.t[i + period:end]
        before = (self.t[start:i] != self.t[start + period:i + period])[::-1]
        r = int(after.argmax()) if after.any() else len(after)
        b = int(before.argmax()) if before.any() else len(before)
        return i - b, i + period + r, period


def _shares(size: np.ndarray):
    """Index ranges whose sizes sum to about ``_COMPARE``."""
    total = np.cumsum(size)
    lo = 0
    while lo < len(size):
        before = total[lo - 1] if lo else 0
        hi = max(lo + 1, int(np.searchsorted(total, before + _COMPARE, side="right")))
        yield lo, hi
        lo = hi


def small_periods(t: np.ndarray) -> np.ndarray:
    out = []
    for q in range(1, min(SMALL, len(t) // 2) + 1):
        s, e = runs(t[:-q] == t[q:])
        long = e - s >= q
        out.append(np.column_stack((s[long], e[long] + q, np.full(long.sum(), q))))
    return np.concatenate(out) if out else np.zeros((0, 3), dtype=np.int64)


def synchronising_set(seq: Sequence, t: int, n: int, periodic: np.ndarray) -> np.ndarray:
    """Selected positions of scale ``t`` among the first ``n`` words;
    ``periodic`` has the runs with periods of t/3 or less."""
    ids = np.minimum(seq.hashes(np.arange(n - t + 1), t), _NONE - np.uint64(1))
    long = periodic[(periodic[:, 1] - periodic[:, 0] >= t) & (periodic[:, 1] <= n)]
    if len(long):
        edge = (np.bincount(long[:, 0], minlength=n + 1)
                - np.bincount(long[:, 1] - t + 1, minlength=n + 1))
        ids[np.cumsum(edge)[:n - t + 1] > 0] = _NONE
    least = sliding_min(ids, t + 1)
    return np.flatnonzero((least != _NONE) & ((least == ids[:len(least)]) | (least == ids[t:])))


def equal_contexts(seq: Sequence, at: np.ndarray, t: int) -> tuple[np.ndarray, np.ndarray]:
    """(position, distance) of selected positions with equal contexts, at
    distances in [3t, 6t)."""
    context = seq.hashes(at, 2 * t)
    order = np.argsort(context, kind="stable")
    context, at = context[order], at[order]
    first, gap = [], []
    for k in range(1, len(at)):
        d = at[k:] - at[:-k]
        near = (context[k:] == context[:-k]) & (d < 6 * t)
        if not near.any():
            break
        near &= d >= 3 * t
        first.append(at[:-k][near])
        gap.append(d[near])
    return (np.concatenate(first), np.concatenate(gap)) if first else (np.zeros(0, np.int64),) * 2


def touching(seq: Sequence, found: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(position, period) proposed by neighbouring runs of equal period and
    root that touch."""
    long = found[found[:, 1] - found[:, 0] >= 9 * found[:, 2] - 1]
    long = long[np.lexsort((long[:, 0], long[:, 2]))]
    pair = np.flatnonzero((long[1:, 2] == long[:-1, 2]) & (long[1:, 0] <= long[:-1, 1]))
    at, period = [], []
    for (a1, b1, p), (a2, b2, _) in zip(long[pair].tolist(), long[pair + 1].tolist()):
        phase = _find(seq.t[a1:a1 + 2 * p - 1], seq.t[a2:a2 + p])
        if phase < 0:
            continue
        rest = (a2 - a1 - phase) % p
        q = np.arange(8 * p + rest, min(b1 - a1, b2 - a2, (b2 - a1) // 2) + 1, p)
        at.append(np.maximum(a1, a2 - q))
        period.append(q)
    return (np.concatenate(at), np.concatenate(period)) if at else (np.zeros(0, np.int64),) * 2


def _find(words_: np.ndarray, root: np.ndarray) -> int:
    """First place of ``root`` in ``words_``, or -1."""
    hay, needle, at = words_.tobytes(), root.tobytes(), -1
    while (at := hay.find(needle, at + 1)) >= 0:
        if at % words_.itemsize == 0:
            return at // words_.itemsize
    return -1


def _smallest(found: np.ndarray) -> np.ndarray:
    """The smallest period of each stretch."""
    found = found[np.lexsort((found[:, 2], found[:, 1], found[:, 0]))]
    first = np.ones(len(found), dtype=bool)
    first[1:] = (found[1:, :2] != found[:-1, :2]).any(axis=1)
    return found[first]


def all_runs(seq: Sequence, reach) -> np.ndarray:
    """Every run (start, end, period). ``reach(n)`` is the number of leading
    words that hold all rows of ``n`` words or more."""
    found = small_periods(seq.t)
    found = _smallest(np.concatenate((found, seq.extended(*touching(seq, found)))))
    t = 3
    while (n := reach(6 * t)) >= 6 * t:
        at = synchronising_set(seq, t, n, found[found[:, 2] * 3 <= t])
        found = _smallest(np.concatenate((found, seq.extended(*equal_contexts(seq, at, t)))))
        new = found[(found[:, 2] >= 3 * t) & (found[:, 2] < 6 * t)]
        found = _smallest(np.concatenate((found, seq.extended(*touching(seq, new)))))
        t *= 2
    return found


def row_runs(tokens: np.ndarray, bounds: np.ndarray, min_length: int = MIN_LENGTH):
    """(row, start, length, period) of the runs of every row, by row, start
    and period; ``tokens`` are numbers >= 0."""
    size = np.diff(bounds)
    rows = np.argsort(-size, kind="stable")
    rows = rows[size[rows] >= max(2, min_length)]
    if not len(rows):
        return (np.zeros(0, np.int64),) * 4
    n = size[rows]
    edge = np.concatenate(([0], np.cumsum(n + 1)))
    at = np.repeat(bounds[rows] - edge[:-1], n + 1) + np.arange(edge[-1])
    at[edge[1:] - 1] = 0
    joined = tokens[at].astype(np.int64)
    joined[edge[1:] - 1] = np.arange(len(rows)) + (int(tokens.max()) + 1)
    found = all_runs(Sequence(joined), lambda least: int(edge[np.searchsorted(-n, -least, side="right")]))
    found = found[found[:, 1] - found[:, 0] >= min_length]
    of = np.searchsorted(edge, found[:, 0], side="right") - 1
    row, start = rows[of], found[:, 0] - edge[of]
    order = np.lexsort((found[:, 2], start, row))
    return row[order], start[order], (found[:, 1] - found[:, 0])[order], found[order, 2]


def periodic_runs(docs: DataFrame, min_length: int = MIN_LENGTH) -> DataFrame:
    """doc_id, n_words, runs (start, length and period in words, by start and
    period) and collapsed: the words, joined by one space, without those that
    a run contains after its first period."""

    def run(batches):
        for batch in batches:
            for b in blocks(batch.column(1)):
                w = words(b)
                size = np.diff(w.bounds)
                row, start, length, period = row_runs(word_ids(b.data, w.start, w.end)[0], w.bounds, min_length)
                first = w.bounds[row] + start
                depth = np.zeros(len(w.start) + 1, dtype=np.int64)
                np.add.at(depth, first + period, 1)
                np.add.at(depth, first + length, -1)
                text = join_words(b, w, np.cumsum(depth)[:-1] == 0)
                edge = np.searchsorted(row, np.arange(len(size) + 1))
                found = pa.StructArray.from_arrays([pa.array(x, pa.int64()) for x in (start, length, period)],
                                                   fields=list(RUN))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(b.lo, b.hi - b.lo), pa.array(size, pa.int64()),
                     pa.ListArray.from_arrays(pa.array(edge, pa.int32()), found), text],
                    names=["doc_id", "n_words", "runs", "collapsed"])

    return documents(docs).mapInArrow(run, SCHEMA)
