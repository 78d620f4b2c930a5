"""Lexicon of frequent words as a minimal acyclic transducer.

Words are the byte strings of a tokenizer's splits. The automaton shares
prefixes and suffixes; arcs carry numbers whose sum along a word is the
word's rank, and the rank points at its ids. The arrays travel as one
bounded broadcast; every Python worker puts them in a file of its own
temporary folder, maps the file into memory and unlinks it.
"""

from __future__ import annotations

import io
import tempfile

import numpy as np

from nightjar.llm.bpe import Bpe, HashTable, Ragged

MAX_WORDS = 1 << 16


def minimal_automaton(words: list[bytes]) -> tuple[list[dict[int, int]], list[bool]]:
    """Arcs and final flags of the minimal automaton of sorted words; state 0
    is the start. States are merged with equal ones as soon as no later word
    can reach into them."""
    arcs: list[dict[int, int]] = [{}]
    final = [False]
    register: dict[tuple, int] = {}
    free: list[int] = []
    path = [0]                        # states along the last word
    last = b""

    def settle(depth: int) -> None:
        while len(path) > depth + 1:
            state = path.pop()
            key = (final[state], *arcs[state].items())
            same = register.setdefault(key, state)
            if same != state:
                arcs[path[-1]][last[len(path) - 1]] = same
                arcs[state], final[state] = {}, False
                free.append(state)

    for word in words:
        common = 0
        while common < min(len(word), len(last)) and word[common] == last[common]:
            common += 1
        settle(common)
        for byte in word[common:]:
            if free:
                state = free.pop()
            else:
                state = len(arcs)
                arcs.append({})
                final.append(False)
            arcs[path[-1]][byte] = state
            path.append(state)
        final[path[-1]] = True
        last = word
    settle(0)
    return arcs, final


def compile_lexicon(words: list[bytes], bpe: Bpe) -> bytes:
    """The transducer of ``words`` with their ids, as bytes of one .npz-like
    buffer (plain arrays, no compression)."""
    words = sorted(set(words))
    arcs, final = minimal_automaton(words)
    below = [-1] * len(arcs)          # words that end in or under a state

    def count(root: int) -> None:
        stack = [root]
        while stack:
            s = stack[-1]
            todo = [t for t in arcs[s].values() if below[t] < 0]
            if todo:
                stack += todo
            else:
                below[s] = final[s] + sum(below[t] for t in arcs[s].values())
                stack.pop()

    count(0)
    key, target, number = [], [], []
    for s, out in enumerate(arcs):
        if below[s] <= 0 and s:
            continue
        seen = int(final[s])
        for byte in sorted(out):
            key.append(s << 8 | byte)
            target.append(out[byte])
            number.append(seen)
            seen += below[out[byte]]
    table = HashTable(np.array(key, dtype=np.uint64), np.array(target, dtype=np.int32),
                      np.array(number, dtype=np.int32))
    data = np.frombuffer(b"".join(words), dtype=np.uint8)
    edge = np.concatenate(([0], np.cumsum([len(w) for w in words]))).astype(np.int64)
    ids = bpe.merge(data, edge[:-1], edge[1:]) if words else Ragged(np.zeros(0, np.int32), np.zeros(1, np.int64))
    out = io.BytesIO()
    for a in (table.keys, table.a, table.b, np.array(final), ids.flat, ids.bounds):
        np.save(out, a)
    return out.getvalue()


class Lexicon:
    """The transducer, mapped from a file."""

    def __init__(self, raw: bytes):
        arrays = []
        with tempfile.TemporaryFile() as f:          # unlinked, yet mapped
            f.write(raw)
            f.flush()
            f.seek(0)
            for _ in range(6):
                np.lib.format.read_magic(f)
                shape, _, dtype = np.lib.format.read_array_header_1_0(f)
                size = int(np.prod(shape))
                at = f.tell()
                arrays.append(np.memmap(f, dtype=dtype, mode="r", offset=at, shape=shape)
                              if size else np.zeros(shape, dtype))
                f.seek(at + size * dtype.itemsize)
        keys, a, b, self.final, flat, bounds = arrays
        self.table = HashTable(None, None, None, slots=(keys, a, b))
        self.ids = Ragged(flat, bounds)

    def find(self, data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Rank of each byte range in the lexicon, or -1; all walk side by
        side, one byte a step."""
        rank = np.zeros(len(start), dtype=np.int64)
        state = np.zeros(len(start), dtype=np.int64)
        size = end - start
        live, step = np.arange(len(start)), 0
        ended = np.full(len(start), -1, dtype=np.int64)
        while len(live):
            over = size[live] == step
            stop = live[over]
            ended[stop] = np.where(self.final[state[stop]], rank[stop], -1)
            live = live[~over]
            slot = self.table.find(state[live].astype(np.uint64) << np.uint64(8)
                                   | data[start[live] + step].astype(np.uint64))
            live, slot = live[slot >= 0], slot[slot >= 0]
            state[live] = self.table.a[slot]
            rank[live] += self.table.b[slot]
            step += 1
        return ended


_open: dict[str, Lexicon] = {}


def opened(name: str, raw: bytes) -> Lexicon:
    if name not in _open:
        _open.clear()
        _open[name] = Lexicon(raw)
    return _open[name]
