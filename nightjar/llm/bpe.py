"""Byte-pair encoding of whole batches of texts, equal to the ids of the
public tokenizer files.

Texts are split into words by array operations on code points, each different
word of a block is merged once, and merges of many words run side by side:
every round finds each word's best pair and merges its first place, until no
word has a pair with a rank.
"""

from __future__ import annotations

import heapq
import json
import re
import unicodedata

import numpy as np

from nightjar.llm.textbytes import strings, word_ids

LETTER, NUMBER, SPACE, OTHER = 1, 2, 3, 0
_NO = np.int32(2**31 - 1)
_LONG = 48                           # longer words are merged one by one
_CACHE_WORDS = 1 << 19
_classes: list[np.ndarray] = []


def char_classes() -> np.ndarray:
    """Class of every code point: letter, number, white space or other."""
    if not _classes:
        import regex

        every = "".join(map(chr, [*range(0xD800), *range(0xE000, 0x110000)]))
        out = np.zeros(0x110000, dtype=np.uint8)
        for cls, pattern in ((LETTER, r"\p{L}+"), (NUMBER, r"\p{N}+"), (SPACE, r"\p{White_Space}+")):
            for m in regex.finditer(pattern, every):
                s, e = ord(every[m.start()]), ord(every[m.end() - 1])
                out[s:e + 1] = cls
        _classes.append(out)
    return _classes[0]


def byte_symbols() -> list[str]:
    """The character that stands for each byte in byte-level vocabularies."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return [chr(b) if b in plain else chr(256 + rest.index(b)) for b in range(256)]


class HashTable:
    """Open addressing from uint64 keys to two int32 values, looked up for
    whole arrays."""

    EMPTY = np.uint64(2**64 - 1)

    def __init__(self, keys: np.ndarray, a: np.ndarray, b: np.ndarray, slots=None):
        if slots is not None:
            self.keys, self.a, self.b = slots
            self.bits = len(self.keys).bit_length() - 1
            return
        self.bits = max(8, int(len(keys) * 4).bit_length())
        size = 1 << self.bits
        self.keys = np.full(size, self.EMPTY, dtype=np.uint64)
        self.a, self.b = np.full(size, -1, np.int32), np.full(size, -1, np.int32)
        todo, at = np.arange(len(keys)), self._slot(keys)
        while len(todo):
            _, first = np.unique(at, return_index=True)
            free = np.zeros(len(todo), dtype=bool)
            free[first] = self.keys[at[first]] == self.EMPTY
            put = at[free]
            self.keys[put], self.a[put], self.b[put] = keys[todo[free]], a[todo[free]], b[todo[free]]
            todo, at = todo[~free], (at[~free] + 1) & (size - 1)

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.bits)).astype(np.int64)

    def find(self, keys: np.ndarray) -> np.ndarray:
        """Slot of each key, or -1."""
        slot = self._slot(keys)
        have = self.keys[slot]
        wrong = np.flatnonzero((have != keys) & (have != self.EMPTY))
        slot[have == self.EMPTY] = -1
        while len(wrong):
            nxt = (slot[wrong] + 1) & (len(self.keys) - 1)
            have = self.keys[nxt]
            slot[wrong] = np.where(have == self.EMPTY, -1, nxt)
            wrong = wrong[(have != keys[wrong]) & (have != self.EMPTY)]
        return slot


class Ragged:
    """Rows of different length in one flat array."""

    def __init__(self, flat: np.ndarray, bounds: np.ndarray):
        self.flat, self.bounds = flat, bounds

    def take(self, rows: np.ndarray) -> "Ragged":
        size = (self.bounds[1:] - self.bounds[:-1])[rows]
        bounds = np.concatenate(([0], np.cumsum(size)))
        at = np.repeat(self.bounds[rows] - bounds[:-1], size) + np.arange(bounds[-1])
        return Ragged(self.flat[at], bounds)

    @staticmethod
    def join(parts: list["Ragged"]) -> "Ragged":
        size = np.concatenate([np.diff(p.bounds) for p in parts])
        return Ragged(np.concatenate([p.flat for p in parts]), np.concatenate(([0], np.cumsum(size))))


class Bpe:
    """A tokenizer file: ``byte`` splits keep spaces (byte-level), ``word``
    splits lower-case and drop white space."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        self.suffix = model.get("end_of_word_suffix") or ""
        self.word_mode = spec["normalizer"] is not None
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.special_re = re.compile("|".join(map(re.escape, self.special)))
        vocab = model["vocab"]
        symbols = byte_symbols()
        self.first = np.array([vocab[c] for c in symbols], dtype=np.int32)
        self.last = np.array([vocab[c + self.suffix] for c in symbols], dtype=np.int32)
        pairs = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        left = np.array([vocab[a] for a, _ in pairs], dtype=np.uint64)
        right = np.array([vocab[b] for _, b in pairs], dtype=np.uint64)
        into = np.array([vocab[a + b] for a, b in pairs], dtype=np.int32)
        self.table = HashTable(left << np.uint64(32) | right, np.arange(len(pairs), dtype=np.int32), into)
        self.pairs = {(int(a), int(b)): (i, int(c)) for i, (a, b, c) in enumerate(zip(left, right, into))}
        back = {c: b for b, c in enumerate(symbols)}
        size = max(max(vocab.values()), *self.special.values()) + 1
        text: list[bytes] = [b""] * size
        for token, i in vocab.items():
            text[i] = bytes(back[c] for c in token.removesuffix(self.suffix)) if token not in self.special else b""
        for token, i in self.special.items():
            text[i] = token.encode()
        self.token_bytes = Ragged(np.frombuffer(b"".join(text), dtype=np.uint8),
                                  np.concatenate(([0], np.cumsum([len(t) for t in text]))))
        self.cache_rows: dict[bytes, int] = {}
        self.cache = Ragged(np.zeros(0, np.int32), np.zeros(1, np.int64))

    # --- words -----------------------------------------------------------

    def normalise(self, text: str) -> str:
        if not self.word_mode:
            return text
        if not text.isascii():
            # Lower-casing is by character: a final capital sigma has no rule.
            text = unicodedata.normalize("NFC", text).replace("Σ", "σ")
        return text.lower()

    def split(self, texts: list[str]):
        """(bytes, starts, ends, word bounds of the texts)."""
        joined = "".join(texts)
        data = np.frombuffer(joined.encode("utf-8"), dtype=np.uint8)
        cp = np.frombuffer(joined.encode("utf-32-le"), dtype=np.uint32)
        n = len(cp)
        edge = np.concatenate(([0], np.cumsum([len(t) for t in texts]))).astype(np.int64)
        if len(data) == n:
            offset = np.arange(n + 1)
        else:
            wide = 1 + (cp >= 0x80).astype(np.int64) + (cp >= 0x800) + (cp >= 0x10000)
            offset = np.concatenate(([0], np.cumsum(wide)))
        cls = char_classes()[cp]
        head = np.zeros(n + 1, dtype=bool)
        head[edge] = True
        change = head[:-1].copy()
        if n:
            change[1:] |= cls[1:] != cls[:-1]
        start = change.copy()
        run_s = np.flatnonzero(change)
        run_e = np.append(run_s[1:], n)
        if self.word_mode:
            start[cls == SPACE] = False
            start[cls == NUMBER] = True
        else:
            space = cls[run_s] == SPACE
            e = run_e[space]
            e = e[~head[e]]                   # followed by something else in the same text
            start[e - 1] = True
            start[e[cp[e - 1] == 32]] = False
        quote = run_s[(cp[run_s] == 39) & (run_e - run_s == 1)]
        quote = quote[start[quote]]
        quote = quote[~head[quote + 1]]
        if len(quote):
            x = cp[quote + 1]
            third = np.minimum(quote + 2, n - 1)
            y = np.where(head[quote + 2 if n else quote], 0, cp[third])
            one = np.isin(x, [ord(c) for c in "stmd"])
            two = ((x == ord("r")) | (x == ord("v"))) & (y == ord("e")) | (x == ord("l")) & (y == ord("l"))
            hit = one | two
            q, size = quote[hit], np.where(one, 1, 2)[hit]
            start[q + 1] = change[q + 1] = False
            after = q + 1 + size
            after = after[(after < n)]
            after = after[~head[after]]
            start[after[cls[after] == LETTER]] = True
        if self.word_mode:
            border = np.flatnonzero(start | change)
            keep = start[border]
            s, e = border[keep], np.append(border[1:], n)[keep]
        else:
            s = np.flatnonzero(start)
            e = np.append(s[1:], n)
        return data, offset[s], offset[e], np.searchsorted(s, edge)

    # --- merges ----------------------------------------------------------

    def _ranks(self, left: np.ndarray, right: np.ndarray):
        slot = self.table.find(left.astype(np.uint64) << np.uint64(32) | right.astype(np.uint64))
        return np.where(slot < 0, _NO, self.table.a[slot]), self.table.b[slot]

    def merge(self, data: np.ndarray, start: np.ndarray, end: np.ndarray) -> Ragged:
        """Ids of every byte range, merged as one word."""
        size = end - start
        short = np.flatnonzero(size <= _LONG)
        parts, order = [], []
        if len(short):
            parts.append(self._merge_short(data, start[short], end[short]))
            order.append(short)
        for i in np.flatnonzero(size > _LONG).tolist():
            ids = np.array(self._merge_long(data[start[i]:end[i]]), dtype=np.int32)
            parts.append(Ragged(ids, np.array([0, len(ids)])))
            order.append(np.array([i]))
        if not parts:
            return Ragged(np.zeros(0, np.int32), np.zeros(1, np.int64))
        back = np.empty(len(size), dtype=np.int64)
        back[np.concatenate(order)] = np.arange(len(size))
        return Ragged.join(parts).take(back)

    def _merge_short(self, data, start, end) -> Ragged:
        size = end - start
        bound = np.concatenate(([0], np.cumsum(size)))
        at = np.repeat(start - bound[:-1], size) + np.arange(bound[-1])
        sym = self.first[data[at]]
        sym[bound[1:] - 1] = self.last[data[end - 1]]
        name = np.arange(len(size))            # word number of each row still at work
        done_sym, done_name, done_size = [], [], []
        rank = np.full(len(sym), _NO, dtype=np.int32)
        into = np.zeros(len(sym), dtype=np.int32)
        r, m = self._ranks(sym[:-1], sym[1:])
        rank[:-1], into[:-1] = r, m
        rank[bound[1:] - 1] = _NO
        while len(size):
            bound = np.concatenate(([0], np.cumsum(size)))
            best = np.minimum.reduceat(rank, bound[:-1])
            alive = best < _NO
            if not alive.all():
                off = ~alive
                cells = np.repeat(off, size)
                done_sym.append(sym[cells])
                done_name.append(name[off])
                done_size.append(size[off])
                keep = ~cells
                sym, rank, into = sym[keep], rank[keep], into[keep]
                size, name, best = size[alive], name[alive], best[alive]
                if not len(size):
                    break
                bound = np.concatenate(([0], np.cumsum(size)))
            row = np.repeat(np.arange(len(size)), size)
            hit = np.flatnonzero(rank == best[row])
            first = np.ones(len(hit), dtype=bool)
            first[1:] = row[hit[1:]] != row[hit[:-1]]
            p = hit[first]                      # one place a word, in word order
            sym[p] = into[p]
            keep = np.ones(len(sym), dtype=bool)
            keep[p + 1] = False
            lost_last = p + 1 == bound[1:] - 1
            sym, rank, into = sym[keep], rank[keep], into[keep]
            size = size - 1
            p = p - np.arange(len(p))
            rank[p] = _NO
            q = p[~lost_last]
            rank[q], into[q] = self._ranks(sym[q], sym[q + 1])
            begin = np.concatenate(([0], np.cumsum(size)))[:-1]
            q = p[p > begin] - 1
            rank[q], into[q] = self._ranks(sym[q], sym[q + 1])
        flat = Ragged(np.concatenate(done_sym), np.concatenate(([0], np.cumsum(np.concatenate(done_size)))))
        back = np.empty(len(start), dtype=np.int64)
        back[np.concatenate(done_name)] = np.arange(len(start))
        return flat.take(back)

    def _merge_long(self, word: np.ndarray) -> list[int]:
        sym: list[int] = self.first[word].tolist()
        sym[-1] = int(self.last[word[-1]])
        n = len(sym)
        nxt, prv, gone = list(range(1, n + 1)), list(range(-1, n - 1)), [False] * n
        heap = []

        def push(i):
            j = nxt[i]
            if i >= 0 and j < n and (found := self.pairs.get((sym[i], sym[j]))) is not None:
                heapq.heappush(heap, (found[0], i, sym[i], sym[j], found[1]))

        for i in range(n - 1):
            push(i)
        while heap:
            _, i, a, b, into = heapq.heappop(heap)
            if gone[i] or sym[i] != a or nxt[i] >= n or sym[nxt[i]] != b:
                continue
            j = nxt[i]
            sym[i], gone[j], nxt[i] = into, True, nxt[j]
            if nxt[i] < n:
                prv[nxt[i]] = i
            push(i)
            if prv[i] >= 0:
                push(prv[i])
        return [s for s, g in zip(sym, gone) if not g]

    # --- texts -----------------------------------------------------------

    def words(self, data, start, end, lexicon=None) -> tuple[Ragged, np.ndarray]:
        """Ids of the different words, and which of them each word is."""
        if not len(start):
            return Ragged(np.zeros(0, np.int32), np.zeros(1, np.int64)), np.zeros(0, np.int64)
        which, first = word_ids(data, start, end)
        s, e = start[first], end[first]
        parts, order = [], []
        open_ = np.arange(len(first))
        if lexicon is not None:
            index = lexicon.find(data, s, e)
            known = index >= 0
            parts.append(lexicon.ids.take(index[known]))
            order.append(open_[known])
            open_ = open_[~known]
        names = strings(data, s[open_], e[open_])
        row = np.fromiter((self.cache_rows.get(x, -1) for x in names), np.int64, len(names))
        known = row >= 0
        parts.append(self.cache.take(row[known]))
        order.append(open_[known])
        new = open_[~known]
        if len(new):
            fresh = self.merge(data, s[new], e[new])
            parts.append(fresh)
            order.append(new)
            if len(self.cache_rows) + len(new) <= _CACHE_WORDS:
                rows = range(len(self.cache_rows), len(self.cache_rows) + len(new))
                self.cache_rows.update(zip((names[i] for i in np.flatnonzero(~known).tolist()), rows))
                self.cache = Ragged.join([self.cache, fresh])
        back = np.empty(len(first), dtype=np.int64)
        back[np.concatenate(order)] = np.arange(len(first))
        return Ragged.join(parts).take(back), which

    def encode(self, texts: list[str], lexicon=None) -> Ragged:
        """Ids of every text."""
        pieces, owner, special = [], [], []
        for i, t in enumerate(texts):
            if "<|" in t:
                at = 0
                for m in self.special_re.finditer(t):
                    pieces += [self.normalise(t[at:m.start()]), ""]
                    owner += [i, i]
                    special += [-1, self.special[m.group()]]
                    at = m.end()
                t = t[at:]
            pieces.append(self.normalise(t))
            owner.append(i)
            special.append(-1)
        data, start, end, bounds = self.split(pieces)
        table, which = self.words(data, start, end, lexicon)
        flat = table.take(which)
        edge = flat.bounds[bounds]
        if max(special, default=-1) >= 0:
            at = np.flatnonzero(np.array(special) >= 0)
            ids = np.insert(flat.flat, edge[at], np.array(special, dtype=np.int32)[at])
            extra = np.concatenate(([0], np.cumsum(np.array(special) >= 0)))
            flat, edge = Ragged(ids, flat.bounds), edge + extra
        last = np.searchsorted(np.array(owner), np.arange(len(texts)), side="right")
        return Ragged(flat.flat, np.concatenate(([0], edge[last])))

    def decode(self, ids: np.ndarray) -> bytes:
        return self.token_bytes.take(ids).flat.tobytes()


_models: dict[str, Bpe] = {}


def model(path: str) -> Bpe:
    """The tokenizer of a file, loaded once a process."""
    if path not in _models:
        _models[path] = Bpe(path)
    return _models[path]
