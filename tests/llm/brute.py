"""Plain versions of the operators, for small inputs."""

import collections
import hashlib
import re

import numpy as np
import xxhash


def sha(data) -> str:
    return hashlib.sha256(data if isinstance(data, bytes) else data.encode()).hexdigest()


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def exact(docs):
    groups = collections.defaultdict(list)
    for d, t in docs:
        groups[re.sub(r"[\x20\x09-\x0D]", "", t or "")].append((-len(t or ""), d))
    return {d: (min(g)[1], len(g), d == min(g)[1], sha(k)) for k, g in groups.items() for _, d in g}


def substring(docs, window=13):
    """doc_id -> (n_words, kept words)."""
    first = {}
    for d, t in sorted(docs, key=lambda x: x[0]):
        w = words(t)
        for i in range(len(w) - window + 1):
            first.setdefault(tuple(w[i:i + window]), d)
    out = {}
    for d, t in docs:
        w = words(t)
        gone = [False] * len(w)
        for i in range(len(w) - window + 1):
            if first[tuple(w[i:i + window])] < d:
                gone[i:i + window] = [True] * window
        out[d] = (len(w), [x for x, g in zip(w, gone) if not g])
    return out


def fingerprint(text, n=3):
    low = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))
    w = re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode().translate(low))
    shingles = [b" ".join(w[i:i + n]) for i in range(max(1, len(w) - n + 1))] if w else []
    ones = [0] * 64
    for s in shingles:
        h = xxhash.xxh64_intdigest(s, 42)
        for i in range(64):
            ones[i] += h >> i & 1
    return sum(1 << i for i in range(64) if 2 * ones[i] > len(shingles))


def components(codes, max_bits=3):
    """{id: code} -> {id: smallest id reachable}."""
    ids = sorted(codes)
    parent = {i: i for i in ids}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    a = np.array([codes[i] for i in ids], dtype=np.uint64)
    for i in range(len(ids)):
        for j in np.flatnonzero(np.bitwise_count(a[i + 1:] ^ a[i]) <= max_bits).tolist():
            x, y = find(ids[i]), find(ids[i + 1 + j])
            if x != y:
                parent[max(x, y)] = min(x, y)
    return {i: find(i) for i in ids}


def suffix(docs, size=200):
    data = [(d, (t or "").encode()) for d, t in docs]
    seen = collections.Counter(b[i:i + size] for _, b in data for i in range(len(b) - size + 1))
    out = {}
    for d, b in data:
        gone = [False] * len(b)
        for i in range(len(b) - size + 1):
            if seen[b[i:i + size]] > 1:
                gone[i:i + size] = [True] * size
        spans = sum(g and (i == 0 or not gone[i - 1]) for i, g in enumerate(gone))
        out[d] = (len(b), sum(gone), spans, sha(bytes(x for x, g in zip(b, gone) if not g)))
    return out


def best_fit(lengths, size):
    """Number of sequences that best fit decreasing needs."""
    import bisect

    gaps, n = [], 0
    for x in sorted(lengths, reverse=True):
        i = bisect.bisect_left(gaps, x)
        gap = gaps.pop(i) if i < len(gaps) else size
        n += gap == size and i >= len(gaps)
        if gap > x:
            bisect.insort(gaps, gap - x)
    return n


def runs(tokens, least=12):
    """(start, length, period) of every maximal repetition."""
    out = {}
    for q in range(1, len(tokens) // 2 + 1):
        same = [x == y for x, y in zip(tokens, tokens[q:])] + [False]
        start = 0
        for i, x in enumerate(same):
            if not x:
                if i - start >= q:
                    out.setdefault((start, i + q), q)
                start = i + 1
    return sorted((s, e - s, q) for (s, e), q in out.items() if e - s >= least)


def periodic(tokens):
    """(number of words, runs, collapsed text)."""
    numbers = {x: i for i, x in enumerate(dict.fromkeys(tokens))}
    found = runs([numbers[x] for x in tokens])
    gone = {i for s, n, q in found for i in range(s + q, s + n)}
    return len(tokens), found, " ".join(x for i, x in enumerate(tokens) if i not in gone)
