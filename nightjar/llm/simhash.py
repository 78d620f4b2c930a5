"""SimHash near-deduplication by anchor-point covering.

Fingerprint: 64 bits over the XXH64 hashes (seed 42) of a text's word
shingles. Two fingerprints link at ``max_bits`` = 3 or fewer differing bits.

Covering: the 64 bits are two halves of 32. Of two linked fingerprints one
half differs in at most one bit. A half is covered by the product of the
perfect binary Golay code (23 bits, covering radius 3, 4,096 code words) and
all words of the other 9 bits: 2**21 anchors with covering radius 3. A
fingerprint's home is its nearest anchor; it visits every anchor within the
covering radius plus the threshold of one bit, at most 15 a half. So a linked
pair meets at the home of either one, and homes are compared with visitors
anchor by anchor.

Only distinct fingerprints take part. Anchors that are home to more than
``BLOCK`` fingerprints are split into blocks of homes, each met by all
visitors, so one dense group is spread over tasks; a comparison returns
spanning links (at most one a visitor and one a home), never all pairs.

Defined cases: a null or blank text has fingerprint zero and links like any
other; repeated rows share a class; an empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from nightjar.llm.tables import documents, materialize, partitions
from nightjar.llm.textbytes import blocks, words
from nightjar.operators.spatial import connected_components

SHINGLE = 3
MAX_BITS = 3
SEED = 42
BLOCK = 2048
_PAIRS = 1 << 21                     # fingerprint pairs compared at once
#: Fixed value: generator polynomial of the binary Golay code (23, 12).
GOLAY = 0b101011100011
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def fingerprints(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """doc_id and fp (long), whole texts."""

    def run(batches):
        for batch in batches:
            ids = batch.column(0)
            for b in blocks(batch.column(1)):
                yield pa.RecordBatch.from_arrays(
                    [ids.slice(b.lo, b.hi - b.lo), pa.array(_block_fingerprints(b, shingle), pa.int64())],
                    names=["doc_id", "fp"])

    return documents(docs).mapInArrow(run, "doc_id long, fp long")


def _block_fingerprints(b, shingle: int) -> np.ndarray:
    b.data = _LOWER[b.data]
    w = words(b)
    n = len(b.offsets) - 1
    out = np.zeros(n, dtype=np.uint64)
    if not len(w.start):
        return out.view(np.int64)
    # The words of a text joined by one space, all texts in one buffer.
    raw = b.data.tobytes()
    tokens = [raw[s:e] for s, e in zip(w.start.tolist(), w.end.tolist())]
    joined = b" ".join(tokens)
    size = w.end - w.start
    begin = np.concatenate(([0], np.cumsum(size + 1)[:-1]))
    stop = begin + size
    count = np.diff(w.bounds)
    width = np.minimum(count, shingle)
    first = np.arange(len(tokens))
    row = w.row
    ok = first + width[row] <= w.bounds[1:][row]
    first = first[ok]
    last = first + width[row[first]] - 1
    h64 = xxhash.xxh64_intdigest
    hashes = np.fromiter((h64(joined[s:e], SEED) for s, e in zip(begin[first].tolist(), stop[last].tolist())),
                         dtype=np.uint64, count=len(first))
    row = row[first]
    total = np.bincount(row, minlength=n)
    edge = np.concatenate(([0], np.cumsum(total)))
    step = 1 << 16
    ones = np.zeros((n, 64), dtype=np.int64)
    for lo in range(0, len(hashes), step):
        bits = np.unpackbits(hashes[lo:lo + step].astype(">u8").view(np.uint8).reshape(-1, 8), axis=1)
        r = row[lo:lo + step]
        cut = np.concatenate(([0], np.flatnonzero(np.diff(r)) + 1))
        ones[r[cut]] += np.add.reduceat(bits, cut, axis=0, dtype=np.int64)
    del edge
    major = (2 * ones > total[:, None]).astype(np.uint8)
    return np.packbits(major, axis=1).view(">u8").ravel().astype(np.uint64).view(np.int64)


def _golay_tables() -> tuple[np.ndarray, np.ndarray]:
    """Remainder of every 23-bit word's high 12 bits, and for every syndrome
    the error patterns of weight <= 4 (the nearest first, padded with -1)."""
    rem = np.zeros(1 << 12, dtype=np.int64)
    for m in range(1 << 12):
        v = m << 11
        for i in range(22, 10, -1):
            if v >> i & 1:
                v ^= GOLAY << (i - 11)
        rem[m] = v
    patterns: list[list[int]] = [[] for _ in range(1 << 11)]
    from itertools import combinations

    for weight in range(5):
        for pos in combinations(range(23), weight):
            e = sum(1 << p for p in pos)
            patterns[int(rem[e >> 11] ^ (e & 2047))].append(e)
    table = np.full((1 << 11, max(map(len, patterns))), -1, dtype=np.int64)
    for s, p in enumerate(patterns):
        table[s, :len(p)] = p
    return rem, table


_TABLES: list = []


def anchors(fps: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(index into fps, anchor, is home) of every visit of a fingerprint."""
    if not _TABLES:
        _TABLES.extend(_golay_tables())
    rem, table = _TABLES
    index = np.arange(len(fps))
    found = []
    for half in range(2):
        v = ((fps >> np.uint64(32 * half)) & np.uint64(0xFFFFFFFF)).astype(np.int64)
        code, free = v >> 9, v & 511
        errors = table[rem[code >> 11] ^ (code & 2047)]
        base = half << 21
        home = base | ((code ^ errors[:, 0]) >> 11) << 9 | free
        found.append((index, home, True))
        for bit in range(9):
            found.append((index, home ^ (1 << bit), False))
        for j in range(1, errors.shape[1]):
            there = np.flatnonzero(errors[:, j] >= 0)
            found.append((there, base | ((code[there] ^ errors[there, j]) >> 11) << 9 | free[there], False))
    return (np.concatenate([x[0] for x in found]), np.concatenate([x[1] for x in found]),
            np.concatenate([np.full(len(x[0]), x[2]) for x in found]))


def _visits(codes: DataFrame) -> DataFrame:
    def run(batches):
        for batch in batches:
            fps = batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64)
            for lo in range(0, len(fps), 1 << 15):
                part = fps[lo:lo + (1 << 15)]
                i, a, home = anchors(part)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(a.astype(np.int32)), pa.array(part[i].view(np.int64)), pa.array(home)],
                    names=["anchor", "fp", "home"])

    return codes.select("fp").mapInArrow(run, "anchor int, fp long, home boolean")


class _Dense:
    """Homes of one anchor block against a stream of visitors; yields links
    that span the groups they form."""

    def __init__(self, homes: np.ndarray):
        self.homes = homes
        self.parent = list(range(len(homes)))

    def find(self, x: int) -> int:
        while self.parent[x] != x:
            self.parent[x] = self.parent[self.parent[x]]
            x = self.parent[x]
        return x

    def visit(self, visitors: np.ndarray, max_bits: int):
        out = []
        step = max(1, _PAIRS // len(self.homes))
        for lo in range(0, len(visitors), step):
            v = visitors[lo:lo + step]
            near = np.bitwise_count(v[:, None] ^ self.homes[None, :]) <= max_bits
            hit = np.flatnonzero(near.any(axis=1))
            if not len(hit):
                continue
            near = near[hit]
            first = near.argmax(axis=1)
            out.append(np.stack([v[hit], self.homes[first]], axis=1))
            r, c = np.nonzero(near)
            pairs = np.unique(first[r] * len(self.homes) + c)
            for a, b in zip((pairs // len(self.homes)).tolist(), (pairs % len(self.homes)).tolist()):
                x, y = self.find(a), self.find(b)
                if x != y:
                    self.parent[y] = x
                    out.append(self.homes[[a, b]][None, :])
        return out


def _emit(links: list[np.ndarray]):
    if links:
        e = np.concatenate(links)
        e = e[e[:, 0] != e[:, 1]]
        if len(e):
            e = np.unique(np.sort(e, axis=1), axis=0)
            yield pa.RecordBatch.from_arrays([pa.array(e[:, 0].copy().view(np.int64)),
                                              pa.array(e[:, 1].copy().view(np.int64))], names=["a", "b"])


def _compare_sorted(max_bits: int):
    """Task over rows sorted by (anchor, block, homes first). Memory: one
    batch, and the homes of one block."""

    def small_groups(anchor, fp, home, cuts, sizes):
        homes_n = np.add.reduceat(home.astype(np.int64), cuts)
        work = homes_n * sizes
        links = []
        for lo in _chunks(work):
            sel = slice(*lo)
            c, s, h = cuts[sel], sizes[sel], homes_n[sel]
            w = h * s
            g = np.repeat(np.arange(len(c)), w)
            k = np.arange(len(g)) - np.repeat(np.concatenate(([0], np.cumsum(w)[:-1])), w)
            x, y = fp[c[g] + k // s[g]], fp[c[g] + k % s[g]]
            near = (np.bitwise_count(x ^ y) <= max_bits) & (x != y)
            links.append(np.stack([x[near], y[near]], axis=1))
        return links

    def run(batches):
        dense, key = None, None
        for batch in batches:
            a = batch.column(0).to_numpy(zero_copy_only=False).astype(np.int64)
            blk = batch.column(1).to_numpy(zero_copy_only=False).astype(np.int64)
            fp = batch.column(2).to_numpy(zero_copy_only=False).view(np.uint64)
            home = batch.column(3).to_numpy(zero_copy_only=False).astype(bool)
            if not len(a):
                continue
            group = (a << 32) | blk
            cuts = np.concatenate(([0], np.flatnonzero(np.diff(group)) + 1))
            ends = np.append(cuts[1:], len(a))
            links = []
            # The first group may go on from the batch before, the last may go
            # on into the next one: both are streamed.
            for i in sorted({0, len(cuts) - 1}):
                lo, hi = cuts[i], ends[i]
                if group[lo] != key:
                    dense, key = None, group[lo]
                h = fp[lo:hi][home[lo:hi]]
                if len(h):
                    old = dense.homes if dense is not None else np.zeros(0, np.uint64)
                    parent = dense.parent if dense is not None else []
                    dense = _Dense(np.concatenate([old, h]))
                    dense.parent[:len(parent)] = parent
                if dense is not None:
                    links += dense.visit(fp[lo:hi], max_bits)
                    if len(h) and len(old):        # homes of the batch before against these
                        links += dense.visit(old, max_bits)
            if len(cuts) > 2:
                mid = slice(1, -1)
                sizes = ends - cuts
                big = np.flatnonzero((sizes > 512))
                big = big[(big > 0) & (big < len(cuts) - 1)]
                for i in big.tolist():
                    h = fp[cuts[i]:ends[i]][home[cuts[i]:ends[i]]]
                    if len(h):
                        links += _Dense(h).visit(fp[cuts[i]:ends[i]], max_bits)
                keep = np.ones(len(cuts), dtype=bool)
                keep[[0, -1]] = False
                keep[big] = False
                c, s = cuts[keep], sizes[keep]
                if len(c):
                    rows = np.repeat(c - np.concatenate(([0], np.cumsum(s)[:-1])), s) + np.arange(s.sum())
                    links += small_groups(a[rows], fp[rows], home[rows],
                                          np.concatenate(([0], np.cumsum(s)[:-1])), s)
                del mid
            yield from _emit(links)

    return run


def _chunks(work: np.ndarray):
    """Index ranges of groups with about _PAIRS comparisons each."""
    total = np.cumsum(work)
    lo = 0
    while lo < len(work):
        done = total[lo - 1] if lo else 0
        hi = max(lo + 1, int(np.searchsorted(total, done + _PAIRS, side="right")))
        yield lo, hi
        lo = hi


def links(codes: DataFrame, max_bits: int = MAX_BITS, block: int = BLOCK) -> DataFrame:
    """Spanning links (a, b) between distinct fingerprints ``fp`` of
    ``codes`` that differ in ``max_bits`` = 3 or fewer bits."""
    if not 0 <= max_bits <= 3:
        raise ValueError("the covering holds for at most three differing bits")
    spark = codes.sparkSession
    visits = _visits(codes)
    hot = (visits.where("home").groupBy("anchor").count().where(F.col("count") > block)
           .select(F.col("anchor").alias("h_anchor"),
                   F.ceil(F.col("count") / block).cast("int").alias("n_blocks")))
    hot = materialize(hot, "op5-hot")
    plain = visits.withColumn("block", F.lit(0))
    if not hot.isEmpty():
        split = visits.join(hot, F.col("anchor") == F.col("h_anchor"), "left").fillna(1, ["n_blocks"])
        own = F.pmod(F.xxhash64("fp"), F.col("n_blocks")).cast("int")
        # A home is a home in its own block and a visitor in the others.
        plain = (split.withColumn("block", F.explode(F.sequence(F.lit(0), F.col("n_blocks") - 1)))
                 .withColumn("home", F.col("home") & (F.col("block") == own))
                 .select("anchor", "fp", "home", "block"))
    dealt = (plain.select("anchor", "block", "fp", "home")
             .repartition(partitions(spark), "anchor", "block")
             .sortWithinPartitions("anchor", "block", F.col("home").desc()))
    return dealt.mapInArrow(_compare_sorted(max_bits), "a long, b long").distinct()


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, max_bits: int = MAX_BITS) -> DataFrame:
    """doc_id, fp (long), component_id: smallest doc_id reachable by links."""
    fp = materialize(fingerprints(docs, shingle), "op5-fingerprints")
    codes = materialize(fp.groupBy("fp").agg(F.min("doc_id").alias("first_id")), "op5-codes")
    found = materialize(links(codes, max_bits), "op5-links")
    label = connected_components(found, keys=(), src="a", dst="b")
    classes = (codes.join(label, F.col("fp") == F.col("node"), "left")
               .select("fp", "first_id", F.coalesce("label", "fp").alias("class")))
    first = classes.groupBy("class").agg(F.min("first_id").alias("component_id"))
    named = classes.join(first, "class").select(F.col("fp").alias("n_fp"), "component_id")
    return (fp.join(named, F.col("fp") == F.col("n_fp"))
            .select("doc_id", "fp", "component_id"))


def hex_fingerprint(fp):
    return F.lpad(F.lower(F.hex(fp)), 16, "0")
