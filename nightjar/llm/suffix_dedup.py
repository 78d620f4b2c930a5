"""Deduplication of long repeats by common-prefix interval trees.

Every byte covered by a 200-byte string that also starts anywhere else, in
the same or another document, is removed.

1. Equal texts of 200 bytes and more are repeats from end to end; one text of
   each class goes on.
2. Sampling: any 200-byte string holds the position of the smallest of its
   169 32-byte hashes. Of a repeat, both places have that position in common
   (its pivot), and share 100 bytes to the right of it or 100 to the left.
   These 100-byte keys are counted over the corpus.
3. Pivots with a key that occurs twice get the context that a 200-byte string
   around the pivot can reach (300 bytes at most), and contexts are counted by
   hash. A context that occurs twice is a repeat as a whole. Only keys with
   different contexts, one of them single, are open: their contexts shuffle by
   key as text, each once a task.
4. Per key the contexts are an enhanced (sparse) suffix array: sorted by what
   follows the pivot, with the longest common prefixes of neighbours. A stack
   scan gives the common-prefix intervals. In every interval the members are
   ordered by what precedes the pivot: where the left extensions differ a
   maximal repeat ends, and a member's longest left match in the interval
   plus the interval's depth is the repeat it takes part in. So each context
   gets its repeats with any member of the group, not just neighbours.
5. Repeats of 200 bytes and more are joined back to all occurrences.

Keys with more than ``GROUP`` different contexts are not gathered: their
200-byte strings are counted one by one by a hash aggregate instead, which
combines before the shuffle. Both ways give the same bytes.

Defined cases: a null text is empty; a repeated row counts as another place,
so it loses a text of 200 bytes and more; rows without a doc_id are each a
document of their own, with a private number inside; an empty table gives an
empty result.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from nightjar.llm.tables import (CAPACITY, BitFilter, documents, key_filter, map_without, materialize, partitions,
                                 split_by_keys)
from nightjar.llm.textbytes import blocks, mix, powers, runs, signed, sliding_min
from nightjar.llm.substring_dedup import covered_by

MIN_BYTES = 200
GRAM = 32
GROUP = 1 << 14
_BLOCK = 1 << 18
_BASE = 0xA0761D6478BD642F | 1


def _pivots(b, size: int, gram: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(position, start of its text, end of its text) of every pivot."""
    n, span = len(b.data), size - gram + 1
    none = np.zeros(0, dtype=np.int64)
    if n < size:
        return none, none, none
    padded = np.concatenate([b.data, np.zeros(gram, dtype=np.uint8)])
    h = np.zeros(n, dtype=np.uint64)
    for i in range(0, gram, 8):
        load = np.lib.stride_tricks.as_strided(padded[i:].view(np.uint8)[:n + 7 - 0].view(), (n, 8), (1, 1))
        word = np.ascontiguousarray(load).view(np.uint64).ravel()
        h = (h ^ word) * np.uint64(0x9E3779B97F4A7C15)
        h ^= h >> np.uint64(29)
    g = (mix(h) >> np.uint64(32)).astype(np.uint32) | np.uint32(1)
    low = np.zeros(n, dtype=np.uint32)
    found = sliding_min(g[:n - gram + 1], span)
    low[:len(found)] = found
    ends = np.repeat(b.offsets[1:], np.diff(b.offsets))
    begins = np.repeat(b.offsets[:-1], np.diff(b.offsets))
    low[np.arange(n) + size > ends] = 0
    # The largest of the window minima around a position is its own value
    # exactly if some window chose it.
    front = np.concatenate([np.zeros(span - 1, dtype=np.uint32), low])
    high = ~sliding_min(~front, span)
    at = np.flatnonzero((high == g) & (np.arange(n) + gram <= ends))
    return at, begins[at], ends[at]


def _sides(b, size: int, gram: int):
    """Both keys of every pivot: (key, position, context start, context end),
    first those that share half a string to the right, then to the left."""
    at, begin, end = _pivots(b, size, gram)
    half = size // 2
    p, inv = powers(_BASE, len(b.data) + 1)
    acc = np.zeros(len(b.data) + 1, dtype=np.uint64)
    np.cumsum((b.data.astype(np.uint64) + np.uint64(1)) * p[:-1], out=acc[1:])

    def value(lo, hi):
        return mix((acc[hi] - acc[lo]) * inv[lo])

    out = []
    for right in (True, False):
        sel = at + half <= end if right else at - half >= begin
        x, s, e = at[sel], begin[sel], end[sel]
        key = value(x, x + half) if right else ~value(x - half, x)
        lo = np.maximum(s, x - (half if right else size - gram))
        hi = np.minimum(e, x + (size if right else half))
        ok = hi - lo >= size
        out.append((key[ok], x[ok], lo[ok], hi[ok], value(lo[ok], hi[ok]) ^ mix((x - lo)[ok].astype(np.uint64))))
    return [np.concatenate(c) for c in zip(*out)]


def _keys(docs: DataFrame, gone: DataFrame, n_gone: int, size: int, gram: int) -> DataFrame:
    def run(batches):
        for batch in batches:
            for b in blocks(batch.column(1), _BLOCK):
                key = _sides(b, size, gram)[0]
                if len(key):
                    yield pa.RecordBatch.from_arrays([pa.array(signed(key))], names=["key"])

    return map_without(docs, gone, n_gone, run, "key long")


_HIT = "key long, ctx long, doc_id long, pos long, context binary, before int, after int"


def _hits(docs: DataFrame, gone: DataFrame, n_gone: int, shared: DataFrame, size: int, gram: int) -> DataFrame:
    """A row for every pivot with a shared key; the context only with the
    first of equal ones in a block."""
    n = shared.count()
    f = key_filter(shared, n) if n <= CAPACITY else None

    def run(batches):
        for batch in batches:
            ids = batch.column(0)
            for b in blocks(batch.column(1), _BLOCK):
                key, at, lo, hi, ctx = _sides(b, size, gram)
                if f is not None:
                    sel = f.contains(key)
                    key, at, lo, hi, ctx = key[sel], at[sel], lo[sel], hi[sel], ctx[sel]
                if not len(key):
                    continue
                row = np.searchsorted(b.offsets, at, side="right") - 1
                first = np.zeros(len(key), dtype=bool)
                first[np.unique(key ^ mix(ctx), return_index=True)[1]] = True
                raw = b.data.tobytes()
                text = [raw[x:y] if z else None for x, y, z in zip(lo.tolist(), hi.tolist(), first.tolist())]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(signed(key)), pa.array(signed(ctx)), ids.take(pa.array(b.lo + row)),
                     pa.array(at - b.offsets[row]), pa.array(text, pa.binary()), pa.array((at - lo).astype(np.int32)),
                     pa.array((hi - at).astype(np.int32))],
                    names=["key", "ctx", "doc_id", "pos", "context", "before", "after"])

    hits = map_without(docs, gone, n_gone, run, _HIT)
    if f is None:
        # More keys than a filter holds: contexts of all pivots, then a join.
        hits = hits.join(shared, "key", "left_semi")
    return hits


def common_prefix(a: np.ndarray, b: np.ndarray, limit: np.ndarray) -> np.ndarray:
    """Length of the common prefix of each pair of rows, at most ``limit``."""
    differ = a != b
    at = np.where(differ.any(axis=1), differ.argmax(axis=1), a.shape[1])
    return np.minimum(at, limit)


def _matrix(parts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    size = np.fromiter(map(len, parts), dtype=np.int64, count=len(parts))
    width = max(1, int(size.max()))
    out = np.frombuffer(b"".join(x.ljust(width, b"\0") for x in parts), dtype=np.uint8)
    return out.reshape(len(parts), width), size


def intervals(lcp: np.ndarray) -> list[tuple[int, int, int]]:
    """(first, last, depth) of every common-prefix interval of an array with
    ``lcp[i]`` between rows i and i + 1; a stack scan."""
    out, stack = [], [(0, 0)]
    for i, d in enumerate([*lcp.tolist(), 0]):
        first = i
        while stack and stack[-1][1] > d:
            first, depth = stack.pop()
            out.append((first, i, depth))
        if not stack or stack[-1][1] < d:
            stack.append((first, d))
    return out


def group_repeats(contexts: list[bytes], before: list[int], size: int) -> list[tuple[int, int, int]]:
    """(member, left, right): the member's bytes from ``left`` before the
    pivot to ``right`` after it also occur in another member."""
    after = [c[x:] for c, x in zip(contexts, before)]
    order = sorted(range(len(after)), key=after.__getitem__)
    right, r_len = _matrix([after[i] for i in order])
    left, l_len = _matrix([contexts[i][:before[i]][::-1] for i in order])
    lcp = common_prefix(right[:-1], right[1:], np.minimum(r_len[:-1], r_len[1:]))
    by_left = np.array(sorted(range(len(order)), key=lambda i: left[i].tobytes()))
    rank = np.empty(len(order), dtype=np.int64)
    rank[by_left] = np.arange(len(order))
    out = []
    for lo, hi, depth in intervals(lcp):
        members = lo + np.argsort(rank[lo:hi + 1], kind="stable")
        ext = common_prefix(left[members[:-1]], left[members[1:]],
                            np.minimum(l_len[members[:-1]], l_len[members[1:]]))
        most = np.maximum(np.concatenate(([0], ext)), np.concatenate((ext, [0])))
        for m in np.flatnonzero(most + depth >= size).tolist():
            out.append((order[members[m]], int(most[m]), depth))
    return out


def _repeats(size: int):
    """Task over contexts sorted by key and hash; equal ones follow each other."""

    def run(batches):
        held: list[tuple] = []
        for batch in batches:
            for row in zip(*(batch.column(i).to_pylist() for i in range(4))):
                if not held or held[-1][:2] != row[:2]:
                    held.append(row)
            if not held:
                continue
            last = held[-1][0]
            cut = len(held)
            while cut and held[cut - 1][0] == last:
                cut -= 1
            yield from _found(held[:cut], size)
            held = held[cut:]
        yield from _found(held, size)

    return run


def _found(rows: list[tuple], size: int):
    key, ctx, left, right = [], [], [], []

    def add(row, a, b):
        key.append(row[0])
        ctx.append(row[1])
        left.append(a)
        right.append(b)

    pairs, i = [], 0
    while i < len(rows):
        j = i + 1
        while j < len(rows) and rows[j][0] == rows[i][0]:
            j += 1
        if j - i == 2:
            pairs.append(i)
        elif j - i > 2:
            for m, a, b in group_repeats([r[2] for r in rows[i:j]], [r[3] for r in rows[i:j]], size):
                add(rows[i + m], a, b)
        i = j
    for lo in range(0, len(pairs), 4096):
        part = pairs[lo:lo + 4096]
        a, b = [rows[i] for i in part], [rows[i + 1] for i in part]
        ra, na = _matrix([r[2][r[3]:] for r in a] + [r[2][r[3]:] for r in b])
        la, ma = _matrix([r[2][:r[3]][::-1] for r in a] + [r[2][:r[3]][::-1] for r in b])
        k = len(part)
        fwd = common_prefix(ra[:k], ra[k:], np.minimum(na[:k], na[k:]))
        back = common_prefix(la[:k], la[k:], np.minimum(ma[:k], ma[k:]))
        for m in np.flatnonzero(fwd + back >= size).tolist():
            add(a[m], int(back[m]), int(fwd[m]))
            add(b[m], int(back[m]), int(fwd[m]))
    if key:
        yield pa.RecordBatch.from_arrays(
            [pa.array(key, pa.int64()), pa.array(ctx, pa.int64()), pa.array(left, pa.int32()),
             pa.array(right, pa.int32())], names=["key", "ctx", "left", "right"])


def _counted_repeats(contexts: DataFrame, size: int) -> DataFrame:
    """The same for keys with very many contexts, by counting strings."""

    def strings_of(batches):
        for batch in batches:
            before = batch.column(3).to_numpy(zero_copy_only=False).astype(np.int64)
            for b in blocks(batch.column(2), _BLOCK):
                p, inv = powers(_BASE, len(b.data) + 1)
                acc = np.zeros(len(b.data) + 1, dtype=np.uint64)
                np.cumsum((b.data.astype(np.uint64) + np.uint64(1)) * p[:-1], out=acc[1:])
                x = before[b.lo:b.hi]
                low = np.maximum(0, x - size + 1)              # first start of a string that holds the pivot
                n = np.maximum(0, np.minimum(x, np.diff(b.offsets) - size) - low + 1)
                row = np.repeat(np.arange(len(n)), n)
                start = low[row] + np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n)
                at = b.offsets[row] + start
                digest = mix((acc[at + size] - acc[at]) * inv[at])
                own = pa.array(b.lo + row)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(own), batch.column(1).take(own), pa.array((x[row] - start).astype(np.int32)),
                     pa.array(signed(digest))], names=["key", "ctx", "left", "digest"])

    each = contexts.mapInArrow(strings_of, "key long, ctx long, left int, digest long")
    often = (each.groupBy(F.col("key").alias("o_key"), F.col("left").alias("o_left"), F.col("digest").alias("o_digest"))
             .agg(F.count(F.lit(1)).alias("n_all")).where("n_all > 1").drop("n_all"))
    return (each.join(often, (F.col("key") == F.col("o_key")) & (F.col("left") == F.col("o_left"))
                      & (F.col("digest") == F.col("o_digest")), "left_semi")
            .select("key", "ctx", "left", (F.lit(size) - F.col("left")).cast("int").alias("right")))


def repeats(docs: DataFrame, gone: DataFrame | None = None, size: int = MIN_BYTES, gram: int = GRAM,
            group: int = GROUP) -> DataFrame:
    """doc_id, start, end: places of strings of ``size`` bytes and more that
    occur more than once in ``docs`` (doc_id, text) without the rows of
    ``gone`` (doc_id)."""
    spark = docs.sparkSession
    if gone is None:
        gone = spark.createDataFrame([], "doc_id long")
    n_gone = gone.count()
    keys = _keys(docs, gone, n_gone, size, gram).groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("key")
    shared = materialize(keys, "op7-keys")
    hits = materialize(_hits(docs, gone, n_gone, shared, size, gram), "op7-hits")
    counts = materialize(hits.groupBy("key", "ctx").agg(F.count(F.lit(1)).alias("n")), "op7-contexts")
    per_key = (counts.groupBy(F.col("key").alias("g_key"))
               .agg(F.count(F.lit(1)).alias("contexts"), F.min("n").alias("least")))
    is_open, is_crowded = F.expr("contexts > 1 AND least = 1"), F.col("contexts") > group
    found = materialize(per_key.select("g_key", is_open.alias("open"), is_crowded.alias("crowded"))
                        .where("open OR crowded"), "op7-open")
    usual, many = _open_contexts(hits, found)
    # By a hash of the key: after a join by the key itself Spark would leave out
    # this exchange, and split large partitions of the join between tasks.
    dealt = usual.repartition(partitions(spark), F.xxhash64("key")).sortWithinPartitions("key", "ctx")
    ranges = dealt.mapInArrow(_repeats(size), "key long, ctx long, left int, right int")
    if many is not None:
        ranges = ranges.unionByName(_counted_repeats(many.dropDuplicates(["key", "ctx"]), size))
    # All ranges of a context hold its pivot, so together they are one range.
    ranges = ranges.groupBy("key", "ctx").agg(F.max("left").alias("left"), F.max("right").alias("right"))
    ranges = ranges.join(counts.where("n > 1"), ["key", "ctx"], "left_anti")
    whole = counts.where("n > 1").select("key", "ctx", F.lit(None).cast("int").alias("left"),
                                         F.lit(None).cast("int").alias("right"))
    ranges = whole.unionByName(ranges).select(F.col("key").alias("r_key"), F.col("ctx").alias("r_ctx"), "left", "right")
    # A place shuffles as one number; both sides of a context are shorter than ``wide``.
    wide = 2 * size
    place = (F.col("pos") * wide + F.col("before")) * wide + F.col("after")
    before, after = F.expr(f"place div {wide} % {wide}"), F.col("place") % wide
    pos = F.expr(f"place div {wide * wide}")
    return (hits.select("key", "ctx", "doc_id", place.alias("place"))
            .join(ranges, (F.col("key") == F.col("r_key")) & (F.col("ctx") == F.col("r_ctx")))
            .select("doc_id", (pos - F.coalesce("left", before)).alias("start"),
                    (pos + F.coalesce("right", after)).alias("end")))


def _open_contexts(hits: DataFrame, found: DataFrame) -> tuple[DataFrame, DataFrame | None]:
    """key, ctx, context, before of the open keys that are not crowded, and of
    those that are (None if no key is).

    Filters of both kinds of keys deal the rows out before the shuffle, so a
    context shuffles one way only. A key that only seems open has equal
    contexts, or one, and finds nothing new; a key that only seems crowded is
    counted instead of gathered, with the same result. A task sends a context
    once."""
    open_, crowded = found.where("open"), found.where("crowded")
    n, n_crowded = open_.count(), crowded.count()
    rows = hits.where(F.col("context").isNotNull()).select("key", "ctx", "context", "before")
    if n > CAPACITY or n_crowded > CAPACITY:
        usual, many = (rows.join(open_.where(F.col("crowded") == x).select("g_key"), F.col("key") == F.col("g_key"),
                                 "left_semi") for x in (False, True))
        return usual, many if n_crowded else None
    f = key_filter(open_.select(F.col("g_key").alias("key")), n)
    if not n_crowded:
        return rows.mapInArrow(_sent(f, None, False), _CONTEXT), None
    c = key_filter(crowded.select(F.col("g_key").alias("key")), n_crowded)
    return rows.mapInArrow(_sent(f, c, False), _CONTEXT), rows.mapInArrow(_sent(f, c, True), _CONTEXT)


_CONTEXT = "key long, ctx long, context binary, before int"


def _sent(f: BitFilter, crowded: BitFilter | None, want: bool):
    """Task: rows whose key is in ``f``, and in ``crowded`` as wanted."""

    def run(batches):
        sent: set[int] = set()
        for batch in batches:
            key = batch.column(0).to_numpy(zero_copy_only=False)
            hit = f.contains(key)
            if crowded is not None:
                hit &= crowded.contains(key) == want
            keep = np.flatnonzero(hit)
            if not len(keep):
                continue
            ctx = batch.column(1).to_numpy(zero_copy_only=False)
            new = []
            for i, x in zip(keep.tolist(), (key[keep] ^ signed(mix(ctx[keep].view(np.uint64)))).tolist()):
                if x not in sent:
                    if len(sent) < 1 << 18:
                        sent.add(x)
                    new.append(i)
            if new:
                yield batch.take(pa.array(new, pa.int64()))

    return run


def _numbered(d: DataFrame) -> tuple[DataFrame, int, int]:
    """``d`` with numbers that no row has in place of the null doc_ids, and the
    range (first, end) of these numbers."""
    spark = d.sparkSession
    seen = d.agg(F.min("doc_id").alias("lo"), F.max("doc_id").alias("hi"),
                 F.count_if(F.col("doc_id").isNull()).alias("n")).first()
    if not seen.n:
        return d, 0, 0
    lo, hi = (0, 0) if seen.lo is None else (seen.lo, seen.hi)
    first = hi + 1 if hi + seen.n < 1 << 63 else lo - seen.n
    if first < -1 << 63:
        raise ValueError("no numbers are left for the rows without a doc_id")
    # Written once: the numbers must be the same in every pass.
    rows = materialize(d.where(F.col("doc_id").isNull()).select(F.monotonically_increasing_id().alias("m"), "text"),
                       "op7-nameless")
    task, within = F.shiftright("m", 33), F.col("m").bitwiseAND(F.lit((1 << 33) - 1))
    starts, at = [], first
    for r in sorted(rows.groupBy(task.alias("task")).agg(F.max(within).alias("last")).collect()):
        starts.append((r.task, at))                            # a row a task
        at += r.last + 1
    start = F.broadcast(spark.createDataFrame(starts, "task long, start long"))
    named = rows.join(start, task == F.col("task")).select((F.col("start") + within).alias("doc_id"), "text")
    return d.where(F.col("doc_id").isNotNull()).unionByName(named), first, at


def suffix_dedup(docs: DataFrame, size: int = MIN_BYTES) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept (bytes that stay; null where
    nothing was removed), kept_sha256."""
    d, first, end = _numbered(documents(docs))
    own = materialize(d.select("doc_id", F.octet_length("text").cast("long").alias("n_bytes"),
                               F.sha2("text", 256).alias("sha")), "op7-classes")
    classes = own.groupBy(F.col("sha").alias("c_sha")).agg(F.count(F.lit(1)).alias("rows"),
                                                           F.min("doc_id").alias("first_id"))
    copies = materialize(classes.where("rows > 1"), "op7-copies")
    known = materialize(own.join(copies, F.col("sha") == F.col("c_sha"), "left").drop("c_sha"), "op7-known")
    later = materialize(known.where(F.col("doc_id") > F.col("first_id")).select("doc_id").distinct(), "op7-later")
    # A span is one number too: no span is longer than a context.
    span = F.col("start") * (2 * size) + (F.col("end") - F.col("start"))
    spans = materialize(repeats(d, later, size).groupBy(F.col("doc_id").alias("s_doc")).agg(
        F.collect_list(span).alias("spans")), "op7-spans")
    gone = F.col("rows").isNotNull() & (F.col("n_bytes") >= size)
    base = materialize(known.join(spans.select("s_doc"), F.col("doc_id") == F.col("s_doc"), "left"), "op7-base")
    whole = base.where(F.col("s_doc").isNull() | gone).select(
        "doc_id", "n_bytes", F.when(gone, F.col("n_bytes")).otherwise(F.lit(0)).alias("n_removed"),
        F.when(gone, 1).otherwise(0).cast("long").alias("n_spans"),
        F.when(gone, F.lit(b"")).alias("kept"),
        F.when(gone, F.lit(hashlib.sha256(b"").hexdigest())).otherwise(F.col("sha")).alias("kept_sha256"))
    # Documents that equal texts already emptied are done.
    part = base.where(F.col("s_doc").isNotNull() & ~gone).select(F.col("doc_id").alias("t_doc")).distinct()
    touched = spans.join(part, F.col("s_doc") == F.col("t_doc"), "left_semi")
    ids = touched.select(F.col("s_doc").alias("doc_id"))
    _, maybe = split_by_keys(d, "doc_id", ids, ids.count())
    cut = maybe.join(touched, F.col("doc_id") == F.col("s_doc")).select("doc_id", "text", "spans")
    out = whole.unionByName(cut.mapInArrow(
        _cut(2 * size), "doc_id long, n_bytes long, n_removed long, n_spans long, kept binary, kept_sha256 string"))
    if first == end:
        return out
    private = (F.col("doc_id") >= first) & (F.col("doc_id") < end)
    return out.withColumn("doc_id", F.when(~private, F.col("doc_id")))


def _cut(wide: int):
    def run(batches):
        for batch in batches:
            spans = batch.column(2)
            flat = spans.flatten().to_numpy(zero_copy_only=False)
            start, end = flat // wide, flat // wide + flat % wide
            edge = np.concatenate(([0], np.cumsum(pc.list_value_length(spans).to_numpy(zero_copy_only=False))))
            for b in blocks(batch.column(1)):
                out = []
                for i in range(b.hi - b.lo):
                    own = b.data[b.offsets[i]:b.offsets[i + 1]]
                    x, y = edge[b.lo + i], edge[b.lo + i + 1]
                    off = covered_by(start[x:y], end[x:y], len(own))
                    kept = own[~off].tobytes()
                    out.append((len(own), int(off.sum()), len(runs(off)[0]), kept, hashlib.sha256(kept).hexdigest()))
                c = list(zip(*out))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(b.lo, b.hi - b.lo), pa.array(c[0], pa.int64()), pa.array(c[1], pa.int64()),
                     pa.array(c[2], pa.int64()), pa.array(c[3], pa.binary()), pa.array(c[4], pa.string())],
                    names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept", "kept_sha256"])

    return run
