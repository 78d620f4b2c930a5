"""Mixture-controlled packing by deficit round-robin over source queues.

Documents become ids (a tokenizer file's, then a closing id). Each source's
documents form a queue, and every window of ``size`` tokens is filled from the
queues in turn, by target proportions:

1. Queues: a task writes its documents' ids with the number of tokens of the
   same source before them in the task; a running sum over the tasks' sums
   gives every document its place in its source's queue. No source's documents
   come together anywhere. Sources of under ``least`` tokens a window share a
   last queue, in which each is spread evenly, so there are at most
   ``size / least`` queues whatever the number of sources.
2. Quanta: a queue is credited its share of a window, in 1/65,536 token, and
   sends whole tokens of its credit. What is left, its deficit, goes on to the
   next queue of the turn and, by the turn's running sums, to the next window;
   so a window is always full and no queue is ever two tokens off its share.
   Windows with equal quanta form a phase. As credits are linear in the number
   of windows, the deficits before any window follow from its number, and each
   task carries them in for the windows that its documents fall in.
3. A phase ends when a queue cannot send its quantum. One window takes what is
   left of it and a second turn over the others; then the next phase begins
   with the deficits so far. There are about two phases a queue, which is
   the whole plan that reaches the tasks.
4. Documents are cut where their window's share ends. Tokens that fill no whole
   window form sequences of powers of two, so nothing is padded.

Targets are the sources' own proportions by default; ``targets`` names shares
for some sources, the others together get the rest of 1, and those without a
share come when all with one are empty.

Defined cases: a null text is empty and becomes the closing id alone; a null
or missing source counts as the empty string; repeated rows and null ids are
packed like any other row; an empty table gives an empty result; other columns
are not read.
"""

from __future__ import annotations

import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from nightjar.llm.bpe import model
from nightjar.llm.tables import materialize, partitions, small_batches
from nightjar.llm.textbytes import blocks

SIZE = 2048
CLOSING = 1
LEAST = 8                            # tokens a window that give a source a queue of its own
UNIT = 1 << 16                       # parts of a token in which credit is counted
GROUP_TOKENS = 4 << 20               # tokens of the shared queue that are ordered together
REST = "\x00rest"                    # name of the shared queue
_BLOCK = 1 << 20


@dataclass
class Phase:
    """``windows`` windows from ``first`` on, of ``size`` tokens each. By
    queue: credit of the turn so far before the first window and a window
    (both up to and with the queue), tokens sent before."""

    first: int
    windows: int
    credit: list[int]
    quantum: list[int]
    sent: list[int]

    def served(self, j: int, k: int) -> int:
        upto = (self.credit[j] + k * self.quantum[j]) // UNIT
        return upto - ((self.credit[j - 1] + k * self.quantum[j - 1]) // UNIT if j else 0)


def _running(values) -> list[int]:
    return np.cumsum(np.array(values, dtype=np.int64)).tolist()


def _shared_out(total: int, weights: list[int | float], least: int = 0) -> list[int]:
    """``total`` in proportion to the weights, in whole numbers; what would be
    under ``least`` is ``least``. The largest fractions are rounded up."""
    out = [0] * len(weights)
    some = [i for i, w in enumerate(weights) if w]
    while low := [i for i in some if weights[i] * total < least * sum(weights[k] for k in some)]:
        for i in low:
            out[i] = least
        some = [i for i in some if i not in low]
        total -= least * len(low)
    weight = sum(weights[i] for i in some)
    rest = []
    for i in some:
        w = weights[i]
        out[i] = total * w // weight if isinstance(w, int) else int(total * (w / weight))
        rest.append((out[i] - total * w / weight, i))
    short = total - sum(out[i] for i in some)
    for _, i in sorted(rest)[:short]:
        out[i] += 1
    return out


def plan(tokens: list[int], weights: list[int | float], size: int = SIZE) -> list[Phase]:
    """The phases that send ``tokens`` of each queue in proportion to
    ``weights``."""
    left, sent = list(tokens), [0] * len(tokens)
    carry = [0] * len(tokens)        # turn's credit of the last phase, its whole tokens sent
    phases, first = [], 0
    while (total := sum(left)):
        active = [w if n else 0 for w, n in zip(weights, left)]
        if not any(active):
            active = list(left)
        cap = size if total >= size else 1 << total.bit_length() - 1
        credit = [c if a and cap == size else 0 for a, c in zip(active, carry)]
        for j in range(len(credit)):  # an idle queue adds nothing to the turn
            if not active[j]:
                credit[j] = credit[j - 1] if j else 0
        last = max(j for j, a in enumerate(active) if a)
        credit[last:] = [0] * (len(credit) - last)
        phase = Phase(first, 0, credit, _running(_shared_out(cap * UNIT, active, UNIT if cap == size else 0)), list(sent))
        if cap == size:
            lo, hi = 0, total // size
            for j in (j for j, a in enumerate(active) if a):
                lo = 0
                while lo < hi:
                    mid = (lo + hi + 1) // 2
                    lo, hi = (mid, hi) if phase.served(j, mid) <= left[j] else (lo, mid - 1)
            phase.windows = hi
        if not phase.windows:
            phase.windows = 1
            give = [min(n, phase.served(j, 1)) for j, n in enumerate(left)]
            while (short := cap - sum(give)):
                want = [a if n > g else 0 for a, n, g in zip(active, left, give)]
                if not any(want):
                    want = [n - g for n, g in zip(left, give)]
                give = [g + min(n - g, x) for g, n, x in zip(give, left, _shared_out(short, want))]
            phase.credit = [0] * len(left)
            phase.quantum = [UNIT * x for x in _running(give)]
        phases.append(phase)
        done = [phase.served(j, phase.windows) for j in range(len(left))]
        if phase.credit == credit:
            carry = [(c + phase.windows * q) % UNIT for c, q in zip(phase.credit, phase.quantum)]
        left = [n - x for n, x in zip(left, done)]
        sent = [n + x for n, x in zip(sent, done)]
        first += phase.windows
    return phases


class Schedule:
    """The phases as arrays; places of documents in windows."""

    def __init__(self, phases: list[Phase]):
        self.first = np.array([p.first for p in phases], dtype=np.int64)
        n = len(phases[0].sent) if phases else 0
        shape = lambda rows: np.array(rows, dtype=np.int64).reshape(len(phases), n)
        self.sent = shape([p.sent for p in phases])
        zero = np.zeros((len(phases), 1), dtype=np.int64)
        self.credit = np.hstack((zero, shape([p.credit for p in phases])))
        self.quantum = np.hstack((zero, shape([p.quantum for p in phases])))

    def _turn(self, phase, j, k):
        return (self.credit[phase, j] + k * self.quantum[phase, j]) // UNIT

    def _served(self, phase, j, k):
        return self._turn(phase, j + 1, k) - self._turn(phase, j, k)

    def window(self, j: np.ndarray, at: np.ndarray) -> np.ndarray:
        """The window that sends token ``at`` of queue ``j``."""
        phase = np.zeros(len(at), dtype=np.int64)
        for q in np.unique(j).tolist():
            own = j == q
            phase[own] = np.searchsorted(self.sent[:, q], at[own], side="right") - 1
        inside = at - self.sent[phase, j]
        quantum = np.maximum(1, self.quantum[phase, j + 1] - self.quantum[phase, j])
        k = np.maximum(0, inside * UNIT // quantum - 3)
        while (late := self._served(phase, j, k + 1) <= inside).any():
            k[late] += 1
        return self.first[phase] + k

    def pieces(self, j: np.ndarray, at: np.ndarray, n: np.ndarray):
        """(document, place in it, length, window, offset) of the pieces of
        documents of ``n`` tokens from place ``at`` of queue ``j``."""
        lo, hi = self.window(j, at), self.window(j, at + n - 1)
        count = hi - lo + 1
        doc = np.repeat(np.arange(len(at)), count)
        window = np.repeat(lo - (np.cumsum(count) - count), count) + np.arange(count.sum())
        phase = np.searchsorted(self.first, window, side="right") - 1
        k, q = window - self.first[phase], j[doc]
        start = self.sent[phase, q] + self._served(phase, q, k)
        end = self.sent[phase, q] + self._served(phase, q, k + 1)
        a, b = np.maximum(start, at[doc]), np.minimum(end, (at + n)[doc])
        offset = self._turn(phase, q, k + 1) - self._turn(phase, q, k) + a - start
        some = a < b
        return doc[some], (a - at[doc])[some], (b - a)[some], window[some], offset[some]


def tokenised(docs: DataFrame, path: str, closing: int = CLOSING, source: str = "source") -> DataFrame:
    """doc_id, source, part (the task), at (tokens of the source before it in
    the task), n and ids of every document."""

    def run(batches):
        bpe, part, before = model(path), TaskContext.get().partitionId(), {}
        for batch in batches:
            for b in blocks(batch.column(2), _BLOCK):
                raw, edge = b.data.tobytes(), b.offsets.tolist()
                r = bpe.encode([raw[s:e].decode("utf-8") for s, e in zip(edge, edge[1:])])
                ids = np.insert(r.flat.astype("<u4"), r.bounds[1:], closing)
                bound = r.bounds + np.arange(len(edge))
                size = np.diff(bound).tolist()
                names = batch.column(1).slice(b.lo, b.hi - b.lo)
                at = []
                for name, n in zip(names.to_pylist(), size):
                    at.append(before.get(name, 0))
                    before[name] = at[-1] + n
                buf, cut = ids.tobytes(), (bound * 4).tolist()
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(b.lo, b.hi - b.lo), names, pa.array([part] * len(size), pa.int32()),
                     pa.array(at, pa.int64()), pa.array(size, pa.int64()),
                     pa.array([buf[s:e] for s, e in zip(cut, cut[1:])], pa.binary())],
                    names=["doc_id", "source", "part", "at", "n", "ids"])

    small_batches(docs.sparkSession)
    name = F.col(source).cast("string") if source in docs.columns else F.lit(None)
    return (docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(name, F.lit("")).alias("source"),
                        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
            .mapInArrow(run, "doc_id long, source string, part int, at long, n long, ids binary"))


def _shared_queue(rest: DataFrame, sums: DataFrame, tokens: int) -> DataFrame:
    """Places of the documents of small sources in their shared queue: each
    source is spread over the queue evenly, from a place given by its hash."""
    place = sums.select(F.col("source").alias("s_source"), F.col("part").alias("s_part"), "base", "total")
    turn = F.pmod(F.xxhash64("source") / F.lit(2.0**64) + (F.col("base") + F.col("at")) / F.col("total"), F.lit(1.0))
    groups = max(partitions(rest.sparkSession), -(-tokens // GROUP_TOKENS))
    spread = (rest.join(place, (F.col("source") == F.col("s_source")) & (F.col("part") == F.col("s_part")))
              .withColumn("turn", turn)
              .withColumn("slice", F.least(F.floor(F.col("turn") * groups), F.lit(groups - 1)))
              .select("doc_id", "source", "part", "at", "n", "ids", "turn", "slice"))
    spread = materialize(spread, "op13-rest")
    # Running sums in two levels, so that no task sees all slices.
    level = max(1, int(groups ** 0.5))
    slices = spread.groupBy("slice").agg(F.sum("n").alias("total"))
    upper = F.floor(F.col("slice") / level)
    tops = slices.groupBy(upper.alias("u")).agg(F.sum("total").alias("u_total"))
    tops = tops.select("u", F.coalesce(F.sum("u_total").over(
        W.orderBy("u").rowsBetween(W.unboundedPreceding, -1)), F.lit(0)).alias("u_base"))
    inner = W.partitionBy(upper).orderBy("slice").rowsBetween(W.unboundedPreceding, -1)
    slices = (slices.withColumn("inner", F.coalesce(F.sum("total").over(inner), F.lit(0))).withColumn("u", upper)
              .join(tops, "u").select(F.col("slice").alias("b_slice"), (F.col("inner") + F.col("u_base")).alias("b_base")))
    own = (W.partitionBy("slice").orderBy("turn", "source", "part", "at")
           .rowsBetween(W.unboundedPreceding, -1))
    return (spread.withColumn("inside", F.coalesce(F.sum("n").over(own), F.lit(0)))
            .join(slices, F.col("slice") == F.col("b_slice"))
            .select("doc_id", "source", "n", "ids", (F.col("inside") + F.col("b_base")).alias("place")))


def mixture_pack(docs: DataFrame, path: str, size: int = SIZE, closing: int = CLOSING, source: str = "source",
                 targets: dict[str, float] | None = None, least: int = LEAST, with_ids: bool = False) -> DataFrame:
    """doc_id, source, start, length, ids_crc32, doc_tokens, sequence_id,
    offset (and ids) of every piece."""
    spark = docs.sparkSession
    ids = materialize(tokenised(docs, path, closing, source), "op13-ids")
    order = W.partitionBy("source").orderBy("part").rowsBetween(W.unboundedPreceding, -1)
    sums = (ids.groupBy("source", "part").agg(F.sum("n").alias("tokens"))
            .withColumn("base", F.coalesce(F.sum("tokens").over(order), F.lit(0)))
            .withColumn("total", F.sum("tokens").over(W.partitionBy("source"))))
    sums = materialize(sums, "op13-sums")
    total = sums.agg(F.sum("tokens")).first()[0] or 0
    named = F.col("source").isin(list(targets)) if targets else F.col("total") * size >= least * total
    own = {r.source: r.total for r in
           sums.where(named).select("source", "total").distinct().collect()}  # size / least rows, or targets
    queues = [*sorted(own.items()), (REST, total - sum(own.values()))]
    if targets:
        weights = [targets.get(name, max(0.0, 1.0 - sum(targets.values()))) for name, _ in queues]
    else:
        weights = [n for _, n in queues]
    schedule = spark.sparkContext.broadcast(Schedule(plan([n for _, n in queues], weights, size)))
    number = {name: i for i, (name, _) in enumerate(queues)}

    def cut(batches):
        s = schedule.value
        for batch in batches:
            j = np.array([number.get(x, len(number) - 1) for x in batch.column(1).to_pylist()], dtype=np.int64)
            at, n = (batch.column(c).to_numpy(zero_copy_only=False) for c in (2, 3))
            if not len(j):
                continue
            doc, start, length, window, offset = s.pieces(j, at, n)
            own_ids = [memoryview(x.as_buffer()) for x in batch.column(4)]
            parts = [own_ids[d][4 * a:4 * (a + b)] for d, a, b in zip(doc.tolist(), start.tolist(), length.tolist())]
            cols = [batch.column(0).take(pa.array(doc)), batch.column(1).take(pa.array(doc)), pa.array(start), pa.array(length),
                    pa.array([zlib.crc32(x) for x in parts], pa.int64()), pa.array(n[doc]), pa.array(window),
                    pa.array(offset)]
            names = ["doc_id", "source", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
            if with_ids:
                cols.append(pa.array([bytes(x) for x in parts], pa.binary()))
                names.append("ids")
            yield pa.RecordBatch.from_arrays(cols, names=names)

    base = sums.where(F.col("source").isin(list(own))).select(F.col("source").alias("s_source"), F.col("part").alias("s_part"), "base")
    base = materialize(base, "op13-queues")      # its size is known, so a small one is broadcast by Spark's own limit
    placed = (ids.join(base, (F.col("source") == F.col("s_source")) & (F.col("part") == F.col("s_part")))
              .select("doc_id", "source", (F.col("base") + F.col("at")).alias("place"), "n", "ids"))
    if queues[-1][1]:
        rest = _shared_queue(ids.where(~F.col("source").isin(list(own))), sums, queues[-1][1])
        placed = placed.unionByName(rest.select(*placed.columns))
    schema = ("doc_id long, source string, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, "
              "offset long" + ", ids binary" * with_ids)
    return placed.mapInArrow(cut, schema)
