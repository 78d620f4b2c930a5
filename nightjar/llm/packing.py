"""Bulk-synchronous best-fit packing of token sequences.

Documents become ids (a tokenizer file's, then a closing id) and pieces of at
most ``size`` tokens. Pieces go into as few sequences of ``size`` as best fit
gets to, longest first:

1. Range sort: pieces are range-partitioned and sorted by length, and every
   piece gets its rank among the pieces of its length. As lengths are at most
   ``size``, the sorted pieces are at most ``size`` runs (length, count), and
   gaps of open sequences are runs (gap, first sequence, count) likewise. The
   sweeps work on these runs; the rows themselves never leave the executors.
2. Supersteps: the lengths are taken in bands, longest first. In a superstep
   the runs of pieces and gaps are dealt over ranges of size, and a task
   sweeps its range: each run of pieces, longest first, takes the smallest
   gaps that hold it (its successors), as many pieces a gap as fit. Two runs
   that want the same gaps are served by rank: the longer run first, inside a
   run the lower ranks to the lower sequence numbers.
3. Gaps shrink and move to their new range; runs of pieces left over go up one
   range in the next superstep. When no gap holds them they open new
   sequences, and the next band begins.
4. The placements (runs of ranks to runs of sequences, bounded like the runs)
   are sent to all tasks, which look up every piece's sequence and offset.

Defined cases: a null text is empty and becomes the closing id alone;
repeated rows are packed like any other; an empty table gives an empty result.
"""

from __future__ import annotations

import zlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from nightjar.llm.bpe import model
from nightjar.llm.tables import documents, materialize, partitions
from nightjar.llm.textbytes import blocks

SIZE = 2048
CLOSING = 0
RANGES = 4
_BLOCK = 1 << 20


def pieces(docs: DataFrame, path: str, size: int = SIZE, closing: int = CLOSING, with_ids: bool = False) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32 (and ids) of every piece."""

    def run(batches):
        bpe = model(path)
        for batch in batches:
            ids_col = batch.column(0)
            for b in blocks(batch.column(1), _BLOCK):
                raw, edge = b.data.tobytes(), b.offsets.tolist()
                r = bpe.encode([raw[s:e].decode("utf-8") for s, e in zip(edge, edge[1:])])
                rows = len(edge) - 1
                ids = np.insert(r.flat.astype("<u4"), r.bounds[1:], closing)
                bound = r.bounds + np.arange(rows + 1)
                total = np.diff(bound)
                n = -(-total // size)
                row = np.repeat(np.arange(rows), n)
                piece = np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n)
                start = piece * size
                length = np.minimum(total[row] - start, size)
                buf = ids.tobytes()
                lo = ((bound[row] + start) * 4).tolist()
                parts = [buf[x:x + y] for x, y in zip(lo, (length * 4).tolist())]
                cols = [ids_col.take(pa.array(b.lo + row)), pa.array(piece, pa.int32()), pa.array(start, pa.int64()),
                        pa.array(length, pa.int64()), pa.array([zlib.crc32(p) for p in parts], pa.int64())]
                names = ["doc_id", "piece", "start", "length", "ids_crc32"]
                if with_ids:
                    cols.append(pa.array(parts, pa.binary()))
                    names.append("ids")
                yield pa.RecordBatch.from_arrays(cols, names=names)

    schema = "doc_id long, piece int, start long, length long, ids_crc32 long" + (", ids binary" if with_ids else "")
    return documents(docs).mapInArrow(run, schema)


def ranked(items: DataFrame) -> DataFrame:
    """The rows range-sorted by length, with ``rank`` from 0 inside each length."""
    spark = items.sparkSession
    s = (items.repartitionByRange(partitions(spark), "length", "doc_id", "piece")
         .sortWithinPartitions("length", "doc_id", "piece")
         .withColumn("at", F.monotonically_increasing_id()))
    s = materialize(s, "op10-sorted")
    part = F.shiftright("at", 33)
    spans = (s.groupBy(part.alias("p"), F.col("length").alias("p_length"))
             .agg(F.min("at").alias("p_first"), F.count(F.lit(1)).alias("n")))
    before = W.partitionBy("p_length").orderBy("p").rowsBetween(W.unboundedPreceding, -1)
    spans = spans.withColumn("base", F.coalesce(F.sum("n").over(before), F.lit(0))).drop("n")
    return (s.join(spans, (part == F.col("p")) & (F.col("length") == F.col("p_length")))
            .withColumn("rank", F.col("at") - F.col("p_first") + F.col("base"))
            .drop("p", "p_length", "p_first", "base", "at"))


_RUNS = "kind string, size long, low long, n long"
_OUT = "kind string, size long, low long, n long, bin long, each long, place long"


def sweep(items: list[tuple[int, int, int]], gaps: list[tuple[int, int, int]], size: int):
    """One range: (placements, items left, gaps after). Items are (length,
    first rank, count), gaps (gap, first sequence, count)."""
    import bisect

    gaps = sorted(gaps)
    placed, left = [], []
    for length, low, n in sorted(items, reverse=True):
        i = bisect.bisect_left(gaps, (length, -1, -1))
        while n and i < len(gaps):
            gap, first, count = gaps.pop(i)
            each = gap // length
            full = min(count, n // each)
            if full:
                placed.append((length, low, full * each, first, each, size - gap))
                low, n = low + full * each, n - full * each
                if gap - each * length:
                    bisect.insort(gaps, (gap - each * length, first, full))
            if full < count:
                first, count = first + full, count - full
                if n:                               # one sequence gets the rest of the run
                    placed.append((length, low, n, first, n, size - gap))
                    if gap - n * length:
                        bisect.insort(gaps, (gap - n * length, first, 1))
                    low, n, first, count = low + n, 0, first + 1, count - 1
                if count:
                    bisect.insort(gaps, (gap, first, count))
            i = bisect.bisect_left(gaps, (length, -1, -1))
        if n:
            left.append((length, low, n))
    return placed, left, gaps


def _range_task(size: int):
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        rows = {k: [tuple(map(int, r)) for r in g[["size", "low", "n"]].itertuples(index=False)]
                for k, g in pdf.groupby("kind")}
        placed, left, gaps = sweep(rows.get("item", []), rows.get("gap", []), size)
        out = [("placed", a, b, c, d, e, f) for a, b, c, d, e, f in placed]
        out += [("item", a, b, c, int(pdf["range"].iloc[0]), 0, 0) for a, b, c in left]
        out += [("gap", a, b, c, 0, 0, 0) for a, b, c in gaps]
        return pd.DataFrame(out, columns=["kind", "size", "low", "n", "bin", "each", "place"])

    return run


def _bands(size: int) -> list[int]:
    """Lower ends of the length bands: size/2, size/3 ... size/8, then halves."""
    ends = [size // k for k in range(2, 9)]
    while ends[-1] > 8:
        ends.append(ends[-1] // 2)
    return ends + [0]


def plan(spark: SparkSession, counts: dict[int, int], size: int = SIZE, ranges: int = RANGES) -> list[tuple]:
    """Placements (length, first rank, count, first sequence, pieces a
    sequence, offset) of runs of pieces; ``counts`` has the pieces of each length."""
    placed: list[tuple] = []
    gaps: list[tuple[int, int, int]] = []
    opened = 0
    high = size
    for low in _bands(size):
        todo = [(n, 0, counts[n]) for n in range(high, low, -1) if counts.get(n)]
        high = low
        climb = {length: 0 for length, _, _ in todo}
        while todo:
            usable = sorted(g for g in gaps if g[0] >= todo[-1][0])
            todo = sorted(todo, reverse=True)
            if not usable or usable[-1][0] < todo[-1][0]:
                break
            # Range borders at quantiles of the gaps; a run of pieces starts in
            # the range of its length and climbs one range a superstep.
            cuts = sorted({usable[i * len(usable) // ranges][0] for i in range(1, ranges)})
            place = lambda s: int(np.searchsorted(cuts, s, side="right"))
            top = len(cuts)
            if all(place(length) + climb[length] > top for length, _, _ in todo):
                break
            rows = [(min(top, place(length) + climb[length]), "item", length, a, n) for length, a, n in todo]
            rows += [(place(g), "gap", g, a, n) for g, a, n in usable]
            got = (spark.createDataFrame(rows, "range int, " + _RUNS).groupBy("range")
                   .applyInPandas(_range_task(size), _OUT).collect())
            gaps = [g for g in gaps if g[0] < min(u[0] for u in usable)]
            gaps += [(r.size, r.low, r.n) for r in got if r.kind == "gap"]
            placed += [(r.size, r.low, r.n, r.bin, r.each, r.place) for r in got if r.kind == "placed"]
            todo = [(r.size, r.low, r.n) for r in got if r.kind == "item"]
            for length, _, _ in todo:
                climb[length] += 1
        # No gap holds these: open sequences, longest first, and fill them.
        for length, first, n in sorted(todo, reverse=True):
            new, rest, rest_gaps = sweep([(length, first, n)], [g for g in gaps if g[0] >= length], size)
            kept = [g for g in gaps if g[0] < length]
            placed += new
            gaps = kept + rest_gaps
            if rest:
                _, first, n = rest[0]
                each = size // length
                bins = -(-n // each)
                new, rest, rest_gaps = sweep(rest, [(size, opened, bins)], size)
                opened += bins
                placed += new
                gaps += rest_gaps
    return placed


def pack(docs: DataFrame, path: str, size: int = SIZE, closing: int = CLOSING, with_ids: bool = False) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id, offset (and ids)."""
    spark = docs.sparkSession
    # Written first: the range sort reads its input twice, once for the borders.
    cut = materialize(pieces(docs, path, size, closing, with_ids), "op10-cut")
    items = materialize(ranked(cut), "op10-pieces")
    counts = {r.length: r["count"] for r in items.groupBy("length").count().collect()}   # at most ``size`` rows
    runs = sorted(plan(spark, counts, size))
    table = np.array(runs, dtype=np.int64).reshape(-1, 6)
    shared = spark.sparkContext.broadcast(table)

    def place(batches):
        t = shared.value
        key = (t[:, 0] << 44) | t[:, 1]
        for batch in batches:
            length = batch.column("length").to_numpy(zero_copy_only=False)
            rank = batch.column("rank").to_numpy(zero_copy_only=False)
            if not len(length):
                continue
            row = t[np.searchsorted(key, (length << 44) | rank, side="right") - 1]
            nth = rank - row[:, 1]
            seq = row[:, 3] + nth // row[:, 4]
            at = row[:, 5] + nth % row[:, 4] * length
            keep = [i for i, n in enumerate(batch.schema.names) if n != "rank"]
            yield pa.RecordBatch.from_arrays([batch.column(i) for i in keep] + [pa.array(seq), pa.array(at)],
                                             names=[batch.schema.names[i] for i in keep] + ["sequence_id", "offset"])

    cols = ["doc_id", "piece", "start", "length", "ids_crc32"] + ["ids"] * with_ids
    schema = "doc_id long, piece int, start long, length long, ids_crc32 long" + ", ids binary" * with_ids
    return items.select(*cols, "rank").mapInArrow(place, schema + ", sequence_id long, offset long")
