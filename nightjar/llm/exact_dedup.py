"""Exact deduplication with two-pass Bloom filtering.

Texts are equal when they are identical after every character of
``[\\x20\\x09-\\x0D]`` is deleted. Pass one fills a counting filter (two bit
planes: seen once, seen again) with the digests of all rows; pass two tests
every row. A row with a position that nobody else set cannot have a copy and
passes straight through; only the others shuffle, by digest, to be compared.

Defined cases: a null text is empty; all empty texts equal each other; of
equal texts the one with most code points stays, ties go to the smallest
doc_id (null doc_id last), and of repeated rows with the same doc_id and text
one stays. An empty table gives an empty result. Other columns are carried
along untouched (columns named like results are replaced in ``exact_dedup``).
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType

from nightjar.llm.tables import BitFilter, filter_bits, materialize, pack, positions

SPACES = " \t\n\x0b\x0c\r"


def digests(docs: DataFrame) -> DataFrame:
    """doc_id, sha (normalised text), n_points, key (first 8 digest bytes)."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    d = docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                    F.sha2(F.translate(text, SPACES, ""), 256).alias("text_sha256"),
                    F.char_length(text).alias("n_points"))
    return d.withColumn("key", digest_key(F.col("text_sha256")))


def digest_key(sha):
    return F.xxhash64(sha)


def repeat_filter(keys: DataFrame, n: int) -> BitFilter:
    """Filter of the positions that at least two rows set. Every task keeps
    two bit planes; planes merge by ``again |= again' | (once & once')``."""
    bits = filter_bits(n)

    def fill(batches):
        once = np.zeros(bits // 8, dtype=np.uint8)
        again = np.zeros(bits // 8, dtype=np.uint8)
        for batch in batches:
            k = batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64)
            for p in positions(k, bits):
                uniq, cnt = np.unique(p, return_counts=True)
                at, bit = uniq >> np.uint64(3), np.uint8(1) << (uniq & np.uint64(7)).astype(np.uint8)
                seen = (cnt > 1) | ((once[at] & bit) != 0)
                np.bitwise_or.at(again, at[seen], bit[seen])
                np.bitwise_or.at(once, at, bit)
        o = pack(once)
        if o is None:
            return
        width = len(o.column(1)[0].as_py())
        planes = again.reshape(-1, width)
        twice = [planes[c].tobytes() for c in o.column(0).to_pylist()]
        yield pa.RecordBatch.from_arrays([o.column(0), o.column(1), pa.array(twice, pa.binary())],
                                         names=["chunk", "once", "again"])

    def merge(pdf):
        once = np.frombuffer(pdf["once"].iloc[0], dtype=np.uint8).copy()
        again = np.frombuffer(pdf["again"].iloc[0], dtype=np.uint8).copy()
        for o, a in zip(pdf["once"].iloc[1:], pdf["again"].iloc[1:]):
            o, a = np.frombuffer(o, dtype=np.uint8), np.frombuffer(a, dtype=np.uint8)
            again |= a | (once & o)
            once |= o
        return pdf.iloc[:1][["chunk"]].assign(bits=[again.tobytes()])

    parts = keys.select(F.col("key").cast("long").alias("key")).mapInArrow(
        fill, "chunk long, once binary, again binary")
    merged = parts.groupBy("chunk").applyInPandas(merge, "chunk long, bits binary")
    out = bytearray(bits // 8)
    for row in merged.collect():          # 16 MB at most, in one job whatever the partitions
        out[row.chunk * len(row.bits):(row.chunk + 1) * len(row.bits)] = row.bits
    return BitFilter(keys.sparkSession.sparkContext.broadcast(bytes(out)), bits)


def _suspects(df: DataFrame, f: BitFilter) -> DataFrame:
    @F.pandas_udf(BooleanType())
    def repeated(k):
        import pandas as pd

        return pd.Series(f.contains(k.to_numpy(dtype=np.int64)))

    return df.withColumn("_suspect", repeated(F.col("key")))


def exact_dedup(docs: DataFrame) -> DataFrame:
    """doc_id, keep_id, group_size, kept, text_sha256, n_points, one row per
    input row."""
    d = materialize(digests(docs), "op2-digests")
    flagged = _suspects(d, repeat_filter(d.select("key"), d.count()))
    alone = flagged.where(~F.col("_suspect")).select(
        "doc_id", F.col("doc_id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"),
        F.lit(True).alias("kept"), "text_sha256", "n_points")
    # The row number only tells repeated rows of one doc_id apart.
    again = flagged.where("_suspect").withColumn("rid", F.monotonically_increasing_id())
    best = F.max(F.struct("n_points", (-F.col("doc_id")).alias("neg_id"), (-F.col("rid")).alias("neg_rid")))
    keepers = (again.groupBy(F.col("text_sha256").alias("k_sha"))
               .agg(F.count(F.lit(1)).alias("group_size"), best.alias("best")))
    rows = (again.join(keepers, F.col("text_sha256") == F.col("k_sha"))
            .select("doc_id", (-F.col("best.neg_id")).alias("keep_id"), "group_size",
                    (F.col("rid") == -F.col("best.neg_rid")).alias("kept"), "text_sha256", "n_points"))
    return alone.unionByName(rows)


def drop_copies(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that stay, all columns. Rows without a possible
    copy are not shuffled; the input row travels as one struct, so no column
    name can clash."""
    keys = materialize(digests(docs).select("key"), "op2-keys")
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    work = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"),
                       F.sha2(F.translate(text, SPACES, ""), 256).alias("sha"),
                       F.char_length(text).alias("points"), F.col("doc_id").cast("long").alias("id"))
    flagged = _suspects(work.withColumn("key", digest_key(F.col("sha"))), repeat_filter(keys, keys.count()))
    alone = flagged.where(~F.col("_suspect"))
    again = flagged.where("_suspect")
    best = (again.groupBy(F.col("sha").alias("k_sha"))
            .agg(F.max(F.struct("points", (-F.col("id")).alias("neg_id"))).alias("best"))
            .select("k_sha", (-F.col("best.neg_id")).alias("k_id"), F.col("best.points").alias("k_points")))
    kept = again.join(best, (F.col("sha") == F.col("k_sha")) & F.col("id").eqNullSafe(F.col("k_id"))
                      & (F.col("points") == F.col("k_points")), "left_semi")
    return alone.select("row.*").unionByName(kept.dropDuplicates(["id", "sha"]).select("row.*"))
