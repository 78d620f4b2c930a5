"""Scratch tables, key filters and routing shared by the operators."""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType

from nightjar.operators.lineage import materialize

#: Bits of a broadcast key filter at most (16 MB); beyond CAPACITY keys the
#: callers join instead of broadcasting.
FILTER_BITS = 1 << 27
CAPACITY = FILTER_BITS // 4
#: Rows of an Arrow batch at most, unless the session asks for fewer: texts can
#: be long, and a Python worker holds a batch or two.
BATCH_ROWS = 512
_CHUNK = 1 << 16                      # bytes of a filter that travel as one row

__all__ = ["BitFilter", "documents", "key_filter", "map_without", "materialize", "partitions", "split_by_keys",
           "table"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    small_batches(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def small_batches(spark: SparkSession) -> None:
    """Limit the rows of an Arrow batch for this session."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(key)) <= BATCH_ROWS:
        spark.conf.set(key, str(BATCH_ROWS))


def documents(df: DataFrame) -> DataFrame:
    """doc_id and text of any frame that has them; a null text is empty."""
    small_batches(df.sparkSession)
    return df.select(F.col("doc_id").cast("long").alias("doc_id"),
                     F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


class BitFilter:
    """A Bloom filter with two probes, sent to executors as one broadcast."""

    def __init__(self, broadcast, bits: int):
        self.broadcast, self.bits = broadcast, bits
        self._words = None

    def __getstate__(self):
        return {"broadcast": self.broadcast, "bits": self.bits, "_words": None}

    def contains(self, keys: np.ndarray) -> np.ndarray:
        if self._words is None:
            self._words = np.frombuffer(self.broadcast.value, dtype=np.uint8)
        out = np.ones(len(keys), dtype=bool)
        for p in positions(keys.view(np.uint64), self.bits):
            out &= (self._words[p >> np.uint64(3)] >> (p & np.uint64(7)).astype(np.uint8)) & np.uint8(1) == 1
        return out


def positions(keys: np.ndarray, bits: int) -> list[np.ndarray]:
    a = keys * np.uint64(0x9FB21C651E98DF25)
    a ^= a >> np.uint64(29)
    b = keys * np.uint64(0xD6E8FEB86659FD93)
    b ^= b >> np.uint64(32)
    shift = np.uint64(64 - int(math.log2(bits)))
    return [(a * np.uint64(0x2545F4914F6CDD1D)) >> shift, (b * np.uint64(0x94D049BB133111EB)) >> shift]


def filter_bits(n: int) -> int:
    return min(FILTER_BITS, 1 << max(13, math.ceil(math.log2(max(1, n) * 16))))


def pack(bitmap: np.ndarray) -> pa.RecordBatch | None:
    """The chunks of a bitmap (uint8) that are not empty."""
    parts = bitmap.reshape(-1, min(_CHUNK, len(bitmap)))
    full = np.flatnonzero(parts.any(axis=1))
    if not len(full):
        return None
    return pa.RecordBatch.from_pydict({"chunk": pa.array(full, pa.int64()),
                                       "bits": pa.array([parts[i].tobytes() for i in full], pa.binary())})


def key_filter(keys: DataFrame, n: int) -> BitFilter:
    """Bloom filter of the long column ``key``; ``n`` is its row count. Tasks
    fill partial bitmaps, chunks of them are merged by a shuffle, and at most
    FILTER_BITS / 8 bytes reach the driver."""
    spark = keys.sparkSession
    bits = filter_bits(n)

    def fill(batches):
        bitmap = np.zeros(bits // 8, dtype=np.uint8)
        for batch in batches:
            k = batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64)
            for p in positions(k, bits):
                np.bitwise_or.at(bitmap, p >> np.uint64(3), np.uint8(1) << (p & np.uint64(7)).astype(np.uint8))
        out = pack(bitmap)
        if out is not None:
            yield out

    def merge(pdf):
        acc = np.frombuffer(pdf["bits"].iloc[0], dtype=np.uint8).copy()
        for x in pdf["bits"].iloc[1:]:
            acc |= np.frombuffer(x, dtype=np.uint8)
        return pdf.iloc[:1].assign(bits=[acc.tobytes()])

    parts = keys.select(F.col("key").cast("long").alias("key")).mapInArrow(fill, "chunk long, bits binary")
    merged = parts.groupBy("chunk").applyInPandas(merge, "chunk long, bits binary")
    out = bytearray(bits // 8)
    width = min(_CHUNK, bits // 8)
    for row in merged.collect():          # 16 MB at most, in one job whatever the partitions
        out[row.chunk * width:(row.chunk + 1) * width] = row.bits
    return BitFilter(spark.sparkContext.broadcast(bytes(out)), bits)


def split_by_keys(df: DataFrame, col: str, keys: DataFrame, n: int) -> tuple[DataFrame | None, DataFrame]:
    """(rows whose ``col`` is certainly not among ``keys``, rows to join).

    A Bloom filter of the keys lets most rows pass without a shuffle; over
    CAPACITY keys, or more, all rows are left to the join."""
    if n > CAPACITY:
        return None, df
    f = key_filter(keys.select(F.col(col).alias("key")), n)

    @F.pandas_udf(BooleanType())
    def maybe(k):
        import pandas as pd

        return pd.Series(f.contains(k.to_numpy(dtype=np.int64)))

    flagged = df.withColumn("__maybe_key", maybe(F.coalesce(F.col(col).cast("long"), F.lit(-1))))
    return flagged.where(~F.col("__maybe_key")).drop("__maybe_key"), flagged.where("__maybe_key").drop("__maybe_key")


def map_without(docs: DataFrame, gone: DataFrame, n: int, fn, schema: str) -> DataFrame:
    """``docs`` (doc_id, text) without the ``n`` doc_ids of ``gone``, through
    the ``mapInArrow`` function ``fn``. Most rows are tested and mapped in one
    Python worker; those that may be among ``gone`` shuffle to an anti-join
    first, so no task needs a second worker beside the one of ``fn``."""
    if n > CAPACITY:
        return docs.join(gone, "doc_id", "left_anti").select("doc_id", "text").mapInArrow(fn, schema)
    f = key_filter(gone.select(F.col("doc_id").alias("key")), n)

    def unseen(batches):
        for batch in batches:
            hit = f.contains(batch.column(0).to_numpy(zero_copy_only=False))
            if not hit.all():
                yield batch.filter(pa.array(~hit)) if hit.any() else batch

    @F.pandas_udf(BooleanType())
    def maybe(k):
        import pandas as pd

        return pd.Series(f.contains(k.to_numpy(dtype=np.int64)))

    rest = docs.where(maybe("doc_id")).join(gone, "doc_id", "left_anti").select("doc_id", "text")
    # The exchange keeps the test and ``fn`` in different stages.
    rest = rest.hint("rebalance")
    return (docs.select("doc_id", "text").mapInArrow(lambda batches: fn(unseen(batches)), schema)
            .unionByName(rest.mapInArrow(fn, schema)))
