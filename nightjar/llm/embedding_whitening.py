"""Whitening of embeddings over their distinct vectors.

Entries become whole numbers x = floor(64 c) + 1,000,000, so that vectors are
equal or not without rounding.

1. Rows are grouped by x; counts are combined before the shuffle, so a vector
   that a third of all rows hold shuffles once a task. The distinct vectors
   are the fit list, weighted by one (``weights="one"``) or by their counts
   (``weights="count"``).
2. The weights' sum n and the dimensions' sums S are exact. A second pass
   centres every vector, (n x - S) / n with an exact numerator, and multiplies:
   each task adds the matrix products of its batches, the tasks' matrices are
   added by row on the executors, and the covariance (dimension squared) goes
   to the driver.
3. Its eigenvectors whiten every distinct vector once. The whitened vectors'
   covariance is computed the same way and compared with the identity.
4. Rows get their vector's result by a join. Vectors that hold more than a
   thousandth of all rows are at most a thousand; they are broadcast, and all
   others have at most a thousandth of the rows of the shuffled join.

Defined cases: rows whose vector is null, empty or has a null or non-finite
entry are dropped, and so are those of another length than most rows have
(ties: the longer); entries beyond 2**56 saturate there; components with an
eigenvalue that is zero to rounding do not exist, so equal vectors alone have
none; null ids and repeated rows are kept; an empty table gives an empty
result; other columns are not read.
"""

from __future__ import annotations

from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from nightjar.llm.tables import materialize, small_batches

SCALE, SHIFT = 64, 1_000_000
COMPONENTS = 16
HOT = 1000                           # a vector with over 1 / HOT of the rows is broadcast
_MOST = float(1 << 56)
_EXACT = 1 << 62


def whole_vectors(df: DataFrame, id_col: str = "vec_id", col: str = "embedding") -> DataFrame:
    """id, dim and x (bytes: the width of a number, then the numbers) of every
    row whose vector is complete and finite."""

    def run(batches):
        for batch in batches:
            vectors = batch.column(1)
            size = pc.fill_null(pc.list_value_length(vectors), 0).to_numpy(zero_copy_only=False).astype(np.int64)
            bound = np.concatenate(([0], np.cumsum(size)))
            flat = vectors.flatten()
            c = pc.fill_null(flat, float("nan")).to_numpy(zero_copy_only=False)
            bad = np.bincount(np.repeat(np.arange(len(size)), size)[~np.isfinite(c)], minlength=len(size)) > 0
            keep = np.flatnonzero(~bad & (size > 0))
            with np.errstate(over="ignore", invalid="ignore"):
                x = np.floor(np.clip(np.where(np.isfinite(c), c, 0) * SCALE, -_MOST, _MOST)).astype(np.int64) + SHIFT
            wide = np.bincount(np.repeat(np.arange(len(size)), size)[x != x.astype(np.int32)], minlength=len(size)) > 0
            four, eight = x.astype("<i4").tobytes(), x.astype("<i8").tobytes()
            out = [b"\x08" + eight[8 * s:8 * e] if w else b"\x04" + four[4 * s:4 * e] for s, e, w in
                   zip(bound[keep].tolist(), bound[keep + 1].tolist(), wide[keep].tolist())]
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(keep)), pa.array(size[keep], pa.int32()),
                                              pa.array(out, pa.binary())], names=["vec_id", "dim", "x"])

    small_batches(df.sparkSession)
    return (df.select(F.col(id_col).cast("long").alias("vec_id"), F.col(col).cast("array<double>").alias("v"))
            .mapInArrow(run, "vec_id long, dim int, x binary"))


def _numbers(x: pa.Array) -> np.ndarray:
    """The vectors of a column of equal dimension, as rows."""
    raw = x.to_pylist()
    rows = [np.frombuffer(v, dtype="<i4" if v[0] == 4 else "<i8", offset=1) for v in raw]
    return np.array(rows, dtype=np.int64)


def _exact_sums(fit: DataFrame) -> tuple[int, list[int]]:
    """(sum of the weights, weighted sum of each dimension)."""

    def run(batches):
        total, n = 0, 0
        for batch in batches:
            if batch.num_rows:
                x, w = _numbers(batch.column(0)), batch.column(1).to_numpy(zero_copy_only=False)
                if int(np.abs(x).max()) * int(w.sum()) >= _EXACT:
                    x, w = x.astype(object), w.astype(object)
                total, n = total + (x * w[:, None]).sum(axis=0).astype(object), n + int(w.sum())
        if n:
            yield pa.RecordBatch.from_arrays(
                [pa.array(range(-1, len(total)), pa.int32()),
                 pa.array([Decimal(int(v)) for v in (n, *total)], pa.decimal128(38, 0))], names=["i", "total"])

    parts = fit.select("x", "w").mapInArrow(run, "i int, total decimal(38,0)")
    got = {r.i: int(r.total) for r in parts.groupBy("i").agg(F.sum("total").alias("total")).collect()}  # a row a dimension
    return got.pop(-1, 0), [got[i] for i in range(len(got))]


def _matrix_sum(df: DataFrame, product, columns: int) -> np.ndarray:
    """Sum of ``product(batch)``, a matrix, over all batches: rows of the
    tasks' sums are added on the executors, in task order."""

    def run(batches):
        total = None
        for batch in batches:
            if batch.num_rows:
                m = product(batch)
                total = m if total is None else total + m
        if total is not None:
            k = len(total)
            yield pa.RecordBatch.from_arrays(
                [pa.array([TaskContext.get().partitionId()] * k, pa.int32()), pa.array(range(k), pa.int32()),
                 pa.array(list(total), pa.list_(pa.float64()))], names=["part", "i", "row"])

    def merge(pdf: pd.DataFrame) -> pd.DataFrame:
        rows = np.array(pdf.sort_values("part")["row"].tolist(), dtype=np.longdouble)
        return pd.DataFrame({"i": pdf["i"].iloc[:1], "row": [rows.sum(axis=0).astype(float)]})

    got = (df.mapInArrow(run, "part int, i int, row array<double>").groupBy("i")
           .applyInPandas(merge, "i int, row array<double>").collect())
    return np.array([r.row for r in sorted(got, key=lambda r: r.i)], dtype=float).reshape(-1, columns)


def _off_mean(x: np.ndarray, n: int, sums: list[int]) -> np.ndarray:
    """n x - S, exact: whole numbers, or Python integers where they could overflow."""
    if (int(np.abs(x).max(initial=0)) + 1) * n >= _EXACT:
        return x.astype(object) * n - np.array(sums, dtype=object)
    return x * n - np.array(sums, dtype=np.int64)


def _squares(d: np.ndarray) -> pa.Array:
    """Exact sum of squares of each row; null over 38 digits."""
    if d.dtype != object and len(d) and float(np.abs(d).max()) ** 2 * d.shape[1] < _EXACT:
        return pc.cast(pa.array((d * d).sum(axis=1)), pa.decimal128(38, 0))
    exact = [sum(int(v) ** 2 for v in row) for row in d]
    return pa.array([Decimal(v) if v < 10**38 else None for v in exact], pa.decimal128(38, 0))


@dataclass
class Whitening:
    """The fit: weights' sum, sums, and per component a direction (column,
    already over the root of its eigenvalue) and its share of the variance."""

    n: int
    sums: list[int]
    directions: np.ndarray
    explained: list[float]


def fit_whitening(fit: DataFrame, components: int = COMPONENTS) -> Whitening:
    """``fit``: x (of one dimension) and its weight w."""
    n, sums = _exact_sums(fit)
    d = len(sums)

    def product(batch):
        x, w = _numbers(batch.column(0)), batch.column(1).to_numpy(zero_copy_only=False).astype(float)
        c = _off_mean(x, n, sums).astype(float) / n
        return (c * w[:, None]).T @ c

    cov = _matrix_sum(fit.select("x", "w"), product, d) / n if n else np.zeros((0, 0))
    value, vector = np.linalg.eigh((cov + cov.T) / 2)
    value, vector = value[::-1], vector[:, ::-1]
    some = (value > value.max(initial=0) * d * 4 * np.finfo(float).eps)[:components]
    k = int(some.sum())
    return Whitening(n, sums, vector[:, :k] / np.sqrt(value[:k]), (value[:k] / np.trace(cov)).tolist())


def whitened_vectors(distinct: DataFrame, model: Whitening) -> DataFrame:
    """x, deviation (exact sum of (n x - S) squared) and z of each row."""

    def run(batches):
        for batch in batches:
            if batch.num_rows:
                off = _off_mean(_numbers(batch.column(0)), model.n, model.sums)
                z = off.astype(float) / model.n @ model.directions
                yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), _squares(off),
                                                  pa.array(list(z), pa.list_(pa.float64())), batch.column(2)],
                                                 names=["x", "n_rows", "deviation", "z", "w"])

    return (distinct.select("x", "n_rows", "w")
            .mapInArrow(run, "x binary, n_rows long, deviation decimal(38,0), z array<double>, w long"))


def identity_error(z: DataFrame, n: int, k: int) -> float:
    """Largest entry of the covariance of z (weights w) minus the identity."""
    if not k:
        return 0.0

    def split(batch):
        flat = batch.column(0).flatten().to_numpy(zero_copy_only=False)
        return flat.reshape(-1, k), batch.column(1).to_numpy(zero_copy_only=False).astype(float)

    def sums(batch):
        x, w = split(batch)
        return (x * w[:, None]).sum(axis=0, keepdims=True)

    mean = (_matrix_sum(z.select("z", "w"), sums, k) / n)[0]

    def product(batch):
        x, w = split(batch)
        return ((x - mean) * w[:, None]).T @ (x - mean)

    return float(np.abs(_matrix_sum(z.select("z", "w"), product, k) / n - np.eye(k)).max())


def whiten(df: DataFrame, components: int = COMPONENTS, weights: str = "one", id_col: str = "vec_id",
           col: str = "embedding") -> DataFrame:
    """vec_id, n, deviation, z (the components' values), explained (a value a
    component) and identity_error of every row that remains."""
    rows = materialize(whole_vectors(df, id_col, col), "op12-rows")
    counted = materialize(rows.groupBy("x", "dim").agg(F.count(F.lit(1)).alias("n_rows")), "op12-distinct")
    dims = counted.groupBy("dim").agg(F.sum("n_rows").alias("n")).orderBy(F.col("n").desc(), F.col("dim").desc()).first()
    dim, total = (dims.dim, dims.n) if dims else (0, 0)
    weight = {"one": F.lit(1), "count": F.col("n_rows")}[weights].cast("long")
    distinct = counted.where(F.col("dim") == dim).withColumn("w", weight)
    model = fit_whitening(distinct, components)
    done = materialize(whitened_vectors(distinct, model), "op12-whitened")
    error = identity_error(done, model.n, len(model.explained))
    result = done.select(F.col("x").alias("d_x"), "deviation", "z", "n_rows")
    is_hot = F.col("n_rows") * HOT > total
    hot = result.where(is_hot).drop("n_rows")                     # fewer than HOT rows
    own = rows.where(F.col("dim") == dim).select("vec_id", "x")
    out = ["vec_id", "deviation", "z"]
    often = own.join(F.broadcast(hot), F.col("x") == F.col("d_x")).select(*out)
    other = (own.join(F.broadcast(hot.select("d_x")), F.col("x") == F.col("d_x"), "left_anti")
             .join(result.where(~is_hot), F.col("x") == F.col("d_x")).select(*out))
    return often.unionByName(other).select(
        "vec_id", F.lit(model.n).cast("long").alias("n"), "deviation", "z",
        F.array(*map(F.lit, model.explained)).cast("array<double>").alias("explained"),
        F.lit(error).cast("double").alias("identity_error"))
