"""Order-dependent operators (LAG, running SUM) that do not put one key in one task.

A plain ``lag(x) OVER (PARTITION BY vin ORDER BY eventat)`` sends every row of
a vehicle to one task. A vehicle that reports far more often than others (or a
replayed device) then becomes one straggler task holding a large share of the
data. ``ordered`` cuts only such vehicles into ranges of about equal row
counts; every other vehicle stays whole and takes the plain window:

1. Row counts per key, combined before the shuffle. A key is heavy if it has
   more rows than an eighth of a task's share; there are at most eight times
   the number of shuffle partitions of those, whatever the data.
2. The borders of a heavy key's ranges are quantiles of the ordering column
   (``percentile_approx``), as many as the key has shares. The borders of all
   keys together are bounded like the keys, so they are broadcast.
3. A value that fills whole ranges by itself (a border met twice) is a hot
   instant and a range of its own. Its equal rows become two rows, the first
   and one that stands for the others with their number as weight: equal
   readings need no order among themselves. If a hot instant still has too
   many different rows, it is cut again by the first tie column, and so on.

Only the first row of a range depends on the range before. Its value comes
from a summary with one row per range (a map-side aggregate, bounded like the
borders). Nothing is written between the steps, and without a heavy key the
plan is the plain window's. Results are identical to the plain window.

``ties`` are further order columns for rows with an equal ``order`` value, so
that a retry orders them alike.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, replace
from typing import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

DEFAULT_BUCKET_MS = 3_600_000
SHARES = 8                 # ranges a task's share of the rows is cut into
LEAST_ROWS = 50_000        # keys with fewer rows are never cut
MAX_RANGES = 1 << 14       # of one key
RANGE, COPY, WEIGHT = "_range", "_copy", "_weight"


@dataclass(frozen=True)
class Ordered:
    """Rows with the range of each (``part``: the columns that name it).
    ``split``: some key has several ranges; ``small``: their number is bounded,
    so summaries may be broadcast; ``hot``: instants that are ranges of their
    own; ``weighted``: rows stand for WEIGHT equal ones."""

    rows: DataFrame
    keys: tuple[str, ...]
    order: str
    ties: tuple[str, ...]
    part: tuple[str, ...] = ()
    split: bool = False
    small: bool = True
    hot: bool = False
    weighted: bool = False

    @property
    def window(self):
        last = (COPY,) if self.weighted else ()
        return Window.partitionBy(*self.keys, *self.part).orderBy(self.order, *self.ties, *last)

    def cut_rows(self, rows: DataFrame) -> DataFrame:
        """Those of ``rows`` whose key has several ranges."""
        return rows.where(F.size(RANGE) > 0) if self.small else rows

    def with_summary(self, rows: DataFrame, summary: DataFrame) -> DataFrame:
        return rows.join(F.broadcast(summary) if self.small else summary, on=[*self.keys, *self.part], how="left")


# --- ranges ------------------------------------------------------------------

def _sortable(c: str, kind: T.DataType) -> Column:
    """``c`` as a number that is never null and rises with the sort order."""
    if isinstance(kind, T.BooleanType):
        return F.coalesce(F.col(c).cast("int"), F.lit(-1))
    if isinstance(kind, T.IntegralType):
        return F.coalesce(F.col(c).cast("long"), F.lit(-2**63))
    return F.coalesce(F.col(c).cast("double"), F.lit(float("-inf")))


def _quantiles(df: DataFrame, by: list[str], value: Column, groups: dict[tuple, int], share: float) -> dict[tuple, list]:
    """Borders of each group (its row count given): as many quantiles of
    ``value`` as the group has shares, rounded up to a power of two."""
    need = {g: min(MAX_RANGES, 1 << math.ceil(math.log2(max(2.0, n / share)))) for g, n in groups.items()}
    schema = T.StructType([df.schema[c] for c in by] + [T.StructField("_need", T.IntegerType())])
    table = df.sparkSession.createDataFrame([(*g, n) for g, n in need.items()], schema)
    own = [df[c].eqNullSafe(table[c]) for c in by]
    cond = own[0]
    for c in own[1:]:
        cond = cond & c
    rows = df.join(F.broadcast(table), cond).select(*[df[c] for c in by], "_need", value.alias("_value"))
    sizes = sorted(set(need.values()))
    aggs = [F.percentile_approx(F.when(F.col("_need") == n, F.col("_value")),
                                [i / n for i in range(1, n)], 10 * n).alias(f"q{n}") for n in sizes]
    got = rows.groupBy(*by).agg(*aggs).collect()          # at most 2 * SHARES * partitions borders in all
    return {tuple(r[c] for c in by): next(r[f"q{n}"] for n in sizes if r[f"q{n}"] is not None) for r in got}


def _placed(df: DataFrame, by: list[str], value: Column, borders: dict[tuple, list]) -> DataFrame:
    """RANGE extended by the range of ``value``: twice the number of borders
    below it, plus one if it is a border that is met twice."""
    kind = df.select(value.alias("v")).schema["v"].dataType
    rows = []
    for g, b in borders.items():
        b = sorted(b)
        one = sorted(set(b))
        width = max(1, math.isqrt(len(one)))
        chunks = [one[i:i + width] for i in range(0, len(one), width)]
        rows.append((*g, [c[0] for c in chunks], chunks, sorted({x for x, y in zip(b, b[1:]) if x == y})))
    names = [f"_g{i}" for i in range(len(by))]
    schema = T.StructType([T.StructField(n, df.schema[c].dataType) for n, c in zip(names, by)]
                          + [T.StructField("_tops", T.ArrayType(kind)),
                             T.StructField("_chunks", T.ArrayType(T.ArrayType(kind))),
                             T.StructField("_hot", T.ArrayType(kind))])
    table = df.sparkSession.createDataFrame(rows, schema)
    cond = F.lit(True)
    for n, c in zip(names, by):
        cond = cond & F.col(c).eqNullSafe(F.col(n))
    joined = df.withColumn("_value", value).join(F.broadcast(table), cond, "left")
    below = lambda a: F.size(F.filter(a, lambda x: x < F.col("_value")))
    chunk = below("_tops")
    upto = F.when(chunk == 0, F.lit(0)).otherwise(
        (chunk - 1) * F.size(F.col("_chunks")[0]) + below(F.get("_chunks", chunk - 1)))
    place = 2 * upto + F.array_contains("_hot", F.col("_value")).cast("int")
    return (joined.withColumn(RANGE, F.when(F.col("_tops").isNull(), F.col(RANGE))
                              .otherwise(F.concat(RANGE, F.array(place))))
            .drop("_value", "_tops", "_chunks", "_hot", *names))


def _counts(df: DataFrame, by: list[str], least: float) -> dict[tuple, int]:
    """Groups with more than ``least`` rows."""
    got = df.groupBy(*by).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > least).collect()
    return {tuple(r[c] for c in by): r["_n"] for r in got}


def _among(df: DataFrame, by: list[str], groups) -> DataFrame:
    """``df`` with ``_in``: whether its row is in one of ``groups`` (bounded)."""
    names = [f"_g{i}" for i in range(len(by))]
    schema = T.StructType([T.StructField(n, df.schema[c].dataType) for n, c in zip(names, by)])
    table = df.sparkSession.createDataFrame([tuple(g) for g in groups], schema).withColumn("_in", F.lit(True))
    cond = F.lit(True)
    for n, c in zip(names, by):
        cond = cond & F.col(c).eqNullSafe(F.col(n))
    return df.join(F.broadcast(table), cond, "left").drop(*names)


def _collapsed(df: DataFrame, by: list[str], groups) -> DataFrame:
    """Equal rows of ``groups`` as two rows: the first, and one for the others."""
    marked = _among(df, by, groups)
    columns = [c for c in df.columns if c not in (COPY, WEIGHT)]
    many = (marked.where("_in").groupBy(*columns).agg(F.count(F.lit(1)).alias("_n"))
            .withColumn("_both", F.when(F.col("_n") > 1, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))))
            .select(*columns, "_n", F.explode("_both").alias(COPY))
            .withColumn(WEIGHT, F.when(F.col(COPY) == 0, F.lit(1)).otherwise(F.col("_n") - 1).cast("long"))
            .select(*df.columns))
    return marked.where("_in IS NULL").select(*df.columns).unionByName(many)


def ordered(df: DataFrame, keys: Sequence[str], order: str, ties: Sequence[str] = (),
            least_rows: int = LEAST_ROWS) -> Ordered:
    """``df`` cut so that no range of a key has more than about an eighth of a
    task's share of the rows (and ``least_rows``)."""
    keys, ties = list(keys), list(ties)
    plain = Ordered(df, tuple(keys), order, tuple(ties))
    tasks = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    some = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > least_rows)
    if some.isEmpty():
        return plain
    share = max(float(least_rows), df.count() / (SHARES * tasks))
    heavy = _counts(df, keys, share)                      # fewer than SHARES * tasks keys
    if not heavy:
        return plain
    rows = df.withColumns({RANGE: F.array().cast("array<int>"), COPY: F.lit(0), WEIGHT: F.lit(1).cast("long")})
    hot_any, by, groups = False, list(keys), heavy
    for column in [order, *ties]:
        value = _sortable(column, df.schema[column].dataType)
        borders = _quantiles(rows, by, value, groups, share)
        rows = _placed(rows, by, value, borders)
        hot = [(*g, x) for g, b in borders.items() for x in {x for x, y in zip(sorted(b), sorted(b)[1:]) if x == y}]
        if not hot:
            break
        # From here the prefix is (keys, the hot values so far), as sortable numbers.
        name = f"_p_{column}"
        rows = rows.withColumn(name, value)
        by = [*by, name]
        if not hot_any:
            rows = _collapsed(rows, by, hot)
            hot_any = True
        groups = _counts(_among(rows, by, hot).where("_in"), by, share)
        if not groups:
            break
    rows = rows.drop(*[f"_p_{c}" for c in [order, *ties]])
    return replace(plain, rows=rows, part=(RANGE,), split=True, hot=hot_any, weighted=hot_any)


def every_row(o: Ordered, rows: DataFrame | None = None) -> DataFrame:
    """The rows without helper columns, those with a weight repeated."""
    rows = o.rows if rows is None else rows
    if o.weighted:
        # A row that stands for very many is repeated in two steps.
        rows = (rows.withColumn("_thousands", F.explode(F.sequence(
                    F.lit(0).cast("long"), F.floor((F.col(WEIGHT) - 1) / 1024))))
                .withColumn("_one", F.explode(F.sequence(
                    F.lit(1).cast("long"), F.least(F.lit(1024), F.col(WEIGHT) - 1024 * F.col("_thousands")))))
                .drop("_thousands", "_one"))
    return rows.drop(RANGE, COPY, WEIGHT) if o.small and o.split else rows


def weight(o: Ordered) -> Column:
    """How many rows a row stands for."""
    return F.col(WEIGHT) if o.weighted else F.lit(1).cast("long")


# --- LAG and islands -----------------------------------------------------------

def lagged(o: Ordered, columns: Mapping[str, tuple[str, Column | None]]) -> Ordered:
    """Add ``out = lag(src, 1, default)`` over the keys in order.

    ``columns`` maps output name -> (source column, default). The default is
    used only for the first row of a key (SQL LAG semantics: a NULL value of
    the previous row stays NULL). A default of ``None`` means NULL; a Column
    default may refer to the current row (``lag(x, 1, x)``)."""
    rows, first = o.rows, F.lag(F.lit(1)).over(o.window).isNull()
    if o.split:
        srcs = sorted({src for src, _ in columns.values()})
        last = [COPY] if o.weighted else []
        place = [o.order, *o.ties, *last]
        ends = (o.cut_rows(rows).groupBy(*o.keys, *o.part)
                .agg(F.max(F.struct(*[F.col(c).alias(f"o{i}") for i, c in enumerate(place)],
                                    F.struct(*srcs).alias("row"))).alias("_end")))
        before = Window.partitionBy(*o.keys).orderBy(*o.part)
        ends = ends.select(*o.keys, *o.part, F.lag("_end.row").over(before).alias("_before"))
        rows = o.with_summary(rows, ends)
    outs = {}
    for out, (src, default) in columns.items():
        edge = F.lit(None) if default is None else default
        if o.split:
            edge = F.when(F.col("_before").isNull(), edge).otherwise(F.col("_before").getField(src))
        outs[out] = F.when(first, edge).otherwise(F.lag(src).over(o.window))
    rows = rows.withColumns(outs)
    return replace(o, rows=rows.drop("_before") if o.split else rows)


def island_ids(o: Ordered, flag: str, out: str) -> Ordered:
    """Gaps and islands: a row starts an island when ``flag`` is 1 and the
    previous row's flag (0 before the first row) is 0; ``out`` is the running
    count of starts (default RANGE frame), as ``SUM(start) OVER (PARTITION BY
    keys ORDER BY order)``.

    Only the first row of a range depends on the range before (its previous
    flag), so one summary row per range carries the first and last flag and the
    number of starts among the other rows; a window over the ranges turns these
    into the first row's start and the count before the range. Rows of one
    instant have one count, that at its end, also where it has several ranges."""
    parts = [*o.keys, *o.part]
    run = Window.partitionBy(*parts).orderBy(o.order).rangeBetween(Window.unboundedPreceding, Window.currentRow)
    start = F.when((F.col(flag) == 1) & (F.lag(flag, 1, 0).over(o.window) == 0), 1).otherwise(0)
    if o.split:                # the first row of a range gets its start from the summary
        first = F.lag(F.lit(1)).over(o.window).isNull()
        start = F.when(first & (F.size(RANGE) > 0) if o.small else first, 0).otherwise(start)
    rows = o.rows.withColumn("_start", start)
    if not o.split:
        return replace(o, rows=rows.withColumn(out, F.sum("_start").over(run)).drop("_start"))
    head = o.window.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ends = (o.cut_rows(rows).select(*parts, F.first(flag).over(head).alias("_head"), F.col(flag).alias("_tail"), "_start",
                                    F.lead(F.lit(1)).over(o.window).isNull().alias("_last"),
                                    F.sum("_start").over(run).alias("_total"))
            .where("_last"))
    before = Window.partitionBy(*o.keys).orderBy(*o.part)
    ends = ends.withColumn("_first", F.when(
        (F.col("_head") == 1) & (F.coalesce(F.lag("_tail").over(before), F.lit(0)) == 0), 1).otherwise(0))
    upto = F.sum(F.col("_total") + F.col("_first")).over(
        before.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    ends = ends.withColumn("_upto", upto).withColumn("_base", F.col("_upto") - F.col("_total"))
    if o.hot:
        instant = F.when(F.col(RANGE)[0] % 2 == 1, F.col(RANGE)[0])
        end = F.max("_upto").over(Window.partitionBy(*o.keys, instant))
        ends = ends.withColumn("_base", F.when(instant.isNotNull(), end - F.col("_total")).otherwise(F.col("_base")))
    rows = o.with_summary(rows, ends.select(*parts, "_base"))
    rows = rows.withColumn(out, F.coalesce(F.col("_base"), F.lit(0)) + F.sum("_start").over(run)).drop("_start", "_base")
    return replace(o, rows=rows)


# --- fixed slices ----------------------------------------------------------------

def with_bucket(df: DataFrame, order: str, bucket_ms: int = DEFAULT_BUCKET_MS,
                name: str = "_bucket") -> DataFrame:
    return df.withColumn(name, F.floor(F.col(order) / F.lit(bucket_ms)))


def _sliced(df: DataFrame, keys, order, bucket, ties) -> Ordered:
    return Ordered(df, tuple(keys), order, tuple(ties), (bucket,), split=True, small=False)


def bucketed_lag(df: DataFrame, keys: Sequence[str], order: str, columns: Mapping[str, tuple[str, Column | None]],
                 bucket: str = "_bucket", ties: Sequence[str] = ()) -> DataFrame:
    """``lagged`` with the slices of ``bucket`` (see ``with_bucket``) as ranges of every key."""
    return lagged(_sliced(df, keys, order, bucket, ties), columns).rows


def bucketed_island_ids(df: DataFrame, keys: Sequence[str], order: str, flag: str,
                        out: str, bucket: str = "_bucket", ties: Sequence[str] = ()) -> DataFrame:
    """``island_ids`` with the slices of ``bucket`` as ranges of every key."""
    return island_ids(_sliced(df, keys, order, bucket, ties), flag, out).rows
