"""Night cells kept from run to run.

A row holds, for one vehicle and grid cell, a bitmap of the nights on which it
was there (bit k: k days before the row's run) and, for each of those nights,
the number of points and their exact coordinate sums. A run shifts the bitmap
by the days that have passed, drops nights that leave the history and adds the
nights of its new points, so it reads the new points only. The cells' counts
and centroids are those of all points of the history (``night_cells``).

The merge joins by vehicle, a vehicle's cells being a short list (61 nights at
most), and keeps the buckets in which the old cells lie.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from nightjar.functions.exprs import CENTROID_TYPE, utc_date
from nightjar.operators.positions import HISTORY_DAYS, MIN_NIGHTS_PRESENT, TOP_K, grid_cell

NIGHT = "struct<day:date,n:bigint,lat:decimal(32,10),lon:decimal(32,10)>"
CELL_COLUMNS = f"vendor STRING, vin STRING, grid_cell STRING, nights BIGINT, parts ARRAY<{NIGHT}>"


def _mask(history: int) -> Column:
    if not 0 < history < 63:
        raise ValueError("a bitmap of nights holds at most 62 days of history")
    return F.lit((1 << history + 1) - 1)


def _bit(day: Column, as_of: dt.date) -> Column:
    return F.call_function("shiftleft", F.lit(1).cast("long"), F.datediff(F.lit(as_of), day))


def new_cells(points: DataFrame, as_of: dt.date, history: int = HISTORY_DAYS) -> DataFrame:
    """Cells of some night points (at most ``history`` days old)."""
    day = utc_date("eventat")
    kept = points.where((day >= F.lit(as_of - dt.timedelta(days=history))) & (day <= F.lit(as_of)))
    total = lambda c: F.sum(F.col(c).cast(CENTROID_TYPE)).cast("decimal(32,10)")
    nights = (kept.groupBy("vendor", "vin", grid_cell().alias("grid_cell"), day.alias("day"))
              .agg(F.count(F.lit(1)).alias("n"), total("latitude").alias("lat"), total("longitude").alias("lon")))
    return (nights.groupBy("vendor", "vin", "grid_cell")
            .agg(F.bit_or(_bit(F.col("day"), as_of)).alias("nights"),
                 F.sort_array(F.collect_list(F.struct("day", "n", "lat", "lon"))).cast(f"array<{NIGHT}>").alias("parts")))


def aged(cells: DataFrame, version: dt.date, as_of: dt.date, history: int = HISTORY_DAYS) -> DataFrame:
    """Cells of ``version``'s run as seen on ``as_of``."""
    cutoff = F.lit(as_of - dt.timedelta(days=history))
    nights = F.call_function("shiftleft", F.col("nights"), F.lit(min(63, (as_of - version).days))).bitwiseAND(_mask(history))
    return (cells.withColumn("nights", nights).where("nights <> 0")
            .withColumn("parts", F.filter("parts", lambda p: p.day >= cutoff)))


def _vehicles(cells: DataFrame, name: str) -> DataFrame:
    return cells.groupBy("vendor", "vin").agg(F.collect_list(F.struct("grid_cell", "nights", "parts")).alias(name))


def _one_each(parts: Column) -> Column:
    """Nights of one cell, those of one day added up."""
    days = F.array_sort(F.array_distinct(F.transform(parts, lambda p: p.day)))
    zero = F.struct(F.lit(0).cast("bigint").alias("n"), F.lit(0).cast("decimal(32,10)").alias("lat"),
                    F.lit(0).cast("decimal(32,10)").alias("lon"))
    add = lambda a, p: F.struct((a.n + p.n).alias("n"), (a.lat + p.lat).cast("decimal(32,10)").alias("lat"),
                                (a.lon + p.lon).cast("decimal(32,10)").alias("lon"))

    def night(day):
        s = F.aggregate(F.filter(parts, lambda p: p.day == day), zero, add)
        return F.struct(day.alias("day"), s.n.alias("n"), s.lat.alias("lat"), s.lon.alias("lon"))

    return F.transform(days, night)


def merged_cells(old: DataFrame, new: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(cells of vehicles that ``old`` has, in its partitioning; cells of other
    vehicles)."""
    before, after = _vehicles(old, "_old"), _vehicles(new, "_new")
    both = F.concat("_old", F.coalesce("_new", F.array().cast(
        f"array<struct<grid_cell:string,nights:bigint,parts:array<{NIGHT}>>>")))
    names = F.array_distinct(F.transform("_all", lambda c: c.grid_cell))

    def cell(name):
        own = F.filter("_all", lambda c: c.grid_cell == name)
        return F.struct(name.alias("grid_cell"),
                        F.aggregate(own, F.lit(0).cast("bigint"), lambda a, c: a.bitwiseOR(c.nights)).alias("nights"),
                        _one_each(F.flatten(F.transform(own, lambda c: c.parts))).alias("parts"))

    known = (before.join(after, ["vendor", "vin"], "left").select("vendor", "vin", both.alias("_all"))
             .select("vendor", "vin", F.inline(F.transform(names, cell))))
    fresh = new.join(before.select("vendor", "vin"), ["vendor", "vin"], "left_anti")
    return known, fresh.select(*known.columns)


def cell_counts(cells: DataFrame, min_nights: int = MIN_NIGHTS_PRESENT, k: int = TOP_K) -> DataFrame:
    """``night_cells`` of the points that the cells were made of."""
    total = lambda c: F.aggregate("parts", F.lit(0).cast("decimal(32,10)"),
                                  lambda a, p: (a + p[c]).cast("decimal(32,10)"))
    n = F.aggregate("parts", F.lit(0).cast("bigint"), lambda a, p: a + p.n).cast("decimal(20,0)")
    counted = (cells.select("vendor", "vin", "grid_cell", F.bit_count("nights").cast("long").alias("night_count"),
                            (total("lat") / n).cast("decimal(26,14)").alias("latitude"),
                            (total("lon") / n).cast("decimal(26,14)").alias("longitude"))
               .where(F.col("night_count") >= min_nights))
    w = Window.partitionBy("vendor", "vin").orderBy(F.col("night_count").desc(), F.col("grid_cell"))
    return counted.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)
