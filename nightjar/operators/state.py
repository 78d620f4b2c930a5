"""Day-to-day state: previous rows + new rows, previous wins, retention."""

from __future__ import annotations

import datetime as dt
from typing import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from nightjar.functions.exprs import MS_PER_DAY, utc_date

NIGHT_KEYS = ["vendor", "vin", "eventat"]
CHARGING_KEYS = ["vendor", "vin", "session_start_time"]
NIGHT_COLUMNS = ["vendor", "vin", "eventat", "latitude", "longitude"]
CHARGING_COLUMNS = ["vendor", "vin", "session_start_time", "latitude", "longitude"]


def merge_state(previous: DataFrame | None, new: DataFrame, keys: Sequence[str],
                columns: Sequence[str]) -> DataFrame:
    """Union with the previous rows first; one row per key, the previous
    row winning. ``min(struct(priority, ...))`` per key keeps the choice
    deterministic and aggregates map-side."""
    keys = list(keys)
    values = [c for c in columns if c not in keys]
    frames = [new.select(*columns).withColumn("_prio", F.lit(1))]
    if previous is not None:
        frames.insert(0, previous.select(*columns).withColumn("_prio", F.lit(0)))
    u = frames[0] if len(frames) == 1 else frames[0].unionByName(frames[1])
    best = u.groupBy(*keys).agg(F.min(F.struct("_prio", *values)).alias("_w"))
    return best.select(*keys, *[F.col(f"_w.{v}").alias(v) for v in values]).select(*columns)


def added_rows(known: DataFrame, new: DataFrame, order: str, columns: Sequence[str]) -> DataFrame:
    """Rows of ``new``, one per (vendor, vin, ``order``), whose key ``known``
    has not. As previous rows win, they are all that a run adds to the state.

    ``known`` is grouped by vehicle, so one that is bucketed by vehicle is
    read as it lies: only the day's new rows are dealt out. A vehicle's keys
    are those of the rescanned days."""
    one = merge_state(None, new, ["vendor", "vin", order], columns)
    keys = known.groupBy("vendor", "vin").agg(F.collect_set(order).alias("_known"))
    return (one.join(keys, ["vendor", "vin"], "left")
            .where(F.col("_known").isNull() | ~F.array_contains("_known", F.col(order)))
            .select(*columns))


def night_retention(state: DataFrame, as_of: dt.date, days: int) -> DataFrame:
    cutoff = as_of - dt.timedelta(days=days)
    return state.where(utc_date("eventat") >= F.lit(cutoff))


def charging_retention(state: DataFrame, as_of: dt.date, days: int) -> DataFrame:
    epoch = dt.date(1970, 1, 1)
    cutoff_ms = ((as_of - epoch).days - days) * MS_PER_DAY
    return state.where(F.col("session_start_time") >= F.lit(cutoff_ms))


def merge_night_state(previous: DataFrame | None, new: DataFrame, as_of: dt.date,
                      days: int = 60) -> DataFrame:
    return night_retention(merge_state(previous, new, NIGHT_KEYS, NIGHT_COLUMNS), as_of, days)


def merge_charging_state(previous: DataFrame | None, new: DataFrame, as_of: dt.date,
                         days: int = 60) -> DataFrame:
    return charging_retention(merge_state(previous, new, CHARGING_KEYS, CHARGING_COLUMNS),
                              as_of, days)
