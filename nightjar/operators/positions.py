"""Valid positions, stationary points, nightly parked points and night cells."""

from __future__ import annotations

import datetime as dt
from typing import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from nightjar.functions.exprs import (coord_text, exact_mean, in_bbox, number, round_half_even,
                                      utc_date, utc_hour)
from nightjar.operators.sequence import every_row, lagged, ordered
from nightjar.sources.vendors import VendorSpec, partition_days, partition_filter, spec_column

NIGHT_LAST_HOUR = 6           # night is 00:00:00-06:59:59 UTC
STATIONARY_ODOMETER_STEP = 0.1
MIN_NIGHTS_PRESENT = 2
GRID_DECIMALS = 3             # grid cell precision for both axes
TEXT_DECIMALS = 5             # location text precision
TOP_K = 3
HISTORY_DAYS = 60
KEPT = "kept"
REASONS = ("no_position", "not_two_parts", "not_numeric", "outside_box")   # why a raw position is rejected


def valid_positions(raw: DataFrame, specs: Sequence[VendorSpec]) -> DataFrame:
    """Typed positions from raw text: a packed ``'lat,lon'`` column for
    vendors with ``packed_position``, else separate text columns. Keeps rows
    whose parts parse and lie in the bounding box."""
    packed = spec_column(specs, "packed_position", False)
    parts = F.split(F.col("location"), ",")
    lat = F.when(~packed, F.col("lat_text")).when(F.size(parts) == 2, F.try_element_at(parts, F.lit(1)))
    lon = F.when(~packed, F.col("lon_text")).when(F.size(parts) == 2, F.try_element_at(parts, F.lit(2)))
    # The generator parses each text once: filters are not pushed through it,
    # so the parsing is not repeated in every part of the filter.
    typed = raw.select("vendor", "vin", "eventat", F.inline(F.array(F.struct(
        number(lat).alias("latitude"), number(lon).alias("longitude")))))
    return typed.where(in_bbox("latitude", "longitude"))


def judged_positions(raw: DataFrame, specs: Sequence[VendorSpec]) -> DataFrame:
    """Every raw position with its typed coordinates (NULL where they do not
    parse) and a ``reason``: ``KEPT`` for the rows of ``valid_positions``, else
    the first of ``REASONS`` that holds. The texts are kept for the rejected."""
    packed = spec_column(specs, "packed_position", False)
    parts = F.split(F.col("location"), ",")
    lat = F.when(~packed, F.col("lat_text")).when(F.size(parts) == 2, F.try_element_at(parts, F.lit(1)))
    lon = F.when(~packed, F.col("lon_text")).when(F.size(parts) == 2, F.try_element_at(parts, F.lit(2)))
    absent = F.when(packed, F.col("location").isNull()).otherwise(F.col("lat_text").isNull() | F.col("lon_text").isNull())
    typed = raw.select("vendor", "vin", "eventat", "location", "lat_text", "lon_text", absent.alias("_absent"),
                       (packed & (F.size(parts) != 2)).alias("_parts"),
                       F.inline(F.array(F.struct(number(lat).alias("latitude"), number(lon).alias("longitude")))))
    found = dict(zip(REASONS, (F.col("_absent"), F.col("_parts"), F.col("latitude").isNull() | F.col("longitude").isNull(),
                               ~F.coalesce(in_bbox("latitude", "longitude"), F.lit(False)))))
    reason = F.lit(KEPT)
    for name in reversed(REASONS):
        reason = F.when(found[name], name).otherwise(reason)
    return typed.withColumn("reason", reason).drop("_absent", "_parts")


def scan_window(telemetry: DataFrame, as_of: dt.date, lookback: int) -> DataFrame:
    """Rows of ``as_of`` and the ``lookback`` days before, by partition."""
    return telemetry.where(partition_filter(partition_days(as_of, lookback)))


def night_candidates(telemetry: DataFrame, specs: Sequence[VendorSpec]) -> DataFrame:
    """Night-hour rows with a valid position; for odometer vendors also a
    non-null odometer and the vendor's extra predicate. These predicates run
    BEFORE the lag: the previous row is the previous surviving row."""
    has_odo = spec_column(specs, "has_odometer", False)
    motion = spec_column(specs, "motion_filter", False)
    return (telemetry
            .where(F.col("eventat").isNotNull() & F.col("vin").isNotNull())
            .where(utc_hour("eventat") <= NIGHT_LAST_HOUR)
            .where(F.col("latitude").isNotNull() & F.col("longitude").isNotNull()
                   & in_bbox("latitude", "longitude"))
            .where(~has_odo | F.col("odometer").isNotNull())
            .where(~has_odo | ~motion | F.coalesce(F.col("motion_ok"), F.lit(False)))
            .select("vendor", "vin", "eventat", "latitude", "longitude", "odometer"))


def stationary_points(telemetry: DataFrame, specs: Sequence[VendorSpec],
                      stationary: bool = True) -> DataFrame:
    """Night rows whose odometer moved at most 0.1 since the previous night
    row of the vehicle; the first row compares with itself. Vendors without
    an odometer (or ``stationary=False``) keep every night row."""
    cand = night_candidates(telemetry, specs)
    if not stationary:
        return cand.withColumn("prev_odometer", F.lit(None).cast("double"))
    o = ordered(cand, ["vendor", "vin"], "eventat", ["latitude", "longitude", "odometer"])
    o = lagged(o, {"prev_odometer": ("odometer", F.col("odometer"))})
    has_odo = spec_column(specs, "has_odometer", False)
    keep = ~has_odo | (F.abs(F.col("odometer") - F.col("prev_odometer")) <= STATIONARY_ODOMETER_STEP)
    return every_row(o, o.rows.where(keep))


def night_points(telemetry: DataFrame, specs: Sequence[VendorSpec],
                 stationary: bool = True) -> DataFrame:
    """Per vehicle and UTC night, the latest (stationary) point.

    ``max(struct(eventat, latitude, longitude))`` per (vendor, vin, date) is
    ROW_NUMBER() = 1 ordered by eventat DESC (ties: larger lat, lon), but it
    aggregates map-side instead of sorting each group."""
    pts = stationary_points(telemetry, specs, stationary)
    latest = (pts.groupBy("vendor", "vin", utc_date("eventat").alias("event_date"))
                 .agg(F.max(F.struct("eventat", "latitude", "longitude")).alias("p")))
    return latest.select("vendor", "vin", "p.eventat", "p.latitude", "p.longitude")


def with_event_date(state: DataFrame) -> DataFrame:
    return state.withColumn("event_date", utc_date("eventat"))


def last_night(night_state: DataFrame, as_of: dt.date) -> DataFrame:
    """Location text of each vehicle's point dated yesterday (UTC); with
    several points that day (rescan overlap), the latest one."""
    y = as_of - dt.timedelta(days=1)
    pts = with_event_date(night_state).where(F.col("event_date") == F.lit(y))
    latest = (pts.groupBy("vendor", "vin")
                 .agg(F.max(F.struct("eventat", "latitude", "longitude")).alias("p")))
    return latest.select("vendor", "vin",
                         coord_text("p.latitude", "p.longitude", TEXT_DECIMALS).alias("last_night_location"))


def grid_cell(lat="latitude", lon="longitude", decimals: int = GRID_DECIMALS):
    return F.concat(round_half_even(lat, decimals).cast("string"), F.lit(","),
                    round_half_even(lon, decimals).cast("string"))


def night_cells(night_state: DataFrame, min_nights: int = MIN_NIGHTS_PRESENT,
                k: int = TOP_K) -> DataFrame:
    """Recurrent night cells: 3-decimal grid cells seen on at least
    ``min_nights`` distinct nights; centroid of their points; top ``k`` per
    vehicle by nights, ties by cell text."""
    pts = with_event_date(night_state).withColumn("grid_cell", grid_cell())
    cells = (pts.groupBy("vendor", "vin", "grid_cell")
                .agg(F.countDistinct("event_date").alias("night_count"),
                     exact_mean("latitude").alias("latitude"),
                     exact_mean("longitude").alias("longitude"))
                .where(F.col("night_count") >= min_nights))
    w = Window.partitionBy("vendor", "vin").orderBy(F.col("night_count").desc(), F.col("grid_cell"))
    return (cells.withColumn("rank", F.row_number().over(w))
                 .where(F.col("rank") <= k))
