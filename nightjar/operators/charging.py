"""Charging signal and gaps-and-islands charging sessions."""

from __future__ import annotations

import datetime as dt
from dataclasses import replace
from typing import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from nightjar.functions.exprs import in_bbox, weighted_mean
from nightjar.operators.positions import STATIONARY_ODOMETER_STEP
from nightjar.operators.sequence import Ordered, every_row, island_ids, lagged, ordered, weight
from nightjar.sources.vendors import (VendorSpec, partition_days, partition_filter,
                                      spec_column)

KEYS = ["vendor", "vin"]
TIES = ["latitude", "longitude", "odometer", "soc", "dte", "charge_flag"]


def charging_scan_filter(specs: Sequence[VendorSpec], as_of: dt.date, lookback: int) -> Column:
    """Partition predicate of the charging scan. Vendors with
    ``charging_days`` read only the days before ``as_of``; the rest read
    ``as_of`` and ``lookback`` days back. Vendors without charging read
    nothing."""
    clauses = []
    normal = [s.name for s in specs if s.charging and s.charging_days is None]
    if normal:
        clauses.append(F.col("vendor").isin(normal) & partition_filter(partition_days(as_of, lookback)))
    for s in specs:
        if s.charging and s.charging_days is not None:
            days = [as_of - dt.timedelta(days=i) for i in range(1, s.charging_days + 1)]
            clauses.append((F.col("vendor") == s.name) & partition_filter(days))
    out = F.lit(False)
    for c in clauses:
        out = out | c
    return out


def charging_candidates(telemetry: DataFrame, specs: Sequence[VendorSpec]) -> DataFrame:
    """Rows the signal is computed on: valid position in the box, a
    non-null odometer for odometer vendors, the vendor's extra predicate.
    Applied before the lags."""
    has_odo = spec_column(specs, "has_odometer", False)
    motion = spec_column(specs, "motion_filter", False)
    charging = spec_column(specs, "charging", False)
    return (telemetry
            .where(charging)
            .where(F.col("eventat").isNotNull() & F.col("vin").isNotNull())
            .where(F.col("latitude").isNotNull() & F.col("longitude").isNotNull()
                   & in_bbox("latitude", "longitude"))
            .where(~has_odo | F.col("odometer").isNotNull())
            .where(~motion | F.coalesce(F.col("motion_ok"), F.lit(False)))
            .select("vendor", "vin", "eventat", "latitude", "longitude", "odometer",
                    "soc", "dte", "charge_flag"))


def signal_rows(telemetry: DataFrame, specs: Sequence[VendorSpec]) -> Ordered:
    """Per row: previous soc/range (default 0), previous odometer (default
    itself) and ``is_charging_signal`` = (flag OR soc rose OR range rose)
    AND stationary, with the vendor's clauses."""
    return signalled(charging_candidates(telemetry, specs), specs)


def signalled(rows: DataFrame, specs: Sequence[VendorSpec]) -> Ordered:
    """``signal_rows`` of candidates, which may have further columns."""
    o = lagged(ordered(rows, KEYS, "eventat", TIES), {
        "prev_soc": ("soc", F.lit(0.0)),
        "prev_dte": ("dte", F.lit(0.0)),
        "prev_odometer": ("odometer", F.col("odometer")),
    })
    use_flag = spec_column(specs, "use_flag", False)
    use_soc = spec_column(specs, "use_soc", False)
    use_dte = spec_column(specs, "use_dte", False)
    has_odo = spec_column(specs, "has_odometer", False)
    f = lambda c: F.coalesce(c, F.lit(False))  # noqa: E731  NULL clause = not charging
    clue = ((use_flag & f(F.col("charge_flag")))
            | (use_soc & f(F.col("soc") > F.col("prev_soc")))
            | (use_dte & f(F.col("dte") > F.col("prev_dte"))))
    still = ~has_odo | f(F.abs(F.col("odometer") - F.col("prev_odometer")) <= STATIONARY_ODOMETER_STEP)
    return replace(o, rows=o.rows.withColumn("is_charging_signal", F.when(clue & still, 1).otherwise(0)))


def charging_signal(telemetry: DataFrame, specs: Sequence[VendorSpec]) -> DataFrame:
    """``signal_rows`` as a plain frame."""
    return every_row(signal_rows(telemetry, specs))


def charging_sessions(telemetry: DataFrame, specs: Sequence[VendorSpec],
                      with_metrics: bool = False) -> DataFrame:
    """Islands of consecutive charging rows per vehicle. A session starts on
    a charging row whose previous row (any row) was not charging; its id is
    the running count of starts. Its place is the exact mean of its points at
    ten decimals, so it is the same whatever order they are summed in. Sessions
    shorter than the vendor's minimum minutes or points are dropped."""
    o = island_ids(signal_rows(telemetry, specs), "is_charging_signal", "session_id")
    n = weight(o)
    sess = (o.rows.where(F.col("is_charging_signal") == 1)
               .groupBy("vendor", "vin", "session_id")
               .agg(F.min("eventat").alias("session_start_time"),
                    F.max("eventat").alias("_end"),
                    weighted_mean("latitude", n).alias("latitude"),
                    weighted_mean("longitude", n).alias("longitude"),
                    F.sum(n).alias("point_count")))
    # Whole minutes between the second-truncated start and end instants.
    sess = sess.withColumn(
        "duration_minutes",
        F.floor((F.floor(F.col("_end") / 1000) - F.floor(F.col("session_start_time") / 1000)) / 60))
    keep = ((F.col("duration_minutes") >= spec_column(specs, "min_duration", 1))
            & (F.col("point_count") >= spec_column(specs, "min_points", 1)))
    sess = sess.where(keep)
    cols = ["vendor", "vin", "session_start_time", "latitude", "longitude"]
    if with_metrics:
        cols += ["point_count", "duration_minutes"]
    return sess.select(*cols)
