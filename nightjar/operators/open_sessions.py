"""Charging sessions carried from run to run.

A run that rescans the last days cuts sessions at the edge of its scan: the
first row of the scan has no row before it, so a session over midnight comes
out twice, with two starts. Here a run reads only rows it has not read yet and
takes up a carry: one row a vehicle with its last reading, whether that was
charging, and the exact sums of its open session.

The carried reading goes before the vehicle's new rows, so their LAG and their
islands start from it, and what it stands for in the sums is the open session.
A session comes out when a later row of its vehicle ends it, once, with the
points of all runs. One whose vehicle is still charging at its last row is
open. A vehicle silent since before ``silent_since`` is given up: its open
session comes out as it is and it leaves the carry, as a scan of the whole
history would not see it either.

Defined cases: vehicles without new rows keep their carry; without a carry
(None) all rows are a first run; a row dated before its vehicle's carried
reading is read as one that stands before it, without a row before itself.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import replace
from typing import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from nightjar.functions.exprs import MS_PER_DAY, coordinate_units, units_mean
from nightjar.operators.charging import TIES, charging_candidates, signalled
from nightjar.operators.lineage import materialize
from nightjar.operators.sequence import COPY, island_ids, weight
from nightjar.sources.vendors import VendorSpec, spec_column

UNITS = T.DecimalType(38, 0)
OPEN = ["open_start", "open_points", "open_lat", "open_lon"]
CARRY_SCHEMA = T.StructType([
    T.StructField("vendor", T.StringType()), T.StructField("vin", T.StringType()), T.StructField("eventat", T.LongType()),
    *[T.StructField(c, T.BooleanType() if c == "charge_flag" else T.DoubleType()) for c in TIES],
    T.StructField("charging", T.IntegerType()),
    T.StructField("open_start", T.LongType()), T.StructField("open_points", T.LongType()),
    T.StructField("open_lat", UNITS), T.StructField("open_lon", UNITS)])


def advance(telemetry: DataFrame, carry: DataFrame | None, specs: Sequence[VendorSpec],
            silent_since: dt.date) -> tuple[DataFrame, DataFrame]:
    """(sessions, carry) after the rows of ``telemetry``, none of which the
    carry has seen. Sessions have ``is_open``; those shorter than the vendor's
    minimum minutes or points are dropped, open ones too, which may come out
    later."""
    rows = charging_candidates(telemetry, specs)
    if carry is None:
        carry = telemetry.sparkSession.createDataFrame([], CARRY_SCHEMA)
    rows = rows.unionByName(carry.select(*CARRY_SCHEMA.names), allowMissingColumns=True)
    o = signalled(rows, specs)
    carried = F.col("charging").isNotNull()
    o = replace(o, rows=o.rows.withColumn("is_charging_signal", F.coalesce("charging", "is_charging_signal")))
    o = island_ids(o, "is_charging_signal", "session_id")

    # One row an island, with the rows after it up to the next: a vehicle's
    # last island has its last reading.
    on = F.col("is_charging_signal") == 1
    points = F.when(on, F.when(carried, F.col("open_points")).otherwise(weight(o)))
    units = lambda c, kept: F.when(on, F.when(carried, F.col(kept))
                                   .otherwise((coordinate_units(c) * weight(o).cast("decimal(12,0)")).cast(UNITS)))
    last = ["eventat", *TIES, *([COPY] if o.weighted else [])]
    parts = o.rows.groupBy("vendor", "vin", "session_id").agg(
        F.min(F.when(on, F.coalesce("open_start", "eventat"))).alias("session_start_time"),
        F.max(F.when(on, F.col("eventat"))).alias("_end"),
        F.sum(points).alias("point_count"),
        F.sum(units("latitude", "open_lat")).cast(UNITS).alias("_lat"),
        F.sum(units("longitude", "open_lon")).cast(UNITS).alias("_lon"),
        F.max(F.struct(*last, "is_charging_signal")).alias("_last"))
    islands = Window.partitionBy("vendor", "vin").orderBy("session_id")
    parts = materialize(parts.withColumn("_tail", F.lead(F.lit(1)).over(islands).isNull()), "open-sessions")

    silent = F.lit((silent_since - dt.date(1970, 1, 1)).days * MS_PER_DAY)
    going_on = F.col("_tail") & (F.col("_last.is_charging_signal") == 1)
    minutes = F.floor((F.floor(F.col("_end") / 1000) - F.floor(F.col("session_start_time") / 1000)) / 60)
    sessions = (parts.where(F.col("session_start_time").isNotNull())
                .select("vendor", "vin", "session_start_time", units_mean("_lat", "point_count").alias("latitude"),
                        units_mean("_lon", "point_count").alias("longitude"), "point_count",
                        minutes.alias("duration_minutes"),
                        (going_on & (F.col("_last.eventat") >= silent)).alias("is_open"))
                .where((F.col("duration_minutes") >= spec_column(specs, "min_duration", 1))
                       & (F.col("point_count") >= spec_column(specs, "min_points", 1))))
    kept = dict(zip(OPEN, ("session_start_time", "point_count", "_lat", "_lon")))
    after = (parts.where(F.col("_tail") & (F.col("_last.eventat") >= silent))
             .select("vendor", "vin", *[F.col(f"_last.{c}").alias(c) for c in ("eventat", *TIES)],
                     F.col("_last.is_charging_signal").alias("charging"),
                     *[F.when(going_on, F.col(c)).alias(name) for name, c in kept.items()]))
    return sessions, after.select(*[F.col(f.name).cast(f.dataType) for f in CARRY_SCHEMA.fields])
