"""Per-vehicle assembly, the daily fleet report, its delta and JSON form."""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from nightjar.functions.exprs import MOVE_THRESHOLD_M, haversine_m, maps_link, parse_pair
from nightjar.sources.vendors import VendorSpec, vendor_priority

LOCATION_SLOTS = ["night_location_1", "night_location_2", "night_location_3"]
CHARGING_SLOTS = ["charging_location_1", "charging_location_2", "charging_location_3"]
VISIT_SLOTS = ["charging_location_visits_1", "charging_location_visits_2", "charging_location_visits_3"]
VEHICLE_COLUMNS = (["last_night_location"] + LOCATION_SLOTS
                   + [c for pair in zip(CHARGING_SLOTS, VISIT_SLOTS) for c in pair])
REPORT_COLUMNS = ["loan_no", "vin", "last_night_location", *LOCATION_SLOTS, "current_address",
                  "charging_location_1", "charging_location_visits_1", "charging_location_2",
                  "charging_location_visits_2", "charging_location_3", "charging_location_visits_3"]
TEXT_COLUMNS = [c for c in REPORT_COLUMNS if c not in VISIT_SLOTS]


def vendor_vehicle(last: DataFrame, nights: DataFrame, charging: DataFrame,
                   specs: Sequence[VendorSpec]) -> DataFrame:
    """One row per vin. Per vendor: the vins of any of the three results,
    each of which has one row per vin, so one aggregate over their union
    brings the columns together. Across vendors a vin keeps the row of the
    first vendor in configuration order. Missing values stay NULL."""
    every = (last.unionByName(nights, allowMissingColumns=True)
                 .unionByName(charging, allowMissingColumns=True))
    v = every.groupBy("vendor", "vin").agg(*[F.max(c).alias(c) for c in VEHICLE_COLUMNS])
    v = v.withColumn("_prio", vendor_priority(specs))
    best = v.groupBy("vin").agg(F.min(F.struct("_prio", "vendor", *VEHICLE_COLUMNS)).alias("b"))
    return best.select("vin", F.col("b.vendor").alias("vendor"), *[F.col(f"b.{c}").alias(c) for c in VEHICLE_COLUMNS])


def current_address_text(lat: str = "current_lat", lng: str = "current_lng"):
    """The master's current coordinates as ``'(lat, lng)'`` text."""
    return F.when(F.col(lat).isNotNull() & F.col(lng).isNotNull(),
                  F.concat(F.lit("("), F.col(lat).cast("string"), F.lit(", "), F.col(lng).cast("string"),
                           F.lit(")")))


def vehicle_report(master: DataFrame, vehicles: DataFrame) -> DataFrame:
    """Deduplicated master (one row per vin) left-joined with the vehicle
    results; the 13 report columns, '' for missing text and 0 for missing
    visits. Ordering (last night, loan, vin descending) is applied by the
    sink, not here."""
    base = master.select("vin", "loan_no", current_address_text().alias("current_address"))
    j = base.join(vehicles.drop("vendor"), "vin", "left")
    cols = []
    for c in REPORT_COLUMNS:
        if c in VISIT_SLOTS:
            cols.append(F.coalesce(F.col(c), F.lit(0)).cast("int").alias(c))
        else:
            cols.append(F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c))
    return j.select(*cols)


def report_order(report: DataFrame) -> DataFrame:
    return report.orderBy(F.col("last_night_location").desc(), F.col("loan_no").desc(), F.col("vin").desc())


def _moved(today: str, prev: str):
    """Both texts present and parsable, and more than 100 m apart."""
    lat1, lon1, lat2, lon2 = parse_pair(today, 1), parse_pair(today, 2), parse_pair(prev, 1), parse_pair(prev, 2)
    ok = lat1.isNotNull() & lon1.isNotNull() & lat2.isNotNull() & lon2.isNotNull()
    both = (F.coalesce(F.col(today), F.lit("")) != "") & (F.coalesce(F.col(prev), F.lit("")) != "")
    return F.coalesce(both & ok & (haversine_m(lat1, lon1, lat2, lon2) > MOVE_THRESHOLD_M), F.lit(False))


DELTA_COLUMNS = ["last_night_location", *LOCATION_SLOTS, *CHARGING_SLOTS]


def _delta_counts(m: DataFrame) -> DataFrame:
    """The five counts over vehicles with ``{column}_today`` and
    ``{column}_prev``; ``_t`` and ``_p`` are set where the vehicle is in
    today's and in the previous report."""
    night_any = _moved("night_location_1_today", "night_location_1_prev")
    for c in LOCATION_SLOTS[1:]:
        night_any = night_any | _moved(f"{c}_today", f"{c}_prev")
    charge_any = _moved("charging_location_1_today", "charging_location_1_prev")
    for c in CHARGING_SLOTS[1:]:
        charge_any = charge_any | _moved(f"{c}_today", f"{c}_prev")
    first_charge = ((F.coalesce(F.col("charging_location_1_today"), F.lit("")) != "")
                    & (F.coalesce(F.col("charging_location_1_prev"), F.lit("")) == ""))
    # Vehicles with rows on both sides only; absent sides are empty.
    return m.agg(
        F.count_distinct(F.when(F.col("_t") & F.col("_p").isNull(), F.col("vin"))).alias("new_vehicles"),
        F.count_if(_moved("last_night_location_today", "last_night_location_prev")).alias("updated_last_night"),
        F.count_if(night_any).alias("updated_night_locations"),
        F.count_if(first_charge & F.col("_t")).alias("newly_charged"),
        F.count_if(charge_any).alias("updated_charging_locations"),
    )


def report_delta(today: DataFrame, previous: DataFrame) -> DataFrame:
    """One row of change counts between two reports joined on vin:
    new vehicles; moved last-night points; vehicles with any moved night
    slot; vehicles charging for the first time; vehicles with any moved
    charging slot. "Moved" is strictly more than 100 m."""
    t = today.select("vin", *[F.col(c).alias(f"{c}_today") for c in DELTA_COLUMNS]).withColumn("_t", F.lit(True))
    p = previous.select("vin", *[F.col(c).alias(f"{c}_prev") for c in DELTA_COLUMNS]).withColumn("_p", F.lit(True))
    return _delta_counts(t.join(p, "vin", "full"))


# --- changes from report to report -----------------------------------------------

PRINT = "row_print"


def with_prints(report: DataFrame) -> DataFrame:
    """The report columns, missing text as '' and missing visits as 0, and the
    row's fingerprint (SHA-256 of its columns by name)."""
    cols = [F.coalesce(F.col(c).cast("int"), F.lit(0)).alias(c) if c in VISIT_SLOTS
            else F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in REPORT_COLUMNS]
    return report.select(*cols).withColumn(PRINT, F.unhex(F.sha2(F.to_json(F.struct(*REPORT_COLUMNS)), 256)))


def report_changes(today: DataFrame, previous: DataFrame) -> DataFrame:
    """vin, change (insert, update or delete), columns (the names that
    differ), old and new (structs of the report columns).

    Both are reports ``with_prints`` (one row per vin), as a stored version
    is: vin and fingerprint alone are joined to find what changed, and only
    those rows are then read whole."""
    key = lambda a, b: F.col(a).eqNullSafe(F.col(b))
    t = today.select(F.col("vin").alias("t_vin"), F.col(PRINT).alias("t_print"))
    p = previous.select(F.col("vin").alias("p_vin"), F.col(PRINT).alias("p_print"))
    found = (t.join(p, key("t_vin", "p_vin"), "full").where(~F.col("t_print").eqNullSafe(F.col("p_print")))
             .select(F.when(F.col("p_print").isNull(), "insert").when(F.col("t_print").isNull(), "delete")
                     .otherwise("update").alias("change"),
                     F.when(F.col("t_print").isNull(), F.col("p_vin")).otherwise(F.col("t_vin")).alias("vin")))
    new = today.select(F.col("vin").alias("n_vin"), F.struct(*REPORT_COLUMNS).alias("new"))
    old = previous.select(F.col("vin").alias("o_vin"), F.struct(*REPORT_COLUMNS).alias("old"))
    both = found.join(new, key("vin", "n_vin"), "left").join(old, key("vin", "o_vin"), "left")
    differ = F.filter(F.array(*[F.when(~F.col(f"old.{c}").eqNullSafe(F.col(f"new.{c}")), c) for c in REPORT_COLUMNS]),
                      lambda c: c.isNotNull())
    return both.select("vin", "change", F.when(F.col("change") == "update", differ).otherwise(
        F.array(*map(F.lit, REPORT_COLUMNS))).alias("columns"), "old", "new")


def changes_delta(changes: DataFrame) -> DataFrame:
    """``report_delta`` of the two reports whose changes these are: vehicles
    that are alike in both count nowhere."""
    return _delta_counts(changes.select(
        "vin", F.when(F.col("new").isNotNull(), True).alias("_t"), F.when(F.col("old").isNotNull(), True).alias("_p"),
        *[F.col(f"new.{c}").alias(f"{c}_today") for c in DELTA_COLUMNS],
        *[F.col(f"old.{c}").alias(f"{c}_prev") for c in DELTA_COLUMNS]))


def apply_changes(previous: DataFrame, changes: DataFrame) -> DataFrame:
    """Today's report from the previous one and the changes since."""
    gone = changes.where("change <> 'insert'").select(F.col("vin").alias("_vin"))
    kept = previous.select(*REPORT_COLUMNS).join(gone, F.col("vin").eqNullSafe(F.col("_vin")), "left_anti")
    return kept.unionByName(changes.where("change <> 'delete'").select("new.*"))


def report_json(report: DataFrame) -> DataFrame:
    """The JSON record fields: location columns become map links ('' when
    not a valid 'lat, lng'); the current address loses its parentheses and
    blanks first; visit counts stay integers; other fields are text."""
    out = []
    for c in REPORT_COLUMNS:
        if c in VISIT_SLOTS:
            out.append(F.coalesce(F.col(c), F.lit(0)).cast("int").alias(c))
        elif c == "current_address":
            cleaned = F.regexp_replace(F.btrim(F.coalesce(F.col(c), F.lit("")), F.lit("()")), " ", "")
            out.append(maps_link(cleaned).alias(c))
        elif "location" in c:
            out.append(maps_link(F.col(c)).alias(c))
        else:
            out.append(F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c))
    return report.select(*out)


def report_json_text(report: DataFrame) -> DataFrame:
    """One JSON object per vehicle (JSON Lines), for the sink."""
    rec = report_json(report)
    return rec.select(F.to_json(F.struct(*REPORT_COLUMNS)).alias("value"))
