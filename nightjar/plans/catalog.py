"""The checked queries: each takes (spark, sf_dir) and returns a DataFrame.

Every query reads the driver's tables through the proxies in
``nightjar.sources.proxy`` and runs the engine's operators over all rows.
Averages are rounded half-even to 8 decimals in the outputs only, so that
two engines summing in different orders compare equal.
"""

from __future__ import annotations

from typing import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from nightjar.functions.exprs import round_half_even
from nightjar.operators import cells as ce
from nightjar.operators import charging as ch
from nightjar.operators import positions as pos
from nightjar.operators import spatial as sp
from nightjar.operators import state as st
from nightjar.operators.lineage import materialize, scratch_path
from nightjar.operators.reshape import pivot_top3
from nightjar.plans import fixture as fx
from nightjar.sources import io, proxy
from nightjar.sources.vendors import PROXY_VENDORS, partition_days, partition_filter

SPECS = PROXY_VENDORS
OUT_DECIMALS = 8


def _r(c: str) -> F.Column:
    return round_half_even(c, OUT_DECIMALS).alias(c)


def _rd(c: str) -> F.Column:
    """Exact decimal centroid -> half-even at 8 decimals -> double."""
    return F.bround(F.col(c), OUT_DECIMALS).cast("double").alias(c)


def telemetry(spark: SparkSession, sf_dir: str) -> DataFrame:
    return proxy.telemetry_proxy(proxy.read_table(spark, sf_dir, "events"))


def _night_points(spark, sf_dir, as_of, lookback, stationary=True) -> DataFrame:
    t = pos.scan_window(telemetry(spark, sf_dir), as_of, lookback)
    return pos.night_points(t, SPECS, stationary)


def night_state(spark, sf_dir) -> DataFrame:
    """First-run night state at ``AS_OF`` (61 days, retention 60)."""
    return st.night_retention(_night_points(spark, sf_dir, fx.AS_OF, fx.LOOKBACK), fx.AS_OF, 60)


def sessions(spark, sf_dir, as_of=fx.AS_OF, lookback=fx.LOOKBACK, with_metrics=False) -> DataFrame:
    t = telemetry(spark, sf_dir).where(ch.charging_scan_filter(SPECS, as_of, lookback))
    return ch.charging_sessions(t, SPECS, with_metrics)


def charging_state(spark, sf_dir) -> DataFrame:
    return st.charging_retention(sessions(spark, sf_dir), fx.AS_OF, 60)


# --- queries ---------------------------------------------------------------

def q_valid_positions(spark, sf_dir):
    raw = proxy.raw_positions_proxy(proxy.read_table(spark, sf_dir, "events"))
    return pos.valid_positions(raw, SPECS)


def _channels(spark, sf_dir):
    raw = proxy.raw_positions_proxy(proxy.read_table(spark, sf_dir, "events"))
    return io.write_positions(pos.judged_positions(raw, SPECS), scratch_path(spark, "positions"), fx.AS_OF)


def q_rejected_positions(spark, sf_dir):
    return _channels(spark, sf_dir)[1].select("vendor", "vin", "eventat", "location", "lat_text", "lon_text", "reason")


def q_position_counts(spark, sf_dir):
    """Rows by reason as observed while both channels are written, beside
    those that each channel holds."""
    kept, rejected, counts = _channels(spark, sf_dir)
    held = (kept.select(F.lit(pos.KEPT).alias("reason")).unionByName(rejected.select("reason"))
            .groupBy("reason").agg(F.count(F.lit(1)).alias("held")))
    return counts.join(held, "reason", "left").select("reason", "rows", F.coalesce("held", F.lit(0)).alias("held"))


def q_partition_window(spark, sf_dir):
    days = partition_days(fx.WINDOW_TRIAL_AS_OF, fx.WINDOW_TRIAL_LOOKBACK)
    return (telemetry(spark, sf_dir).where(partition_filter(days))
            .select("vendor", "vin", "eventat", "year", "month", "day"))


def q_stationary_points(spark, sf_dir):
    t = pos.scan_window(telemetry(spark, sf_dir), fx.AS_OF, fx.LOOKBACK)
    return (pos.stationary_points(t, SPECS)
            .select("vendor", "vin", "eventat", "latitude", "longitude", "odometer", "prev_odometer"))


def q_night_points(spark, sf_dir):
    return _night_points(spark, sf_dir, fx.AS_OF, fx.LOOKBACK)


def q_night_points_simple(spark, sf_dir):
    return _night_points(spark, sf_dir, fx.AS_OF, fx.LOOKBACK, stationary=False)


def q_last_night(spark, sf_dir):
    return pos.last_night(night_state(spark, sf_dir), fx.AS_OF)


def q_night_cells(spark, sf_dir):
    c = pos.night_cells(night_state(spark, sf_dir))
    return c.select("vendor", "vin", "grid_cell", "night_count", _rd("latitude"), _rd("longitude"), "rank")


def q_night_state_merge(spark, sf_dir):
    prev = _night_points(spark, sf_dir, fx.PREV_AS_OF, fx.LOOKBACK)
    new = _night_points(spark, sf_dir, fx.AS_OF, fx.INCREMENTAL_LOOKBACK)
    return st.merge_night_state(prev, new, fx.AS_OF, fx.RETENTION_TRIAL_DAYS)


def nights_by_log(spark, sf_dir) -> tuple[DataFrame, DataFrame]:
    """(night state, night cells) of a first run at ``PREV_AS_OF`` and the
    next day's incremental run, kept in bucketed logs."""
    from nightjar.plans.daily import JobConfig, add_nights

    root = scratch_path(spark, "log")
    cfg = JobConfig(telemetry=telemetry(spark, sf_dir), specs=SPECS, state_root=root, master_root=root,
                    report_root=root, state_buckets=fx.STATE_BUCKETS)
    add_nights(spark, fx.PREV_AS_OF, cfg)
    return add_nights(spark, fx.AS_OF, cfg)


def q_night_state_log(spark, sf_dir):
    return nights_by_log(spark, sf_dir)[0]


def q_night_cells_incremental(spark, sf_dir):
    c = ce.cell_counts(nights_by_log(spark, sf_dir)[1])
    return c.select("vendor", "vin", "grid_cell", "night_count", _rd("latitude"), _rd("longitude"), "rank")


def q_pivot_top3(spark, sf_dir):
    return pivot_top3(pos.night_cells(night_state(spark, sf_dir)), "night_location")


def q_charging_signal(spark, sf_dir):
    t = telemetry(spark, sf_dir).where(ch.charging_scan_filter(SPECS, fx.AS_OF, fx.LOOKBACK))
    return ch.charging_signal(t, SPECS).select(
        "vendor", "vin", "eventat", "soc", "prev_soc", "dte", "prev_dte", "odometer",
        "prev_odometer", "is_charging_signal")


def q_charging_sessions(spark, sf_dir):
    s = sessions(spark, sf_dir, with_metrics=True)
    return s.select("vendor", "vin", "session_start_time", _r("latitude"), _r("longitude"),
                    "point_count", "duration_minutes")


def q_charging_state_merge(spark, sf_dir):
    prev = sessions(spark, sf_dir, fx.PREV_AS_OF, fx.LOOKBACK)
    new = sessions(spark, sf_dir, fx.AS_OF, fx.INCREMENTAL_LOOKBACK)
    m = st.merge_charging_state(prev, new, fx.AS_OF, fx.RETENTION_TRIAL_DAYS)
    return m.select("vendor", "vin", "session_start_time", _r("latitude"), _r("longitude"))


def q_charging_sessions_carried(spark, sf_dir):
    """Charging state of runs on ``CARRY_RUNS``, each of which reads only the
    days since the run before and goes on with its open sessions."""
    from nightjar.plans.daily import JobConfig, carry_sessions

    root = scratch_path(spark, "carried")
    cfg = JobConfig(telemetry=telemetry(spark, sf_dir), specs=SPECS, state_root=root, master_root=root,
                    report_root=root, state_buckets=fx.STATE_BUCKETS)
    for day in fx.CARRY_RUNS:
        state = carry_sessions(spark, day, cfg)
    return state.select("vendor", "vin", "session_start_time", _r("latitude"), _r("longitude"))


def q_proximity_pairs(spark, sf_dir):
    return sp.proximity_edges(charging_state(spark, sf_dir))


def q_charging_clusters(spark, sf_dir):
    c = sp.charging_clusters(charging_state(spark, sf_dir))
    return c.select("vendor", "vin", "session_start_time", _r("latitude"), _r("longitude"),
                    "cluster", "cluster_anchor_start", "cluster_anchor_vin", "cluster_sessions")


def q_charging_clusters_incremental(spark, sf_dir):
    """Clusters of runs on ``CLUSTER_RUNS`` with a short history, each made
    from the run before, its new sessions and those that left the history."""
    from nightjar.plans.daily import JobConfig, add_sessions, kept_clusters

    root = scratch_path(spark, "clusters")
    cfg = JobConfig(telemetry=telemetry(spark, sf_dir), specs=SPECS, state_root=root, master_root=root, report_root=root,
                    history_days=fx.RETENTION_TRIAL_DAYS, state_buckets=fx.STATE_BUCKETS, cluster_state=True)
    for day in fx.CLUSTER_RUNS:
        state = add_sessions(spark, day, cfg)
    c = kept_clusters(spark, fx.AS_OF, cfg, state)
    return c.select("vendor", "vin", "session_start_time", _r("latitude"), _r("longitude"),
                    "cluster", "cluster_anchor_start", "cluster_anchor_vin", "cluster_sessions")


def q_charging_places(spark, sf_dir):
    p = sp.charging_places(sp.charging_clusters(charging_state(spark, sf_dir)))
    return p.select("vendor", "vin", "cluster", _rd("latitude"), _rd("longitude"), "visits",
                    "first_visit", "rank")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "valid_positions": q_valid_positions,
    "rejected_positions": q_rejected_positions,
    "position_counts": q_position_counts,
    "partition_window": q_partition_window,
    "stationary_points": q_stationary_points,
    "night_points": q_night_points,
    "night_points_simple": q_night_points_simple,
    "last_night": q_last_night,
    "night_cells": q_night_cells,
    "night_state_merge": q_night_state_merge,
    "night_state_log": q_night_state_log,
    "night_cells_incremental": q_night_cells_incremental,
    "pivot_top3": q_pivot_top3,
    "charging_signal": q_charging_signal,
    "charging_sessions": q_charging_sessions,
    "charging_state_merge": q_charging_state_merge,
    "charging_sessions_carried": q_charging_sessions_carried,
    "proximity_pairs": q_proximity_pairs,
    "charging_clusters": q_charging_clusters,
    "charging_clusters_incremental": q_charging_clusters_incremental,
    "charging_places": q_charging_places,
}


# --- address side ------------------------------------------------------------

from nightjar.operators import address as ad  # noqa: E402

DATE_COLUMNS = ("dob", "soft_check_date", "loan_approval_date", "disbursal_date", "downpayment_date",
                "pre_emi_date", "emi_start_date")


def profile(spark, sf_dir) -> DataFrame:
    return ad.loan_profile(proxy.loan_tables(spark, sf_dir))


def pairs(spark, sf_dir) -> DataFrame:
    return ad.loan_vehicle_pairs(proxy.loan_vehicle_pairs_source(spark, sf_dir))


def worklist(spark, sf_dir) -> DataFrame:
    return ad.address_worklist(proxy.address_master_source(spark, sf_dir), pairs(spark, sf_dir))


def composed(spark, sf_dir) -> DataFrame:
    work = materialize(worklist(spark, sf_dir), "worklist")
    return materialize(ad.address_compose(work, ad.loan_profile(proxy.loan_tables(spark, sf_dir), loans=work)),
                       "composed")


def geocoded(spark, sf_dir) -> DataFrame:
    return ad.geocode_lookup(composed(spark, sf_dir), proxy.geocode_reference(spark, sf_dir))


def merged_master(spark, sf_dir) -> DataFrame:
    return ad.address_master_merge(proxy.address_master_source(spark, sf_dir), geocoded(spark, sf_dir),
                                   fx.BATCH_SEQ)


def q_loan_vehicle_pairs(spark, sf_dir):
    return pairs(spark, sf_dir)


# Integer columns that can be NULL are returned as DOUBLE by the checked
# queries, so both engines hand pandas the same NaN for a missing value.
NULLABLE_INTS = ("business_stability", "residence_stability", "vehicle_active_status",
                 "charging_location_visits_1", "charging_location_visits_2", "charging_location_visits_3")


def _as_checked(df: DataFrame) -> DataFrame:
    return df.select(*[F.col(c).cast("double").alias(c) if c in NULLABLE_INTS else F.col(c)
                       for c in df.columns])


def q_loan_role_address(spark, sf_dir):
    tables = proxy.loan_tables(spark, sf_dir)
    out = None
    for profile_type, address_type in (("APPLICANT", "OFFICE"), ("APPLICANT", "PERMANENT_RESIDENCE"),
                                       ("GURANTOR", "CURRENT_RESIDENCE"), ("CO_APPLICANT", "CURRENT_RESIDENCE")):
        r = ad.role_address(tables, profile_type, address_type, with_stability=True).select(
            F.lit(f"{profile_type} {address_type}").alias("role"), "*")
        out = r if out is None else out.unionByName(r)
    return _as_checked(out)


def q_loan_profile(spark, sf_dir):
    p = profile(spark, sf_dir)
    return _as_checked(p.select(*[F.col(c).cast("string").alias(c) if c in DATE_COLUMNS else F.col(c)
                                  for c in p.columns]))


def q_address_worklist(spark, sf_dir):
    return worklist(spark, sf_dir)


def q_address_compose(spark, sf_dir):
    return composed(spark, sf_dir)


def q_geocode_lookup(spark, sf_dir):
    return geocoded(spark, sf_dir)


def q_address_master_merge(spark, sf_dir):
    return merged_master(spark, sf_dir)


def q_master_dedup(spark, sf_dir):
    m = merged_master(spark, sf_dir)
    dup = m.select("vin", F.concat(F.col("loan_no"), F.lit("-B")).alias("loan_no"), "current_lat", "current_lng",
                   "permanent_lat", "permanent_lng",
                   (F.col("ingest_seq") + F.lit(fx.DUPLICATE_SEQ_OFFSET)).alias("ingest_seq"))
    return ad.master_dedup(m.unionByName(dup))


QUERIES.update({
    "loan_vehicle_pairs": q_loan_vehicle_pairs,
    "loan_role_address": q_loan_role_address,
    "loan_profile": q_loan_profile,
    "address_worklist": q_address_worklist,
    "address_compose": q_address_compose,
    "geocode_lookup": q_geocode_lookup,
    "address_master_merge": q_address_master_merge,
    "master_dedup": q_master_dedup,
})


# --- report side ---------------------------------------------------------------

from nightjar.operators import report as rp  # noqa: E402


def vehicles_at(spark, sf_dir, as_of) -> DataFrame:
    """Per-vin telemetry results of a first run at ``as_of`` (one row per
    vehicle), written once so that reports join two small tables instead of
    re-planning both pipelines."""
    tel = telemetry(spark, sf_dir)
    nstate = materialize(st.night_retention(
        pos.night_points(pos.scan_window(tel, as_of, fx.LOOKBACK), SPECS), as_of, 60), "night")
    last = pos.last_night(nstate, as_of)
    nights = pivot_top3(pos.night_cells(nstate), "night_location")
    cstate = st.charging_retention(sessions(spark, sf_dir, as_of, fx.LOOKBACK), as_of, 60)
    places = sp.charging_places(sp.charging_clusters(cstate))
    charging = pivot_top3(places, "charging_location", include_visits=True)
    return materialize(rp.vendor_vehicle(last, nights, charging, SPECS), "vehicles")


def report_master(spark, sf_dir) -> DataFrame:
    return materialize(ad.master_dedup(merged_master(spark, sf_dir)), "master")


def report_at(spark, sf_dir, as_of, master: DataFrame | None = None) -> DataFrame:
    master = master if master is not None else report_master(spark, sf_dir)
    return rp.vehicle_report(master, vehicles_at(spark, sf_dir, as_of))


def q_vendor_vehicle(spark, sf_dir):
    return _as_checked(vehicles_at(spark, sf_dir, fx.AS_OF))


def q_vehicle_report(spark, sf_dir):
    return report_at(spark, sf_dir, fx.AS_OF)


def _two_reports(spark, sf_dir) -> tuple[DataFrame, DataFrame]:
    master = report_master(spark, sf_dir)
    # The report compared with is older and has a smaller master.
    before = master.where(F.col("vin").cast("long") % fx.DELTA_MASTER_STEP != 0)
    return report_at(spark, sf_dir, fx.AS_OF, master), report_at(spark, sf_dir, fx.DELTA_AS_OF, before)


def q_report_delta(spark, sf_dir):
    return rp.report_delta(*_two_reports(spark, sf_dir))


def q_report_changes(spark, sf_dir):
    today, previous = (materialize(rp.with_prints(r), "prints") for r in _two_reports(spark, sf_dir))
    changes = rp.report_changes(today, previous)
    side = lambda s: [F.col(f"{s}.{c}").cast("double" if c in NULLABLE_INTS else "string").alias(f"{s}_{c}")
                      for c in rp.REPORT_COLUMNS if c != "vin"]
    return changes.select("vin", "change", F.array_join("columns", ",").alias("columns"), *side("old"), *side("new"))


def q_report_json(spark, sf_dir):
    return rp.report_json(report_at(spark, sf_dir, fx.AS_OF))


QUERIES.update({
    "vendor_vehicle": q_vendor_vehicle,
    "vehicle_report": q_vehicle_report,
    "report_delta": q_report_delta,
    "report_changes": q_report_changes,
    "report_json": q_report_json,
})
