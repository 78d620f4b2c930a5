"""The daily fleet location job as one Spark application.

``run(spark, as_of, config)`` reads each vendor's telemetry table, the
previous state versions, the address master and the loan sources, and
writes new versions of the states, the master and the report. One plan
serves all vendors (``vendor`` leads every key), replacing a thread per
vendor.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass
from typing import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from nightjar.functions.exprs import MS_PER_DAY
from nightjar.operators import address as ad
from nightjar.operators import cells as ce
from nightjar.operators import charging as ch
from nightjar.operators import cluster_state as cs
from nightjar.operators import open_sessions as op
from nightjar.operators import positions as pos
from nightjar.operators import report as rp
from nightjar.operators import spatial as sp
from nightjar.operators import state as st
from nightjar.operators.reshape import pivot_top3
from nightjar.operators.lineage import materialize, release_written, written_mark
from nightjar.sources import io
from nightjar.sources.bucketed import BucketedLog
from nightjar.sources.vendors import VendorSpec, partition_days, partition_filter

HISTORY_DAYS = 60
INCREMENTAL_DAYS = 1      # days before as_of that a run rescans at least


@dataclass
class JobConfig:
    telemetry: DataFrame | Callable[[SparkSession], DataFrame]   # canonical telemetry
    specs: Sequence[VendorSpec]
    state_root: str
    master_root: str
    report_root: str
    loan_tables: Callable[[SparkSession], dict] | None = None
    loan_pairs: Callable[[SparkSession], DataFrame] | None = None
    geocode_cache: Callable[[SparkSession], DataFrame] | None = None
    geocode_enrich: Callable | None = None
    geocode_root: str | None = None          # answers are kept here from run to run
    history_days: int = HISTORY_DAYS
    state_buckets: int | None = None         # keep states as bucketed logs of this many files a run
    carry_sessions: bool = False             # sessions go on over midnight (needs state_buckets)
    cluster_state: bool = False              # clusters go on from run to run (needs state_buckets, no carry_sessions)
    previous_report_csv: str | None = None   # compare against this CSV instead of the last version


def _telemetry(spark, cfg) -> DataFrame:
    return cfg.telemetry(spark) if callable(cfg.telemetry) else cfg.telemetry


def _lookback(as_of: dt.date, version: dt.date | None, since: dt.date | None, history: int) -> int:
    """Days before ``as_of`` to rescan on top of the state of ``version``: back
    to that version's own day, so that a gap between runs loses nothing, and
    back to the day before ``since`` if older days were delivered."""
    days = INCREMENTAL_DAYS
    if version is not None:
        days = max(days, (as_of - version).days)
    if since is not None:
        days = max(days, (as_of - since).days + 1)
    return min(days, history)


def _scan(specs, as_of, with_state: set[str], lookback: int, history: int, charging: bool):
    """Partition predicate: vendors with state read as_of and ``lookback``
    days before, others the whole history; for charging, ``charging_days``
    vendors read only the days before as_of, that many or, after a gap, all
    since the state."""
    clauses = []
    for s in specs:
        if charging and not s.charging:
            continue
        if charging and s.charging_days is not None:
            back = max(s.charging_days, lookback if s.name in with_state else 0)
            days = [as_of - dt.timedelta(days=i) for i in range(1, back + 1)]
        else:
            days = partition_days(as_of, lookback if s.name in with_state else history)
        clauses.append((F.col("vendor") == s.name) & partition_filter(days))
    out = F.lit(False)
    for c in clauses:
        out = out | c
    return out


def _vendors_in(df: DataFrame | None) -> set[str]:
    if df is None:
        return set()
    return {r[0] for r in df.select("vendor").distinct().collect()}   # at most one row per vendor


def run(spark: SparkSession, as_of: dt.date, cfg: JobConfig, since: dt.date | None = None) -> dict[str, DataFrame]:
    """One daily run; every output is written before this returns, then the
    scratch tables are deleted (the returned frames read only the written
    versions). ``since`` is the oldest day of which new rows arrived; days
    back to it are rescanned even if the state is newer. States are written
    last, so a failed run leaves no state without its report."""
    written = written_mark()
    try:
        return _run(spark, as_of, cfg, since)
    finally:
        release_written(written)


def state_logs(spark: SparkSession, cfg: JobConfig) -> tuple[BucketedLog, BucketedLog, BucketedLog]:
    """The bucketed logs of night points, night cells and charging sessions."""
    make = lambda name, columns: BucketedLog(spark, f"{cfg.state_root}/{name}", columns, cfg.state_buckets)
    return (make("night_log", "vendor STRING, vin STRING, eventat BIGINT, latitude DOUBLE, longitude DOUBLE"),
            make("cell_log", ce.CELL_COLUMNS),
            make("charging_log", "vendor STRING, vin STRING, session_start_time BIGINT, latitude DOUBLE, longitude DOUBLE"))


def live(log: BucketedLog, before: dt.date, as_of: dt.date, history: int) -> DataFrame:
    """Rows of the finished runs before a date that ``as_of``'s history may
    hold: runs before its first day have none."""
    return log.read([d for d in log.finished(before) if (as_of - d).days <= history])


def _known(log: BucketedLog, found: DataFrame, order: str, as_of: dt.date) -> DataFrame:
    """Rows of the log that can have the key of a row of ``found``: those of
    runs since its oldest row, as no row is dated after its run."""
    oldest = found.agg(F.min(order)).first()[0]
    if oldest is None:
        return log.read([])
    day = dt.date(1970, 1, 1) + dt.timedelta(days=oldest // MS_PER_DAY)
    return log.read([d for d in log.finished(as_of) if d >= day]).where(F.col(order) >= oldest)


def add_nights(spark: SparkSession, as_of: dt.date, cfg: JobConfig, since: dt.date | None = None) -> tuple[DataFrame, DataFrame]:
    """(night state, night cells) after adding the run's new night points to
    their log and its new nights to the cells."""
    points, cells, _ = state_logs(spark, cfg)
    history, done = cfg.history_days, points.finished(as_of)
    back = _lookback(as_of, done[-1] if done else None, since, history)
    have = _vendors_in(live(points, as_of, as_of, history))
    scan = _telemetry(spark, cfg).where(_scan(cfg.specs, as_of, have, back, history, False))
    found = materialize(st.night_retention(pos.night_points(scan, cfg.specs), as_of, history), "night-found")
    added = materialize(st.added_rows(_known(points, found, "eventat", as_of), found, "eventat", st.NIGHT_COLUMNS),
                        "night-added")
    points.write(as_of, points.dealt(added))
    fresh = ce.new_cells(added, as_of, history)
    # The cells of the last run whose points are finished too.
    if done and (as_of - done[-1]).days <= history:
        kept, fresh = ce.merged_cells(ce.aged(cells.read(done[-1:]), done[-1], as_of, history), fresh)
        cells.write(as_of, kept, cells.dealt(fresh))
    else:
        cells.write(as_of, cells.dealt(fresh))
    cells.finish(as_of)
    points.finish(as_of)
    rows = live(points, as_of + dt.timedelta(days=1), as_of, history)
    return st.night_retention(rows.select(*st.NIGHT_COLUMNS), as_of, history), cells.read([as_of])


def add_sessions(spark: SparkSession, as_of: dt.date, cfg: JobConfig, since: dt.date | None = None) -> DataFrame:
    """Charging state after adding the run's new sessions to their log."""
    log = state_logs(spark, cfg)[2]
    history, done = cfg.history_days, log.finished(as_of)
    back = _lookback(as_of, done[-1] if done else None, since, history)
    have = _vendors_in(live(log, as_of, as_of, history))
    scan = _telemetry(spark, cfg).where(_scan(cfg.specs, as_of, have, back, history, True))
    found = materialize(st.charging_retention(ch.charging_sessions(scan, cfg.specs), as_of, history), "charging-found")
    order = "session_start_time"
    log.write(as_of, log.dealt(st.added_rows(_known(log, found, order, as_of), found, order, st.CHARGING_COLUMNS)))
    io.drop_versions(spark, f"{cfg.state_root}/clusters", as_of)
    if cfg.cluster_state:
        update_clusters(spark, as_of, cfg, log)
    log.finish(as_of)
    rows = live(log, as_of + dt.timedelta(days=1), as_of, history)
    return st.charging_retention(rows.select(*st.CHARGING_COLUMNS), as_of, history)


def _clusters_at(spark: SparkSession, cfg: JobConfig, as_of: dt.date) -> cs.Clusters:
    path = io.version_path(f"{cfg.state_root}/clusters", as_of)
    return cs.Clusters(**{name: spark.read.schema(schema).parquet(f"{path}/{name}") for name, schema in cs.SCHEMAS.items()})


def update_clusters(spark: SparkSession, as_of: dt.date, cfg: JobConfig, log: BucketedLog) -> cs.Clusters:
    """The run's version of the cluster state, from the newest one of a
    finished run and the sessions that the log got since. It is written before
    the log's run is finished, so a finished run's version was made from its
    rows; a run that is done again drops its version and later ones."""
    root, history = f"{cfg.state_root}/clusters", cfg.history_days
    since = ((as_of - dt.date(1970, 1, 1)).days - history) * MS_PER_DAY
    path = io.version_path(root, as_of)

    def keep(df: DataFrame, name: str) -> DataFrame:
        df.write.mode("overwrite").parquet(f"{path}/{name}")
        return spark.read.schema(cs.SCHEMAS[name]).parquet(f"{path}/{name}")

    done = [d for d in log.finished(as_of) if (as_of - d).days <= history]
    based = [d for d in done if io.is_written(spark, f"{io.version_path(root, d)}/labels")]
    if not based:
        return cs.first_clusters(log.read([*done, as_of]).select(*st.CHARGING_COLUMNS), since, keep)
    added = log.read([d for d in done if d > based[-1]] + [as_of]).select(*st.CHARGING_COLUMNS)
    return cs.next_clusters(_clusters_at(spark, cfg, based[-1]), added, since, keep)


def kept_clusters(spark: SparkSession, as_of: dt.date, cfg: JobConfig, sessions: DataFrame) -> DataFrame:
    """``charging_clusters`` of the run's charging state, by its cluster state."""
    return cs.clustered_sessions(sessions, _clusters_at(spark, cfg, as_of).labels)


def carry_sessions(spark: SparkSession, as_of: dt.date, cfg: JobConfig, since: dt.date | None = None) -> DataFrame:
    """Charging state after a run that takes up the open sessions of the run
    before: the sessions that ended go to the log, those still open are in the
    returned state only. With ``since`` the runs that read that day are
    forgotten and their days read again."""
    log = BucketedLog(spark, f"{cfg.state_root}/carried_log", "vendor STRING, vin STRING, session_start_time BIGINT, "
                      "latitude DOUBLE, longitude DOUBLE", cfg.state_buckets)
    root, history = f"{cfg.state_root}/charging_carry", cfg.history_days
    done = [d for d in log.finished(as_of) if (since is None or d < since) and (as_of - d).days <= history]
    base = done[-1] if done else None
    carry = None if base is None else spark.read.schema(op.CARRY_SCHEMA).parquet(io.version_path(root, base))
    have, first = _vendors_in(carry), as_of - dt.timedelta(days=history)
    days = F.lit(False)
    for s in cfg.specs:
        if s.charging:
            # A vendor with ``charging_days`` is read up to the day before the run.
            late = dt.timedelta(days=0 if s.charging_days is None else 1)
            lo = first if s.charging_days is None else as_of - dt.timedelta(days=s.charging_days)
            lo = base + dt.timedelta(days=1) - late if s.name in have else lo
            days = days | ((F.col("vendor") == s.name)
                           & partition_filter(partition_days(as_of - late, (as_of - late - lo).days)))
    sessions, after = op.advance(_telemetry(spark, cfg).where(days), carry, cfg.specs, first)
    log.forget(as_of if base is None and since is None else (base or dt.date.min) + dt.timedelta(days=1))
    ended = st.charging_retention(sessions.where("NOT is_open"), as_of, history)
    log.write(as_of, log.dealt(ended.select(*st.CHARGING_COLUMNS)))
    io.write_version(after, root, as_of)
    log.finish(as_of)
    rows = live(log, as_of + dt.timedelta(days=1), as_of, history).select(*st.CHARGING_COLUMNS)
    return st.charging_retention(rows.unionByName(sessions.where("is_open").select(*st.CHARGING_COLUMNS)), as_of, history)


def _run(spark: SparkSession, as_of: dt.date, cfg: JobConfig, since: dt.date | None) -> dict[str, DataFrame]:
    specs = cfg.specs
    if cfg.cluster_state and (cfg.carry_sessions or not cfg.state_buckets):
        raise ValueError("cluster_state needs state_buckets, and open sessions, which still move, cannot be kept in it")
    tel = _telemetry(spark, cfg)
    night_root, charge_root = f"{cfg.state_root}/night", f"{cfg.state_root}/charging"

    if cfg.state_buckets:
        night_state, cells = add_nights(spark, as_of, cfg, since)
        charge_state = (carry_sessions if cfg.carry_sessions else add_sessions)(spark, as_of, cfg, since)
        nights = pivot_top3(ce.cell_counts(cells), "night_location")
    else:
        prev_night = io.read_version(spark, night_root, as_of, io.NIGHT_STATE_SCHEMA)
        back = _lookback(as_of, io.latest_version(spark, night_root, as_of), since, cfg.history_days)
        night_new = pos.night_points(
            tel.where(_scan(specs, as_of, _vendors_in(prev_night), back, cfg.history_days, False)), specs)
        night_state = materialize(
            st.merge_night_state(prev_night, night_new, as_of, cfg.history_days).select(*io.NIGHT_STATE_SCHEMA.names),
            "night")

        prev_charge = io.read_version(spark, charge_root, as_of, io.CHARGING_STATE_SCHEMA)
        back = _lookback(as_of, io.latest_version(spark, charge_root, as_of), since, cfg.history_days)
        sessions = ch.charging_sessions(
            tel.where(_scan(specs, as_of, _vendors_in(prev_charge), back, cfg.history_days, True)), specs)
        charge_state = materialize(
            st.merge_charging_state(prev_charge, sessions, as_of, cfg.history_days)
              .select(*io.CHARGING_STATE_SCHEMA.names), "charging")
        nights = pivot_top3(pos.night_cells(night_state), "night_location")

    last = pos.last_night(night_state, as_of)
    clusters = kept_clusters(spark, as_of, cfg, charge_state) if cfg.cluster_state else sp.charging_clusters(charge_state)
    places = sp.charging_places(clusters)
    charging = pivot_top3(places, "charging_location", include_visits=True)
    vehicles = rp.vendor_vehicle(last, nights, charging, specs)

    counts: dict[str, int] = {}              # observed while the outputs are written
    master = update_master(spark, as_of, cfg, counts)
    report = io.write_version(rp.vehicle_report(ad.master_dedup(master), vehicles),
                              f"{cfg.report_root}/table", as_of, (), counts, "report")
    io.write_report_csv(report, io.version_path(f"{cfg.report_root}/csv", as_of))
    io.write_report_json(report, io.version_path(f"{cfg.report_root}/json", as_of))

    out = {"master": master, "report": report}
    if cfg.previous_report_csv:
        previous = io.read_report_csv(spark, cfg.previous_report_csv)
    else:
        previous = io.read_version(spark, f"{cfg.report_root}/table", as_of, report.schema)
    if previous is not None:
        changes = rp.report_changes(rp.with_prints(report), rp.with_prints(previous))
        out["changes"] = io.write_version(changes, f"{cfg.report_root}/changes", as_of, (), counts, "changes")
        out["delta"] = io.write_version(rp.changes_delta(out["changes"]), f"{cfg.report_root}/delta", as_of)
    if cfg.state_buckets:
        # The log has no single write of the whole state to observe.
        for name, rows in (("night_state", night_state), ("charging_state", charge_state)):
            out[name], counts[name] = rows, rows.count()
    else:
        for name, rows, root in (("night_state", night_state, night_root), ("charging_state", charge_state, charge_root)):
            out[name] = io.write_version(rows, root, as_of, ("vendor",), counts, name)
    out["counts"] = io.write_version(spark.createDataFrame(sorted(counts.items()), "name string, rows long"),
                                     f"{cfg.report_root}/counts", as_of)
    return out


def update_master(spark: SparkSession, as_of: dt.date, cfg: JobConfig, counts: dict | None = None) -> DataFrame:
    """Geocode the work list (incomplete rows and new loan/vehicle pairs)
    and write the next master version; without loan sources the previous
    master is carried over unchanged."""
    version = io.latest_version(spark, cfg.master_root, as_of)
    if version is None:
        master = spark.createDataFrame([], io.MASTER_SCHEMA)
    else:
        master = io.read_master(spark, io.version_path(cfg.master_root, version))
    if cfg.loan_tables is None or cfg.loan_pairs is None:
        return io.write_version(master, cfg.master_root, as_of, (), counts, "master")
    work = materialize(ad.address_worklist(master, ad.loan_vehicle_pairs(cfg.loan_pairs(spark))), "worklist")
    profile = ad.loan_profile(cfg.loan_tables(spark), loans=work)
    composed = materialize(ad.address_compose(work, profile), "composed")
    cache = cfg.geocode_cache(spark) if cfg.geocode_cache else spark.createDataFrame([], ad.GEOCODE_SCHEMA)
    kept = io.read_version(spark, cfg.geocode_root, as_of, ad.GEOCODE_SCHEMA) if cfg.geocode_root else None
    if kept is not None:
        cache = cache.select(*ad.GEOCODE_SCHEMA.names).unionByName(kept)
    answers = materialize(ad.geocode(ad.composed_addresses(composed), cache, cfg.geocode_enrich), "geocodes")
    if cfg.geocode_root:
        # Only answers are kept: a miss is asked again by the next run.
        found = answers.where("status = 'ok'").select(*ad.GEOCODE_SCHEMA.names)
        if kept is not None:
            found = found.unionByName(kept.join(found.select("address"), "address", "left_anti"))
        io.write_version(found, cfg.geocode_root, as_of)
    geocoded = ad.attach_coordinates(composed, answers)
    seq = (as_of - dt.date(1970, 1, 1)).days * 4_294_967_296
    merged = ad.address_master_merge(master, geocoded, seq)
    return io.write_version(merged, cfg.master_root, as_of, (), counts, "master")
