import datetime as dt
import tempfile

from pyspark.sql import functions as F

from nightjar.operators import positions as pos
from nightjar.operators import state as st
from nightjar.plans.daily import JobConfig, run
from nightjar.sources import io, proxy
from nightjar.sources.vendors import PROXY_VENDORS, partition_days, partition_filter
from nightjar.streaming import incremental

SF = "/root/testdata/sf0.001"


def config(spark, root):
    tel_path = f"{root}/telemetry"
    incremental.land_partitioned(proxy.telemetry_proxy(proxy.read_table(spark, SF, "events")), tel_path)
    master = proxy.address_master_source(spark, SF)
    io.write_version(master, f"{root}/master", dt.date(2024, 1, 1))
    return JobConfig(
        telemetry=lambda s: incremental.read_partitioned(s, tel_path),
        specs=PROXY_VENDORS, state_root=f"{root}/state", master_root=f"{root}/master",
        report_root=f"{root}/report",
        loan_tables=lambda s: proxy.loan_tables(s, SF),
        loan_pairs=lambda s: proxy.loan_vehicle_pairs_source(s, SF),
        geocode_cache=lambda s: proxy.geocode_reference(s, SF)), tel_path


def test_two_daily_runs_chain_state_and_report(spark):
    root = tempfile.mkdtemp(prefix="nightjar-daily-")
    cfg, tel_path = config(spark, root)
    first = run(spark, dt.date(2024, 1, 30), cfg)
    assert "delta" not in first
    second = run(spark, dt.date(2024, 1, 31), cfg)
    # Incremental night state == previous version merged with the 2-day rescan.
    tel = incremental.read_partitioned(spark, tel_path)
    delta = pos.night_points(tel.where(partition_filter(partition_days(dt.date(2024, 1, 31), 1))), PROXY_VENDORS)
    expect = st.merge_night_state(first["night_state"], delta, dt.date(2024, 1, 31))
    got = second["night_state"].select(*expect.columns)
    assert got.exceptAll(expect).count() == 0 and expect.exceptAll(got).count() == 0
    rep = second["report"]
    assert rep.count() == rep.select("vin").distinct().count() > 0
    assert second["delta"].count() == 1
    assert io.latest_version(spark, f"{root}/state/night", dt.date(2024, 2, 1)) == dt.date(2024, 1, 31)
    csv = spark.read.option("header", True).csv(io.version_path(f"{root}/report/csv", dt.date(2024, 1, 31)))
    assert csv.count() == rep.count()


def test_scan_prunes_partitions(spark):
    root = tempfile.mkdtemp(prefix="nightjar-prune-")
    _, tel_path = config(spark, root)
    tel = incremental.read_partitioned(spark, tel_path)
    plan = tel.where(partition_filter(partition_days(dt.date(2024, 1, 31), 1)))._jdf.queryExecution() \
        .executedPlan().toString()
    assert "PartitionFilters" in plan and "day" in plan


def test_stream_trigger_runs_the_job_once_per_new_files(spark):
    root = tempfile.mkdtemp(prefix="nightjar-stream-")
    cfg, tel_path = config(spark, root)
    q = incremental.start(spark, tel_path, f"{root}/checkpoint", cfg)
    q.awaitTermination(600)
    assert io.latest_version(spark, f"{root}/report/table", dt.date(2030, 1, 1)) == dt.date(2024, 1, 31)


def test_report_csv_round_trip_and_master_column_check(spark):
    import pytest

    from nightjar.operators import report as rp
    root = tempfile.mkdtemp(prefix="nightjar-io-")
    cols = rp.REPORT_COLUMNS
    rows = [tuple("" if c not in rp.VISIT_SLOTS else 0 for c in cols)]
    schema = ", ".join(f"{c} {'int' if c in rp.VISIT_SLOTS else 'string'}" for c in cols)
    rep = spark.createDataFrame(rows, schema).withColumn("vin", F.lit("7")).withColumn("loan_no", F.lit("L7"))
    io.write_report_csv(rep, f"{root}/csv")
    back = io.read_report_csv(spark, f"{root}/csv").first()
    assert (back.vin, back.loan_no, back.last_night_location, back.charging_location_visits_1) == ("7", "L7", None, 0)
    assert rp.report_delta(rep, io.read_report_csv(spark, f"{root}/csv")).first().new_vehicles == 0
    spark.createDataFrame([("1", "L1")], "vin string, loan_no string").write.parquet(f"{root}/bad")
    with pytest.raises(ValueError):
        io.read_master(spark, f"{root}/bad")


def test_an_instant_is_worked_out_once_a_row(spark):
    """Filters and columns made of ``eventat`` share one computation; before,
    each had its own copy of the expression."""
    from nightjar.operators import charging as ch
    from nightjar.sources import proxy
    from nightjar.sources.vendors import PROXY_VENDORS

    events = spark.createDataFrame([], "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string")
    t = proxy.telemetry_proxy(events).where(ch.charging_scan_filter(PROXY_VENDORS, dt.date(2024, 1, 31), 60))
    plan = ch.charging_candidates(t, PROXY_VENDORS)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.lower().count("secondwithfraction") + plan.lower().count("extract(second") == 1
