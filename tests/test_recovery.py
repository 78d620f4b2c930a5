"""State that survives: gaps, late deliveries, empty and unfinished versions."""

import datetime as dt
import os
import tempfile

import pytest

from helpers import ms, row, telemetry
from nightjar.functions.exprs import number
from nightjar.operators import charging as ch
from nightjar.operators import positions as pos
from nightjar.operators import report as rp
from nightjar.operators.address import incomplete
from nightjar.plans.daily import JobConfig, _lookback, run
from nightjar.sources import io
from nightjar.sources.vendors import VendorSpec
from nightjar.streaming import incremental

SPEC = (VendorSpec("a", use_dte=False),)


def nights(spark, days):
    rows = []
    for d in days:
        day = dt.date(2024, 1, d)
        rows += [row("a", "1", ms(day, 1)), row("a", "1", ms(day, 2))]
    return telemetry(spark, rows)


def config(root):
    return JobConfig(telemetry=lambda s: incremental.read_partitioned(s, f"{root}/tel"), specs=SPEC,
                     state_root=f"{root}/state", master_root=f"{root}/master", report_root=f"{root}/report")


def state_days(df):
    return sorted({r.event_date.day for r in pos.with_event_date(df).select("event_date").collect()})


def test_lookback_reaches_back_to_the_state_and_to_late_days():
    day = dt.date(2024, 1, 11)
    assert _lookback(day, dt.date(2024, 1, 10), None, 60) == 1
    assert _lookback(day, dt.date(2024, 1, 5), None, 60) == 6
    assert _lookback(day, dt.date(2024, 1, 10), dt.date(2024, 1, 3), 60) == 9
    assert _lookback(day, dt.date(2023, 1, 1), None, 60) == 60


def test_a_gap_of_six_days_loses_no_night_and_an_empty_state_is_read_back(spark):
    root = tempfile.mkdtemp(prefix="nightjar-gap-")
    incremental.land_partitioned(nights(spark, range(1, 12)), f"{root}/tel")
    run(spark, dt.date(2024, 1, 5), config(root))
    out = run(spark, dt.date(2024, 1, 11), config(root))
    assert state_days(out["night_state"]) == list(range(1, 12))
    # No charging session at all: the empty version exists and is the newest.
    assert out["charging_state"].count() == 0
    assert io.latest_version(spark, f"{root}/state/charging", dt.date(2024, 2, 1)) == dt.date(2024, 1, 11)
    assert {r.name: r.rows for r in out["counts"].collect()}["night_state"] == 11


def test_a_delivery_of_six_days_and_a_late_day_reach_the_state(spark):
    root = tempfile.mkdtemp(prefix="nightjar-late-")
    incremental.land_partitioned(nights(spark, [1, 2, 4]), f"{root}/tel")
    incremental.start(spark, f"{root}/tel", f"{root}/cp", config(root)).awaitTermination(300)
    incremental.land_partitioned(nights(spark, [5, 6, 7, 8, 9, 10]), f"{root}/tel")
    incremental.start(spark, f"{root}/tel", f"{root}/cp", config(root)).awaitTermination(300)
    incremental.land_partitioned(nights(spark, [3]), f"{root}/tel")
    incremental.start(spark, f"{root}/tel", f"{root}/cp", config(root)).awaitTermination(300)
    state = io.read_version(spark, f"{root}/state/night", dt.date(2024, 2, 1), io.NIGHT_STATE_SCHEMA)
    assert state_days(state) == list(range(1, 11))


def test_versions_without_success_do_not_count_and_types_are_not_guessed(spark):
    root = tempfile.mkdtemp(prefix="nightjar-version-")
    assert io.latest_version(spark, f"{root}/none", dt.date(2024, 2, 1)) is None
    df = spark.createDataFrame([("7", "L")], "vin string, loan_no string")
    spark.conf.set("spark.sql.sources.partitionColumnTypeInference.enabled", "true")
    try:
        io.write_version(df, root, dt.date(2024, 1, 1))
        io.write_version(df, root, dt.date(2024, 1, 2))
        os.remove(f"{root}/run_date=2024-01-02/_SUCCESS")
        assert io.latest_version(spark, root, dt.date(2024, 2, 1)) == dt.date(2024, 1, 1)
        assert io.read_version(spark, root, dt.date(2024, 2, 1), df.schema).first().vin == "7"
    finally:
        spark.conf.set("spark.sql.sources.partitionColumnTypeInference.enabled", "false")


def test_motion_clause_of_charging_holds_without_an_odometer(spark):
    spec = (VendorSpec("a", has_odometer=False, motion_filter=True, use_soc=True),)
    day = dt.date(2024, 1, 10)
    tel = telemetry(spark, [row("a", "1", ms(day, 1), motion=False), row("a", "1", ms(day, 2))])
    assert ch.charging_candidates(tel, spec).count() == 1


def test_numbers_with_type_suffixes_are_no_numbers(spark):
    df = spark.createDataFrame([("12.5",), ("12.5d",), ("12f",), (" -3e2 ",), ("",), (None,)], "t string")
    assert [r[0] for r in df.select(number("t")).collect()] == [12.5, None, None, -300.0, None, None]


def test_nan_counts_as_a_missing_coordinate(spark):
    nan = float("nan")
    df = spark.createDataFrame([(1.0, 1.0, 1.0, 1.0), (nan, 1.0, 1.0, 1.0), (1.0, None, 1.0, 1.0)],
                               "current_lat double, current_lng double, permanent_lat double, permanent_lng double")
    assert [r[0] for r in df.select(incomplete(df)).collect()] == [False, True, True]


def test_report_order_of_the_csv(spark):
    root = tempfile.mkdtemp(prefix="nightjar-order-")
    cols = rp.REPORT_COLUMNS
    rows = [tuple(0 if c in rp.VISIT_SLOTS else {"vin": v, "loan_no": n, "last_night_location": s}.get(c, "")
                  for c in cols) for s, n, v in [("9, 1", "L1", "1"), ("10, 1", "L2", "2"), ("9, 1", "L1", "3")]]
    schema = ", ".join(f"{c} {'int' if c in rp.VISIT_SLOTS else 'string'}" for c in cols)
    io.write_report_csv(spark.createDataFrame(rows, schema).coalesce(1), f"{root}/csv")
    got = [r.vin for r in io.read_report_csv(spark, f"{root}/csv").coalesce(1).collect()]
    assert sorted(got) == ["1", "2", "3"]
    files = sorted(f for f in os.listdir(f"{root}/csv") if f.endswith(".csv"))
    text = "".join(open(f"{root}/csv/{f}").read() for f in files)
    assert text.index(",3,") < text.index(",1,") < text.index(",2,")


@pytest.mark.parametrize("prefix", ["9", "10"])
def test_report_delta_counts_every_kind(spark, prefix):
    cols = ["vin", "last_night_location", *rp.LOCATION_SLOTS, *rp.CHARGING_SLOTS]
    schema = ", ".join(f"{c} string" for c in cols)
    at = lambda v, a, b, c: (v, a, b, "", "", c, "", "")
    far, near = f"{prefix}.0, 77.0", f"{prefix}.01, 77.0"
    today = spark.createDataFrame([at("1", far, far, far), at("2", near, near, near), at("3", far, far, "")], schema)
    before = spark.createDataFrame([at("2", far, far, far), at("3", far, far, ""), at("4", far, far, far)], schema)
    assert tuple(rp.report_delta(today, before).first()) == (1, 1, 1, 1, 1)
