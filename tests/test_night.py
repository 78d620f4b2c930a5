import datetime as dt

from helpers import DAY, ms, row, telemetry

from nightjar.operators import positions as pos
from nightjar.operators.reshape import pivot_top3
from nightjar.sources.vendors import PROXY_VENDORS as SPECS
from nightjar.sources.vendors import VendorSpec


def test_night_window_is_inclusive_of_6_59_59_and_first_row_is_stationary(spark):
    rows = [row("v2", "a", ms(DAY, 6, 59, 59), odo=10.0), row("v2", "a", ms(DAY, 7, 0, 0), odo=10.0)]
    pts = pos.stationary_points(telemetry(spark, rows), SPECS).collect()
    assert [r.eventat for r in pts] == [ms(DAY, 6, 59, 59)]
    assert pts[0].prev_odometer == 10.0


def test_odometer_step_of_exactly_0_1_is_stationary_and_0_2_is_not(spark):
    rows = [row("v2", "a", ms(DAY, 1), odo=10.0), row("v2", "a", ms(DAY, 2), odo=10.1),
            row("v2", "a", ms(DAY, 3), odo=10.3)]
    got = [r.eventat for r in pos.stationary_points(telemetry(spark, rows), SPECS).collect()]
    assert sorted(got) == [ms(DAY, 1), ms(DAY, 2)]


def test_lag_compares_night_rows_not_adjacent_raw_rows(spark):
    # The day row moves the odometer by 50; the next night row is compared
    # with the previous NIGHT row (filters run before the lag).
    rows = [row("v2", "a", ms(DAY, 5), odo=10.0), row("v2", "a", ms(DAY, 12), odo=60.0),
            row("v2", "a", ms(DAY + dt.timedelta(days=1), 2), odo=10.05)]
    got = [r.eventat for r in pos.stationary_points(telemetry(spark, rows), SPECS).collect()]
    assert sorted(got) == [ms(DAY, 5), ms(DAY + dt.timedelta(days=1), 2)]


def test_gear_filter_applies_before_the_lag_and_only_to_its_vendor(spark):
    rows = [row("v0", "a", ms(DAY, 1), odo=10.0), row("v0", "a", ms(DAY, 2), odo=50.0, motion=False),
            row("v0", "a", ms(DAY, 3), odo=10.0)]
    got = [r.eventat for r in pos.stationary_points(telemetry(spark, rows), SPECS).collect()]
    assert sorted(got) == [ms(DAY, 1), ms(DAY, 3)]


def test_night_point_is_latest_of_the_night_and_vendor_without_odometer_keeps_all(spark):
    rows = [row("v4", "z", ms(DAY, 1), lat=12.1, odo=None), row("v4", "z", ms(DAY, 4), lat=12.2, odo=None),
            row("v2", "a", ms(DAY, 1), odo=5.0), row("v2", "a", ms(DAY, 2), odo=9.0)]
    got = {(r.vin, r.eventat) for r in pos.night_points(telemetry(spark, rows), SPECS).collect()}
    assert got == {("z", ms(DAY, 4)), ("a", ms(DAY, 1))}


def test_bounding_box_is_inclusive(spark):
    rows = [row("v4", "z", ms(DAY, 1), lat=8.0, lon=98.0, odo=None),
            row("v4", "y", ms(DAY, 1), lat=7.999, lon=98.0, odo=None)]
    got = {r.vin for r in pos.night_points(telemetry(spark, rows), SPECS).collect()}
    assert got == {"z"}


def test_night_cells_need_two_nights_and_tie_breaks_on_cell_text(spark):
    d = [DAY + dt.timedelta(days=i) for i in range(8)]
    state = spark.createDataFrame(
        [("v2", "a", ms(d[0], 1), 12.001, 77.0), ("v2", "a", ms(d[1], 1), 12.001, 77.0),
         ("v2", "a", ms(d[2], 1), 12.002, 77.0), ("v2", "a", ms(d[3], 1), 12.002, 77.0),
         ("v2", "a", ms(d[4], 1), 12.003, 77.0), ("v2", "a", ms(d[5], 1), 12.003, 77.0),
         ("v2", "a", ms(d[6], 1), 12.004, 77.0), ("v2", "a", ms(d[7], 1), 12.004, 77.0),
         ("v2", "a", ms(d[0], 2), 12.009, 77.0)],
        "vendor string, vin string, eventat long, latitude double, longitude double")
    cells = pos.night_cells(state).orderBy("rank").collect()
    assert [c.grid_cell for c in cells] == ["12.001,77.0", "12.002,77.0", "12.003,77.0"]
    wide = pivot_top3(pos.night_cells(state), "night_location").first()
    assert (wide.night_location_1, wide.night_location_3) == ("12.001, 77.0", "12.003, 77.0")


def test_last_night_is_yesterday_utc_latest_point(spark):
    as_of = DAY + dt.timedelta(days=1)
    state = spark.createDataFrame(
        [("v2", "a", ms(DAY, 1), 12.1234567, 77.0), ("v2", "a", ms(DAY, 3), 12.2, 77.0),
         ("v2", "b", ms(as_of, 1), 13.0, 77.0)],
        "vendor string, vin string, eventat long, latitude double, longitude double")
    got = {(r.vin, r.last_night_location) for r in pos.last_night(state, as_of).collect()}
    assert got == {("a", "12.2, 77.0")}


def test_rejected_rows_have_the_first_reason_and_both_channels_add_up(spark, tmp_path):
    from nightjar.operators.positions import judged_positions, valid_positions
    from nightjar.sources.io import write_positions
    specs = (VendorSpec("a"), VendorSpec("p", packed_position=True))
    rows = [("a", "1", None, "12.5", "77.5", "kept"), ("a", "2", None, None, "77.5", "no_position"),
            ("a", "3", None, "x", None, "no_position"), ("a", "4", None, "12.5d", "77", "not_numeric"),
            ("a", "5", None, "50", "77", "outside_box"), ("p", "6", "12.5,77.5", None, None, "kept"),
            ("p", "7", None, "12", "77", "no_position"), ("p", "8", "12.5", None, None, "not_two_parts"),
            ("p", "9", "1,2,3", None, None, "not_two_parts"), ("p", "10", "a,b", None, None, "not_numeric"),
            ("p", "11", "12.5,10", None, None, "outside_box"), ("p", "12", "", None, None, "not_two_parts")]
    raw = spark.createDataFrame([r[:2] + (5,) + r[2:5] for r in rows],
                                "vendor string, vin string, eventat long, location string, lat_text string, lon_text string")
    judged = judged_positions(raw, specs)
    assert {r.vin: r.reason for r in judged.collect()} == {r[1]: r[5] for r in rows}
    kept, rejected, counts = write_positions(judged, str(tmp_path), DAY)
    assert sorted(map(tuple, kept.collect())) == sorted(map(tuple, valid_positions(raw, specs).collect()))
    by_reason = {r.reason: r.rows for r in counts.collect()}
    assert sum(by_reason.values()) == len(rows) and by_reason["kept"] == kept.count() == 2
    assert by_reason["no_position"] == 3 and rejected.count() == 10
    _, rejected, counts = write_positions(judged.limit(0), str(tmp_path / "none"), DAY)
    assert rejected.count() == 0 and sum(r.rows for r in counts.collect()) == 0
