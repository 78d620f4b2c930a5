from helpers import DAY, ms, row, telemetry

from nightjar.operators import charging as ch
from nightjar.sources.vendors import PROXY_VENDORS as SPECS


def test_first_row_signals_charging_through_default_previous_soc(spark):
    rows = [row("v3", "a", ms(DAY, 10, 0), soc=50.0), row("v3", "a", ms(DAY, 10, 1), soc=50.0)]
    sig = ch.charging_signal(telemetry(spark, rows), SPECS).orderBy("eventat").collect()
    assert [r.is_charging_signal for r in sig] == [1, 0]


def test_one_unflagged_row_ends_a_session(spark):
    t = [ms(DAY, 10, m) for m in range(6)]
    rows = [row("v2", "a", t[0], flag=True), row("v2", "a", t[1], flag=True), row("v2", "a", t[2], flag=False),
            row("v2", "a", t[3], flag=True), row("v2", "a", t[4], flag=True), row("v2", "a", t[5], flag=True)]
    s = ch.charging_sessions(telemetry(spark, rows), SPECS, with_metrics=True).orderBy("session_start_time").collect()
    assert [(r.session_start_time, r.point_count, r.duration_minutes) for r in s] == [(t[0], 2, 1), (t[3], 3, 2)]


def test_minimum_duration_is_inclusive(spark):
    def sess(minutes):
        rows = [row("v0", "a", ms(DAY, 10, 0) + i * (minutes * 60000 // 4), flag=True) for i in range(5)]
        return ch.charging_sessions(telemetry(spark, rows), SPECS).count()
    assert sess(9) == 0 and sess(10) == 1


def test_moving_vehicle_is_not_charging(spark):
    rows = [row("v2", "a", ms(DAY, 10, 0), odo=10.0, flag=True), row("v2", "a", ms(DAY, 10, 1), odo=11.0, flag=True)]
    sig = ch.charging_signal(telemetry(spark, rows), SPECS).orderBy("eventat").collect()
    assert [r.is_charging_signal for r in sig] == [1, 0]


def test_vendor_clauses_differ(spark):
    # v1 has no range clause: a range rise alone is not charging.
    rows = [row("v1", "a", ms(DAY, 10, 0), soc=50.0, dte=10.0), row("v1", "a", ms(DAY, 10, 1), soc=50.0, dte=20.0),
            row("v2", "b", ms(DAY, 10, 0), soc=50.0, dte=10.0), row("v2", "b", ms(DAY, 10, 1), soc=50.0, dte=20.0)]
    sig = {(r.vin, r.eventat): r.is_charging_signal for r in ch.charging_signal(telemetry(spark, rows), SPECS).collect()}
    assert sig[("a", ms(DAY, 10, 1))] == 0 and sig[("b", ms(DAY, 10, 1))] == 1
