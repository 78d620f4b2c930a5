import datetime as dt
import random
import tempfile

import pytest
from helpers import ms, row, telemetry
from pyspark.sql import functions as F

from nightjar.operators import charging as ch
from nightjar.operators import open_sessions as op
from nightjar.operators import sequence as sq
from nightjar.plans.daily import JobConfig, carry_sessions
from nightjar.sources.vendors import VendorSpec, partition_filter

SPECS = (VendorSpec("a", use_dte=False, min_duration=1, min_points=2),
         VendorSpec("b", use_flag=False, use_dte=False, min_duration=10, min_points=3),
         VendorSpec("c", charging=False))
FIRST = dt.date(2024, 1, 1)
DAYS = [FIRST + dt.timedelta(days=i) for i in range(5)]
COLUMNS = ["vendor", "vin", "session_start_time", "latitude", "longitude", "point_count", "duration_minutes"]


def charges(spark, seed, vehicles=8):
    """Long runs of charging rows, many of them over midnight; some days are silent."""
    r, rows = random.Random(seed), []
    for v in range(vehicles):
        vendor, soc, flag = "ab"[v % 2], 50.0, False
        for day in DAYS:
            if r.random() < 0.2:
                continue
            for h in range(24):
                for m in sorted(r.sample(range(60), 2)):
                    flag = flag if r.random() < 0.9 else not flag
                    soc += 0.1 if flag else 0.0
                    rows.append(row(vendor, str(v), ms(day, h, m), lat=12 + r.random() / 1000, lon=77.0 + v, soc=soc, flag=flag))
    rows += [row("c", "x", ms(FIRST, 5), flag=True), row("a", "null", ms(FIRST, 23, 59), soc=None, flag=None),
             row("a", "null", ms(DAYS[1], 0), soc=60.0), row("a", "null", ms(DAYS[1], 0), soc=60.0)]
    return telemetry(spark, rows)


def of(tel, *days):
    return tel.where(partition_filter(days))


def found(df):
    return sorted(tuple(r[c] for c in COLUMNS) for r in df.collect())


@pytest.mark.parametrize("cut", [[[d] for d in DAYS], [DAYS[:3], [], DAYS[3:]]])
def test_runs_with_a_carry_equal_one_scan(spark, cut):
    tel = charges(spark, len(cut)).cache()
    carry, ended = None, []
    for days in cut:
        sessions, carry = op.advance(of(tel, *days), carry, SPECS, dt.date(2023, 1, 1))
        ended += found(sessions.where("NOT is_open"))
    want = found(ch.charging_sessions(tel, SPECS, with_metrics=True))
    assert sorted(ended + found(sessions.where("is_open"))) == want and len(ended) == len(set(ended))
    over = [w for w in want if w[2] // 86_400_000 != (w[2] + w[6] * 60_000) // 86_400_000]
    assert len(over) > 3                                       # sessions over midnight were among them
    # Scans cut at midnight would not have found them.
    assert sorted(x for days in cut for x in found(ch.charging_sessions(of(tel, *days), SPECS, True))) != want


def test_a_cut_vehicle_with_equal_rows_carries_on(spark, monkeypatch):
    t = ms(FIRST, 23, 50)
    rows = [row("a", "hot", t, soc=50.0, flag=True)] * 400 + [row("a", "hot", t + 60_000 * i, soc=50.0, flag=True) for i in range(300)]
    tel = telemetry(spark, rows + [row("a", "other", t, flag=True)])
    monkeypatch.setattr(ch, "ordered", lambda *a: sq.ordered(*a, least_rows=20))
    one, carry = op.advance(of(tel, FIRST), None, SPECS, FIRST)
    two, after = op.advance(of(tel, DAYS[1]), carry, SPECS, FIRST)
    assert found(one.where("NOT is_open")) == [] and [r.point_count for r in one.collect()] == [410]
    assert [(r.vin, r.session_start_time, r.point_count, r.duration_minutes, r.is_open) for r in two.collect()] == \
        [("hot", t, 700, 299, True)]
    assert {r.vin: r.open_points for r in after.collect()} == {"hot": 700, "other": 1}


def test_silent_vehicles_are_given_up(spark):
    t = ms(FIRST, 23, 0)
    tel = telemetry(spark, [row("a", "s", t + i * 60_000, flag=True) for i in range(3)])
    one, carry = op.advance(tel, None, SPECS, FIRST)
    assert [r.is_open for r in one.collect()] == [True]
    two, after = op.advance(tel.limit(0), carry, SPECS, FIRST)
    assert found(two) == found(one) and [r.is_open for r in two.collect()] == [True] and after.count() == 1
    three, gone = op.advance(tel.limit(0), after, SPECS, DAYS[1])
    assert found(three) == found(one) and [r.is_open for r in three.collect()] == [False] and gone.count() == 0
    none, empty = op.advance(tel.limit(0), None, SPECS, FIRST)
    assert none.count() == empty.count() == 0


def test_a_job_carries_sessions_and_reads_late_days_again(spark):
    root = tempfile.mkdtemp(prefix="nightjar-carry-")
    tel = charges(spark, 5, vehicles=4).cache()
    make = lambda t: JobConfig(telemetry=t, specs=SPECS, state_root=root, master_root=root, report_root=root,
                               state_buckets=2, carry_sessions=True)
    late = tel.where(~((F.col("vin") == "1") & partition_filter([DAYS[1]])))
    plain = lambda t, days: sorted(r[:5] for r in found(ch.charging_sessions(of(t, *days), SPECS, True)))
    state_rows = lambda s: sorted(tuple(r[c] for c in COLUMNS[:5]) for r in s.collect())
    for day in DAYS[:2]:
        state = carry_sessions(spark, day, make(late))
    assert state_rows(state) == plain(late, DAYS[:2])
    state = carry_sessions(spark, DAYS[2], make(tel), since=DAYS[1])
    assert state_rows(state) == plain(tel, DAYS[:3])
    state = carry_sessions(spark, DAYS[2], make(tel))          # a rerun
    assert state_rows(state) == plain(tel, DAYS[:3])
    state = carry_sessions(spark, DAYS[4], make(tel))          # after a day without a run
    assert state_rows(state) == plain(tel, DAYS)
