import datetime as dt
import os
import random
import tempfile

from helpers import ms, row, telemetry
from pyspark.sql import functions as F

from nightjar.operators import cells as ce
from nightjar.operators import positions as pos
from nightjar.operators import state as st
from nightjar.plans.daily import JobConfig, add_nights, live, run, state_logs
from nightjar.sources.vendors import VendorSpec

SPEC = (VendorSpec("a", use_dte=False),)
FIRST = dt.date(2024, 1, 1)


def config(root, tel, buckets=4, **more):
    return JobConfig(telemetry=tel, specs=SPEC, state_root=f"{root}/state", master_root=f"{root}/master",
                     report_root=f"{root}/report", state_buckets=buckets, **more)


def drives(spark, days, vehicles=6, seed=1):
    """Each vehicle parks in one of a few places a night; some nights are missing."""
    r, rows = random.Random(seed), []
    for d in range(days):
        day = FIRST + dt.timedelta(days=d)
        for v in range(vehicles):
            if r.random() < 0.8:
                place = r.randrange(4)
                for h in (1, 2):
                    rows.append(row("a", str(v), ms(day, h, r.randrange(60)), lat=12.0 + place / 100 + r.randrange(4) / 1e5,
                                    lon=77.0 + v, odo=1000.0, soc=50.0 + r.random(), dte=80.0))
    return telemetry(spark, rows).repartition(3)


def bag(df):
    return sorted(map(str, df.collect()))


def over_state(df, state_path):
    """The plan's exchanges that have a scan of the state below them."""
    lines = df._jdf.queryExecution().executedPlan().toString().splitlines()
    depth = lambda s: len(s) - len(s.lstrip(" :+-"))
    found = []
    for i, line in enumerate(lines):
        if "Exchange" in line.split("[")[0].split("(")[0]:
            below = []
            for x in lines[i + 1:]:
                if depth(x) <= depth(line):
                    break
                below.append(x)
            found += [line for x in below if "FileScan" in x and os.path.basename(state_path.rstrip("/")) in x]
    return found


def test_seventy_days_of_cells_equal_the_cells_of_all_points(spark):
    root = tempfile.mkdtemp(prefix="nightjar-cells-")
    tel = drives(spark, 70).cache()
    cfg = config(root, tel)
    for n in (0, 1, 31, 61, 62, 69):                          # gaps are scanned over
        as_of = FIRST + dt.timedelta(days=n)
        state, cells = add_nights(spark, as_of, cfg)
        if n in (1, 31, 62, 69):
            assert bag(ce.cell_counts(cells)) == bag(pos.night_cells(state))
            assert max((bin(r.nights).count("1") for r in cells.collect()), default=0) <= 61
    # The log holds what a first run over the whole history finds.
    whole = pos.night_points(tel.where(F.col("eventat") < ms(as_of + dt.timedelta(days=1), 0)), SPEC)
    assert bag(state) == bag(st.night_retention(whole, as_of, 60).select(*state.columns))
    assert state.count() < whole.count()
    tel.unpersist()


def test_old_state_has_no_exchange_and_keeps_its_files(spark):
    root = tempfile.mkdtemp(prefix="nightjar-bucketed-")
    tel = drives(spark, 12)
    cfg = config(root, tel)
    day = FIRST + dt.timedelta(days=9)
    add_nights(spark, day, cfg)
    points, cells, _ = state_logs(spark, cfg)

    def files(log):
        return sorted(os.path.join(d, f) for d, _, names in os.walk(log.path) for f in names if f.endswith(".parquet"))

    before = files(points)
    nxt = day + dt.timedelta(days=1)
    found = pos.night_points(tel, SPEC)
    old = live(points, nxt, nxt, 60)
    kept, fresh = ce.merged_cells(ce.aged(cells.read([day]), day, nxt), ce.new_cells(found, nxt))
    before_broadcast = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")          # as for a state too large to broadcast
    try:
        for df in (st.added_rows(old, found, "eventat", st.NIGHT_COLUMNS), pos.last_night(old, nxt), kept):
            text = df._jdf.queryExecution().executedPlan().toString()
            assert "Bucketed: true" in text and not over_state(df, "/rows"), text
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before_broadcast)
    add_nights(spark, nxt, cfg)
    assert set(before) < set(files(points))
    # One file a bucket and part, not one a task.
    assert len([f for f in files(cells) if f"run_date={nxt}" in f]) <= 2 * cfg.state_buckets


def test_a_rerun_gives_the_same_rows_and_a_failed_run_is_not_read(spark):
    root = tempfile.mkdtemp(prefix="nightjar-rerun-")
    cfg = config(root, drives(spark, 8))
    days = [FIRST + dt.timedelta(days=n) for n in (3, 4, 5)]
    for d in days[:2]:
        state, cells = add_nights(spark, d, cfg)
    want = bag(state), bag(ce.cell_counts(cells))
    assert tuple(map(bag, (lambda s, c: (s, ce.cell_counts(c)))(*add_nights(spark, days[1], cfg)))) == want
    # A run that fails after writing its rows: they are there, but not read.
    points, cells_log, _ = state_logs(spark, cfg)
    points.write(days[2], points.dealt(state.limit(1).withColumn("eventat", F.lit(0).cast("long"))))
    assert points.finished(days[2] + dt.timedelta(days=1)) == days[:2]
    state, cells = add_nights(spark, days[2], cfg)
    assert state.where("eventat = 0").count() == 0 and bag(ce.cell_counts(cells)) == bag(pos.night_cells(state))
    # A rerun of an earlier day: later runs no longer count and their days are scanned again.
    add_nights(spark, days[0], cfg)
    assert points.finished(dt.date(2025, 1, 1)) == days[:1]
    again, cells = add_nights(spark, days[2], cfg)
    assert bag(again) == bag(state) and bag(ce.cell_counts(cells)) == bag(pos.night_cells(again))


def test_previous_rows_win_also_within_a_day(spark):
    old = spark.createDataFrame([("a", "1", 5, 1.0, 1.0)], "vendor string, vin string, eventat long, latitude double, longitude double")
    new = spark.createDataFrame([("a", "1", 5, 2.0, 2.0), ("a", "1", 6, 3.0, 3.0), ("a", "2", 5, 4.0, 4.0),
                                 ("a", "2", 5, 4.0, 4.0)], old.schema)
    got = st.added_rows(old, new, "eventat", st.NIGHT_COLUMNS)
    assert sorted((r.vin, r.eventat) for r in got.collect()) == [("1", 6), ("2", 5)]


def test_the_job_with_logs_equals_the_job_with_versions(spark):
    from test_daily import config as daily_config
    out = {}
    for buckets in (None, 4):
        cfg, _ = daily_config(spark, tempfile.mkdtemp(prefix="nightjar-logs-"))
        cfg.state_buckets = buckets
        got = run(spark, dt.date(2024, 1, 31), cfg)
        out[buckets] = {k: bag(got[k].select(*sorted(got[k].columns))) for k in ("report", "night_state", "charging_state")}
    assert out[None] == out[4] and out[4]["report"]
