import datetime as dt

from helpers import ms

from nightjar.operators import report as rp
from nightjar.operators import state as st
from nightjar.sources.vendors import PROXY_VENDORS as SPECS

NIGHT = "vendor string, vin string, eventat long, latitude double, longitude double"
AS_OF = dt.date(2024, 1, 31)


def test_merge_previous_wins_and_is_idempotent(spark):
    prev = spark.createDataFrame([("v2", "a", 1, 12.0, 77.0)], NIGHT)
    new = spark.createDataFrame([("v2", "a", 1, 13.0, 78.0), ("v2", "a", 2, 14.0, 79.0)], NIGHT)
    m = st.merge_state(prev, new, st.NIGHT_KEYS, st.NIGHT_COLUMNS)
    assert sorted((r.eventat, r.latitude) for r in m.collect()) == [(1, 12.0), (2, 14.0)]
    again = st.merge_state(m, new, st.NIGHT_KEYS, st.NIGHT_COLUMNS)
    assert sorted(again.collect()) == sorted(m.collect())


def test_retention_cutoffs(spark):
    old, keep = ms(AS_OF - dt.timedelta(days=61), 1), ms(AS_OF - dt.timedelta(days=60), 0)
    night = spark.createDataFrame([("v2", "a", old, 1.0, 1.0), ("v2", "a", keep, 1.0, 1.0)], NIGHT)
    assert [r.eventat for r in st.night_retention(night, AS_OF, 60).collect()] == [keep]
    sess = night.withColumnRenamed("eventat", "session_start_time")
    assert [r.session_start_time for r in st.charging_retention(sess, AS_OF, 60).collect()] == [keep]


def test_empty_delta_keeps_state(spark):
    prev = spark.createDataFrame([("v2", "a", ms(AS_OF, 1), 12.0, 77.0)], NIGHT)
    empty = spark.createDataFrame([], NIGHT)
    assert st.merge_night_state(prev, empty, AS_OF).count() == 1


def report(spark, rows):
    cols = rp.REPORT_COLUMNS
    data = []
    for r in rows:
        base = {c: ("" if c not in rp.VISIT_SLOTS else 0) for c in cols}
        base.update(r)
        data.append(tuple(base[c] for c in cols))
    schema = ", ".join(f"{c} {'int' if c in rp.VISIT_SLOTS else 'string'}" for c in cols)
    return spark.createDataFrame(data, schema)


def test_delta_moved_is_strictly_more_than_100m(spark):
    d100 = 0.0009 * 100 / 100.0758  # latitude step of 100 m at R = 6,371,000
    today = report(spark, [
        {"vin": "1", "last_night_location": f"{12.0 + d100:.9f}, 77.0"},
        {"vin": "2", "last_night_location": "12.001, 77.0"},
        {"vin": "3", "charging_location_1": "12.0, 77.0"},
        {"vin": "4"}])
    prev = report(spark, [
        {"vin": "1", "last_night_location": "12.0, 77.0"},
        {"vin": "2", "last_night_location": "12.0, 77.0"},
        {"vin": "3"}])
    r = rp.report_delta(today, prev).first()
    assert (r.new_vehicles, r.updated_last_night, r.newly_charged) == (1, 1, 1)


def test_report_json_links(spark):
    rep = report(spark, [{"vin": "1", "loan_no": "L1", "current_address": "(12.5, 77.25)",
                          "night_location_1": "12.9716, 77.0", "charging_location_visits_1": 3}])
    j = rp.report_json(rep).first()
    assert j.current_address == "https://www.google.com/maps?q=12.5,77.25"
    assert j.night_location_1 == "https://www.google.com/maps?q=12.9716,77.0"
    assert j.last_night_location == "" and j.charging_location_visits_1 == 3


def test_vendor_vehicle_prefers_configuration_order(spark):
    last = spark.createDataFrame([("v3", "a", "1.0, 2.0"), ("v1", "a", "3.0, 4.0")],
                                 "vendor string, vin string, last_night_location string")
    nights = spark.createDataFrame([], "vendor string, vin string, night_location_1 string, "
                                       "night_location_2 string, night_location_3 string")
    charging = spark.createDataFrame([], "vendor string, vin string, " + ", ".join(
        f"charging_location_{i} string, charging_location_visits_{i} int" for i in (1, 2, 3)))
    v = rp.vendor_vehicle(last, nights, charging, SPECS).first()
    assert (v.vendor, v.last_night_location) == ("v1", "3.0, 4.0")


def test_report_json_lines_sink_is_valid_json(spark):
    import json
    import tempfile

    from nightjar.sources import io
    rep = report(spark, [{"vin": "1", "loan_no": "L1", "current_address": "(12.5, 77.25)",
                          "night_location_1": "12.9716, 77.0", "charging_location_visits_1": 2},
                         {"vin": "2", "loan_no": "L2"}])
    texts = [r.value for r in rp.report_json_text(rep).collect()]
    recs = {d["vin"]: d for d in map(json.loads, texts)}
    assert recs["1"]["night_location_1"] == "https://www.google.com/maps?q=12.9716,77.0"
    assert recs["1"]["charging_location_visits_1"] == 2 and recs["2"]["current_address"] == ""
    out = tempfile.mkdtemp(prefix="nightjar-json-") + "/r"
    io.write_report_json(rep, out)
    back = spark.read.json(out)
    assert back.count() == 2 and "charging_location_visits_3" in back.columns


def test_changes_give_the_five_counts_and_todays_report(spark):
    import random
    r = random.Random(6)

    def report(vins, seed):
        q = random.Random(seed)
        rows = []
        for v in vins:
            loc = lambda: q.choice(["", "12.0, 77.0", "12.0, 77.0005", "12.0, 77.5", None])
            rows.append((f"L{v}", v, loc(), loc(), loc(), loc(), loc(), loc(), q.choice([None, 0, 3]), loc(), 0, loc(), 1))
        return spark.createDataFrame(rows, ", ".join(
            f"{c} {'int' if c in rp.VISIT_SLOTS else 'string'}" for c in rp.REPORT_COLUMNS))

    vins = [str(i) for i in range(60)]
    previous = report(vins[:50], 1)
    same = [v for v in vins[:50] if r.random() < 0.5]
    today = previous.where(previous.vin.isin(same)).unionByName(
        report([v for v in vins[5:] if v not in same], 2)).unionByName(report([None], 3))
    t, p = rp.with_prints(today), rp.with_prints(previous)
    changes = rp.report_changes(t, p).cache()
    assert rp.changes_delta(changes).collect() == rp.report_delta(t, p).collect()
    bag = lambda df: sorted(map(str, df.select(*rp.REPORT_COLUMNS).collect()))
    assert bag(rp.apply_changes(p, changes)) == bag(t)
    kinds = {x.vin: x for x in changes.collect()}
    assert not set(same) & set(kinds)
    assert kinds["55"].change == "insert" and kinds["55"].old is None and kinds[""].change == "insert"
    for x in kinds.values():
        if x.change == "update":
            assert x.columns and all(x.old[c] != x.new[c] for c in x.columns)
            assert all(x.old[c] == x.new[c] for c in rp.REPORT_COLUMNS if c not in x.columns)
    assert rp.report_changes(t, t).count() == 0
