import pytest
from helpers import DAY, ms

from nightjar.operators.address import loan_profile
from nightjar.operators.charging import charging_candidates
from nightjar.sources import loans, proxy
from nightjar.sources.adapters import RAW_LAYOUTS, adapt, with_layouts
from nightjar.sources.vendors import PROXY_VENDORS, TELEMETRY_COLUMNS, partition_filter, read_telemetry

SF = "/root/testdata/sf0.001"
AT = ms(DAY, 1)
PART = ("2024", "01", "10")
PART_DDL = ", year string, month string, day string"
RAW = {
    "v0": ("vin string, eventat long, latitude string, longitude string, odometer string, soc int, "
           "distancetoempty string, state string, gearposition string",
           [("a", AT, "12.5", "77.5", "10.5", 40, "80", "CHARGING", "Neutral"),
            ("a", AT + 1, "12.5d", "77.5", "10.5", 40, "80", "CHARGING", "Neutral"),
            ("a", AT + 2, "12.5", "77.5", None, 40, "x", None, "Drive"),
            ("a", AT + 3, "12.5", "77.5", "11", 40, "80", "IDLE", None)]),
    "v1": ("vin string, eventat string, location string, odometer double, batterysoc double, batterycurrent string",
           [("b", str(AT), "12.5,77.5", 1.0, 50.0, "0.2"), ("b", "bad", " 12.5 , 77.5 ", 1.0, 50.0, "0.1"),
            ("b", str(AT), "12.5", 1.0, 50.0, "1"), ("b", str(AT), "1,2,3", 1.0, 50.0, "1"),
            ("b", str(AT), None, 1.0, 50.0, "1")]),
    "v2": ("vin string, eventat long, latitude double, longitude double, odometer double, soc double, "
           "distancetillempty double, batterycharging int",
           [("c", AT, 12.5, 77.5, 1.0, 50.0, 60.0, 1), ("c", AT, 12.5, 77.5, 1.0, 50.0, 60.0, None),
            ("c", AT, 0.0, 0.0, 1.0, 50.0, 60.0, 1)]),
    "v3": ("vin string, eventat long, latitude double, longitude double, odometer double, soc double",
           [("d", AT, 12.5, 77.5, 1.0, 50.0)]),
    "v4": ("vin string, eventat long, lat string, lng string", [("e", AT, "12.5", "77.5")]),
}


def raw(spark, name):
    ddl, rows = RAW[name]
    return spark.createDataFrame([r + PART for r in rows], ddl + PART_DDL)


def test_raw_tables_become_canonical_telemetry(spark):
    out = read_telemetry(with_layouts([(s, raw(spark, s.name)) for s in PROXY_VENDORS]))
    assert out.columns == TELEMETRY_COLUMNS
    got = {}
    for r in out.collect():
        assert (r.latitude, r.longitude) == (12.5, 77.5) and (r.year, r.month, r.day) == PART
        got.setdefault(r.vendor, []).append((r.eventat, r.odometer, r.soc, r.dte, r.charge_flag, r.motion_ok))
    assert sorted(got["v0"]) == [(AT, 10.5, 40.0, 80.0, True, True), (AT + 2, None, 40.0, None, False, False),
                                 (AT + 3, 11.0, 40.0, 80.0, False, False)]
    assert got["v1"] == [(AT, 1.0, 50.0, None, True, True), (None, 1.0, 50.0, None, False, True)]
    assert sorted(x[4] for x in got["v2"]) == [False, True]
    assert got["v3"] == [(AT, 1.0, 50.0, None, False, True)]
    assert got["v4"] == [(AT, None, None, None, False, True)]
    # Odometer, motion and time clauses act on the adapted rows.
    kept = charging_candidates(out, PROXY_VENDORS).groupBy("vendor").count().collect()
    assert {r.vendor: r["count"] for r in kept} == {"v0": 1, "v1": 1, "v2": 2, "v3": 1}


def test_a_missing_raw_column_raises(spark):
    with pytest.raises(ValueError, match="gearposition"):
        adapt(raw(spark, "v0").drop("gearposition"), "v0", RAW_LAYOUTS["v0"])


def test_day_predicates_prune_raw_folders(spark, tmp_path):
    raw(spark, "v0").write.partitionBy("year", "month", "day").parquet(str(tmp_path / "v0"))
    spec = next(s for s in PROXY_VENDORS if s.name == "v0")
    out = read_telemetry(with_layouts([(spec, spark.read.parquet(str(tmp_path / "v0")))]))
    plan = out.where(partition_filter([DAY]))._jdf.queryExecution().executedPlan().toString()
    line = next(x for x in plan.splitlines() if "PartitionFilters" in x)
    assert "day" in line.split("PartitionFilters: [", 1)[1].split("]", 1)[0]
    assert out.where(partition_filter([DAY])).count() == 3


def test_loan_tables_from_folders_and_catalog(spark, tmp_path):
    made = proxy.loan_tables(spark, SF)
    assert set(made) == set(loans.LOAN_COLUMNS)
    for name, df in made.items():
        df.limit(20).withColumnRenamed("uuid", "UUID").write.parquet(str(tmp_path / name))
    got = loans.load_loan_tables(spark, str(tmp_path))
    assert {n: df.columns for n, df in got.items()} == {n: c.split() for n, c in loans.LOAN_COLUMNS.items()}
    assert len(loan_profile(got).columns) == 69
    for name, df in got.items():
        df.createOrReplaceTempView(f"loan_{name}")
    names = {n: f"loan_{n}" for n in loans.LOAN_COLUMNS}
    assert loans.load_loan_tables(spark, names)["cities"].count() == got["cities"].count()
    with pytest.raises(ValueError, match="oems"):
        loans.load_loan_tables(spark, {n: t for n, t in names.items() if n != "oems"})
    with pytest.raises(ValueError, match="chasisno"):
        loans.load_loan_pairs(spark.createDataFrame([("L1",)], "loan_no string"))
