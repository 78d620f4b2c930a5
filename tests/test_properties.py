import dataclasses
import datetime as dt

from pyspark.sql import functions as F

from nightjar.operators import charging as ch
from nightjar.operators import positions as pos
from nightjar.sources import proxy
from nightjar.sources.vendors import PROXY_VENDORS

SF = "/root/testdata/sf0.001"


def test_row_order_does_not_change_results(spark):
    tel = proxy.telemetry_proxy(proxy.read_table(spark, SF, "events"))
    shuffled = tel.repartition(7, F.rand(seed=1)).sortWithinPartitions(F.rand(seed=2))
    for fn in (lambda t: pos.night_points(t, PROXY_VENDORS),
               lambda t: ch.charging_sessions(t, PROXY_VENDORS, with_metrics=True)):
        a, b = fn(tel), fn(shuffled)
        assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_one_day_charging_option_reads_only_yesterday(spark):
    specs = tuple(dataclasses.replace(s, charging_days=1) if s.name == "v1" else s for s in PROXY_VENDORS)
    tel = proxy.telemetry_proxy(proxy.read_table(spark, SF, "events"))
    as_of = dt.date(2024, 1, 20)
    scanned = tel.where(ch.charging_scan_filter(specs, as_of, 60))
    days = {(r.vendor, r.day) for r in scanned.select("vendor", "day").distinct().collect()}
    assert {d for v, d in days if v == "v1"} <= {"19"}
    assert len({d for v, d in days if v == "v2"}) > 2
    assert not any(v == "v4" for v, _ in days)


def test_co_applicant_case_arms(spark):
    from nightjar.operators import address as ad
    tables = proxy.loan_tables(spark, SF)
    p = ad.loan_profile(tables)
    got = {r[0] for r in p.select("co_applicant_availability").distinct().collect()}
    assert got == {"Available", "NA", "Unknown"}
