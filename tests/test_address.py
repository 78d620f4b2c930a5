import pandas as pd

from nightjar.operators import address as ad

MASTER = "vin string, loan_no string, current_lat double, current_lng double, permanent_lat double, " \
         "permanent_lng double, ingest_seq long"


def test_worklist_is_incomplete_plus_new_pairs(spark):
    master = spark.createDataFrame([("1", "L1", None, 1.0, 1.0, 1.0, 1), ("2", "L2", 1.0, 1.0, 1.0, 1.0, 2)], MASTER)
    pairs = spark.createDataFrame([("L2", "2"), ("L3", "3"), ("L3", "3")], "loan_no string, vin string")
    got = {(r.loan_no, r.vin) for r in ad.address_worklist(master, pairs).collect()}
    assert got == {("L1", "1"), ("L3", "3")}


def test_geocode_normalises_both_sides_and_retries_misses(spark):
    composed = spark.createDataFrame([("L1", "1", "A St, City, State ", ", , , ")],
                                     "loan_no string, vin string, current_full_address string, "
                                     "permanent_full_address string")
    cache = spark.createDataFrame([("A St, City, State", 1.5, 2.5)], "address string, lat double, lng double")
    r = ad.geocode_lookup(composed, cache).first()
    assert (r.current_lat, r.current_lng, r.permanent_lat) == (1.5, 2.5, None)


def test_geocode_enrichment_hook_runs_on_misses_only(spark):
    addrs = spark.createDataFrame([("known",), ("unknown",)], "address string")
    cache = spark.createDataFrame([("known", 1.0, 1.0)], "address string, lat double, lng double")

    def enrich(batches):
        for b in batches:
            yield pd.DataFrame({"address": b["address"], "lat": 9.0, "lng": 9.0})

    got = {(r.address, r.lat, r.status) for r in ad.geocode(addrs, cache, enrich).collect()}
    assert got == {("known", 1.0, "ok"), ("unknown", 9.0, "ok")}


def test_master_dedup_keeps_earliest_ingest(spark):
    m = spark.createDataFrame([("1", "L1-B", 1.0, 1.0, 1.0, 1.0, 5), ("1", "L1", 2.0, 2.0, 2.0, 2.0, 3)], MASTER)
    assert ad.master_dedup(m).first().loan_no == "L1"
