import duckdb

import __spark_entry__ as E
from nightjar.plans.catalog import QUERIES as FLEET

SMALL = "/root/testdata/sf0.001"
CHEAP = ["valid_positions", "night_points", "pivot_top3", "charging_sessions", "address_worklist",
         "proximity_pairs"]


def test_queries_and_oracles_cover_the_same_keys():
    assert set(E.oracle_sql()) <= set(E.queries()) and set(FLEET) <= set(E.oracle_sql())
    assert {k for k in E.queries() if not k.startswith("op") and k != "pipeline"} == set(FLEET) and len(FLEET) >= 27


def test_entry_runs_on_smoke_data(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert df.columns[:2] == ["loan_no", "vin"]


def test_cheap_queries_match_duckdb_at_smallest_scale(spark):
    con = duckdb.connect()
    for t in ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SMALL}/{t}.parquet')")
    for k in CHEAP:
        s = E.queries()[k](spark, SMALL).toPandas()
        o = con.execute(E.oracle_sql()[k]).df()
        assert len(s) == len(o), k
        assert sorted(s.columns) == sorted(o.columns), k
