import datetime as dt

import numpy as np

from pyspark.sql import functions as F

from nightjar.functions import exprs as X


def one(spark, col, **cols):
    df = spark.createDataFrame([tuple(cols.values())], list(cols.keys())) if cols else spark.range(1)
    return df.select(col.alias("x")).first()["x"]


def test_half_even_rounding_matches_float_arithmetic(spark):
    assert one(spark, X.round_half_even(F.lit(12.971605), 5)) == 12.9716
    assert one(spark, X.round_half_even(F.lit(12.000025), 5)) == float(np.round(12.000025, 5)) == 12.00002
    assert one(spark, X.round_half_even(F.lit(77.0), 5)) == 77.0


def test_coord_text_formats_like_python(spark):
    assert one(spark, X.coord_text(F.lit(12.971605), F.lit(77.0))) == "12.9716, 77.0"


def test_exact_decimal_centroid_breaks_ties_to_even(spark):
    df = spark.createDataFrame([(12.0001,), (12.0002,), (12.0000,), (12.0000,)], ["v"])
    # exact mean 12.000075 -> half-even at 5 decimals -> 12.00008
    assert df.agg(X.decimal_text(X.exact_mean("v"), 5)).first()[0] == "12.00008"


def test_month_boundaries_counts_boundaries(spark):
    df = spark.createDataFrame([(dt.date(2024, 1, 31), dt.date(2024, 2, 1)),
                                (dt.date(2023, 12, 1), dt.date(2024, 1, 31))], ["a", "b"])
    assert [r[0] for r in df.select(X.month_boundaries("a", "b")).collect()] == [1, 1]


def test_ist_date_crosses_midnight_at_1830_utc(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 1, 1, 18, 29),), (dt.datetime(2024, 1, 1, 18, 30),)], ["ts"])
    df = df.select(F.col("ts").cast("timestamp_ntz").alias("ts"))
    got = [r[0] for r in df.select(X.ist_date("ts")).collect()]
    assert got == [dt.date(2024, 1, 1), dt.date(2024, 1, 2)]


def test_utc_hour_and_date_by_integer_arithmetic(spark):
    ms = int(dt.datetime(2024, 1, 5, 6, 59, 59, tzinfo=dt.timezone.utc).timestamp() * 1000)
    df = spark.createDataFrame([(ms,), (ms + 1000,)], ["e"])
    rows = df.select(X.utc_hour("e").alias("h"), X.utc_date("e").alias("d")).collect()
    assert [(r.h, r.d) for r in rows] == [(6, dt.date(2024, 1, 5)), (7, dt.date(2024, 1, 5))]


def test_maps_link_rejects_bad_text(spark):
    vals = [None, "", "  ", "12.5", "1,2,3", "a,b", "12.9716, 77.0"]
    df = spark.createDataFrame([(v,) for v in vals], "t string")
    got = [r[0] for r in df.select(X.maps_link("t")).collect()]
    assert got == ["", "", "", "", "", "", "https://www.google.com/maps?q=12.9716,77.0"]


def test_haversine_report_radius(spark):
    # 0.0009 degrees of latitude at R = 6,371,000 m is about 100.08 m
    d = one(spark, X.haversine_m(F.lit(12.0), F.lit(77.0), F.lit(12.0009), F.lit(77.0)))
    assert abs(d - 100.0758) < 0.01


def test_epoch_ms_ignores_session_time_zone(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 7, 1, 12, 30, 15, 123456),),
                                (dt.datetime(1999, 12, 31, 23, 59, 59, 999999),)], ["ts"])
    df = df.select(F.col("ts").cast("timestamp_ntz").alias("ts"))
    want = [1719837015123, 946684799999]
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        for zone in ("UTC", "America/Los_Angeles", "Asia/Kolkata"):
            spark.conf.set("spark.sql.session.timeZone", zone)
            assert [r[0] for r in df.select(X.epoch_ms_from_ntz("ts")).collect()] == want
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)


def test_partition_filter_spans_year_end_inclusively(spark):
    from nightjar.sources.vendors import partition_days, partition_filter
    days = partition_days(dt.date(2024, 1, 1), 2)
    assert days == [dt.date(2024, 1, 1), dt.date(2023, 12, 31), dt.date(2023, 12, 30)]
    parts = [("2023", "12", "29"), ("2023", "12", "30"), ("2023", "12", "31"), ("2024", "01", "01"),
             ("2024", "01", "02"), ("2024", "12", "31")]
    df = spark.createDataFrame(parts, "year string, month string, day string")
    got = sorted(tuple(r) for r in df.where(partition_filter(days)).collect())
    assert got == [("2023", "12", "30"), ("2023", "12", "31"), ("2024", "01", "01")]


def test_local_session_gets_a_reliable_checkpoint_dir(spark):
    from nightjar.session import ensure_checkpoint_dir
    path = ensure_checkpoint_dir(spark)
    assert path and spark.sparkContext.getCheckpointDir() is not None
    assert ensure_checkpoint_dir(spark) == path
