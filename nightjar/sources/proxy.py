"""Proxy inputs over the driver's test tables.

The job reads vendor telemetry and a loan warehouse that are not available
here; these functions give the driver's tables (``events`` and the star
schema) the shapes of those inputs. Each proxy is an ordinary DataFrame plan
over the parquet scan, so its work grows with the tables. The DuckDB oracle
(``nightjar.plans.oracle``) writes the same expressions in SQL.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from nightjar.functions.exprs import epoch_ms_from_ntz, normalize_address

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events")


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


# --- telemetry -------------------------------------------------------------

def _events_base(events: DataFrame) -> DataFrame:
    # Through a generator, so that the instant is worked out once a row: else
    # each filter and each column that is made of it does so again.
    return events.select("event_id", "ts", "user_id", "event_type", "value", "props",
                         F.inline(F.array(F.struct(epoch_ms_from_ntz("ts").alias("eventat")))))


def _true_position(e: DataFrame) -> DataFrame:
    return (e.withColumn("latitude", F.expr(
                "8.5D + (((user_id div 10) * 37) % 2800) / 100.0D"
                " + ((eventat div 86400000) % 3) * 0.02D + (event_id % 4) * 0.0002D"))
             .withColumn("longitude", F.expr(
                "68.5D + (((user_id div 10) * 53) % 2900) / 100.0D + (event_id % 4) * 0.0001D")))


def telemetry_proxy(events: DataFrame) -> DataFrame:
    """Canonical telemetry (``TELEMETRY_SCHEMA``) over ``events``: vendor
    v0..v4 by ``user_id % 5``, vin = user_id, clean positions."""
    e = _true_position(_events_base(events))
    return e.select(
        F.concat(F.lit("v"), (F.col("user_id") % 5).cast("string")).alias("vendor"),
        F.col("user_id").cast("string").alias("vin"),
        "eventat", "latitude", "longitude",
        F.expr("floor(value / 10) * 0.04D").alias("odometer"),
        F.col("value").alias("soc"),
        F.expr("CAST(get_json_object(props, '$.k') AS DOUBLE)").alias("dte"),
        ((F.col("event_type") == "purchase") & ((F.col("user_id") % 5) != 3)).alias("charge_flag"),
        (F.col("event_type") != "error").alias("motion_ok"),
        F.inline(F.array(F.struct(F.lpad(F.year("ts").cast("string"), 4, "0").alias("year"),
                                  F.lpad(F.month("ts").cast("string"), 2, "0").alias("month"),
                                  F.lpad(F.dayofmonth("ts").cast("string"), 2, "0").alias("day")))),
    )


def raw_positions_proxy(events: DataFrame) -> DataFrame:
    """Raw text positions with corruptions: v1 packs ``'lat,lon'`` into
    ``location``; others carry ``lat_text``/``lon_text``. event_id % 17 = 0
    loses the second part, % 19 = 0 moves latitude to 50, % 23 = 0 makes
    the latitude text non-numeric."""
    e = _true_position(_events_base(events))
    lat_txt = (F.when(F.col("event_id") % 23 == 0, F.lit("n/a"))
                .when(F.col("event_id") % 19 == 0, F.lit(50.0).cast("string"))
                .otherwise(F.col("latitude").cast("string")))
    lon_txt = F.when(F.col("event_id") % 17 == 0, F.lit(None).cast("string")) \
               .otherwise(F.col("longitude").cast("string"))
    packed = F.col("user_id") % 5 == 1
    location = F.when(packed, F.when(lon_txt.isNull(), lat_txt)
                      .otherwise(F.concat(lat_txt, F.lit(","), lon_txt)))
    return e.select(
        F.concat(F.lit("v"), (F.col("user_id") % 5).cast("string")).alias("vendor"),
        F.col("user_id").cast("string").alias("vin"),
        "eventat",
        location.alias("location"),
        F.when(~packed, lat_txt).alias("lat_text"),
        F.when(~packed, lon_txt).alias("lon_text"),
    )


# --- loan warehouse ----------------------------------------------------------

def _s(prefix: str, c) -> F.Column:
    return F.concat(F.lit(prefix), F.col(c).cast("string") if isinstance(c, str) else c.cast("string"))


def loan_tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """The 16 warehouse tables of the loan profile, shaped from the star
    schema. Keys are the logical table names used by
    ``nightjar.operators.address``."""
    t = {n: read_table(spark, sf_dir, n) for n in
         ("orders", "customer", "lineitem", "part", "supplier", "nation", "region")}
    o, c, li = t["orders"], t["customer"], t["lineitem"]
    n, r, p, s = t["nation"], t["region"], t["part"], t["supplier"]
    out: dict[str, DataFrame] = {}
    out["loan_details"] = o.select(
        _s("LD", "o_orderkey").alias("uuid"),
        F.col("o_orderkey").alias("lms_id"),
        _s("VB", "o_orderkey").alias("vehicle_booking_id"),
        _s("LP", F.col("o_orderkey") % 5).alias("loan_provider"),
        _s("L", "o_custkey").alias("loan_reference_id"),
        F.when(F.col("o_orderstatus") == "F", "DISBURSED").when(F.col("o_orderstatus") == "O", "APPROVED")
         .otherwise("PENDING").alias("loan_status"),
        F.when(F.col("o_custkey") % 2 == 0, "INDIVIDUAL").otherwise("PROPRIETOR").alias("loan_applicant_type"),
        F.col("o_orderpriority").alias("assigned_to"),
        (F.col("o_orderkey") % 3).cast("int").alias("co_applicant_added"),
        F.col("o_totalprice").alias("on_road_price"),
        (F.col("o_totalprice") * F.lit(0.8)).alias("loan_amount"),
        (F.lit(9.0) + (F.col("o_orderkey") % 7).cast("double")).alias("interest_rate"),
        (F.lit(12) * (F.lit(1) + F.col("o_orderkey") % 4)).cast("int").alias("duration_in_months"),
        F.expr("timestampadd(HOUR, CAST(o_orderkey % 24 AS INT), o_orderdate)").alias("decision_date"),
        F.expr("timestampadd(HOUR, 48, o_orderdate)").alias("loan_start_date"),
        F.col("o_orderdate").alias("dp_date"),
    )
    out["orders"] = o.select(_s("R", "o_orderkey").alias("ref_id"))
    out["vehicle_bookings"] = (
        li.groupBy("l_orderkey")
          .agg(F.min("l_partkey").alias("pk"), F.min("l_suppkey").alias("sk"))
          .select(_s("VB", "l_orderkey").alias("uuid"), _s("R", "l_orderkey").alias("ref_id"),
                  _s("VD", "l_orderkey").alias("vehicle_details_uuid"),
                  _s("P", "pk").alias("vehicle_uuid"), _s("S", "sk").alias("dealership_uuid"),
                  F.when(F.col("l_orderkey") % 2 == 0, "DEALER").otherwise("DIRECT").alias("source"),
                  _s("KA", "l_orderkey").alias("vehicle_number")))
    out["vehicle_details"] = o.select(_s("VD", "o_orderkey").alias("uuid"),
                                      F.col("o_custkey").cast("string").alias("vin"))
    oc = o.join(c, o["o_custkey"] == c["c_custkey"])
    out["credit_profile"] = oc.select(
        _s("CP", "o_orderkey").alias("uuid"), _s("LD", "o_orderkey").alias("loan_details_id"),
        _s("U", "c_custkey").alias("user_profile_uuid"),
        F.when(F.col("c_custkey") % 4 == 1, "GURANTOR").when(F.col("c_custkey") % 4 == 2, "CO_APPLICANT")
         .otherwise("APPLICANT").alias("profile_type"),
        F.when(F.col("c_custkey") % 5 != 0, 1).otherwise(0).alias("is_active"),
        F.when(F.col("c_custkey") % 7 == 0, 1).otherwise(0).alias("is_ntc"),
        F.when(F.col("c_custkey") % 6 == 0, F.lit(None).cast("string")).otherwise(
            F.concat(F.lit('{"segment": "'), F.col("c_mktsegment"), F.lit('", "displayName": "'),
                     F.col("c_name"), F.lit('", "scheme": "S'), (F.col("c_custkey") % 4).cast("string"),
                     F.lit('", "abbValue": '), (F.col("c_custkey") % 90).cast("string"), F.lit("}")))
         .alias("credit_profile_additional_details"),
        F.col("c_acctbal").alias("monthly_income"),
        (F.col("c_custkey") % 13).cast("int").alias("business_stability"),
        (F.col("c_custkey") % 17).cast("int").alias("residence_stability"),
    )
    out["credit_report"] = o.select(
        _s("CP", "o_orderkey").alias("credit_profile_id"),
        F.when(F.col("o_orderkey") % 8 == 0, F.lit(None).cast("string")).otherwise(
            F.concat(F.lit('{"score": '), (F.lit(600) + F.col("o_custkey") % 300).cast("string"), F.lit("}")))
         .alias("credit_report_extra"),
        F.expr("timestampadd(HOUR, CAST(o_orderkey % 48 AS INT), o_orderdate)").alias("created_at"))
    out["user_profiles"] = c.select(
        _s("U", "c_custkey").alias("uuid"),
        F.when(F.col("c_custkey") % 9 == 0, F.lit(None).cast("string")).otherwise(F.col("c_name")).alias("name"),
        F.when(F.col("c_custkey") % 2 == 0, "F").otherwise("M").alias("gender"),
        F.concat(F.lit('{"occupation": "'), F.col("c_mktsegment"), F.lit('"}')).alias("profile_info"),
        F.lit("COMMERCIAL").alias("use_case"),
        F.expr("date_add(DATE'1970-01-01', CAST(c_custkey % 9000 AS INT))").alias("dob"))
    out["loan_provider"] = r.select(_s("LP", "r_regionkey").alias("uuid"),
                                    F.concat(F.lit("NBFC "), F.col("r_name")).alias("name"))
    out["vehicles"] = p.select(
        _s("P", "p_partkey").alias("uuid"), F.col("p_name").alias("name"), F.col("p_brand").alias("model"),
        _s("O", "p_brand").alias("oem_uuid"),
        F.when(F.col("p_size") % 3 == 0, "2W").when(F.col("p_size") % 3 == 1, "3W").otherwise("4W")
         .alias("vehicle_category_by_wheels"),
        F.col("p_type").alias("vehicle_type"),
        F.concat(F.col("p_brand"), F.lit("-"), F.col("p_size").cast("string")).alias("variant"),
        (F.col("p_size") % 2).cast("int").alias("is_active"))
    out["oems"] = p.select(_s("O", "p_brand").alias("uuid"),
                           F.concat(F.lit("OEM "), F.col("p_brand")).alias("name")).distinct()
    out["dealerships"] = s.select(_s("S", "s_suppkey").alias("uuid"), F.col("s_name").alias("full_name"),
                                  _s("C", "s_nationkey").alias("city_uuid"))
    out["cities"] = n.select(_s("C", "n_nationkey").alias("uuid"), F.col("n_name").alias("name"),
                             _s("ST", "n_regionkey").alias("state_uuid"))
    out["states"] = r.select(_s("ST", "r_regionkey").alias("uuid"), F.col("r_name").alias("name"))
    out["disbursal_details"] = o.where(F.col("o_orderstatus") == "F").select(
        _s("LD", "o_orderkey").alias("loan_details_uuid"),
        F.expr("timestampadd(DAY, 10, o_orderdate)").alias("pre_emi_date"),
        F.expr("timestampadd(DAY, 40, o_orderdate)").alias("emi_start_date"),
        (F.col("o_totalprice") * F.lit(0.2)).alias("down_payment"),
        (F.col("o_totalprice") * F.lit(0.01)).alias("pre_emi_amount"),
        (F.col("o_totalprice") * F.lit(0.05)).alias("emi_amount"),
        _s("UTR", "o_orderkey").alias("utr_reference"))
    mapped = lambda kind, tag: F.struct(kind.alias("address_type"), _s(tag, "c_custkey").alias("address_uuid"))
    two = [mapped(F.lit("CURRENT_RESIDENCE"), "AC"),
           mapped(F.when(F.col("c_custkey") % 3 == 1, "OFFICE").otherwise("PERMANENT_RESIDENCE"), "AP")]
    out["address_mapping"] = oc.select(
        _s("LD", "o_orderkey").alias("loan_details_uuid"), _s("U", "c_custkey").alias("user_profile_uuid"),
        F.inline(F.when(F.col("c_custkey") % 10 == 9, F.array(*two, mapped(F.lit("CURRENT_RESIDENCE"), "AX")))
                 .otherwise(F.array(*two))))
    cn = c.join(n, c["c_nationkey"] == n["n_nationkey"]).join(r, F.col("n_regionkey") == r["r_regionkey"])
    lines = cn.select("*", F.inline(F.array(*[
        F.struct(_s(tag, "c_custkey").alias("uuid"), F.concat(F.lit(word), F.col("c_name")).alias("address_line_1"))
        for tag, word in (("AC", ""), ("AP", "Perm "), ("AX", "Alt "))])))
    out["address"] = lines.select(
            "uuid", "address_line_1",
            F.concat(F.lit("Block "), (F.col("c_custkey") % 50).cast("string")).alias("address_line_2"),
            F.col("n_name").alias("city"), F.col("r_name").alias("state"),
            F.when(F.col("c_custkey") % 11 == 0, F.lit(None).cast("string"))
             .otherwise((F.lit(560000) + F.col("c_custkey") % 1000).cast("string")).alias("pincode"),
            F.when(F.col("c_custkey") % 2 == 0, "OWNED").otherwise("RENTED").alias("house_ownership"),
            F.expr("date_add(DATE'2019-01-31', CAST(c_custkey % 400 AS INT))").alias("residing_since"),
            F.expr("date_add(DATE'2024-01-31', CAST(c_custkey % 30 AS INT))").alias("marked_at"))
    return out


def loan_vehicle_pairs_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Loan/chassis sheet: (loan_no, chasisno), loan_no NULL for pending."""
    o = read_table(spark, sf_dir, "orders")
    return o.select(
        F.when(F.col("o_orderstatus") == "P", F.lit(None).cast("string"))
         .otherwise(_s("L", "o_custkey")).alias("loan_no"),
        F.col("o_custkey").cast("string").alias("chasisno"))


def address_master_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stored address master: one row per customer except ids ending
    in 3; current coordinates missing when id % 7 = 0."""
    c = read_table(spark, sf_dir, "customer")
    missing = F.col("c_custkey") % 7 == 0
    return c.where(F.col("c_custkey") % 10 != 3).select(
        F.col("c_custkey").cast("string").alias("vin"),
        _s("L", "c_custkey").alias("loan_no"),
        F.when(missing, F.lit(None).cast("double")).otherwise(
            F.lit(8.5) + (F.col("c_nationkey") % 25).cast("double") * F.lit(1.1)).alias("current_lat"),
        F.when(missing, F.lit(None).cast("double")).otherwise(
            F.lit(68.5) + (F.col("c_nationkey") % 25).cast("double") * F.lit(1.2)).alias("current_lng"),
        (F.lit(8.51) + (F.col("c_nationkey") % 25).cast("double") * F.lit(1.1)).alias("permanent_lat"),
        (F.lit(68.51) + (F.col("c_nationkey") % 25).cast("double") * F.lit(1.2)).alias("permanent_lng"),
        F.col("c_custkey").alias("ingest_seq"))


def geocode_reference(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Known coordinates of composed customer addresses (the geocoding
    service's answers): by nation; no answer in one region."""
    c = read_table(spark, sf_dir, "customer")
    n = read_table(spark, sf_dir, "nation")
    r = read_table(spark, sf_dir, "region")
    cn = c.join(n, c["c_nationkey"] == n["n_nationkey"]).join(r, F.col("n_regionkey") == r["r_regionkey"])
    pin = F.when(F.col("c_custkey") % 11 == 0, F.lit("")).otherwise(
        (F.lit(560000) + F.col("c_custkey") % 1000).cast("string"))
    lines = cn.withColumn("word", F.explode(F.array(F.lit(""), F.lit("Perm "), F.lit("Alt "))))
    text = F.concat(F.col("word"), F.col("c_name"), F.lit(", "), F.col("n_name"), F.lit(", "), F.col("r_name"),
                    F.lit(" "), pin)
    return lines.select(
        normalize_address(text).alias("address"),
        F.when(F.col("n_regionkey") == 4, F.lit(None).cast("double"))
         .otherwise(F.lit(12.0) + F.col("n_nationkey").cast("double") * F.lit(0.5)).alias("lat"),
        F.when(F.col("n_regionkey") == 4, F.lit(None).cast("double"))
         .otherwise(F.lit(75.0) + F.col("n_nationkey").cast("double") * F.lit(0.5)).alias("lng")).distinct()
