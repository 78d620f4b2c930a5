"""The loan profile against plain joins, on keys that repeat or are missing."""

import re
from collections import Counter

from pyspark.sql import functions as F

from nightjar.operators import address as ad
from nightjar.sources.loans import LOAN_COLUMNS

TYPES = {"co_applicant_added": "int", "is_active": "int", "is_ntc": "int", "business_stability": "int",
         "residence_stability": "int", "dob": "date", "residing_since": "date",
         "marked_at": "date", **{c: "timestamp" for c in ("decision_date", "loan_start_date", "dp_date", "created_at",
                                                          "pre_emi_date", "emi_start_date")}}

ROWS = {
    "loan_details": [
        dict(uuid="l1", lms_id="m1", vehicle_booking_id="b1", loan_reference_id="L1", loan_status="DISBURSED"),
        dict(uuid="l1", lms_id="m2", vehicle_booking_id="b2", loan_reference_id="L2", loan_status="APPROVED"),
        dict(uuid="l3", lms_id="m3", vehicle_booking_id="b1", loan_reference_id="L3", loan_status="DISBURSED"),
        dict(uuid="l4", lms_id="m3", loan_reference_id="L4", loan_status="PENDING"),
        dict(uuid="l5", lms_id="m3", vehicle_booking_id="b3", loan_reference_id="L5", loan_status="APPROVED"),
        dict(uuid=None, lms_id="m6", vehicle_booking_id="b1", loan_reference_id="L6", loan_status="APPROVED"),
        dict(uuid="l7", lms_id=None, vehicle_booking_id="b9", loan_reference_id="L7", loan_status="APPROVED"),
        dict(uuid="l8", lms_id="m8", vehicle_booking_id="b8", loan_reference_id="L8", loan_status="APPROVED")],
    "orders": [dict(ref_id="r1"), dict(ref_id="r1"), dict(ref_id="r3"), dict(ref_id=None)],
    "vehicle_bookings": [
        dict(uuid="b1", ref_id="r1", vehicle_details_uuid="d1", vehicle_uuid="v1", dealership_uuid="s1", vehicle_number="N1"),
        dict(uuid="b3", ref_id="r3", vehicle_number="N3"), dict(uuid="b3", ref_id="r3", vehicle_number="N4"),
        dict(uuid="b2", ref_id="r9", vehicle_number="N2"), dict(uuid=None, ref_id="r1", vehicle_number="N0")],
    "vehicle_details": [dict(uuid="d1", vin="x1"), dict(uuid=None, vin="x0")],
    "vehicles": [dict(uuid="v1", name="car", oem_uuid="o1")], "oems": [dict(uuid="o1", name="oem")],
    "dealerships": [dict(uuid="s1", full_name="dealer", city_uuid="c1")],
    "cities": [dict(uuid="c1", name="city", state_uuid="t1")], "states": [dict(uuid="t1", name="state")],
    "loan_provider": [], "disbursal_details": [dict(loan_details_uuid="l1", utr_reference="u1"),
                                               dict(loan_details_uuid="l1", utr_reference="u2")],
    "credit_profile": [
        dict(uuid=u, loan_details_id=l, user_profile_uuid=p, profile_type=t, is_active=a, business_stability=n)
        for n, (u, l, p, t, a) in enumerate([
            ("p1", "l1", "u1", "APPLICANT", 1), ("p1", "l1", "u1", "APPLICANT", 1), ("p2", "l3", "u2", "GURANTOR", 1),
            ("p3", "l4", "u3", "APPLICANT", 1), ("p4", "l5", "u4", "CO_APPLICANT", 1), ("p5", "l5", "u5", "APPLICANT", 0),
            ("p6", "l7", "u1", "APPLICANT", 1), ("p7", None, "u1", "APPLICANT", 1), ("p8", "l8", None, "APPLICANT", 1),
            ("p9", "l8", "u9", "APPLICANT", 1)])],
    "credit_report": [dict(credit_profile_id="p1", credit_report_extra='{"score": 7}'),
                      dict(credit_profile_id="p6", credit_report_extra='{"score": 8}'),
                      dict(credit_profile_id="p6", credit_report_extra=None)],
    "user_profiles": [dict(uuid="u1", name="ann"), dict(uuid="u2", name="bob"), dict(uuid=None, name="nobody")],
    "address_mapping": [
        dict(loan_details_uuid=l, user_profile_uuid=u, address_type=t, address_uuid=a) for l, u, t, a in [
            ("l1", "u1", "CURRENT_RESIDENCE", "a1"), ("l1", "u1", "CURRENT_RESIDENCE", "a2"), ("l1", "u1", "OFFICE", "a2"),
            ("l1", "u2", "OFFICE", "a1"), ("l3", "u2", "CURRENT_RESIDENCE", "a1"), ("l3", "u2", "CURRENT_RESIDENCE", None),
            ("l4", "u3", "PERMANENT_RESIDENCE", "a2"), ("l5", "u4", "CURRENT_RESIDENCE", "a9"),
            ("l7", "u1", "PERMANENT_RESIDENCE", "a1"), (None, "u1", "OFFICE", "a1"), ("l8", None, "OFFICE", "a1"),
            ("l8", "u9", "SHOP", "a1")]],
    "address": [dict(uuid="a1", address_line_1="one", city="c1"), dict(uuid="a2", address_line_1="two", city="c2"),
                dict(uuid="a2", address_line_1="two b"), dict(uuid=None, address_line_1="none")],
}

PLAIN = """
SELECT l.lms_id, l.loan_reference_id AS loan_no, o.ref_id AS order_id, b.vehicle_number, vd.vin, v.name AS vehicle_name,
  oe.name AS oem_name, s.full_name AS dealership_name, ct.name AS dealership_city_name, st.name AS dealers_state_name,
  eu.name AS customer_name, get_json_object(cr.credit_report_extra, '$.score') AS bureau, a.address_line_1 AS current_address1,
  d.utr_reference, rb.line AS bussiness_address_1, rb.stability AS business_stability, rp.line AS permanent_address_1,
  rg.line AS gurantor_address_1, rc.line AS co_app_address_1
FROM loan_details l
LEFT JOIN (vehicle_bookings b JOIN orders o ON o.ref_id = b.ref_id) ON b.uuid = l.vehicle_booking_id
LEFT JOIN vehicle_details vd ON vd.uuid = b.vehicle_details_uuid
LEFT JOIN vehicles v ON v.uuid = b.vehicle_uuid LEFT JOIN oems oe ON oe.uuid = v.oem_uuid
LEFT JOIN dealerships s ON s.uuid = b.dealership_uuid LEFT JOIN cities ct ON ct.uuid = s.city_uuid
LEFT JOIN states st ON st.uuid = ct.state_uuid
LEFT JOIN credit_profile cp ON cp.loan_details_id = l.uuid AND cp.is_active = 1 AND cp.profile_type = 'APPLICANT'
LEFT JOIN credit_report cr ON cr.credit_profile_id = cp.uuid LEFT JOIN user_profiles eu ON eu.uuid = cp.user_profile_uuid
LEFT JOIN address_mapping m ON m.loan_details_uuid = l.uuid AND m.user_profile_uuid = cp.user_profile_uuid
  AND m.address_type = 'CURRENT_RESIDENCE'
LEFT JOIN address a ON a.uuid = m.address_uuid
LEFT JOIN disbursal_details d ON d.loan_details_uuid = l.uuid
LEFT JOIN rb ON rb.lms_id = l.lms_id LEFT JOIN rp ON rp.lms_id = l.lms_id
LEFT JOIN rg ON rg.lms_id = l.lms_id LEFT JOIN rc ON rc.lms_id = l.lms_id
WHERE l.loan_status IN ('DISBURSED', 'APPROVED')
"""

ONE_ROLE = """r{name} AS (
  SELECT l.lms_id, a.address_line_1 AS line, cp.business_stability AS stability FROM loan_details l
  LEFT JOIN credit_profile cp ON cp.loan_details_id = l.uuid AND cp.is_active = 1 AND cp.profile_type = '{ptype}'
  LEFT JOIN address_mapping m ON m.loan_details_uuid = cp.loan_details_id AND m.user_profile_uuid = cp.user_profile_uuid
    AND m.address_type = '{atype}'
  LEFT JOIN address a ON a.uuid = m.address_uuid)"""


def _tables(spark) -> dict:
    out = {}
    for name, columns in LOAN_COLUMNS.items():
        kinds = [(c, TYPES.get(c, "string"))
                 for c in columns.split()]
        out[name] = spark.createDataFrame([tuple(r.get(c) for c, _ in kinds) for r in ROWS[name]],
                                          ", ".join(f"{c} {k}" for c, k in kinds))
    return out


def _plain(spark, tables):
    for name, df in tables.items():
        df.createOrReplaceTempView(name)
    roles = ",\n".join(ONE_ROLE.format(name=n, ptype=p, atype=a) for n, (p, a) in ad.ROLES.items())
    return spark.sql("WITH " + roles + PLAIN)


def _rows(df, columns):
    return Counter(tuple(r) for r in df.select(*columns).collect())


def test_profile_equals_plain_joins_where_keys_repeat_or_are_missing(spark):
    tables = _tables(spark)
    want = _plain(spark, tables)
    got = ad.loan_profile(tables)
    assert _rows(got, want.columns) == _rows(want, want.columns)
    some = spark.createDataFrame([("L1",), ("L5",), ("L6",), ("L7",), ("L7",)], "loan_no string")
    assert _rows(ad.loan_profile(tables, some), want.columns) == _rows(
        want.where(F.col("loan_no").isin("L1", "L5", "L6", "L7")), want.columns)


def test_wide_rows_are_dealt_out_once(spark):
    """No shuffle carries what two branches have brought: before, the whole
    profile went through one by lms_id (over 50 columns)."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = ad.loan_profile(_tables(spark))._jdf.queryExecution().explainString(
            spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    widths = [int(n) for n in re.findall(r"\(\d+\) Exchange\nInput \[(\d+)\]", text)]
    assert len(widths) > 10 and max(widths) < 24
