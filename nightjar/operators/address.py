"""Loan profile, address work list, composition, geocoding, master upkeep.

``tables`` is a dict of logical warehouse tables (see
``nightjar.sources.proxy.loan_tables`` for the names and columns), so the
same code runs on a JDBC source, a lake or the test proxy.
"""

from __future__ import annotations

from typing import Callable, Iterator, Mapping, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from nightjar.functions.exprs import ist_date, month_boundaries, normalize_address

LOAN_STATUSES = ("DISBURSED", "APPROVED")
MASTER_COLUMNS = ["vin", "loan_no", "current_lat", "current_lng", "permanent_lat", "permanent_lng",
                  "ingest_seq"]


def json_text(doc: Column, key: str) -> Column:
    """Text of top-level ``key`` of a JSON document; a NULL document reads as
    ``{}`` and a missing key gives NULL."""
    return F.get_json_object(F.coalesce(doc, F.lit("{}")), f"$.{key}")


def _active_profiles(tables: dict, profile_types: Sequence[str]) -> DataFrame:
    # ON-clause literals of a LEFT JOIN filter the right side before the join.
    return tables["credit_profile"].where((F.col("is_active") == 1) & F.col("profile_type").isin(*profile_types))


ADDRESS_FIELDS = ["address_line_1", "address_line_2", "city", "state", "pincode", "house_ownership", "residing_since",
                  "marked_at"]


def _located(tables: dict, address_types: Sequence[str]) -> DataFrame:
    """Mapped addresses dealt out by loan uuid (``m_ld``): user, address type
    and address. The mapping meets the addresses with its keys alone, and each
    address then travels to its loan once."""
    mp = tables["address_mapping"].where(F.col("address_type").isin(*address_types)
                                         & F.col("loan_details_uuid").isNotNull()).select(
        F.col("loan_details_uuid").cast("string").alias("m_ld"), F.col("user_profile_uuid").alias("m_user"),
        F.col("address_type").alias("m_type"), F.col("address_uuid").alias("m_addr"))
    a = tables["address"].select(F.col("uuid").alias("a_uuid"), *ADDRESS_FIELDS)
    return mp.join(a, F.col("a_uuid") == F.col("m_addr"), "left").drop("m_addr", "a_uuid").repartition("m_ld")


def _same(a: str, b: str) -> Column:
    """``a = b`` as a condition beside the join key: the rows stay where the
    key alone has dealt them."""
    return (F.col(a) <= F.col(b)) & (F.col(a) >= F.col(b))


def role_lists(tables: dict, roles: Mapping[str, tuple[str, str]], located: DataFrame) -> DataFrame:
    """Per loan uuid (``cp_ld``) that has an active profile: for each name of
    ``roles`` (profile type and address type) the list of that role's rows:
    each active profile of the role with each of its ``located`` addresses, or
    with none. One pass serves all roles, and no join has the NULL of loans
    without a profile as a hot key."""
    cp = (_active_profiles(tables, sorted({p for p, _ in roles.values()})).where(F.col("loan_details_id").isNotNull())
          .select(F.col("loan_details_id").cast("string").alias("cp_ld"), F.col("user_profile_uuid").alias("cp_user"),
                  F.col("profile_type").alias("cp_type"), F.col("business_stability").alias("cp_stability"))
          .repartition("cp_ld"))
    wanted = F.lit(None)
    for ptype in {p for p, _ in roles.values()}:
        wanted = F.when(F.col("cp_type") == ptype, F.array(*[
            F.struct(F.lit(a).alias("address"), F.lit(name).alias("role"))
            for name, (p, a) in roles.items() if p == ptype])).otherwise(wanted)
    rows = (cp.select("cp_ld", "cp_user", "cp_stability", F.inline(wanted))
            .join(located, (F.col("cp_ld") == F.col("m_ld")) & _same("cp_user", "m_user") & _same("address", "m_type"), "left"))
    row = F.struct(F.col("address_line_1").alias("line_1"), F.col("address_line_2").alias("line_2"), "city", "state",
                   "pincode", F.coalesce(month_boundaries("residing_since", "marked_at"),
                                         F.col("cp_stability")).alias("business_stability"), "house_ownership")
    return rows.groupBy("cp_ld").agg(*[F.collect_list(F.when(F.col("role") == r, row)).alias(r) for r in roles])


def role_address(tables: dict, profile_type: str, address_type: str, with_stability: bool = False,
                 lms: DataFrame | None = None) -> DataFrame:
    """Per loan (lms_id) the address of the active profile of one role and
    one address type. Left joins throughout: every loan appears; a role
    with several mapped addresses gives several rows. ``lms`` (column
    ``lms_id``) limits the loans."""
    ld = tables["loan_details"].select(F.col("uuid").cast("string").alias("ld_uuid"), "lms_id")
    if lms is not None:
        ld = ld.join(lms, "lms_id", "left_semi")
    lists = role_lists(tables, {"rows": (profile_type, address_type)}, _located(tables, [address_type]))
    r = (ld.join(lists, F.col("ld_uuid") == F.col("cp_ld"), "left")
         .select("lms_id", F.explode_outer("rows").alias("r")))
    cols = ["line_1", "line_2", "city", "state", "pincode"] + (["business_stability"] if with_stability else [])
    return r.select("lms_id", *[F.col(f"r.{c}").alias(c) for c in cols])


#: Roles whose addresses stand in the profile, and their columns.
ROLES = {
    "b": ("APPLICANT", "OFFICE"), "p": ("APPLICANT", "PERMANENT_RESIDENCE"),
    "g": ("GURANTOR", "CURRENT_RESIDENCE"), "c": ("CO_APPLICANT", "CURRENT_RESIDENCE"),
}
ROLE_COLUMNS = [
    ("p", "line_1", "permanent_address_1"), ("p", "line_2", "permanent_address_2"), ("p", "city", "peramanent_address_city"),
    ("p", "state", "peramanent_address_state"), ("p", "pincode", "permanant_pincode"),
    ("b", "line_1", "bussiness_address_1"), ("b", "line_2", "bussiness_address_2"), ("b", "city", "bussiness_address_city"),
    ("b", "state", "business_address_state"),
    ("c", "line_1", "co_app_address_1"), ("c", "line_2", "co_app_address_2"), ("c", "pincode", "co_app_pincode"),
    ("g", "line_1", "gurantor_address_1"), ("g", "line_2", "gurantor_address_2"), ("g", "pincode", "gurantor_pincode"),
]


def _keys(ld: DataFrame, own: str) -> DataFrame:
    """Distinct loan keys with ``own``, a column of the loans by which a
    branch is found, dealt out by it."""
    return (ld.where(F.col(own).isNotNull()).select(F.col("_loan").alias(f"_{own}_loan"), F.col(own).alias(f"_{own}"))
            .repartition(f"_{own}").distinct())


def _only_loans(tables: dict, ld: DataFrame) -> dict:
    """The tables with the rows by loan of ``ld`` and of loans that share an
    lms_id with one of these, so that the others are not carried along."""
    own = tables["loan_details"].join(ld.select("lms_id"), "lms_id", "left_semi")
    ids = own.select(F.col("uuid").alias("_id")).unionByName(ld.select(F.col("uuid").alias("_id")))
    of = lambda name, c: tables[name].join(ids, F.col(c) == F.col("_id"), "left_semi")
    return {**tables, "loan_details": own, "credit_profile": of("credit_profile", "loan_details_id"),
            "address_mapping": of("address_mapping", "loan_details_uuid"),
            "disbursal_details": of("disbursal_details", "loan_details_uuid")}


def loan_profile(tables: dict, loans: DataFrame | None = None) -> DataFrame:
    """One row per loan in DISBURSED/APPROVED (more when a role maps to
    several addresses), 69 output columns. ``loans`` (column ``loan_no``)
    limits the loans before any other join.

    The branches (booking with vehicle and dealer; applicant profile with
    report, user and address; the roles) are joined from their far side, on
    keys that are there, and all meet the loans by the loan's key. A branch
    that hangs on another column gets that key from the loans' keys alone, so
    the wide rows are dealt out once. Texts are taken out of the JSON documents
    before these travel."""
    ld = tables["loan_details"].where(F.col("loan_status").isin(*LOAN_STATUSES))
    if loans is not None:
        ld = ld.join(loans.select(F.col("loan_no").alias("w_loan_no")).distinct(),
                     F.col("loan_reference_id") == F.col("w_loan_no"), "left_semi")
        tables = _only_loans(tables, ld)
    # A loan without an id has a key of its own (no id starts with a NUL).
    dates = ("decision_date", "loan_start_date", "dp_date")
    ld = ld.select(*[(ist_date(c) if c in dates else F.col(c)).alias(f"ld_{c}") for c in ld.columns]).withColumn("_loan", F.coalesce(
        F.col("ld_uuid").cast("string"),
        F.concat(F.lit("\0"), F.xxhash64("ld_vehicle_booking_id", "ld_lms_id").cast("string"))))

    dealers = (tables["dealerships"].select(F.col("uuid").alias("ds_uuid"), F.col("full_name").alias("ds_full_name"),
                                            F.col("city_uuid").alias("ds_city_uuid"))
               .join(tables["cities"].select(F.col("uuid").alias("ct_uuid"), F.col("name").alias("ct_name"),
                                             F.col("state_uuid").alias("ct_state_uuid")),
                     F.col("ct_uuid") == F.col("ds_city_uuid"), "left")
               .join(tables["states"].select(F.col("uuid").alias("st_uuid"), F.col("name").alias("st_name")),
                     F.col("ct_state_uuid") == F.col("st_uuid"), "left"))
    t = lambda name, prefix: tables[name].select(
        *[F.col(c).alias(f"{prefix}_{c}") for c in tables[name].columns])
    vehicles = t("vehicles", "v").join(
        tables["oems"].select(F.col("uuid").alias("oe_uuid"), F.col("name").alias("oe_name")),
        F.col("oe_uuid") == F.col("v_oem_uuid"), "left")
    # RIGHT JOIN keeping every loan == loans LEFT JOIN bookings. Bookings of
    # other loans go first; the widest table comes last.
    booked = (_keys(ld, "ld_vehicle_booking_id")
              .join(t("vehicle_bookings", "vb"), F.col("_ld_vehicle_booking_id") == F.col("vb_uuid"), "inner")
              .join(tables["orders"].select(F.col("ref_id").alias("o_ref_id")),
                    F.col("o_ref_id") == F.col("vb_ref_id"), "inner")
              .join(tables["vehicle_details"].select(F.col("uuid").alias("vd_uuid"), F.col("vin").alias("vd_vin")),
                    F.col("vd_uuid") == F.col("vb_vehicle_details_uuid"), "left")
              .join(dealers, F.col("ds_uuid") == F.col("vb_dealership_uuid"), "left")
              .join(vehicles, F.col("v_uuid") == F.col("vb_vehicle_uuid"), "left"))

    details, score = F.col("credit_profile_additional_details"), json_text(F.col("credit_report_extra"), "score")
    cp = _active_profiles(tables, ["APPLICANT"]).where(F.col("loan_details_id").isNotNull()).select(
        F.col("loan_details_id").cast("string").alias("cp_ld"), F.col("user_profile_uuid").alias("cp_user"),
        F.when(F.col("profile_type") == "APPLICANT", "CURRENT_RESIDENCE").alias("cp_home"),
        F.col("uuid").alias("cp_uuid"), F.col("is_ntc").alias("cp_is_ntc"), F.col("monthly_income").alias("cp_monthly_income"),
        F.col("residence_stability").alias("cp_residence_stability"),
        *[json_text(details, key).alias(f"cp_{key}") for key in ("displayName", "abbValue", "abcValue", "scheme", "segment")])
    report = tables["credit_report"].select(F.col("credit_profile_id").alias("cr_cp"), score.cast("string").alias("cr_score"),
                                            ist_date("created_at").alias("cr_date"))
    user = tables["user_profiles"].select(F.col("uuid").alias("eu_uuid"), F.col("name").alias("eu_name"),
                                          F.col("gender").alias("eu_gender"), F.col("use_case").alias("eu_use_case"),
                                          F.col("dob").alias("eu_dob"),
                                          json_text(F.col("profile_info"), "occupation").alias("eu_occupation"))
    located = _located(tables, sorted({"CURRENT_RESIDENCE"} | {a for _, a in ROLES.values()}))
    applicant = (cp.join(report, F.col("cp_uuid") == F.col("cr_cp"), "left")
                   .join(user, F.col("eu_uuid") == F.col("cp_user"), "left")
                   .join(located, (F.col("cp_ld") == F.col("m_ld")) & _same("cp_user", "m_user")
                         & _same("cp_home", "m_type"), "left"))

    # Roles hang on lms_id. A loan that has its lms_id alone gets them by its own
    # id; only those of loans that share one are brought together by it.
    shared = tables["loan_details"].where(F.col("lms_id").isNotNull()).groupBy("lms_id").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("lms_id")
    lists = role_lists(tables, ROLES, located)
    rows = lambda r: F.when(F.size(r) > 0, F.col(r)).otherwise(  # noqa: E731  a loan without rows counts as one
        F.array(F.lit(None).cast(lists.schema[r].dataType.elementType)))
    together = (tables["loan_details"].select(F.col("uuid").cast("string").alias("ld_uuid"), "lms_id")
                .join(shared, "lms_id", "left_semi").join(lists, F.col("ld_uuid") == F.col("cp_ld"), "left")
                .select("lms_id", *[rows(r).alias(r) for r in ROLES]).groupBy("lms_id")
                .agg(*[F.flatten(F.collect_list(r)).alias(f"{r}_shared") for r in ROLES]))
    together = _keys(ld, "ld_lms_id").join(together, F.col("_ld_lms_id") == F.col("lms_id"), "inner").drop("lms_id")

    lp = tables["loan_provider"].select(F.col("uuid").alias("lp_uuid"), F.col("name").alias("lp_name"))
    dd = tables["disbursal_details"].where(F.col("loan_details_uuid").isNotNull()).select(
        F.col("loan_details_uuid").cast("string").alias("dd_ld"), "down_payment", "pre_emi_amount", "emi_amount",
        "utr_reference", ist_date("pre_emi_date").alias("pre_emi_date"), ist_date("emi_start_date").alias("emi_start_date"))
    j = (ld.join(lp, F.col("lp_uuid") == F.col("ld_loan_provider"), "left")
           .join(lists, F.col("_loan") == F.col("cp_ld"), "left")
           .join(together, (F.col("_loan") == F.col("_ld_lms_id_loan")) & _same("ld_lms_id", "_ld_lms_id"), "left"))
    for r in ROLES:
        own = F.when(F.col("ld_lms_id").isNotNull(), F.col(r))
        j = j.withColumn(r, F.explode_outer(F.coalesce(F.col(f"{r}_shared"), own)))
    j = j.select("_loan", "lp_name", *ld.drop("_loan").columns, F.col("b.business_stability").alias("business_stability"),
                 *[F.col(f"{role}.{field}").alias(name) for role, field, name in ROLE_COLUMNS])
    j = (j.join(dd, F.col("_loan") == F.col("dd_ld"), "left")
          .join(booked, (F.col("_loan") == F.col("_ld_vehicle_booking_id_loan"))
                & _same("ld_vehicle_booking_id", "_ld_vehicle_booking_id"), "left")
          .join(applicant, F.col("_loan") == F.col("cp_ld"), "left"))

    return j.select(
        F.col("ld_lms_id").alias("lms_id"),
        F.col("o_ref_id").alias("order_id"),
        F.coalesce(F.col("eu_name"), F.col("cp_displayName")).alias("customer_name"),
        F.col("eu_gender").alias("gender"),
        F.col("ld_assigned_to").alias("assigned_to"),
        F.when(F.col("cp_is_ntc") == 1, F.lit("NTC"))
         .otherwise(F.col("cr_score")).alias("bureau"),
        F.col("cp_abbValue").alias("abb_value"),
        F.col("cp_abcValue").alias("abc_value"),
        F.col("ld_loan_applicant_type").alias("constitution"),
        F.col("cp_scheme").alias("scheme"),
        F.col("cp_segment").alias("customer_segment"),
        F.col("eu_occupation").alias("occupation"),
        F.col("eu_use_case").alias("use_case_1"),
        F.col("cp_monthly_income").alias("monthly_income"),
        F.when(F.col("ld_co_applicant_added") == 1, F.lit("Available"))
         .when(F.coalesce(F.col("ld_co_applicant_added") != 0, F.lit(False)), F.lit("NA"))
         .otherwise(F.lit("Unknown")).alias("co_applicant_availability"),
        F.col("eu_dob").alias("dob"),
        F.coalesce(month_boundaries("residing_since", "marked_at"),
                   F.col("cp_residence_stability")).alias("residence_stability"),
        "business_stability",
        F.col("vb_source").alias("source"),
        F.col("ld_loan_reference_id").alias("loan_no"),
        F.col("ld_loan_status").alias("loan_status"),
        F.col("lp_name").alias("nbfc"),
        F.col("house_ownership").alias("house_ownership"),
        F.col("address_line_1").alias("current_address1"),
        F.col("address_line_2").alias("current_address2"),
        F.col("city").alias("current_city"),
        F.col("state").alias("current_state"),
        F.col("pincode").alias("curr_pincode"),
        *[name for _, _, name in ROLE_COLUMNS],
        F.col("oe_name").alias("oem_name"),
        F.col("v_name").alias("vehicle_name"),
        F.col("v_model").alias("vehicle_model"),
        F.col("v_vehicle_category_by_wheels").alias("vehicle_category_by_wheels"),
        F.col("v_vehicle_type").alias("vehicle_type"),
        F.col("v_variant").alias("vehicle_variant"),
        F.col("v_is_active").alias("vehicle_active_status"),
        F.col("vb_vehicle_number").alias("vehicle_number"),
        F.col("vd_vin").alias("vin"),
        F.col("ds_full_name").alias("dealership_name"),
        F.col("ld_on_road_price").alias("on_road_price"),
        F.col("cr_date").alias("soft_check_date"),
        F.col("ld_decision_date").alias("loan_approval_date"),
        F.col("ld_loan_start_date").alias("disbursal_date"),
        F.col("ld_dp_date").alias("downpayment_date"),
        F.col("pre_emi_date"),
        F.col("emi_start_date"),
        F.col("down_payment").alias("downpayment"),
        F.col("pre_emi_amount"),
        F.col("emi_amount"),
        F.col("utr_reference"),
        F.col("ld_loan_amount").alias("loan_amount"),
        F.col("ld_duration_in_months").alias("tenure"),
        F.col("ld_interest_rate").alias("rate_of_interest"),
        F.col("ct_name").alias("dealership_city_name"),
        F.col("st_name").alias("dealers_state_name"),
    )


def loan_vehicle_pairs(sheet: DataFrame) -> DataFrame:
    """(loan_no, vin) pairs of the loan/chassis sheet, both present."""
    return (sheet.where(F.col("loan_no").isNotNull() & F.col("chasisno").isNotNull())
                 .select(F.col("loan_no").cast("string"), F.col("chasisno").cast("string").alias("vin")))


def incomplete(master: DataFrame) -> Column:
    """A coordinate is missing: NULL, or NaN from an imported file."""
    out = F.lit(False)
    for c in ("current_lat", "current_lng", "permanent_lat", "permanent_lng"):
        out = out | F.col(c).isNull() | F.isnan(c)
    return out


def address_worklist(master: DataFrame, pairs: DataFrame) -> DataFrame:
    """Distinct (loan_no, vin): master rows missing a coordinate, plus
    pairs of the sheet that the master does not hold."""
    missing = master.where(incomplete(master)).select("loan_no", "vin")
    new = pairs.join(master.select("loan_no", "vin"), ["loan_no", "vin"], "left_anti")
    return missing.unionByName(new).distinct()


def _compose(line1: str, city: str, state: str, pin: str) -> Column:
    f = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    return F.concat(f(line1), F.lit(", "), f(city), F.lit(", "), f(state), F.lit(" "), f(pin))


def address_compose(worklist: DataFrame, profile: DataFrame) -> DataFrame:
    """Full postal texts ``line1, city, state pin`` (missing parts empty),
    current and permanent, for each work-list pair and matching profile row."""
    p = profile.select("loan_no", "vin", "current_address1", "current_city", "current_state", "curr_pincode",
                       "permanent_address_1", "peramanent_address_city", "peramanent_address_state",
                       "permanant_pincode")
    j = worklist.join(p, ["loan_no", "vin"], "left")
    return j.select(
        "loan_no", "vin",
        _compose("current_address1", "current_city", "current_state", "curr_pincode").alias("current_full_address"),
        _compose("permanent_address_1", "peramanent_address_city", "peramanent_address_state",
                 "permanant_pincode").alias("permanent_full_address"))


GEOCODE_SCHEMA = T.StructType([T.StructField("address", T.StringType()),
                               T.StructField("lat", T.DoubleType()),
                               T.StructField("lng", T.DoubleType())])


def geocode(addresses: DataFrame, cache: DataFrame,
            enrich: Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]] | None = None) -> DataFrame:
    """(address, lat, lng, status) for the distinct normalised non-empty
    addresses. Known ones come from ``cache`` (joined, not collected);
    misses go to ``enrich``, a ``mapInPandas`` function taking batches of
    ``address`` and returning ``GEOCODE_SCHEMA`` rows (the service client,
    batched and rate limited by the caller). A miss stays NULL with status
    'miss' so a later run retries it; it never becomes a fake coordinate."""
    keys = (addresses.select(normalize_address("address").alias("address"))
                     .where(F.col("address") != "").distinct())
    known = cache.select(normalize_address("address").alias("address"), "lat", "lng") \
                 .where(F.col("lat").isNotNull() & F.col("lng").isNotNull()
                        & ~F.isnan("lat") & ~F.isnan("lng")) \
                 .groupBy("address").agg(F.min(F.struct("lat", "lng")).alias("c"))
    hit = keys.join(known, "address", "left")
    out = hit.select("address", F.col("c.lat").alias("lat"), F.col("c.lng").alias("lng"))
    if enrich is not None:
        misses = out.where(F.col("lat").isNull()).select("address")
        fetched = misses.mapInPandas(enrich, GEOCODE_SCHEMA)
        out = out.where(F.col("lat").isNotNull()).unionByName(fetched)
    return out.withColumn("status", F.when(F.col("lat").isNotNull() & F.col("lng").isNotNull(), "ok")
                          .otherwise("miss"))


def geocode_lookup(composed: DataFrame, cache: DataFrame, enrich=None) -> DataFrame:
    """Coordinates of both composed addresses of each work-list row."""
    return attach_coordinates(composed, geocode(composed_addresses(composed), cache, enrich))


def composed_addresses(composed: DataFrame) -> DataFrame:
    return composed.select(F.explode(F.array("current_full_address", "permanent_full_address")).alias("address"))


def attach_coordinates(composed: DataFrame, geocoded: DataFrame) -> DataFrame:
    """The lookup key is normalised exactly like the geocoded key; rows with
    nothing to look up ('' can never match) become NULL keys of a spread of
    their own, so they do not meet in one task."""
    g = geocoded.select("address", "lat", "lng")
    cur = g.select(F.col("address").alias("_ca"), F.col("lat").alias("current_lat"), F.col("lng").alias("current_lng"))
    per = g.select(F.col("address").alias("_pa"), F.col("lat").alias("permanent_lat"),
                   F.col("lng").alias("permanent_lng"))
    spread = lambda c: F.when(c != "", c).otherwise(  # noqa: E731  no address starts with a NUL
        F.concat(F.lit("\0"), F.xxhash64("loan_no", "vin").cast("string")))
    c = composed.withColumn("_ck", spread(normalize_address("current_full_address"))) \
                .withColumn("_pk", spread(normalize_address("permanent_full_address")))
    j = c.join(cur, F.col("_ck") == F.col("_ca"), "left").join(per, F.col("_pk") == F.col("_pa"), "left")
    return j.select("loan_no", "vin", "current_lat", "current_lng", "permanent_lat", "permanent_lng")


def address_master_merge(master: DataFrame, processed: DataFrame, batch_seq: int) -> DataFrame:
    """Complete rows of the old master, then the processed rows of this run
    (``ingest_seq = batch_seq``, larger than every earlier sequence)."""
    keep = master.where(~incomplete(master)).select(*MASTER_COLUMNS)
    new = processed.select("vin", "loan_no", "current_lat", "current_lng", "permanent_lat", "permanent_lng",
                           F.lit(batch_seq).cast("long").alias("ingest_seq"))
    return keep.unionByName(new)


def master_dedup(master: DataFrame) -> DataFrame:
    """One row per vin: the earliest ingested (then smallest values, so the
    choice never depends on file or task order)."""
    best = master.groupBy("vin").agg(F.min(F.struct("ingest_seq", "loan_no", "current_lat", "current_lng",
                                                    "permanent_lat", "permanent_lng")).alias("m"))
    return best.select("vin", "m.loan_no", "m.current_lat", "m.current_lng", "m.permanent_lat",
                       "m.permanent_lng", "m.ingest_seq")
