"""Loader of the loan tables, from catalog tables or from Parquet folders."""

from __future__ import annotations

from typing import Mapping

from pyspark.sql import DataFrame, SparkSession

#: The columns that the loan operators read, by table.
LOAN_COLUMNS: dict[str, str] = {
    "loan_details": "uuid lms_id vehicle_booking_id loan_provider loan_reference_id loan_status loan_applicant_type "
                    "assigned_to co_applicant_added on_road_price loan_amount interest_rate duration_in_months "
                    "decision_date loan_start_date dp_date",
    "orders": "ref_id",
    "vehicle_bookings": "uuid ref_id vehicle_details_uuid vehicle_uuid dealership_uuid source vehicle_number",
    "vehicle_details": "uuid vin",
    "credit_profile": "uuid loan_details_id user_profile_uuid profile_type is_active is_ntc "
                      "credit_profile_additional_details monthly_income business_stability residence_stability",
    "credit_report": "credit_profile_id credit_report_extra created_at",
    "user_profiles": "uuid name gender profile_info use_case dob",
    "loan_provider": "uuid name",
    "vehicles": "uuid name model oem_uuid vehicle_category_by_wheels vehicle_type variant is_active",
    "oems": "uuid name",
    "dealerships": "uuid full_name city_uuid",
    "cities": "uuid name state_uuid",
    "states": "uuid name",
    "disbursal_details": "loan_details_uuid pre_emi_date emi_start_date down_payment pre_emi_amount emi_amount "
                         "utr_reference",
    "address_mapping": "loan_details_uuid user_profile_uuid address_type address_uuid",
    "address": "uuid address_line_1 address_line_2 city state pincode house_ownership residing_since marked_at",
}
PAIR_COLUMNS = "loan_no chasisno"


def _checked(df: DataFrame, name: str, columns: str) -> DataFrame:
    have = {c.lower() for c in df.columns}
    missing = [c for c in columns.split() if c not in have]
    if missing:
        raise ValueError(f"table {name} has no column {', '.join(missing)}")
    return df.select(*columns.split())


def load_loan_tables(spark: SparkSession, where: str | Mapping[str, str]) -> dict[str, DataFrame]:
    """The loan tables by name, with the columns the operators need and no
    others. ``where`` is a folder with one Parquet table per name, or a map
    from name to catalog table. ValueError if a table of the map, or a column,
    is missing; an absent folder raises Spark's own error."""
    if isinstance(where, str):
        read = lambda name: spark.read.parquet(f"{where.rstrip('/')}/{name}")
    else:
        absent = [n for n in LOAN_COLUMNS if n not in where]
        if absent:
            raise ValueError(f"no loan table is named for {', '.join(absent)}")
        read = lambda name: spark.table(where[name])
    return {name: _checked(read(name), name, columns) for name, columns in LOAN_COLUMNS.items()}


def load_loan_pairs(df: DataFrame) -> DataFrame:
    """Loan and chassis numbers, checked."""
    return _checked(df, "loan pairs", PAIR_COLUMNS)
