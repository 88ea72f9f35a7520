"""Raw and staged layouts of the six source entities."""

from __future__ import annotations

from pyspark.sql import types as T

# Raw column names and types. Every column is nullable and raw dates are text;
# money is read as double (float would widen to noise in sums).
RAW_DDL = {
    "customers": """
        customer_id string, first_name string, last_name string, email string,
        date_of_birth string, gender string, region string, acquisition_channel string,
        signup_date string, credit_tier string, credit_score int, annual_income double,
        is_active boolean
    """,
    "transactions": """
        transaction_id string, customer_id string, amount double, product_type string,
        status string, timestamp string, merchant_category string
    """,
    "loan_applications": """
        application_id string, customer_id string, application_date string,
        requested_amount double, approval_status string, loan_amount double,
        interest_rate double, loan_term_months int, default_flag boolean, purpose string
    """,
    "marketing_touches": """
        touch_id string, customer_id string, channel string, campaign string,
        touchpoint_date string, cost double, converted boolean, utm_source string,
        utm_campaign string
    """,
    "product_inventory": """
        product_id string, sku string, product_name string, category string,
        unit_cost double, selling_price double, stock_level int, reorder_point int,
        reorder_quantity int, lead_time_days int, supplier string, is_active boolean
    """,
    "events_raw": """
        event_id string, session_id string, customer_id string, event_type string,
        page string, timestamp string, device string, utm_source string,
        utm_campaign string, is_bot boolean
    """,
}


def raw(entity: str) -> T.StructType:
    """Schema of a raw entity (parsing DDL needs a running session)."""
    return T.StructType.fromDDL(RAW_DDL[entity])


def raw_columns(entity: str) -> list[str]:
    return [field.split()[0] for field in RAW_DDL[entity].split(",")]


# Quality flags that each staged entity exposes after its raw columns.
STAGED_FLAGS = {
    "customers": ["is_income_outlier"],
    "transactions": ["is_amount_outlier"],
    "loan_applications": ["is_requested_amount_outlier", "is_loan_amount_outlier"],
    "marketing_touches": ["is_cost_outlier"],
    "product_inventory": ["is_unit_cost_outlier", "is_selling_price_outlier"],
    "events_raw": [],
}


def staged_columns(entity: str) -> list[str]:
    return raw_columns(entity) + STAGED_FLAGS[entity] + ["is_duplicate", "data_quality_score"]
