"""Facts: clean rows only, with customer context.

The clean-row filter runs before the join with customers. ``clean_*`` give the same rows without
that join, for the marts that need no customer column.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkmart.functions import expr


def clean_only(df: DataFrame, flags: Sequence[str]) -> DataFrame:
    """Rows with no raised flag and a perfect score; a NULL flag or score does not pass."""
    keep = F.col("data_quality_score") == 1.0
    for flag in flags:
        keep = keep & ~F.col(flag)
    return df.where(keep)


def with_customer(df: DataFrame, customers: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Left join on the customer; Spark broadcasts a small side and AQE splits a hot customer."""
    return df.join(customers.select("customer_id", *columns), "customer_id", "left")


def _days_since_signup(day: Column) -> Column:
    return F.datediff(day, F.col("signup_date"))


def clean_transactions(txns: DataFrame) -> DataFrame:
    rows = clean_only(txns, ["is_amount_outlier"])
    return rows.select(
        "transaction_id",
        "customer_id",
        F.to_date("timestamp").alias("transaction_date"),
        "product_type",
        "status",
        "merchant_category",
        F.col("amount").alias("transaction_amount"),
        F.when(F.col("status") == "Completed", F.col("amount"))
        .otherwise(F.lit(0.0))
        .alias("completed_amount"),
        expr.flag01(F.col("status") == "Failed").alias("is_failed"),
        "data_quality_score",
        "is_amount_outlier",
    )


def transactions(txns: DataFrame, customers: DataFrame) -> DataFrame:
    joined = with_customer(clean_transactions(txns), customers, ["signup_date"])
    return joined.withColumn(
        "days_since_signup_at_transaction", _days_since_signup(F.col("transaction_date"))
    ).drop("signup_date")


def clean_loans(loans: DataFrame) -> DataFrame:
    rows = clean_only(loans, ["is_requested_amount_outlier", "is_loan_amount_outlier"])
    interest = F.col("loan_amount") * F.col("interest_rate") / 100
    return rows.select(
        "application_id",
        "customer_id",
        "application_date",
        "approval_status",
        "purpose",
        "loan_term_months",
        "requested_amount",
        "loan_amount",
        "interest_rate",
        expr.flag01(F.col("approval_status") == "Approved").alias("is_approved"),
        expr.flag01(F.col("approval_status") == "Declined").alias("is_declined"),
        expr.flag01(F.col("default_flag")).alias("is_default"),
        expr.rnd(interest, 2).alias("annual_interest_amount"),
        expr.rnd(F.col("requested_amount") - F.col("loan_amount"), 2).alias("amount_gap"),
        "data_quality_score",
        "is_requested_amount_outlier",
        "is_loan_amount_outlier",
    )


def loans(applications: DataFrame, customers: DataFrame) -> DataFrame:
    context = ["signup_date", "credit_tier", "credit_score"]
    joined = with_customer(clean_loans(applications), customers, context)
    return joined.withColumn(
        "days_since_signup_at_application", _days_since_signup(F.col("application_date"))
    ).drop("signup_date")


def clean_touches(touches: DataFrame) -> DataFrame:
    return clean_only(touches, ["is_cost_outlier"]).select(
        "touch_id",
        "customer_id",
        "touchpoint_date",
        "channel",
        "campaign",
        "utm_source",
        "utm_campaign",
        F.col("cost").alias("touch_cost"),
        "converted",
        expr.flag01(F.col("converted")).alias("is_converted"),
        "data_quality_score",
        "is_cost_outlier",
    )


def conversions(touches: DataFrame, customers: DataFrame) -> DataFrame:
    rows = clean_touches(touches).withColumn(
        "cost_per_conversion", F.when(F.col("converted"), F.col("touch_cost"))
    )
    context = ["credit_tier", "region", "acquisition_channel"]
    return with_customer(rows.drop("converted"), customers, context)


def marketing_spend(touches: DataFrame, customers: DataFrame) -> DataFrame:
    """Touch grain with dimension keys. An unknown outcome counts in neither spend column."""
    spend, converted = F.col("touch_cost"), F.col("converted")
    rows = clean_touches(touches).withColumns(
        {
            "channel_key": expr.surrogate_key("channel", "campaign"),
            "campaign_key": expr.surrogate_key("campaign", "utm_campaign"),
            "converted_spend": F.when(converted, spend).otherwise(F.lit(0.0)),
            "unconverted_spend": F.when(~converted, spend).otherwise(F.lit(0.0)),
        }
    )
    context = ["credit_tier", "region", "acquisition_channel"]
    return with_customer(rows.drop("converted"), customers, context).withColumnRenamed(
        "acquisition_channel", "customer_acquisition_channel"
    )
