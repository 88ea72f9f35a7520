"""Aggregated marts. Each is one or two partially aggregated group-bys."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkmart.functions import expr


def channel_performance(spend: DataFrame) -> DataFrame:
    return spend.groupBy(
        "channel", "campaign", "utm_source", "utm_campaign", "credit_tier", "region"
    ).agg(
        F.count("touch_id").alias("total_touches"),
        expr.money_sum("touch_cost").alias("total_spend"),
        expr.money_avg("touch_cost").alias("avg_cost_per_touch"),
        F.sum("is_converted").alias("total_conversions"),
        expr.rate_pct("is_converted").alias("conversion_rate_pct"),
        expr.ratio(
            expr.money_total("touch_cost"), F.sum("is_converted"), digits=2
        ).alias("cost_per_conversion"),
        expr.money_sum("converted_spend").alias("converted_spend"),
        expr.money_sum("unconverted_spend").alias("unconverted_spend"),
    )


def _month_number(day) -> F.Column:
    return F.year(day) * 12 + F.month(day)


def cohort(customers: DataFrame, txns: DataFrame) -> DataFrame:
    """Completed activity per signup cohort and month since signup (0 and later).

    ``customers`` has one row per customer, as the quality suite checks.

    Transactions are reduced to one row per customer and month before they meet the customers.
    """
    month = F.trunc("transaction_date", "month")
    activity = (
        txns.where(F.col("status") == "Completed")
        .groupBy("customer_id", month.alias("_month"))
        .agg(
            F.count("transaction_id").alias("_txns"),
            expr.money_total("transaction_amount").alias("_spend"),
        )
    )
    members = customers.select(
        "customer_id", "signup_date", "credit_tier", "region", "acquisition_channel"
    )
    months = _month_number(F.col("_month")) - _month_number(F.col("signup_date"))
    spend = F.sum("_spend")
    return (
        members.join(activity, "customer_id")
        .withColumns(
            {
                "cohort_month": F.date_format("signup_date", "yyyy-MM"),
                "months_since_signup": months,
            }
        )
        .where(F.col("months_since_signup") >= 0)
        .groupBy(
            "cohort_month", "credit_tier", "region", "acquisition_channel", "months_since_signup"
        )
        .agg(
            # One row per customer and month, and customers are unique: no distinct needed.
            F.count("customer_id").alias("active_customers"),
            F.sum("_txns").alias("total_transactions"),
            F.round(spend, 2).cast("double").alias("total_spend"),
            expr.ratio(spend, F.count("_spend"), digits=2).alias("avg_spend_per_customer"),
        )
    )


def credit_risk(loans: DataFrame) -> DataFrame:
    default_rate = expr.ratio(F.sum("is_default"), F.sum("is_approved"), 100.0, 2)
    return loans.groupBy("credit_tier", "approval_status", "purpose", "loan_term_months").agg(
        F.count("application_id").alias("total_applications"),
        F.sum("is_approved").alias("total_approved"),
        F.sum("is_declined").alias("total_declined"),
        F.sum("is_default").alias("total_defaults"),
        expr.rate_pct("is_approved").alias("approval_rate_pct"),
        expr.rate_pct("is_declined").alias("decline_rate_pct"),
        F.coalesce(default_rate, F.lit(0.0)).alias("default_rate_pct"),
        expr.money_avg("requested_amount").alias("avg_requested_amount"),
        expr.money_avg("loan_amount").alias("avg_approved_amount"),
        expr.money_sum("loan_amount").alias("total_loan_portfolio"),
        expr.money_avg("interest_rate").alias("avg_interest_rate"),
        expr.money_avg("annual_interest_amount").alias("avg_annual_interest"),
        expr.money_avg("amount_gap").alias("avg_amount_gap"),
        expr.rnd(F.avg("credit_score"), 2).alias("avg_credit_score"),
        expr.rnd(F.avg("days_since_signup_at_application"), 0).alias("avg_days_to_application"),
    )


def inventory_health(products: DataFrame) -> DataFrame:
    status, reorder = F.col("stock_status"), F.col("stock_level") <= F.col("reorder_point")
    out = F.count_if(status == "Out of Stock")
    stock, cost = F.col("stock_level"), F.col("unit_cost")
    reorder_cost = F.when(reorder, F.col("reorder_quantity") * cost).otherwise(F.lit(0.0))
    return products.groupBy("category", "supplier").agg(
        F.count("product_id").alias("total_products"),
        F.sum(stock).alias("total_stock_units"),
        out.alias("out_of_stock_count"),
        F.count_if(status == "Low Stock").alias("low_stock_count"),
        F.count_if(status == "In Stock").alias("in_stock_count"),
        expr.ratio(out, F.count("product_id"), 100.0, 2).alias("out_of_stock_rate_pct"),
        expr.money_sum(cost * stock).alias("total_inventory_cost"),
        expr.money_sum(F.col("selling_price") * stock).alias("total_inventory_value"),
        expr.money_avg("margin_pct").alias("avg_margin_pct"),
        expr.money_avg("gross_margin").alias("avg_gross_margin"),
        expr.sum_if("reorder_quantity", reorder).alias("total_units_to_reorder"),
        expr.money_sum(reorder_cost).alias("estimated_reorder_cost"),
        expr.rnd(F.avg("lead_time_days"), 1).alias("avg_lead_time_days"),
        F.max("lead_time_days").alias("max_lead_time_days"),
    )
