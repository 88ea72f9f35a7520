"""Acquisition cost and retention."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkmart.functions import expr


def channel_cac(spend: DataFrame, approx: bool = False) -> DataFrame:
    """Last-click CAC uses the spend on converting touches, blended CAC all spend."""
    total, conversions = expr.money_total("touch_cost"), F.sum("is_converted")
    converting = expr.money_total(F.when(F.col("is_converted") == 1, F.col("touch_cost")))
    return spend.groupBy("channel").agg(
        expr.ndv("customer_id", approx).alias("total_customers_touched"),
        conversions.alias("conversions"),
        expr.money_sum("touch_cost").alias("total_spend"),
        expr.ratio(converting, conversions, digits=2).alias("last_click_cac"),
        expr.ratio(total, conversions, digits=2).alias("blended_cac"),
        expr.rate_pct("is_converted").alias("conversion_rate_pct"),
    )


def cac_gap(spend: DataFrame) -> DataFrame:
    """How far last-click CAC falls short of blended CAC, from the rounded figures."""
    last, blended = F.col("last_click_cac"), F.col("blended_cac")
    return channel_cac(spend).select(
        "channel",
        "conversions",
        "last_click_cac",
        "blended_cac",
        expr.rnd(blended - last, 2).alias("cac_gap"),
        expr.rnd((expr.ratio(blended, last) - 1) * 100, 1).alias("pct_underestimate"),
    )


def _activity(customers: DataFrame, txns: DataFrame, days: Sequence[int]) -> DataFrame:
    """One row per customer: was there a non-failed transaction in days 1..N after signup?

    Transactions are reduced to distinct customer days before the join.
    """
    active_days = (
        txns.where(F.col("is_failed") == 0).select("customer_id", "transaction_date").distinct()
    )
    members = customers.select("customer_id", "signup_date", "acquisition_channel")
    since = F.datediff("transaction_date", "signup_date")
    return (
        members.join(active_days, "customer_id", "left")
        .withColumn("cohort_month", F.date_format("signup_date", "yyyy-MM"))
        .groupBy("customer_id", "cohort_month", "acquisition_channel")
        .agg(*[F.max(expr.flag01(since.between(1, n))).alias(f"active_{n}d") for n in days])
    )


def retention(
    customers: DataFrame,
    txns: DataFrame,
    by: str = "cohort_month",
    days: Sequence[int] = (30, 60, 90),
) -> DataFrame:
    """Retention by signup month (counts and rates) or by acquisition channel (rates)."""
    active = _activity(customers, txns, days)
    if by == "cohort_month":
        return active.groupBy(by).agg(
            F.count("customer_id").alias("cohort_size"),
            *[F.sum(f"active_{n}d").alias(f"retained_{n}d") for n in days],
            *[expr.rate_pct(f"active_{n}d", 1).alias(f"retention_rate_{n}d") for n in days],
        )
    return active.groupBy(by).agg(
        F.count(F.lit(1)).alias("cohort_size"),
        *[expr.rate_pct(f"active_{n}d", 1).alias(f"retention_{n}d_pct") for n in days],
    )
