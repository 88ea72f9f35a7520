"""Dimensions of the star schema."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkmart.functions import expr

# Bands as (lower bound, label), highest first.
CREDIT_BANDS = [(750, "Excellent"), (700, "Good"), (650, "Fair")]
INCOME_BANDS = [(100000, "High"), (60000, "Medium")]
MARGIN_BANDS = [(50, "High Margin"), (30, "Medium Margin")]

# What kind of channel each channel is.
CHANNEL_TYPES = {
    "Email": "Digital", "Social": "Digital", "Digital": "Digital", "Direct Mail": "Traditional",
}

# The channel a campaign mainly runs on, and what it is for.
PRIMARY_CHANNELS = {
    "Email": ["Welcome Series", "Re-engagement", "Promotional"],
    "Social": ["Lookalike", "Retargeting"],
    "Digital": ["Display Prospecting", "Search Retargeting"],
    "Direct Mail": ["Seasonal Offer", "Pre-approved Offer"],
}
OBJECTIVES = {
    "Acquisition": ["Welcome Series", "Lookalike", "Display Prospecting"],
    "Retention": ["Re-engagement", "Retargeting", "Search Retargeting"],
    "Conversion": ["Promotional", "Seasonal Offer", "Pre-approved Offer"],
}

# Season by month number; the rest is Fall.
SEASONS = {"Winter": [12, 1, 2], "Spring": [3, 4, 5], "Summer": [6, 7, 8]}


def _member(c: str | Column, groups: Mapping[str, Sequence], default: str) -> Column:
    return expr.cases(
        [(expr.as_col(c).isin(*members), label) for label, members in groups.items()], default
    )


def customer(df: DataFrame, as_of: Column | str) -> DataFrame:
    """``as_of`` (a date, its text, or a column) takes the place of today's date."""
    today = F.to_date(F.lit(as_of)) if isinstance(as_of, str) else as_of
    return df.select(
        "customer_id",
        "first_name",
        "last_name",
        F.concat("first_name", F.lit(" "), "last_name").alias("full_name"),
        "email",
        "gender",
        "region",
        "acquisition_channel",
        "signup_date",
        "credit_tier",
        "credit_score",
        "annual_income",
        expr.band("credit_score", CREDIT_BANDS, "Poor").alias("credit_score_band"),
        expr.band("annual_income", INCOME_BANDS, "Low").alias("income_band"),
        F.datediff(today, F.col("signup_date")).alias("days_since_signup"),
        "is_active",
        "data_quality_score",
    )


def product(df: DataFrame) -> DataFrame:
    """Active products with margins and stock status; a zero price gives a NULL margin."""
    margin = F.col("selling_price") - F.col("unit_cost")
    status = expr.cases(
        [
            (F.col("stock_level") == 0, "Out of Stock"),
            (F.col("stock_level") <= F.col("reorder_point"), "Low Stock"),
        ],
        "In Stock",
    )
    return (
        df.where("is_active")
        .withColumns(
            {
                "gross_margin": expr.rnd(margin, 2),
                "margin_pct": expr.ratio(margin, "selling_price", 100.0, 2),
                "stock_status": status,
            }
        )
        .withColumn("margin_band", expr.band("margin_pct", MARGIN_BANDS, "Low Margin"))
        .select(
            "product_id", "sku", "product_name", "category", "unit_cost", "selling_price",
            "gross_margin", "margin_pct", "stock_level", "reorder_point", "reorder_quantity",
            "lead_time_days", "supplier", "stock_status", "margin_band", "is_active",
            "data_quality_score",
        )
    )


def channel(touches: DataFrame, types: Mapping[str, str] = CHANNEL_TYPES) -> DataFrame:
    """One row per channel and campaign. Keys are hashed after the distinct, not before."""
    kind = expr.cases([(F.col("channel") == name, label) for name, label in types.items()], "Other")
    return (
        touches.select("channel", "campaign")
        .distinct()
        .select(
            expr.surrogate_key("channel", "campaign").alias("channel_key"),
            "channel",
            "campaign",
            kind.alias("channel_type"),
        )
    )


def campaign(
    touches: DataFrame,
    primary: Mapping[str, Sequence[str]] = PRIMARY_CHANNELS,
    objectives: Mapping[str, Sequence[str]] = OBJECTIVES,
) -> DataFrame:
    return (
        touches.select("campaign", "utm_campaign")
        .distinct()
        .select(
            expr.surrogate_key("campaign", "utm_campaign").alias("campaign_key"),
            "campaign",
            "utm_campaign",
            _member("campaign", primary, "Other").alias("primary_channel"),
            _member("campaign", objectives, "Other").alias("campaign_objective"),
        )
    )


def date_spine(spark: SparkSession, start: str, end: str) -> DataFrame:
    """Every day from ``start`` up to, not including, ``end``."""
    days = F.sequence(F.to_date(F.lit(start)), F.date_sub(F.to_date(F.lit(end)), 1))
    return spark.range(1).select(F.explode(days).alias("date_day"))


def spine_over(df: DataFrame, column: str) -> DataFrame:
    """Every day between the first and the last date in a column."""
    days = F.sequence(F.min(F.to_date(column)), F.max(F.to_date(column)))
    return df.agg(days.alias("_days")).select(F.explode("_days").alias("date_day"))


def date(spine: DataFrame) -> DataFrame:
    """Calendar attributes for a frame with a ``date_day`` column."""
    d = F.col("date_day")
    weekend = F.dayofweek(d).isin(1, 7)
    return spine.select(
        d.cast("date").alias("date_id"),
        F.year(d).alias("year"),
        F.quarter(d).alias("quarter"),
        F.month(d).alias("month"),
        F.day(d).alias("day"),
        F.dayofweek(d).alias("day_of_week"),
        F.dayofyear(d).alias("day_of_year"),
        F.weekofyear(d).alias("week_of_year"),
        F.date_format(d, "MMMM").alias("month_name"),
        F.date_format(d, "EEEE").alias("day_name"),
        F.date_format(d, "MMM yyyy").alias("month_year"),
        F.date_format(d, "yyyy-MM").alias("year_month"),
        F.concat(F.lit("Q"), F.quarter(d), F.lit(" "), F.year(d)).alias("quarter_label"),
        weekend.alias("is_weekend"),
        (~weekend).alias("is_weekday"),
        _member(F.month(d), SEASONS, "Fall").alias("season"),
    )
