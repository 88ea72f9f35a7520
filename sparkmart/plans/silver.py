"""Cleaned entities: one declarative recipe per source table, applied in a fixed order.

deduplicate -> drop bots -> casing -> dates -> fill -> outlier flags -> quality score. The fill
mean is taken after deduplication and the outlier bounds after the fill.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkmart import schemas
from sparkmart.operators import clean


@dataclass(frozen=True)
class Recipe:
    key: str
    title: tuple[str, ...] = ()
    lower: tuple[str, ...] = ()
    mapping: Mapping[str, Mapping[str, str]] = field(default_factory=dict)
    dates: tuple[str, ...] = ()
    timestamps: tuple[str, ...] = ()
    fill: Mapping[str, object] = field(default_factory=dict)
    fill_mean: tuple[str, ...] = ()
    outliers: Mapping[str, str] = field(default_factory=dict)  # measure -> flag
    penalties: Mapping[str, str] = field(default_factory=dict)  # flag -> penalty
    bots: bool = False


# Which columns each entity cleans, its fill values, remaps, flags and penalties.
RECIPES = {
    "customers": Recipe(
        key="customer_id",
        title=("gender", "region", "acquisition_channel", "credit_tier"),
        mapping={"acquisition_channel": {"Direct": "Direct Mail"}},
        dates=("signup_date", "date_of_birth"),
        fill={"email": "unknown@unknown.com", "gender": "Unknown"},
        fill_mean=("annual_income",),
        outliers={"annual_income": "is_income_outlier"},
        penalties={"is_income_outlier": "0.2"},
    ),
    "transactions": Recipe(
        key="transaction_id",
        title=("product_type", "status", "merchant_category"),
        timestamps=("timestamp",),
        fill={"status": "Unknown", "merchant_category": "Unknown"},
        outliers={"amount": "is_amount_outlier"},
        penalties={"is_amount_outlier": "0.2"},
    ),
    "loan_applications": Recipe(
        key="application_id",
        title=("approval_status", "purpose"),
        dates=("application_date",),
        fill={"purpose": "Unknown"},
        outliers={
            "requested_amount": "is_requested_amount_outlier",
            "loan_amount": "is_loan_amount_outlier",
        },
        penalties={"is_requested_amount_outlier": "0.1", "is_loan_amount_outlier": "0.1"},
    ),
    "marketing_touches": Recipe(
        key="touch_id",
        title=("channel",),
        mapping={"channel": {"Digital": "Referral"}},
        dates=("touchpoint_date",),
        fill={"cost": 0.0, "utm_source": "unknown", "utm_campaign": "unknown"},
        outliers={"cost": "is_cost_outlier"},
        penalties={"is_cost_outlier": "0.2"},
    ),
    "product_inventory": Recipe(
        key="product_id",
        fill={"supplier": "Unknown"},
        fill_mean=("selling_price",),
        outliers={
            "unit_cost": "is_unit_cost_outlier",
            "selling_price": "is_selling_price_outlier",
        },
        penalties={"is_unit_cost_outlier": "0.1", "is_selling_price_outlier": "0.1"},
    ),
    "events_raw": Recipe(
        key="event_id",
        lower=("event_type", "device"),
        timestamps=("timestamp",),
        fill={"device": "unknown", "utm_campaign": "unknown"},
        bots=True,
    ),
}


def refine(
    df: DataFrame,
    recipe: Recipe,
    load_date: str | None = None,
    deduplicated: bool = False,
    k: float = 3.0,
) -> DataFrame:
    """Apply a recipe. ``deduplicated`` skips the per-key pass for inputs already unique by key."""
    out = df if deduplicated else clean.dedup(df, recipe.key)
    # Bots go first, so that their rows are not normalised.
    out = clean.drop_bots(out) if recipe.bots else out
    return judged(normalise(out, recipe), recipe, load_date, k)


def normalise(df: DataFrame, recipe: Recipe) -> DataFrame:
    """The steps that look at one row: casing, dates, constant fills."""
    out = clean.casing(df, recipe.title, recipe.lower, recipe.mapping)
    out = clean.parse_dates(out, recipe.dates)
    out = clean.parse_dates(out, recipe.timestamps, kind="timestamp")
    return clean.fill(out, recipe.fill) if recipe.fill else out


def judged(
    df: DataFrame,
    recipe: Recipe,
    load_date: str | None = None,
    k: float = 3.0,
    means: Mapping[str, float | None] | None = None,
    bounds: Mapping[str, float | None] | None = None,
) -> DataFrame:
    """Drop bots and take the steps that depend on all rows: mean fills, outlier flags and the score.

    ``means`` and ``bounds`` are computed from ``df`` unless they are known.
    """
    out = clean.drop_bots(df) if recipe.bots else df
    out = clean.fill_mean(out, recipe.fill_mean, known=means) if recipe.fill_mean else out
    out = clean.flag_outliers(out, recipe.outliers, k, known=bounds) if recipe.outliers else out
    out = clean.quality_score(out.withColumn("is_duplicate", F.lit(False)), recipe.penalties)
    return out.withColumn("silver_load_date", F.lit(load_date)) if load_date else out


def entity(name: str, df: DataFrame, load_date: str | None = None, **options) -> DataFrame:
    return refine(df, RECIPES[name], load_date, **options)


def customers(df: DataFrame, load_date: str | None = None, **options) -> DataFrame:
    return entity("customers", df, load_date, **options)


def transactions(df: DataFrame, load_date: str | None = None, **options) -> DataFrame:
    return entity("transactions", df, load_date, **options)


def loans(df: DataFrame, load_date: str | None = None, **options) -> DataFrame:
    return entity("loan_applications", df, load_date, **options)


def touches(df: DataFrame, load_date: str | None = None, **options) -> DataFrame:
    return entity("marketing_touches", df, load_date, **options)


def products(df: DataFrame, load_date: str | None = None, **options) -> DataFrame:
    return entity("product_inventory", df, load_date, **options)


def events(df: DataFrame, load_date: str | None = None, **options) -> DataFrame:
    return entity("events_raw", df, load_date, **options)


def staging(name: str, df: DataFrame) -> DataFrame:
    """The columns of a cleaned entity that the star schema may use."""
    return df.select(*schemas.staged_columns(name))
