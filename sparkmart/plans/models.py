"""The gold layer as named models: staging, star schema, marts, attribution, supply, serving.

A model is a name, the names it reads, and a function from those frames to its own. ``assemble``
wires them lazily; ``refresh`` writes each one as a table and lets later models read the table, so
nothing is computed twice and no lineage grows long.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from sparkmart import schemas
from sparkmart.operators import (
    attribution, dims, facts, forecast, journey, marts, roi, sessions, supply,
)
from sparkmart.plans import silver
from sparkmart.sources import io


@dataclass(frozen=True)
class Model:
    inputs: tuple[str, ...]
    build: Callable[..., DataFrame]


# Staging view -> cleaned entity.
STAGING = {
    "stg_customers": "customers",
    "stg_transactions": "transactions",
    "stg_loan_applications": "loan_applications",
    "stg_marketing_touches": "marketing_touches",
    "stg_product_inventory": "product_inventory",
    "stg_events": "events_raw",
}

# Serving view -> (model, comment). View and model names are fixed values.
SERVING = {
    "srv_channel_performance": (
        "mart_channel_performance", "Touches, spend and conversions by channel and campaign",
    ),
    "srv_cohort_analysis": ("mart_cohort_analysis", "Activity by signup month and month since"),
    "srv_inventory_health": ("mart_inventory_health", "Stock and margins by category and supplier"),
    "srv_credit_risk": ("mart_credit_risk", "Approvals, defaults and amounts by credit tier"),
    "srv_channel_roi_summary": ("channel_roi", "Acquisition cost per channel"),
}


def _staged(entity: str) -> Callable[[DataFrame], DataFrame]:
    return lambda df: silver.staging(entity, df)


def _of_model(model: str) -> Callable[[DataFrame], DataFrame]:
    return lambda credited: attribution.of_model(credited, model)


def _loan_forecast(train_end: str, created_at: str) -> Callable[[DataFrame], DataFrame]:
    def build(loans: DataFrame) -> DataFrame:
        train, _ = forecast.split(forecast.daily_counts(loans, "application_date"), train_end)
        return forecast.publish(forecast.fit_predict(train), "trend_v1", train_end, created_at)

    return build


def gold(
    as_of: str,
    train_end: str,
    created_at: str,
    calendar: tuple[str, str] = ("2020-01-01", "2027-12-31"),
    load_date: str | None = None,
) -> dict[str, Model]:
    """All models in dependency order. Inputs that are no model are cleaned entities.

    ``load_date`` stamps the three silver tables that are derived here.
    """
    models = {name: Model((entity,), _staged(entity)) for name, entity in STAGING.items()}
    touches_and_customers = ("stg_marketing_touches", "stg_customers")
    spend = ("fct_marketing_spend",)
    start, end = calendar

    def dim_date(customers: DataFrame) -> DataFrame:
        return dims.date(dims.date_spine(customers.sparkSession, start, end))

    models |= {
        "silver_sessions": Model(("stg_events",), lambda e: sessions.rollup(sessions.assign(e), load_date=load_date)),
        "silver_touchpoints": Model(
            (*touches_and_customers, "silver_sessions"),
            lambda t, c, s: journey.touchpoints(t, c, s, load_date=load_date),
        ),
        "silver_customer_journey": Model(
            ("stg_customers", "stg_transactions", "stg_marketing_touches"),
            lambda c, x, t: journey.customer_360(c, x, t, load_date=load_date),
        ),
        "dim_customer": Model(("stg_customers",), lambda c: dims.customer(c, as_of)),
        "dim_products": Model(("stg_product_inventory",), dims.product),
        "dim_channel": Model(("stg_marketing_touches",), dims.channel),
        "dim_campaign": Model(("stg_marketing_touches",), dims.campaign),
        "dim_date": Model(("stg_customers",), dim_date),
        "fct_transactions": Model(("stg_transactions", "stg_customers"), facts.transactions),
        "fct_loan_applications": Model(("stg_loan_applications", "stg_customers"), facts.loans),
        "fct_conversions": Model(touches_and_customers, facts.conversions),
        "fct_marketing_spend": Model(touches_and_customers, facts.marketing_spend),
        "mart_channel_performance": Model(spend, marts.channel_performance),
        "mart_cohort_analysis": Model(("stg_customers", "fct_transactions"), marts.cohort),
        "mart_credit_risk": Model(("fct_loan_applications",), marts.credit_risk),
        "mart_inventory_health": Model(("dim_products",), marts.inventory_health),
        "channel_roi": Model(spend, roi.channel_cac),
        # One pass over the touches; the five models' tables are projections of it.
        "attribution_credits": Model(spend, attribution.credits),
        **{
            f"fct_attribution_{m}": Model(("attribution_credits",), _of_model(m))
            for m in attribution.MODELS
        },
        "mart_attribution_comparison": Model(spend, attribution.compare),
        "fct_inventory_health": Model(
            ("stg_product_inventory",), lambda p: supply.inventory_health(p, as_of)
        ),
        "fct_stockout_early_warning": Model(("fct_inventory_health",), supply.stockout_warning),
        "mart_sop_simulation": Model(
            ("fct_inventory_health", "fct_transactions"), supply.sop_category
        ),
        "srv_loan_forecast": Model(
            ("fct_loan_applications",), _loan_forecast(train_end, created_at)
        ),
        "mart_sop_sku_variance": Model(
            ("fct_stockout_early_warning", "srv_loan_forecast"),
            lambda warnings, fc: supply.sku_variance(warnings, fc, as_of),
        ),
    }
    return models


def assemble(entities: Mapping[str, DataFrame], models: Mapping[str, Model]) -> dict[str, DataFrame]:
    """Every model as a lazy frame over the cleaned entities."""
    frames = dict(entities)
    for name, model in models.items():
        frames[name] = model.build(*[frames[i] for i in model.inputs])
    return {name: frames[name] for name in models}


def refresh(
    spark: SparkSession,
    entities: Mapping[str, DataFrame],
    models: Mapping[str, Model],
    database: str = "default",
    fmt: str = "parquet",
    partitions: Mapping[str, Sequence[str]] | None = None,
    counts: dict[str, int] | None = None,
) -> dict[str, DataFrame]:
    """Write every model except the staging views, in order; later models read the tables.

    ``partitions`` names partition columns by model; ``counts`` receives the rows of each write.
    """
    frames = dict(entities)
    counts = {} if counts is None else counts
    for name, model in models.items():
        frame = model.build(*[frames[i] for i in model.inputs])
        if name not in STAGING:
            by = (partitions or {}).get(name, ())
            counts[name] = io.write_table(frame, f"{database}.{name}", fmt, by)
            frame = spark.read.table(f"{database}.{name}")
        frames[name] = frame
    return {name: frames[name] for name in models}


def publish_views(
    spark: SparkSession,
    views: Mapping[str, tuple[str, str]] = SERVING,
    database: str = "default",
) -> None:
    """``CREATE OR REPLACE VIEW`` with a comment over each listed table."""
    for view, (source, comment) in views.items():
        text = comment.replace("'", "\\'")
        spark.sql(
            f"CREATE OR REPLACE VIEW {database}.{view} COMMENT '{text}' "
            f"AS SELECT * FROM {database}.{source}"
        )


def publish_staging(spark: SparkSession, database: str = "default") -> None:
    """Staging views over the silver tables: ``stg_x`` over ``silver_x``."""
    for view, entity in STAGING.items():
        columns = ", ".join(f"`{c}`" for c in schemas.staged_columns(entity))
        spark.sql(f"CREATE OR REPLACE VIEW {database}.{view} AS SELECT {columns} FROM {database}.silver_{entity}")
