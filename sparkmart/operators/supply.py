"""Inventory health, stock-out warnings and supply-demand views."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkmart.functions import expr

# Warning levels with their severity and the text of the recommended action.
SEVERITY = {"STOCKOUT": 1, "CRITICAL": 2, "AT_RISK": 3, "WARNING": 4}
ACTIONS = {
    "STOCKOUT": "Emergency order required immediately",
    "CRITICAL": "Place order now — below reorder point",
    "AT_RISK": "Order urgently — stockout within lead time",
    "WARNING": "Monitor closely — approaching reorder point",
    "OK": "No action required",
}

# Share of SKUs at risk from which a category has a risk level and recommendation.
RISK_LEVELS = [(50, "HIGH RISK"), (25, "MEDIUM RISK")]
RISK_ADVICE = [
    (50, "Immediate procurement review required"),
    (25, "Schedule procurement review this week"),
]


def _date(as_of: Column | str) -> Column:
    return F.to_date(F.lit(as_of)) if isinstance(as_of, str) else as_of


def inventory_health(products: DataFrame, as_of: Column | str) -> DataFrame:
    """Stock value, supply and risk of every product, inactive ones included.

    ``days_of_supply`` is stock divided by reorder quantity: a ratio in spite of its name. Without
    a reorder quantity it is NULL, which reads as low obsolescence and healthy stock.
    """
    stock, reorder_at = F.col("stock_level"), F.col("reorder_point")
    supply = F.col("days_of_supply")
    return (
        products.where(~F.col("is_duplicate"))
        .withColumn("days_of_supply", expr.ratio(stock, "reorder_quantity", digits=1))
        .select(
            "product_id",
            "product_name",
            "category",
            "supplier",
            _date(as_of).alias("snapshot_date"),
            "stock_level",
            "reorder_point",
            "reorder_quantity",
            "lead_time_days",
            "unit_cost",
            "selling_price",
            expr.rnd(stock * F.col("unit_cost"), 2).alias("inventory_value"),
            "days_of_supply",
            expr.flag01(stock <= reorder_at).alias("reorder_trigger"),
            expr.cases([(supply > 180, "high"), (supply > 90, "medium")], "low").alias(
                "obsolescence_risk"
            ),
            expr.cases(
                [
                    (stock <= 0, "out_of_stock"),
                    (stock <= reorder_at, "critical"),
                    (supply <= 30, "low"),
                    (supply <= 60, "moderate"),
                ],
                "healthy",
            ).alias("stock_status"),
        )
    )


def stockout_warning(health: DataFrame) -> DataFrame:
    """Warning level, days left, order quantity and action per product, with a severity rank."""
    status, supply = F.col("stock_status"), F.col("days_of_supply")
    lead = F.col("lead_time_days")
    within_lead, near_lead = supply <= lead, supply <= lead * 1.5
    level = expr.cases(
        [
            (status == "out_of_stock", "STOCKOUT"),
            (status == "critical", "CRITICAL"),
            (within_lead, "AT_RISK"),
            (near_lead, "WARNING"),
        ],
        "OK",
    )
    days_left = F.when(status == "out_of_stock", F.lit(0)).when(within_lead, supply.cast("int"))
    quantity = F.col("reorder_quantity")
    order = (
        F.when(F.col("stock_level") < F.col("reorder_point"), quantity)
        .when(near_lead, F.ceil(quantity * 1.25).cast("int"))
        .otherwise(F.lit(0))
    )
    warning = F.col("warning_level")
    action = expr.cases([(warning == name, text) for name, text in ACTIONS.items()])
    return (
        health.drop("selling_price")
        .withColumns(
            {
                "warning_level": level,
                "days_until_stockout": days_left,
                "recommended_order_qty": order,
            }
        )
        .withColumns(
            {
                "recommended_action": action,
                "severity_rank": expr.rank_map("warning_level", SEVERITY, 5),
            }
        )
    )


def order_by_severity(warnings: DataFrame, metric: str) -> DataFrame:
    """Presentation order: most severe first, then the smallest metric."""
    return warnings.orderBy("severity_rank", metric, "product_id")


def product_demand(txns: DataFrame) -> DataFrame:
    """Non-failed transactions per product type."""
    return (
        txns.where(F.col("is_failed") == 0)
        .groupBy(F.col("product_type").alias("category"))
        .agg(
            F.count("transaction_id").alias("total_transactions"),
            expr.money_sum("transaction_amount").alias("total_revenue"),
            expr.money_avg("transaction_amount").alias("avg_transaction_value"),
            F.count_distinct("customer_id").alias("unique_customers"),
        )
    )


def sop_category(health: DataFrame, txns: DataFrame, demand_once: bool = False) -> DataFrame:
    """Category roll-up of stock status next to demand.

    Demand is counted once per SKU of the category (``demand_once=False``), or once. Both sides are
    aggregated to one row per category before they are joined.
    """
    status = F.col("stock_status")
    at_risk = F.count_if(status.isin("out_of_stock", "critical"))
    stock = health.groupBy("category").agg(
        F.count("product_id").alias("total_skus"),
        F.count(F.lit(1)).alias("_skus"),
        F.sum("stock_level").alias("total_units_on_hand"),
        expr.money_sum("inventory_value").alias("total_inventory_value"),
        expr.money_avg("days_of_supply", digits=1).alias("avg_days_of_supply"),
        *[
            F.count_if(status == name).alias(f"skus_{name}")
            for name in ("out_of_stock", "critical", "low", "moderate", "healthy")
        ],
        F.count_if(F.col("reorder_trigger") == 1).alias("skus_needing_reorder"),
        F.count_if(F.col("obsolescence_risk") == "high").alias("skus_high_obsolescence"),
        expr.ratio(at_risk, F.count("product_id"), 100.0, 1).alias("pct_skus_at_risk"),
    )
    times = F.lit(1) if demand_once else F.col("_skus")
    revenue = F.coalesce("total_revenue", F.lit(0.0)) * times
    demand = product_demand(txns).drop("unique_customers")
    return stock.join(demand, "category", "left").select(
        "category",
        "total_skus",
        "total_units_on_hand",
        "total_inventory_value",
        "avg_days_of_supply",
        "skus_out_of_stock",
        "skus_critical",
        "skus_low",
        "skus_moderate",
        "skus_healthy",
        "skus_needing_reorder",
        "skus_high_obsolescence",
        expr.rnd(revenue, 2).alias("total_category_revenue"),
        F.coalesce("avg_transaction_value", F.lit(0.0)).alias("avg_transaction_value"),
        (F.coalesce("total_transactions", F.lit(0)) * times).alias("total_transactions"),
        "pct_skus_at_risk",
        expr.band("pct_skus_at_risk", RISK_LEVELS, "LOW RISK").alias("category_risk_level"),
        expr.band("pct_skus_at_risk", RISK_ADVICE, "No immediate action required").alias(
            "sop_recommendation"
        ),
    )


def sku_variance(
    warnings: DataFrame, forecast: DataFrame, as_of: Column | str, horizon: int = 30
) -> DataFrame:
    """Stock against the demand forecast for ``[as_of, as_of + horizon)``.

    ``forecast`` has ``forecast_date`` and ``predicted_applications``, for one series or several:
    predictions are summed per day first. Its two figures come in as one scalar subquery, so the
    products are only projected.
    """
    start, day = _date(as_of), F.col("forecast_date")
    window = forecast.where((day >= start) & (day < F.date_add(start, horizon)))
    per_day = window.groupBy("forecast_date").agg(expr.money_total("predicted_applications").alias("_sum"))
    figures = per_day.agg(
        F.struct(
            expr.rnd(F.avg("_sum"), 2).alias("daily"),
            F.round(F.sum("_sum"), 2).cast("double").alias("total"),
        )
    ).scalar()
    daily, lead = F.col("avg_daily_forecast"), F.col("lead_time_days")
    stock, variance = F.col("stock_level"), F.col("_variance")
    return (
        warnings.withColumns(
            {
                "avg_daily_forecast": figures.getField("daily"),
                "total_forecast_30d": figures.getField("total"),
            }
        )
        .withColumn("_variance", stock - daily * lead)
        .withColumns(
            {
                "supply_demand_variance": expr.rnd(variance, 2),
                "variance_status": expr.cases(
                    [(variance < 0, "DEFICIT"), (variance < F.col("reorder_point"), "TIGHT")],
                    "SURPLUS",
                ),
                "forecast_days_of_supply": expr.ratio(stock, daily, digits=1),
            }
        )
        .drop("_variance", "snapshot_date")
    )
