"""Declared checks of the star schema and marts: 9 unique, 51 not-null, 16 accepted, 6 relationships."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from sparkmart.operators.dq import Check

# Accepted values per domain. Channels are those left after cleaning, which turns
# Direct into Direct Mail for customers and Digital into Referral for touches.
DOMAINS: dict[str, list] = {
    "credit_tier": ["Prime", "Near-prime", "Subprime"],
    "region": ["Northeast", "Midwest", "South", "West"],
    "acquisition_channel": ["Email", "Social", "Direct Mail", "Referral"],
    "stock_status": ["In Stock", "Low Stock", "Out of Stock"],
    "margin_band": ["High Margin", "Medium Margin", "Low Margin"],
    "channel": ["Email", "Social", "Referral", "Direct Mail"],
    "channel_type": ["Digital", "Traditional", "Other"],
    "campaign_objective": ["Acquisition", "Retention", "Conversion", "Other"],
    "season": ["Winter", "Spring", "Summer", "Fall"],
    "status": ["Completed", "Pending", "Failed", "Refunded", "Unknown"],
    "product_type": ["Credit Card", "Personal Loan", "Savings", "Checking"],
    "approval_status": ["Approved", "Declined", "Under Review"],
    "is_converted": [0, 1],
}

# Per model, column -> checks. A check with a dot names the parent column of a
# relationship; accepted values are those of the domain with the column's name.
DECLARED: dict[str, dict[str, list[str]]] = {
    "dim_customer": {
        "customer_id": ["unique", "not_null"],
        "credit_tier": ["not_null", "accepted_values"],
        "region": ["not_null", "accepted_values"],
        "acquisition_channel": ["not_null", "accepted_values"],
        "data_quality_score": ["not_null"],
    },
    "dim_products": {
        "product_id": ["unique", "not_null"],
        "category": ["not_null"],
        "stock_status": ["not_null", "accepted_values"],
        "margin_band": ["not_null", "accepted_values"],
    },
    "dim_channel": {
        "channel_key": ["unique", "not_null"],
        "channel": ["not_null", "accepted_values"],
        "channel_type": ["not_null", "accepted_values"],
    },
    "dim_campaign": {
        "campaign_key": ["unique", "not_null"],
        "campaign_objective": ["not_null", "accepted_values"],
    },
    "dim_date": {
        "date_id": ["unique", "not_null"],
        "season": ["not_null", "accepted_values"],
    },
    "fct_transactions": {
        "transaction_id": ["unique", "not_null"],
        "customer_id": ["not_null", "dim_customer.customer_id"],
        "transaction_amount": ["not_null"],
        "status": ["not_null", "accepted_values"],
        "product_type": ["not_null", "accepted_values"],
    },
    "fct_loan_applications": {
        "application_id": ["unique", "not_null"],
        "customer_id": ["not_null", "dim_customer.customer_id"],
        "approval_status": ["not_null", "accepted_values"],
        "purpose": ["not_null"],
        "requested_amount": ["not_null"],
    },
    "fct_conversions": {
        "touch_id": ["unique", "not_null"],
        "customer_id": ["not_null", "dim_customer.customer_id"],
        "channel": ["not_null", "accepted_values"],
        "is_converted": ["not_null", "accepted_values"],
    },
    "fct_marketing_spend": {
        "touch_id": ["unique", "not_null"],
        "customer_id": ["not_null", "dim_customer.customer_id"],
        "channel_key": ["not_null", "dim_channel.channel_key"],
        "campaign_key": ["not_null", "dim_campaign.campaign_key"],
        "touch_cost": ["not_null"],
    },
    "mart_channel_performance": {
        "channel": ["not_null", "accepted_values"],
        "total_touches": ["not_null"],
        "total_spend": ["not_null"],
        "conversion_rate_pct": ["not_null"],
    },
    "mart_cohort_analysis": {
        "cohort_month": ["not_null"],
        "months_since_signup": ["not_null"],
        "active_customers": ["not_null"],
        "total_spend": ["not_null"],
    },
    "mart_inventory_health": {
        "category": ["not_null"],
        "supplier": ["not_null"],
        "total_products": ["not_null"],
        "avg_margin_pct": ["not_null"],
    },
    "mart_credit_risk": {
        "credit_tier": ["not_null", "accepted_values"],
        "total_applications": ["not_null"],
        "approval_rate_pct": ["not_null"],
        "total_loan_portfolio": ["not_null"],
    },
}


def checks(
    models: Sequence[str] | None = None,
    domains: Mapping[str, Sequence] | None = None,
    skip_relationships_to: Sequence[str] = (),
) -> list[Check]:
    """The declared checks, for some models if given, with accepted values replaced by ``domains``."""
    accepted = DOMAINS | dict(domains or {})
    out = []
    for model in models or DECLARED:
        for column, kinds in DECLARED[model].items():
            for kind in kinds:
                if kind in ("unique", "not_null"):
                    out.append(Check(model, column, kind))
                elif kind == "accepted_values":
                    out.append(Check(model, column, "accepted_values", tuple(accepted[column])))
                elif kind.split(".")[0] not in skip_relationships_to:
                    parent, pk = kind.split(".")
                    out.append(Check(model, column, "relationships", (parent, pk)))
    return out
