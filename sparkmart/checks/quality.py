"""The declared quality suite over all thirteen models, with its own SQL and lists."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor

from sparkmart.checks import gold, oracle_base as ob
from sparkmart.operators import dims, dq, facts, marts
from sparkmart.plans import suite
from sparkmart.sources import testviews as tv
from sparkmart.sources import workspace

QUERIES = {}
SQL = {}

# Columns that marts read of a fact beyond those that checks name.
_FOR_MARTS = {
    "fct_transactions": ["transaction_date"],
    "fct_loan_applications": [
        "loan_term_months", "is_approved", "is_declined", "is_default", "loan_amount", "interest_rate",
        "annual_interest_amount", "amount_gap", "credit_tier", "credit_score", "days_since_signup_at_application",
    ],
    "fct_marketing_spend": [
        "channel", "campaign", "utm_source", "utm_campaign", "credit_tier", "region", "is_converted",
        "converted_spend", "unconverted_spend",
    ],
}


def _staged_models(spark, sf):
    """The thirteen models, each built once: entities and facts are written with the columns that checks
    and marts read, and everything else is made from these tables. Independent writes run side by side."""
    folder = workspace.new_folder(spark, "suite")
    declared = suite.checks()

    def staged(name, df, columns=None):
        wanted = df.select(*columns) if columns else df
        wanted.write.parquet(f"{folder}/{name}")
        return spark.read.schema(wanted.schema).parquet(f"{folder}/{name}")

    def fact(name, df):
        own = [k.column for k in declared if k.model == name]
        return name, staged(name, df, list(dict.fromkeys([*own, *_FOR_MARTS.get(name, [])])))

    def each(*steps):
        with ThreadPoolExecutor(4) as pool:
            return list(pool.map(lambda step: step(), steps))

    entity = lambda name: tv.clean_entity(spark, sf, name)
    customers, touches, products = each(
        *(lambda n=n: staged(n, entity(n)) for n in ("customers", "marketing_touches", "product_inventory"))
    )
    facts_ = dict(each(
        lambda: fact("fct_loan_applications", facts.loans(entity("loan_applications"), customers)),
        lambda: fact("fct_transactions", facts.transactions(entity("transactions"), customers)),
        lambda: fact("fct_conversions", facts.conversions(touches, customers)),
        lambda: fact("fct_marketing_spend", facts.marketing_spend(touches, customers)),
    ))
    dim_products = dims.product(products)
    others = {
        "dim_customer": dims.customer(customers, gold.AS_OF),
        "dim_products": dim_products,
        "dim_channel": dims.channel(touches),
        "dim_campaign": gold.QUERIES["dim_campaign"](spark, sf),
        "dim_date": gold.QUERIES["dim_date"](spark, sf),
        "mart_channel_performance": marts.channel_performance(facts_["fct_marketing_spend"]),
        "mart_cohort_analysis": marts.cohort(customers, facts_["fct_transactions"]),
        "mart_credit_risk": marts.credit_risk(facts_["fct_loan_applications"]),
        "mart_inventory_health": marts.inventory_health(dim_products),
    }
    return facts_ | dict(each(*(lambda n=n, d=d: (n, staged(n, d)) for n, d in others.items())))


QUERIES["dq_suite"] = lambda spark, sf: dq.run(_staged_models(spark, sf), suite.checks())

# What the checks are, written out a second time, independent of the code.
_UNIQUE = {
    "dim_customer": "customer_id", "dim_products": "product_id", "dim_channel": "channel_key",
    "dim_campaign": "campaign_key", "dim_date": "date_id", "fct_transactions": "transaction_id",
    "fct_loan_applications": "application_id", "fct_conversions": "touch_id",
    "fct_marketing_spend": "touch_id",
}
_NOT_NULL = {
    "dim_customer": "customer_id credit_tier region acquisition_channel data_quality_score",
    "dim_products": "product_id category stock_status margin_band",
    "dim_channel": "channel_key channel channel_type",
    "dim_campaign": "campaign_key campaign_objective",
    "dim_date": "date_id season",
    "fct_transactions": "transaction_id customer_id transaction_amount status product_type",
    "fct_loan_applications": "application_id customer_id approval_status purpose requested_amount",
    "fct_conversions": "touch_id customer_id channel is_converted",
    "fct_marketing_spend": "touch_id customer_id channel_key campaign_key touch_cost",
    "mart_channel_performance": "channel total_touches total_spend conversion_rate_pct",
    "mart_cohort_analysis": "cohort_month months_since_signup active_customers total_spend",
    "mart_inventory_health": "category supplier total_products avg_margin_pct",
    "mart_credit_risk": "credit_tier total_applications approval_rate_pct total_loan_portfolio",
}
_CHANNELS = "'Email', 'Social', 'Referral', 'Direct Mail'"
_TIERS = "'Prime', 'Near-prime', 'Subprime'"
_PRODUCTS = "'Credit Card', 'Personal Loan', 'Savings', 'Checking'"
_ACCEPTED = {
    ("dim_customer", "credit_tier"): _TIERS,
    ("dim_customer", "region"): "'Northeast', 'Midwest', 'South', 'West'",
    ("dim_customer", "acquisition_channel"): "'Email', 'Social', 'Direct Mail', 'Referral'",
    ("dim_products", "stock_status"): "'In Stock', 'Low Stock', 'Out of Stock'",
    ("dim_products", "margin_band"): "'High Margin', 'Medium Margin', 'Low Margin'",
    ("dim_channel", "channel"): _CHANNELS,
    ("dim_channel", "channel_type"): "'Digital', 'Traditional', 'Other'",
    ("dim_campaign", "campaign_objective"): "'Acquisition', 'Retention', 'Conversion', 'Other'",
    ("dim_date", "season"): "'Winter', 'Spring', 'Summer', 'Fall'",
    ("fct_transactions", "status"): "'Completed', 'Pending', 'Failed', 'Refunded', 'Unknown'",
    ("fct_transactions", "product_type"): _PRODUCTS,
    ("fct_loan_applications", "approval_status"): "'Approved', 'Declined', 'Under Review'",
    ("fct_conversions", "channel"): _CHANNELS,
    ("fct_conversions", "is_converted"): "0, 1",
    ("mart_channel_performance", "channel"): _CHANNELS,
    ("mart_credit_risk", "credit_tier"): _TIERS,
}
_PARENTS = {
    ("fct_transactions", "customer_id"): "dim_customer",
    ("fct_loan_applications", "customer_id"): "dim_customer",
    ("fct_conversions", "customer_id"): "dim_customer",
    ("fct_marketing_spend", "customer_id"): "dim_customer",
    ("fct_marketing_spend", "channel_key"): "dim_channel",
    ("fct_marketing_spend", "campaign_key"): "dim_campaign",
}


def _suite_sql() -> str:
    """One row for each check, from the models' own SQL."""
    for model in _NOT_NULL:
        ob.CTE[f"q_{model}"] = gold.SQL[model]
    rows = [
        (m, c, "unique", f"(SELECT {c} FROM q_{m} WHERE {c} IS NOT NULL GROUP BY 1 HAVING count(*) > 1)")
        for m, c in _UNIQUE.items()
    ]
    rows += [
        (m, c, "not_null", f"q_{m} WHERE {c} IS NULL") for m, cs in _NOT_NULL.items() for c in cs.split()
    ]
    rows += [(m, c, "accepted_values", f"q_{m} WHERE {c} NOT IN ({v})") for (m, c), v in _ACCEPTED.items()]
    rows += [
        (m, c, "relationships", f"q_{m} WHERE {c} IS NOT NULL AND {c} NOT IN (SELECT {c} FROM q_{p})")
        for (m, c), p in _PARENTS.items()
    ]
    parts = [
        f"SELECT '{m}' AS model, '{c}' AS column, '{k}' AS \"check\", (SELECT count(*) FROM {source}) AS failures"
        for m, c, k, source in rows
    ]
    return f"SELECT *, failures = 0 AS passed FROM ({' UNION ALL '.join(parts)})"


SQL["dq_suite"] = _suite_sql()
