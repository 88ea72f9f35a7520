"""Registered queries for profiling, cleaning, data quality and the six cleaned entities."""

from __future__ import annotations

from pyspark.sql import functions as F

from sparkmart import schemas
from sparkmart.checks import oracle_base as ob
from sparkmart.functions import expr
from sparkmart.operators import clean, dims, dq, profile, profile_state
from sparkmart.plans import incremental, silver
from sparkmart.sources import testviews as tv
from sparkmart.sources import workspace

QUERIES = {}
SQL = {}


def _raw(name):
    return lambda spark, sf: tv.raw_entity(spark, sf, name)


# --- profiles ---------------------------------------------------------------------------------

QUERIES["profile_nulls"] = lambda spark, sf: profile.nulls(
    tv.raw_entity(spark, sf, "marketing_touches")
)
_touch_columns = [*schemas.raw_columns("marketing_touches"), "load_date"]
SQL["profile_nulls"] = " UNION ALL ".join(
    f"SELECT '{c}' AS column, count(*) FILTER (WHERE {c} IS NULL) AS nulls,"
    f" {ob.rnd(f'count(*) FILTER (WHERE {c} IS NULL) * 100.0::DOUBLE / count(*)', 2)} AS pct"
    " FROM raw_marketing_touches"
    for c in _touch_columns
)

_DUPLICATES = f"""
SELECT total_rows, distinct_rows, total_rows - distinct_rows AS duplicates,
  {ob.rnd('(total_rows - distinct_rows) * 100.0::DOUBLE / total_rows', 2)} AS pct
FROM (SELECT (SELECT count(*) FROM {{all}}) AS total_rows,
             (SELECT count(*) FROM (SELECT DISTINCT {{keys}} FROM {{all}})) AS distinct_rows)
"""
QUERIES["profile_duplicates"] = lambda spark, sf: profile.duplicates(
    tv.raw_entity(spark, sf, "transactions")
)
SQL["profile_duplicates"] = _DUPLICATES.format(all="raw_transactions", keys="*")
QUERIES["profile_duplicate_keys"] = lambda spark, sf: profile.duplicates(
    tv.table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"]
)
SQL["profile_duplicate_keys"] = _DUPLICATES.format(all="lineitem", keys="l_orderkey, l_linenumber")

QUERIES["profile_numeric"] = lambda spark, sf: profile.numeric(
    tv.raw_entity(spark, sf, "loan_applications")
)
SQL["profile_numeric"] = " UNION ALL ".join(
    f"SELECT '{c}' AS column, CAST(min({c}) AS DOUBLE) AS min, CAST(max({c}) AS DOUBLE) AS max,"
    f" {ob.rnd(f'avg({c})', 2)} AS avg, {ob.rnd(f'stddev_samp({c})', 2)} AS stddev,"
    f" count(*) FILTER (WHERE {c} > (SELECT avg({c}) + 3 * stddev_samp({c})"
    " FROM raw_loan_applications)) AS outliers FROM raw_loan_applications"
    for c in ["customer_id", "requested_amount", "loan_amount", "interest_rate", "loan_term_months"]
)


def _values_sql(source, columns):
    return " UNION ALL ".join(
        f"SELECT '{c}' AS column, CAST({c} AS VARCHAR) AS value, count(*) AS count,"
        f" {ob.rnd(f'count(*) * 100.0::DOUBLE / (SELECT count(*) FROM {source})', 1)} AS pct"
        f" FROM {source} GROUP BY {c}"
        for c in columns
    )


QUERIES["profile_values"] = lambda spark, sf: profile.values(
    tv.raw_entity(spark, sf, "transactions"), ["product_type", "status", "merchant_category"]
)
SQL["profile_values"] = _values_sql(
    "raw_transactions", ["product_type", "status", "merchant_category"]
)
QUERIES["bot_rate"] = lambda spark, sf: profile.values(
    tv.raw_entity(spark, sf, "events_raw"), ["is_bot"]
)
SQL["bot_rate"] = _values_sql("raw_events_raw", ["is_bot"])
QUERIES["quality_score_distribution"] = lambda spark, sf: profile.values(
    tv.clean_entity(spark, sf, "transactions"), ["data_quality_score"]
)
SQL["quality_score_distribution"] = _values_sql("c_transactions", ["data_quality_score"])

# --- cleaning ---------------------------------------------------------------------------------

QUERIES["clean_dedup"] = lambda spark, sf: clean.dedup(
    tv.table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"], order_by=["l_shipdate"]
)
SQL["clean_dedup"] = ob.dedup(
    "lineitem",
    ["l_orderkey", "l_linenumber"],
    ["l_shipdate"],
    [
        "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax",
        "l_returnflag", "l_linestatus",
    ],
)
QUERIES["clean_casing"] = lambda spark, sf: clean.casing(
    tv.raw_entity(spark, sf, "customers"),
    title=["region", "acquisition_channel", "credit_tier"],
    lower=["email", "gender"],
    mapping={"acquisition_channel": {"Direct": "Direct Mail"}},
)
SQL["clean_casing"] = f"""
SELECT * REPLACE (
  {ob.title('region')} AS region, {ob.title('credit_tier')} AS credit_tier,
  CASE {ob.title('acquisition_channel')} WHEN 'Direct' THEN 'Direct Mail'
    ELSE {ob.title('acquisition_channel')} END AS acquisition_channel,
  lower(email) AS email, lower(gender) AS gender)
FROM raw_customers
"""
QUERIES["clean_parse_dates"] = lambda spark, sf: clean.parse_dates(
    tv.raw_entity(spark, sf, "customers"), ["signup_date", "date_of_birth"]
)
SQL["clean_parse_dates"] = f"""
SELECT * REPLACE ({ob.parse_date('signup_date')} AS signup_date,
  {ob.parse_date('date_of_birth')} AS date_of_birth) FROM raw_customers
"""
QUERIES["clean_parse_timestamps"] = lambda spark, sf: clean.parse_dates(
    tv.raw_entity(spark, sf, "events_raw"), ["timestamp"], kind="timestamp"
)
SQL["clean_parse_timestamps"] = f"""
SELECT * REPLACE ({ob.parse_ts('timestamp')} AS timestamp) FROM raw_events_raw
"""
QUERIES["clean_fill"] = lambda spark, sf: clean.fill(
    tv.marketing_touches(spark, sf),
    {"cost": 0.0, "utm_source": "unknown", "utm_campaign": "unknown"},
)
SQL["clean_fill"] = """
SELECT * REPLACE (coalesce(cost, 0.0::DOUBLE) AS cost,
  coalesce(utm_source, 'unknown') AS utm_source,
  coalesce(utm_campaign, 'unknown') AS utm_campaign) FROM b_marketing_touches
"""
QUERIES["clean_fill_mean"] = lambda spark, sf: clean.fill_mean(
    tv.product_inventory(spark, sf), ["selling_price"]
)
SQL["clean_fill_mean"] = f"""
SELECT * REPLACE (coalesce(selling_price,
  {ob.rnd('(SELECT avg(selling_price) FROM b_product_inventory)', 2)}) AS selling_price)
FROM b_product_inventory
"""
QUERIES["clean_flag_outliers"] = lambda spark, sf: clean.flag_outliers(
    tv.transactions(spark, sf), {"amount": "is_amount_outlier"}
)
SQL["clean_flag_outliers"] = """
SELECT *, coalesce(amount > (SELECT avg(amount) + 3 * stddev_samp(amount) FROM b_transactions),
  false) AS is_amount_outlier FROM b_transactions
"""
QUERIES["clean_quality_score"] = lambda spark, sf: clean.quality_score(
    tv.table(spark, sf, "lineitem").withColumns(
        {"is_returned": F.col("l_returnflag") == "R", "is_open": F.col("l_linestatus") == "O"}
    ),
    {"is_returned": "0.2", "is_open": "0.1"},
)
SQL["clean_quality_score"] = """
SELECT *, l_returnflag = 'R' AS is_returned, l_linestatus = 'O' AS is_open,
  CAST(1.0 - CASE WHEN l_returnflag = 'R' THEN 0.2 ELSE 0.0 END
    - CASE WHEN l_linestatus = 'O' THEN 0.1 ELSE 0.0 END AS DOUBLE) AS data_quality_score
FROM lineitem
"""
QUERIES["clean_drop_bots"] = lambda spark, sf: clean.drop_bots(tv.events_raw(spark, sf))
SQL["clean_drop_bots"] = "SELECT * FROM b_events_raw WHERE NOT is_bot"

def _profile_by_loads(spark, sf):
    """The profile of both loads from a summary of each."""
    folder = workspace.new_folder(spark, "profiles")
    raw = tv.raw_entity(spark, sf, "loan_applications")
    profile_state.save_loads(raw, folder, "load_date", [tv.EARLIER_LOAD, tv.LOAD_DATE])
    out = profile_state.profile(profile_state.saved(spark, folder))
    return out.select("column", "rows", "nulls", "null_pct", "min", "max", "avg", "stddev")


QUERIES["profile_by_loads"] = _profile_by_loads
_loan_numbers = {"customer_id", "requested_amount", "loan_amount", "interest_rate", "loan_term_months"}
SQL["profile_by_loads"] = " UNION ALL ".join(
    f"SELECT '{c}' AS column, count(*) AS rows, count(*) FILTER (WHERE {c} IS NULL) AS nulls,"
    f" {ob.rnd(f'count(*) FILTER (WHERE {c} IS NULL) * 100.0::DOUBLE / count(*)', 2)} AS null_pct,"
    + (
        f" CAST(min({c}) AS DOUBLE) AS min, CAST(max({c}) AS DOUBLE) AS max, {ob.rnd(f'avg({c})', 2)} AS avg,"
        f" {ob.rnd(f'stddev_samp({c})', 2)} AS stddev"
        if c in _loan_numbers
        else " NULL::DOUBLE AS min, NULL::DOUBLE AS max, NULL::DOUBLE AS avg, NULL::DOUBLE AS stddev"
    )
    + " FROM raw_loan_applications"
    for c in schemas.raw_columns("loan_applications")
)

# --- cleaned entities -------------------------------------------------------------------------


def _silver(name):
    return lambda spark, sf: silver.entity(
        name, tv.raw_entity(spark, sf, name), load_date=tv.LOAD_DATE
    )


def _incremental(name):
    def run(spark, sf):
        folder = workspace.new_folder(spark, "silver-state")
        return incremental.entity(
            spark, folder, name, tv.raw_entity(spark, sf, name), [tv.EARLIER_LOAD, tv.LOAD_DATE], buckets=8
        )

    return run


for _query, _entity in {
    "silver_customers": "customers",
    "silver_transactions": "transactions",
    "silver_loans": "loan_applications",
    "silver_touches": "marketing_touches",
    "silver_products": "product_inventory",
    "silver_events": "events_raw",
}.items():
    QUERIES[_query] = _silver(_entity)
    SQL[_query] = f"SELECT *, '{tv.LOAD_DATE}' AS silver_load_date FROM silver_{_entity}"
    # The same rows from two loads, merged one after the other.
    QUERIES[f"{_query}_incremental"] = _incremental(_entity)
    SQL[f"{_query}_incremental"] = SQL[_query]

for _query, _entity in {
    "staging_customers": "customers",
    "staging_transactions": "transactions",
    "staging_loans": "loan_applications",
    "staging_touches": "marketing_touches",
    "staging_products": "product_inventory",
    "staging_events": "events_raw",
}.items():
    QUERIES[_query] = (
        lambda spark, sf, name=_entity: silver.staging(name, tv.clean_entity(spark, sf, name))
    )
    SQL[_query] = f"SELECT {ob.STAGED[_entity]} FROM c_{_entity}"

# --- data quality -----------------------------------------------------------------------------

QUERIES["dq_unique"] = lambda spark, sf: dq.unique(
    tv.raw_entity(spark, sf, "marketing_touches"), "touch_id"
)
SQL["dq_unique"] = """
SELECT touch_id, count(*) AS rows FROM raw_marketing_touches
WHERE touch_id IS NOT NULL GROUP BY touch_id HAVING count(*) > 1
"""
QUERIES["dq_not_null"] = lambda spark, sf: dq.not_null(
    tv.raw_entity(spark, sf, "customers"), ["customer_id", "email", "gender", "annual_income"]
)
SQL["dq_not_null"] = " UNION ALL ".join(
    f"SELECT '{c}' AS column, count(*) FILTER (WHERE {c} IS NULL) AS failures FROM raw_customers"
    for c in ["customer_id", "email", "gender", "annual_income"]
)
QUERIES["dq_accepted_values"] = lambda spark, sf: dq.accepted(
    tv.raw_entity(spark, sf, "transactions"), "status", ["Completed", "Pending", "Failed"]
)
SQL["dq_accepted_values"] = """
SELECT status, count(*) AS rows FROM raw_transactions
WHERE status NOT IN ('Completed', 'Pending', 'Failed') GROUP BY status
"""
# Line items whose part is not an active product.
QUERIES["dq_relationship"] = lambda spark, sf: dq.relationship(
    tv.table(spark, sf, "lineitem"), "l_partkey",
    dims.product(tv.clean_entity(spark, sf, "product_inventory")), "product_id",
)
SQL["dq_relationship"] = """
SELECT l_partkey, count(*) AS rows FROM lineitem
WHERE l_partkey NOT IN (SELECT product_id FROM c_product_inventory WHERE is_active)
GROUP BY l_partkey
"""
