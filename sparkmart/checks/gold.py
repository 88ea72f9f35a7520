"""Registered queries for sessions, journeys, dimensions, facts, marts, attribution and ROI."""

from __future__ import annotations

from pyspark.sql import functions as F

from sparkmart.checks import oracle_base as ob
from sparkmart.functions import expr
from sparkmart.operators import attribution, dims, facts, journey, marts, roi, session_state, sessions
from sparkmart.plans import partials
from sparkmart.sources import testviews as tv
from sparkmart.sources import workspace
from sparkmart.streaming import sessions as stream

QUERIES = {}
SQL = {}
AS_OF = "2002-01-01"


def _entity(spark, sf, name):
    return tv.clean_entity(spark, sf, name)


# --- sessions and journeys --------------------------------------------------------------------


def _session_ctes(prefix, visitor, where, timeout):
    ob.CTE[f"{prefix}_gaps"] = f"""
SELECT *, {visitor} AS visitor,
  date_diff('second', lag(timestamp) OVER w, timestamp) AS gap,
  lag(timestamp) OVER w IS NULL AS is_start
FROM c_events_raw {where}
WINDOW w AS (PARTITION BY {visitor} ORDER BY timestamp, event_id)
"""
    ob.CTE[f"{prefix}_events"] = f"""
SELECT *, visitor || printf('%04d', session_number) AS true_session_id FROM (
  SELECT * EXCLUDE (gap, is_start), CAST(sum(CASE WHEN is_start OR gap > {timeout} THEN 1 ELSE 0 END)
    OVER (PARTITION BY visitor ORDER BY timestamp, event_id ROWS UNBOUNDED PRECEDING) AS BIGINT)
    AS session_number
  FROM {prefix}_gaps)
"""
    ob.CTE[f"{prefix}_rollup"] = f"""
SELECT true_session_id, customer_id, min(timestamp) AS session_start, max(timestamp) AS session_end,
  count(event_id) AS event_count,
  arg_min(page, (timestamp, event_id)) AS entry_page,
  arg_max(page, (timestamp, event_id)) AS exit_page,
  bool_or(event_type = 'conversion') AS converted,
  arg_min_null(device, (timestamp, event_id)) AS device,
  arg_min_null(utm_source, (timestamp, event_id)) AS utm_source,
  arg_min_null(utm_campaign, (timestamp, event_id)) AS utm_campaign,
  date_diff('second', min(timestamp), max(timestamp)) AS session_duration_seconds
FROM {prefix}_events GROUP BY true_session_id, customer_id
"""


_KNOWN = "WHERE customer_id IS NOT NULL"
_session_ctes("s30", "CAST(customer_id AS VARCHAR)", _KNOWN, 1800)
_session_ctes("s6h", "CAST(customer_id AS VARCHAR)", _KNOWN, 21600)
_session_ctes(
    "sweb", "coalesce(CAST(customer_id AS VARCHAR), 'anonymous-' || session_id)", "", 1800
)
_session_ctes("sall", "CAST(customer_id AS VARCHAR)", "", 1800)

QUERIES["sessions_assign"] = lambda spark, sf: sessions.assign(_entity(spark, sf, "events_raw"))
SQL["sessions_assign"] = "SELECT * EXCLUDE (visitor) FROM s30_events"
QUERIES["sessions_by_client"] = lambda spark, sf: sessions.assign(
    _entity(spark, sf, "events_raw"), anonymous="by_client_session"
)
SQL["sessions_by_client"] = "SELECT * EXCLUDE (visitor) FROM sweb_events"
QUERIES["sessions_rollup"] = lambda spark, sf: sessions.rollup(
    sessions.assign(_entity(spark, sf, "events_raw")), load_date=tv.LOAD_DATE
)
SQL["sessions_rollup"] = "SELECT *, '2024-02-01' AS silver_load_date FROM s30_rollup"


def _sessions_by_loads(spark, sf):
    """Events in three loads that cut across time, merged one after the other."""
    events = _entity(spark, sf, "events_raw")
    state = session_state.store(spark, workspace.new_folder(spark, "sessions"), events, buckets=8)
    for load in range(3):
        session_state.merge(state, events.where(F.col("event_id") % 3 == load), str(load))
    return events, state


QUERIES["sessions_rollup_incremental"] = lambda spark, sf: session_state.rollup(
    _sessions_by_loads(spark, sf)[1], load_date=tv.LOAD_DATE
)
SQL["sessions_rollup_incremental"] = SQL["sessions_rollup"]
QUERIES["sessions_assign_incremental"] = lambda spark, sf: session_state.assign(*_sessions_by_loads(spark, sf))
SQL["sessions_assign_incremental"] = SQL["sessions_assign"]


def _sessions_by_stream(spark, sf):
    """The same from a stream of files, two of them a micro-batch."""
    folder = workspace.new_folder(spark, "session-stream")
    events = _entity(spark, sf, "events_raw")
    events.repartition(6, "event_id").write.parquet(f"{folder}/events")
    state = session_state.store(spark, f"{folder}/state", events, buckets=8)
    stream.run(spark, f"{folder}/events", events.schema, state, f"{folder}/checkpoint", files_per_batch=2)
    return session_state.rollup(state, load_date=tv.LOAD_DATE)


QUERIES["sessions_rollup_stream"] = _sessions_by_stream
SQL["sessions_rollup_stream"] = SQL["sessions_rollup"]
QUERIES["sessions_separated"] = lambda spark, sf: sessions.assign(
    _entity(spark, sf, "events_raw"), separator="-"
)
SQL["sessions_separated"] = """
SELECT * EXCLUDE (visitor) REPLACE (visitor || '-' || printf('%04d', session_number) AS true_session_id)
FROM s30_events
"""
QUERIES["sessions_rollup_anonymous"] = lambda spark, sf: sessions.rollup(
    sessions.assign(_entity(spark, sf, "events_raw"), anonymous="keep")
)
SQL["sessions_rollup_anonymous"] = "SELECT * FROM sall_rollup"


def _six_hour_sessions(spark, sf):
    return sessions.rollup(sessions.assign(_entity(spark, sf, "events_raw"), timeout_s=21600))


QUERIES["journey_touchpoints"] = lambda spark, sf: journey.touchpoints(
    _entity(spark, sf, "marketing_touches"),
    _entity(spark, sf, "customers"),
    _six_hour_sessions(spark, sf),
    load_date=tv.LOAD_DATE,
)
_touchpoints = """
SELECT t.*, {extra} s.true_session_id, s.session_start, s.session_end,
  s.converted AS session_converted, s.entry_page, s.exit_page,
  CAST(date_diff('day', t.touchpoint_date, CAST(s.session_start AS DATE)) AS INTEGER)
    AS days_before_session
FROM c_marketing_touches t {join} JOIN s6h_rollup s ON t.customer_id = s.customer_id
  AND t.touchpoint_date <= s.session_start
  AND date_diff('day', t.touchpoint_date, CAST(s.session_start AS DATE)) <= {lookback}
"""
SQL["journey_touchpoints"] = _touchpoints.format(
    extra="c.credit_tier, c.region, c.acquisition_channel, '2024-02-01' AS silver_load_date,",
    join="LEFT JOIN c_customers c ON t.customer_id = c.customer_id",
    lookback=30,
)
# Lookback of a week without customer attributes, every key treated as hot.
QUERIES["journey_interval_join"] = lambda spark, sf: journey.interval_join(
    _entity(spark, sf, "marketing_touches"),
    _six_hour_sessions(spark, sf).select(
        "true_session_id", "customer_id", "session_start", "session_end",
        F.col("converted").alias("session_converted"), "entry_page", "exit_page",
    ),
    lookback_days=7,
    share=1e-4,
    salts=4,
)
SQL["journey_interval_join"] = _touchpoints.format(extra="", join="", lookback=7)
# The last touch of the week before each session.
QUERIES["journey_asof"] = lambda spark, sf: journey.asof_touches(
    _six_hour_sessions(spark, sf).select("true_session_id", "customer_id", "session_start", "converted"),
    _entity(spark, sf, "marketing_touches"), ["touch_id", "channel", "touchpoint_date", "cost"], lookback_days=7,
)
SQL["journey_asof"] = """
SELECT s.true_session_id, s.customer_id, s.session_start, s.converted, t.touch_id, t.channel, t.touchpoint_date, t.cost,
  CAST(date_diff('day', t.touchpoint_date, CAST(s.session_start AS DATE)) AS INTEGER) AS days_before_session
FROM s6h_rollup s LEFT JOIN c_marketing_touches t ON t.customer_id = s.customer_id
  AND t.touchpoint_date <= CAST(s.session_start AS DATE)
  AND date_diff('day', t.touchpoint_date, CAST(s.session_start AS DATE)) <= 7
QUALIFY row_number() OVER (PARTITION BY s.true_session_id, s.customer_id
  ORDER BY t.touchpoint_date DESC NULLS LAST, t.touch_id DESC) = 1
"""
QUERIES["touch_enrichment"] = lambda spark, sf: journey.enrich(
    _entity(spark, sf, "marketing_touches"), _entity(spark, sf, "customers")
)
SQL["touch_enrichment"] = """
SELECT t.*, c.credit_tier, c.region, c.acquisition_channel
FROM c_marketing_touches t LEFT JOIN c_customers c ON t.customer_id = c.customer_id
"""
QUERIES["customer_journey"] = lambda spark, sf: journey.customer_360(
    _entity(spark, sf, "customers"),
    _entity(spark, sf, "transactions"),
    _entity(spark, sf, "marketing_touches"),
    load_date=tv.LOAD_DATE,
)
SQL["customer_journey"] = f"""
SELECT '2024-02-01' AS silver_load_date, {', '.join('c.' + c for c in journey.CUSTOMER_COLUMNS)}, total_transactions, total_spend,
  avg_transaction_amount, most_used_product, total_touches, total_marketing_cost, avg_touch_cost,
  touch_conversion_rate
FROM c_customers c
LEFT JOIN (
  SELECT customer_id, count(transaction_id) AS total_transactions,
    {ob.money('amount')} AS total_spend, {ob.money_avg('amount')} AS avg_transaction_amount
  FROM c_transactions WHERE status = 'Completed' AND NOT is_amount_outlier GROUP BY customer_id
) t ON c.customer_id = t.customer_id
LEFT JOIN (
  SELECT customer_id, product_type AS most_used_product FROM (
    SELECT customer_id, product_type, row_number() OVER (PARTITION BY customer_id
      ORDER BY count(*) DESC, product_type) AS rn
    FROM c_transactions WHERE status = 'Completed' AND NOT is_amount_outlier
    GROUP BY customer_id, product_type) WHERE rn = 1
) p ON c.customer_id = p.customer_id
LEFT JOIN (
  SELECT customer_id, count(touch_id) AS total_touches, {ob.money('cost')} AS total_marketing_cost,
    {ob.money_avg('cost')} AS avg_touch_cost,
    {ob.rnd('avg(CAST(converted AS INTEGER))', 4)} AS touch_conversion_rate
  FROM c_marketing_touches WHERE NOT is_cost_outlier GROUP BY customer_id
) m ON c.customer_id = m.customer_id
"""

# --- dimensions -------------------------------------------------------------------------------

QUERIES["dim_customer"] = lambda spark, sf: dims.customer(_entity(spark, sf, "customers"), AS_OF)
SQL["dim_customer"] = f"""
SELECT customer_id, first_name, last_name, first_name || ' ' || last_name AS full_name, email,
  gender, region, acquisition_channel, signup_date, credit_tier, credit_score, annual_income,
  CASE WHEN credit_score >= 750 THEN 'Excellent' WHEN credit_score >= 700 THEN 'Good'
    WHEN credit_score >= 650 THEN 'Fair' ELSE 'Poor' END AS credit_score_band,
  CASE WHEN annual_income >= 100000 THEN 'High' WHEN annual_income >= 60000 THEN 'Medium'
    ELSE 'Low' END AS income_band,
  {ob.days('signup_date', f"DATE '{AS_OF}'")} AS days_since_signup, is_active, data_quality_score
FROM c_customers
"""
QUERIES["dim_products"] = lambda spark, sf: dims.product(_entity(spark, sf, "product_inventory"))
ob.CTE["o_products"] = f"""
SELECT *, CASE WHEN margin_pct >= 50 THEN 'High Margin' WHEN margin_pct >= 30 THEN 'Medium Margin'
  ELSE 'Low Margin' END AS margin_band
FROM (SELECT product_id, sku, product_name, category, unit_cost, selling_price,
  {ob.rnd('selling_price - unit_cost', 2)} AS gross_margin,
  {ob.rnd('(selling_price - unit_cost) / nullif(selling_price, 0) * 100', 2)} AS margin_pct,
  stock_level, reorder_point, reorder_quantity, lead_time_days, supplier,
  CASE WHEN stock_level = 0 THEN 'Out of Stock' WHEN stock_level <= reorder_point THEN 'Low Stock'
    ELSE 'In Stock' END AS stock_status, is_active, data_quality_score
  FROM c_product_inventory WHERE is_active)
"""
SQL["dim_products"] = "SELECT * FROM o_products"
QUERIES["dim_channel"] = lambda spark, sf: dims.channel(_entity(spark, sf, "marketing_touches"))
SQL["dim_channel"] = """
SELECT DISTINCT md5(channel || '-' || campaign) AS channel_key, channel, campaign,
  CASE WHEN channel IN ('Email', 'Social', 'Digital') THEN 'Digital'
    WHEN channel = 'Direct Mail' THEN 'Traditional' ELSE 'Other' END AS channel_type
FROM c_marketing_touches
"""
QUERIES["dim_campaign"] = lambda spark, sf: dims.campaign(tv.marketing_touches(spark, sf))
SQL["dim_campaign"] = """
SELECT DISTINCT md5(coalesce(campaign, '_dbt_utils_surrogate_key_null_') || '-' ||
    coalesce(utm_campaign, '_dbt_utils_surrogate_key_null_')) AS campaign_key,
  campaign, utm_campaign,
  CASE WHEN campaign IN ('Welcome Series', 'Re-engagement', 'Promotional') THEN 'Email'
    WHEN campaign IN ('Lookalike', 'Retargeting') THEN 'Social'
    WHEN campaign IN ('Display Prospecting', 'Search Retargeting') THEN 'Digital'
    WHEN campaign IN ('Seasonal Offer', 'Pre-approved Offer') THEN 'Direct Mail'
    ELSE 'Other' END AS primary_channel,
  CASE WHEN campaign IN ('Welcome Series', 'Lookalike', 'Display Prospecting') THEN 'Acquisition'
    WHEN campaign IN ('Re-engagement', 'Retargeting', 'Search Retargeting') THEN 'Retention'
    WHEN campaign IN ('Promotional', 'Seasonal Offer', 'Pre-approved Offer') THEN 'Conversion'
    ELSE 'Other' END AS campaign_objective
FROM b_marketing_touches
"""
# The calendar covers the order history.
QUERIES["date_spine"] = lambda spark, sf: dims.date_spine(spark, "1995-01-01", "2002-01-01").join(
    tv.table(spark, sf, "orders").select(F.to_date("o_orderdate").alias("date_day")).distinct(),
    "date_day", "left_anti",
)
# Days of the spine on which nothing was ordered.
SQL["date_spine"] = """
SELECT date_day FROM (SELECT CAST(unnest(generate_series(DATE '1995-01-01', DATE '2001-12-31',
  INTERVAL 1 DAY)) AS DATE) AS date_day)
WHERE date_day NOT IN (SELECT CAST(o_orderdate AS DATE) FROM orders)
"""
QUERIES["dim_date"] = lambda spark, sf: dims.date(
    dims.spine_over(tv.table(spark, sf, "orders"), "o_orderdate")
)
SQL["dim_date"] = """
SELECT d AS date_id, CAST(year(d) AS INTEGER) AS year, CAST(quarter(d) AS INTEGER) AS quarter,
  CAST(month(d) AS INTEGER) AS month, CAST(day(d) AS INTEGER) AS day,
  CAST(dayofweek(d) + 1 AS INTEGER) AS day_of_week, CAST(dayofyear(d) AS INTEGER) AS day_of_year,
  CAST(weekofyear(d) AS INTEGER) AS week_of_year, strftime(d, '%B') AS month_name,
  strftime(d, '%A') AS day_name, strftime(d, '%b %Y') AS month_year,
  strftime(d, '%Y-%m') AS year_month, 'Q' || quarter(d) || ' ' || year(d) AS quarter_label,
  dayofweek(d) IN (0, 6) AS is_weekend, dayofweek(d) NOT IN (0, 6) AS is_weekday,
  CASE WHEN month(d) IN (12, 1, 2) THEN 'Winter' WHEN month(d) IN (3, 4, 5) THEN 'Spring'
    WHEN month(d) IN (6, 7, 8) THEN 'Summer' ELSE 'Fall' END AS season
FROM (SELECT CAST(unnest(generate_series(min(o_orderdate), max(o_orderdate), INTERVAL 1 DAY)) AS DATE)
  AS d FROM orders)
"""

# --- facts ------------------------------------------------------------------------------------

QUERIES["fct_transactions"] = lambda spark, sf: facts.transactions(
    _entity(spark, sf, "transactions"), _entity(spark, sf, "customers")
)
ob.CTE["f_transactions"] = f"""
SELECT transaction_id, t.customer_id, CAST(timestamp AS DATE) AS transaction_date, product_type,
  status, merchant_category, amount AS transaction_amount,
  CASE WHEN status = 'Completed' THEN amount ELSE 0.0 END AS completed_amount,
  CASE WHEN status = 'Failed' THEN 1 ELSE 0 END AS is_failed,
  {ob.days('c.signup_date', 'CAST(timestamp AS DATE)')} AS days_since_signup_at_transaction,
  t.data_quality_score, is_amount_outlier
FROM c_transactions t LEFT JOIN c_customers c ON t.customer_id = c.customer_id
WHERE NOT is_amount_outlier AND t.data_quality_score = 1.0
"""
SQL["fct_transactions"] = "SELECT * FROM f_transactions"
QUERIES["fct_loan_applications"] = lambda spark, sf: facts.loans(
    _entity(spark, sf, "loan_applications"), _entity(spark, sf, "customers")
)
ob.CTE["f_loans"] = f"""
SELECT application_id, l.customer_id, application_date, approval_status, purpose,
  loan_term_months, requested_amount, loan_amount, interest_rate,
  CASE WHEN approval_status = 'Approved' THEN 1 ELSE 0 END AS is_approved,
  CASE WHEN approval_status = 'Declined' THEN 1 ELSE 0 END AS is_declined,
  CASE WHEN default_flag THEN 1 ELSE 0 END AS is_default,
  {ob.rnd('loan_amount * interest_rate / 100', 2)} AS annual_interest_amount,
  {ob.rnd('requested_amount - loan_amount', 2)} AS amount_gap,
  {ob.days('c.signup_date', 'application_date')} AS days_since_signup_at_application,
  credit_tier, credit_score, l.data_quality_score, is_requested_amount_outlier,
  is_loan_amount_outlier
FROM c_loan_applications l LEFT JOIN c_customers c ON l.customer_id = c.customer_id
WHERE NOT is_requested_amount_outlier AND NOT is_loan_amount_outlier
  AND l.data_quality_score = 1.0
"""
SQL["fct_loan_applications"] = "SELECT * FROM f_loans"


def _spend(spark, sf):
    return facts.marketing_spend(
        _entity(spark, sf, "marketing_touches"), _entity(spark, sf, "customers")
    )


QUERIES["fct_conversions"] = lambda spark, sf: facts.conversions(
    _entity(spark, sf, "marketing_touches"), _entity(spark, sf, "customers")
)
SQL["fct_conversions"] = """
SELECT touch_id, t.customer_id, touchpoint_date, channel, campaign, utm_source, utm_campaign,
  cost AS touch_cost, CASE WHEN converted THEN 1 ELSE 0 END AS is_converted, credit_tier, region,
  acquisition_channel, CASE WHEN converted THEN cost END AS cost_per_conversion,
  t.data_quality_score, is_cost_outlier
FROM c_marketing_touches t LEFT JOIN c_customers c ON t.customer_id = c.customer_id
WHERE NOT is_cost_outlier AND t.data_quality_score = 1.0
"""
QUERIES["fct_marketing_spend"] = _spend
ob.CTE["f_spend"] = """
SELECT touch_id, t.customer_id, touchpoint_date, md5(channel || '-' || campaign) AS channel_key,
  md5(campaign || '-' || utm_campaign) AS campaign_key, channel, campaign, utm_source,
  utm_campaign, cost AS touch_cost, CASE WHEN converted THEN 1 ELSE 0 END AS is_converted,
  CASE WHEN converted THEN cost ELSE 0.0 END AS converted_spend,
  CASE WHEN NOT converted THEN cost ELSE 0.0 END AS unconverted_spend,
  credit_tier, region, acquisition_channel AS customer_acquisition_channel,
  t.data_quality_score, is_cost_outlier
FROM c_marketing_touches t LEFT JOIN c_customers c ON t.customer_id = c.customer_id
WHERE NOT is_cost_outlier AND t.data_quality_score = 1.0
"""
SQL["fct_marketing_spend"] = "SELECT * FROM f_spend"

# --- marts ------------------------------------------------------------------------------------

QUERIES["mart_channel_performance"] = lambda spark, sf: marts.channel_performance(_spend(spark, sf))
_PERFORMANCE = f"""
SELECT channel, campaign, utm_source, utm_campaign, credit_tier, region,
  count(touch_id) AS total_touches, {ob.money('touch_cost')} AS total_spend,
  {ob.money_avg('touch_cost')} AS avg_cost_per_touch,
  {ob.total('is_converted')} AS total_conversions,
  {ob.rnd('avg(is_converted) * 100', 2)} AS conversion_rate_pct,
  {ob.rnd(ob.exact('touch_cost') + ' / nullif(sum(is_converted), 0)', 2)} AS cost_per_conversion,
  {ob.money('converted_spend')} AS converted_spend,
  {ob.money('unconverted_spend')} AS unconverted_spend
FROM {{spend}} GROUP BY ALL
"""
SQL["mart_channel_performance"] = _PERFORMANCE.format(spend="f_spend")


def _subcent(spend):
    """Costs a thousandth as large: most addends are below a cent, as for single impressions."""
    amounts = [c for c in ("touch_cost", "converted_spend", "unconverted_spend") if c in spend.columns]
    return spend.withColumns({c: F.col(c) / 1000 for c in amounts})


ob.CTE["f_subcent"] = """
SELECT * REPLACE (touch_cost / 1000 AS touch_cost, converted_spend / 1000 AS converted_spend,
  unconverted_spend / 1000 AS unconverted_spend) FROM f_spend
"""
QUERIES["channel_performance_subcent"] = lambda spark, sf: marts.channel_performance(
    _subcent(_spend(spark, sf))
)
SQL["channel_performance_subcent"] = _PERFORMANCE.format(spend="f_subcent")


def _clean_transactions(spark, sf):
    return facts.clean_transactions(_entity(spark, sf, "transactions"))


def _by_loads(fact, mart):
    """A mart merged from the states of three loads."""
    spark = fact.sparkSession
    states = partials.States(spark, workspace.new_folder(spark, "mart-states"), mart, "_load")
    fact = fact.withColumn("_load", F.pmod(F.xxhash64(fact.columns[0]), F.lit(3)).cast("string"))
    states.refresh(fact, ["0", "1", "2"])
    return states.merged(fact)


QUERIES["channel_performance_by_loads"] = lambda spark, sf: _by_loads(_spend(spark, sf), partials.CHANNEL_PERFORMANCE)
SQL["channel_performance_by_loads"] = SQL["mart_channel_performance"]
QUERIES["credit_risk_by_loads"] = lambda spark, sf: _by_loads(
    facts.loans(_entity(spark, sf, "loan_applications"), _entity(spark, sf, "customers")), partials.CREDIT_RISK
)
QUERIES["channel_cac_by_loads"] = lambda spark, sf: _by_loads(_spend(spark, sf), partials.CHANNEL_CAC)
QUERIES["mart_cohort_analysis"] = lambda spark, sf: marts.cohort(
    _entity(spark, sf, "customers"), _clean_transactions(spark, sf)
)
SQL["mart_cohort_analysis"] = f"""
SELECT cohort_month, credit_tier, region, acquisition_channel,
  CAST(months AS INTEGER) AS months_since_signup,
  count(DISTINCT customer_id) AS active_customers, {ob.total('n')} AS total_transactions,
  CAST(round(sum(spend), 2) AS DOUBLE) AS total_spend,
  {ob.rnd('CAST(sum(spend) AS DOUBLE) / count(spend)', 2)} AS avg_spend_per_customer
FROM (
  SELECT strftime(c.signup_date, '%Y-%m') AS cohort_month, c.customer_id, credit_tier, region,
    acquisition_channel, n, spend, date_diff('month', date_trunc('month', c.signup_date), m) AS months
  FROM c_customers c LEFT JOIN (
    SELECT customer_id, date_trunc('month', transaction_date) AS m, count(transaction_id) AS n,
      sum(CAST(transaction_amount AS DECIMAL(38,10))) AS spend
    FROM f_transactions WHERE status = 'Completed' GROUP BY ALL) a ON c.customer_id = a.customer_id
) WHERE months >= 0 GROUP BY ALL
"""
QUERIES["mart_credit_risk"] = lambda spark, sf: marts.credit_risk(
    facts.loans(_entity(spark, sf, "loan_applications"), _entity(spark, sf, "customers"))
)
SQL["mart_credit_risk"] = f"""
SELECT credit_tier, approval_status, purpose, loan_term_months,
  count(application_id) AS total_applications, {ob.total('is_approved')} AS total_approved,
  {ob.total('is_declined')} AS total_declined, {ob.total('is_default')} AS total_defaults,
  {ob.rnd('avg(is_approved) * 100', 2)} AS approval_rate_pct,
  {ob.rnd('avg(is_declined) * 100', 2)} AS decline_rate_pct,
  coalesce({ob.rnd('CAST(sum(is_default) AS DOUBLE) / nullif(sum(is_approved), 0) * 100', 2)}, 0.0)
    AS default_rate_pct,
  {ob.money_avg('requested_amount')} AS avg_requested_amount,
  {ob.money_avg('loan_amount')} AS avg_approved_amount,
  {ob.money('loan_amount')} AS total_loan_portfolio,
  {ob.money_avg('interest_rate')} AS avg_interest_rate,
  {ob.money_avg('annual_interest_amount')} AS avg_annual_interest,
  {ob.money_avg('amount_gap')} AS avg_amount_gap,
  {ob.rnd('avg(credit_score)', 2)} AS avg_credit_score,
  {ob.rnd('avg(days_since_signup_at_application)', 0)} AS avg_days_to_application
FROM f_loans GROUP BY credit_tier, approval_status, purpose, loan_term_months
"""
QUERIES["mart_inventory_health"] = lambda spark, sf: marts.inventory_health(
    dims.product(_entity(spark, sf, "product_inventory"))
)
SQL["mart_inventory_health"] = f"""
SELECT category, supplier, count(product_id) AS total_products,
  {ob.total('stock_level')} AS total_stock_units,
  count(*) FILTER (WHERE stock_status = 'Out of Stock') AS out_of_stock_count,
  count(*) FILTER (WHERE stock_status = 'Low Stock') AS low_stock_count,
  count(*) FILTER (WHERE stock_status = 'In Stock') AS in_stock_count,
  {ob.rnd("count(*) FILTER (WHERE stock_status = 'Out of Stock') * 100.0::DOUBLE / count(product_id)", 2)}
    AS out_of_stock_rate_pct,
  {ob.money('unit_cost * stock_level')} AS total_inventory_cost,
  {ob.money('selling_price * stock_level')} AS total_inventory_value,
  {ob.money_avg('margin_pct')} AS avg_margin_pct, {ob.money_avg('gross_margin')} AS avg_gross_margin,
  {ob.total('CASE WHEN stock_level <= reorder_point THEN reorder_quantity ELSE 0 END')}
    AS total_units_to_reorder,
  {ob.money('CASE WHEN stock_level <= reorder_point THEN reorder_quantity * unit_cost ELSE 0 END')}
    AS estimated_reorder_cost,
  {ob.rnd('avg(lead_time_days)', 1)} AS avg_lead_time_days,
  max(lead_time_days) AS max_lead_time_days
FROM o_products GROUP BY category, supplier
"""

# --- attribution ------------------------------------------------------------------------------


def _touch_facts(spark, sf):
    return facts.clean_touches(_entity(spark, sf, "marketing_touches"))


_TOUCH = ", ".join(attribution.TOUCH_COLUMNS)
_BY = "OVER (PARTITION BY customer_id)"
_CREDIT = "attribution_credit, attribution_credit AS attributed_conversions"
ob.CTE["a_first_click"] = f"""
SELECT {_TOUCH}, {_CREDIT}, 'first_click' AS attribution_model FROM (
  SELECT *, CASE WHEN sum(is_converted) {_BY} > 0 AND row_number() OVER (PARTITION BY customer_id
    ORDER BY touchpoint_date, touch_id) = 1 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END
    AS attribution_credit
  FROM f_spend)
"""
ob.CTE["a_last_click"] = f"""
SELECT {_TOUCH}, {_CREDIT}, 'last_click' AS attribution_model FROM (
  SELECT *, CASE WHEN is_converted = 1 AND row_number() OVER (PARTITION BY customer_id
    ORDER BY touchpoint_date DESC, touch_id DESC) = 1 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END
    AS attribution_credit
  FROM f_spend)
"""
ob.CTE["a_linear"] = f"""
SELECT {_TOUCH}, {_CREDIT}, 'linear' AS attribution_model FROM (
  SELECT f.*, CASE WHEN c > 0 THEN {ob.rnd('1.0::DOUBLE / n', 6)} ELSE 0.0::DOUBLE END
    AS attribution_credit
  FROM f_spend f JOIN (SELECT customer_id, count(*) AS n, sum(is_converted) AS c FROM f_spend
    GROUP BY customer_id) s ON f.customer_id = s.customer_id)
"""
ob.CTE["a_decay_weights"] = """
SELECT f.*, CAST(date_diff('day', f.touchpoint_date, d) AS INTEGER) AS days_before_conversion,
  CASE WHEN date_diff('day', f.touchpoint_date, d) >= 0
    THEN pow(2.0::DOUBLE, -date_diff('day', f.touchpoint_date, d) / 7.0::DOUBLE)
    ELSE 0.0::DOUBLE END AS w
FROM f_spend f JOIN (
  SELECT customer_id, min(CASE WHEN is_converted = 1 THEN touchpoint_date END) AS d
  FROM f_spend GROUP BY customer_id) s ON f.customer_id = s.customer_id
"""
ob.CTE["a_time_decay"] = f"""
SELECT {_TOUCH}, days_before_conversion, {_CREDIT}, 'time_decay' AS attribution_model FROM (
  SELECT *, CASE WHEN sum(w) {_BY} > 0 THEN {ob.rnd(f'w / sum(w) {_BY}', 6)} ELSE 0.0::DOUBLE END
    AS attribution_credit FROM a_decay_weights)
"""
ob.CTE["a_position_based"] = f"""
SELECT {_TOUCH}, total_touches, touch_position,
  CASE WHEN touch_position = 1 THEN 'first' WHEN touch_position = total_touches THEN 'last'
    ELSE 'middle' END AS touch_position_label,
  {_CREDIT}, 'position_based' AS attribution_model
FROM (SELECT *, CAST(CASE WHEN c = 0 THEN 0.0 WHEN total_touches = 1 THEN 1.0
    WHEN total_touches = 2 THEN 0.5 WHEN touch_position = 1 THEN 0.4
    WHEN touch_position = total_touches THEN 0.4
    ELSE {ob.rnd('0.2::DOUBLE / nullif(total_touches - 2, 0)', 6)} END AS DOUBLE)
    AS attribution_credit
  FROM (SELECT *, count(touch_id) {_BY} AS total_touches, sum(is_converted) {_BY} AS c,
    row_number() OVER (PARTITION BY customer_id ORDER BY touchpoint_date, touch_id)
      AS touch_position FROM f_spend))
"""
for _model in attribution.MODELS:
    QUERIES[f"attribution_{_model}"] = (
        lambda spark, sf, model=_model: getattr(attribution, model)(_touch_facts(spark, sf))
    )
    SQL[f"attribution_{_model}"] = f"SELECT * FROM a_{_model}"

    QUERIES[f"attribution_table_{_model}"] = (
        lambda spark, sf, model=_model: attribution.of_model(
            attribution.credits(_touch_facts(spark, sf)), model
        )
    )
    SQL[f"attribution_table_{_model}"] = f"SELECT * FROM a_{_model}"

# Shares as they are, to nine digits after summing.
QUERIES["attribution_exact_credits"] = lambda spark, sf: attribution.channel_credits(
    _touch_facts(spark, sf), digits=None
).select("attribution_model", "channel", "total_touches", expr.rnd("credit", 6).alias("credit"))
ob.CTE["a_totals"] = """
SELECT customer_id, count(*) AS n, sum(is_converted) AS c FROM f_spend GROUP BY customer_id
"""
SQL["attribution_exact_credits"] = f"""
SELECT 'linear' AS attribution_model, channel, count(*) AS total_touches,
  {ob.rnd('sum(CASE WHEN c > 0 THEN 1.0::DOUBLE / n ELSE 0 END)', 6)} AS credit
FROM f_spend f JOIN a_totals s ON f.customer_id = s.customer_id GROUP BY channel
UNION ALL
SELECT 'time_decay', channel, count(*),
  {ob.rnd('sum(CASE WHEN t > 0 THEN w / t ELSE 0 END)', 6)}
FROM (SELECT *, sum(w) {_BY} AS t FROM a_decay_weights) GROUP BY channel
UNION ALL
SELECT 'position_based', channel, count(*), {ob.rnd('''sum(CASE WHEN c = 0 THEN 0.0::DOUBLE
  WHEN n = 1 THEN 1 WHEN n = 2 THEN 0.5 WHEN p = 1 OR p = n THEN 0.4 ELSE 0.2::DOUBLE / (n - 2) END)''', 6)}
FROM (SELECT channel, sum(is_converted) {_BY} AS c, count(*) {_BY} AS n, row_number() OVER
  (PARTITION BY customer_id ORDER BY touchpoint_date, touch_id) AS p FROM f_spend) GROUP BY channel
UNION ALL
SELECT attribution_model, channel, count(*), {ob.rnd('sum(attribution_credit)', 6)}
FROM a_all WHERE attribution_model LIKE '%_click' GROUP BY 1, 2
"""

_STACK = (
    "channel, campaign, touch_cost, attribution_credit, attributed_conversions, attribution_model"
)
ob.CTE["a_all"] = " UNION ALL ".join(f"SELECT {_STACK} FROM a_{m}" for m in attribution.MODELS)
QUERIES["attribution_stack"] = lambda spark, sf: attribution.stack(
    [getattr(attribution, m)(_touch_facts(spark, sf)) for m in attribution.MODELS]
)
SQL["attribution_stack"] = "SELECT * FROM a_all"
QUERIES["attribution_all_models"] = lambda spark, sf: attribution.all_models(
    _touch_facts(spark, sf)
)
SQL["attribution_all_models"] = "SELECT * FROM a_all"
QUERIES["attribution_comparison"] = lambda spark, sf: attribution.compare(_touch_facts(spark, sf))
ob.CTE["a_summary"] = f"""
SELECT attribution_model, channel, count(*) AS total_touches, {ob.money('touch_cost')} AS spend,
  {ob.rnd(ob.exact('attributed_conversions'), 2)} AS credit
FROM a_all GROUP BY attribution_model, channel
"""
ob.CTE["a_shares"] = """
SELECT *, credit / nullif(sum(credit) OVER (PARTITION BY attribution_model), 0) * 100 AS credit_share,
  spend / nullif(sum(spend) OVER (PARTITION BY attribution_model), 0) * 100 AS spend_share
FROM a_summary
"""
ob.CTE["a_comparison"] = f"""
SELECT attribution_model, channel, total_touches, spend AS total_spend,
  credit AS attributed_conversions, {ob.rnd('credit_share', 2)} AS conversion_share_pct,
  {ob.rnd('spend / nullif(credit, 0)', 2)} AS effective_cac,
  {ob.rnd('spend_share', 2)} AS spend_share_pct,
  {ob.rnd('credit_share - spend_share', 2)} AS reallocation_signal
FROM a_shares
"""
SQL["attribution_comparison"] = "SELECT * FROM a_comparison"
QUERIES["attribution_pivot"] = lambda spark, sf: attribution.pivot_shares(
    attribution.compare(_touch_facts(spark, sf))
)
SQL["attribution_pivot"] = (
    "SELECT channel, "
    + ", ".join(
        f"max(CASE WHEN attribution_model = '{m}' THEN conversion_share_pct END) AS {m}_pct"
        for m in attribution.MODELS
    )
    + f", {ob.rnd('max(conversion_share_pct) - min(conversion_share_pct)', 1)}"
    " AS variance_across_models FROM a_comparison GROUP BY channel"
)
QUERIES["attribution_recommendation"] = lambda spark, sf: attribution.recommend(
    attribution.compare(_touch_facts(spark, sf))
)
SQL["attribution_recommendation"] = """
SELECT channel, spend_share_pct, conversion_share_pct, reallocation_signal,
  CASE WHEN reallocation_signal >= 5 THEN 'Increase budget'
    WHEN reallocation_signal <= -5 THEN 'Reduce budget' ELSE 'Maintain budget' END AS recommendation
FROM a_comparison WHERE attribution_model = 'linear'
"""

# --- ROI and retention ------------------------------------------------------------------------

QUERIES["roi_channel_cac"] = lambda spark, sf: roi.channel_cac(_touch_facts(spark, sf))
_CAC = f"""
SELECT channel, count(DISTINCT customer_id) AS total_customers_touched,
  {ob.total('is_converted')} AS conversions, {ob.money('touch_cost')} AS total_spend,
  {ob.rnd(ob.exact('CASE WHEN is_converted = 1 THEN touch_cost ELSE 0 END') + ' / nullif(sum(is_converted), 0)', 2)}
    AS last_click_cac,
  {ob.rnd(ob.exact('touch_cost') + ' / nullif(sum(is_converted), 0)', 2)} AS blended_cac,
  {ob.rnd('avg(is_converted) * 100', 2)} AS conversion_rate_pct
FROM {{spend}} GROUP BY channel
"""
ob.CTE["r_cac"] = _CAC.format(spend="f_spend")
QUERIES["roi_subcent"] = lambda spark, sf: roi.channel_cac(_subcent(_touch_facts(spark, sf)))
SQL["roi_subcent"] = _CAC.format(spend="f_subcent")
SQL["roi_channel_cac"] = "SELECT * FROM r_cac"
QUERIES["roi_cac_gap"] = lambda spark, sf: roi.cac_gap(_touch_facts(spark, sf))
SQL["roi_cac_gap"] = f"""
SELECT channel, conversions, last_click_cac, blended_cac,
  {ob.rnd('blended_cac - last_click_cac', 2)} AS cac_gap,
  {ob.rnd('(blended_cac / nullif(last_click_cac, 0) - 1) * 100', 1)} AS pct_underestimate
FROM r_cac
"""
ob.CTE["r_active"] = "SELECT c.customer_id, strftime(c.signup_date, '%Y-%m') AS cohort_month," + (
    "c.acquisition_channel, "
    + ", ".join(
        "max(CASE WHEN date_diff('day', c.signup_date, transaction_date)"
        f" BETWEEN 1 AND {n} THEN 1 ELSE 0 END) AS active_{n}d"
        for n in (30, 60, 90)
    )
    + " FROM c_customers c LEFT JOIN f_transactions t"
    " ON c.customer_id = t.customer_id AND is_failed = 0 GROUP BY 1, 2, 3"
)
QUERIES["retention_by_cohort"] = lambda spark, sf: roi.retention(
    _entity(spark, sf, "customers"), _clean_transactions(spark, sf)
)
SQL["retention_by_cohort"] = (
    "SELECT cohort_month, count(customer_id) AS cohort_size, "
    + ", ".join(
        f"{ob.total(f'active_{n}d')} AS retained_{n}d,"
        f" {ob.rnd(f'avg(active_{n}d) * 100', 1)} AS retention_rate_{n}d"
        for n in (30, 60, 90)
    )
    + " FROM r_active GROUP BY cohort_month"
)
QUERIES["retention_by_channel"] = lambda spark, sf: roi.retention(
    _entity(spark, sf, "customers"), _clean_transactions(spark, sf), by="acquisition_channel"
)
SQL["retention_by_channel"] = (
    "SELECT acquisition_channel, count(*) AS cohort_size, "
    + ", ".join(
        f"{ob.rnd(f'avg(active_{n}d) * 100', 1)} AS retention_{n}d_pct" for n in (30, 60, 90)
    )
    + " FROM r_active GROUP BY acquisition_channel"
)
SQL["credit_risk_by_loads"] = SQL["mart_credit_risk"]
SQL["channel_cac_by_loads"] = SQL["roi_channel_cac"]
