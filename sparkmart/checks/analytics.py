"""Registered queries for supply, experiments and forecasts."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from sparkmart.checks import gold  # noqa: F401  (defines the fact CTEs used below)
from sparkmart.checks import oracle_base as ob
from sparkmart.functions import expr
from sparkmart.operators import abtest, facts, forecast, seasonal, supply
from sparkmart.sources import testviews as tv

QUERIES = {}
SQL = {}
AS_OF = "2001-07-01"
TRAIN_END = "2001-03-31"


# --- supply -----------------------------------------------------------------------------------


def _health(spark, sf):
    return supply.inventory_health(tv.clean_entity(spark, sf, "product_inventory"), AS_OF)


def _clean_transactions(spark, sf):
    return facts.clean_transactions(tv.clean_entity(spark, sf, "transactions"))


QUERIES["inventory_health"] = _health
ob.CTE["i_health"] = f"""
SELECT product_id, product_name, category, supplier, DATE '{AS_OF}' AS snapshot_date, stock_level,
  reorder_point, reorder_quantity, lead_time_days, unit_cost, selling_price,
  {ob.rnd('stock_level * unit_cost', 2)} AS inventory_value, dos AS days_of_supply,
  CASE WHEN stock_level <= reorder_point THEN 1 ELSE 0 END AS reorder_trigger,
  CASE WHEN dos > 180 THEN 'high' WHEN dos > 90 THEN 'medium' ELSE 'low' END AS obsolescence_risk,
  CASE WHEN stock_level <= 0 THEN 'out_of_stock' WHEN stock_level <= reorder_point THEN 'critical'
    WHEN dos <= 30 THEN 'low' WHEN dos <= 60 THEN 'moderate' ELSE 'healthy' END AS stock_status
FROM (SELECT *, {ob.rnd('CAST(stock_level AS DOUBLE) / nullif(reorder_quantity, 0)', 1)} AS dos
  FROM c_product_inventory) WHERE NOT is_duplicate
"""
SQL["inventory_health"] = "SELECT * FROM i_health"
QUERIES["stockout_warning"] = lambda spark, sf: supply.stockout_warning(_health(spark, sf))
ob.CTE["i_warning"] = """
SELECT * EXCLUDE (selling_price),
  CASE WHEN stock_status = 'out_of_stock' THEN 0
    WHEN days_of_supply <= lead_time_days THEN CAST(trunc(days_of_supply) AS INTEGER) END
    AS days_until_stockout,
  CASE WHEN stock_level < reorder_point THEN reorder_quantity
    WHEN days_of_supply <= lead_time_days * 1.5::DOUBLE
      THEN CAST(ceil(reorder_quantity * 1.25::DOUBLE) AS INTEGER) ELSE 0 END
    AS recommended_order_qty,
  CASE warning_level WHEN 'STOCKOUT' THEN 'Emergency order required immediately'
    WHEN 'CRITICAL' THEN 'Place order now — below reorder point'
    WHEN 'AT_RISK' THEN 'Order urgently — stockout within lead time'
    WHEN 'WARNING' THEN 'Monitor closely — approaching reorder point'
    ELSE 'No action required' END AS recommended_action,
  CASE warning_level WHEN 'STOCKOUT' THEN 1 WHEN 'CRITICAL' THEN 2 WHEN 'AT_RISK' THEN 3
    WHEN 'WARNING' THEN 4 ELSE 5 END AS severity_rank
FROM (SELECT *, CASE WHEN stock_status = 'out_of_stock' THEN 'STOCKOUT'
    WHEN stock_status = 'critical' THEN 'CRITICAL'
    WHEN days_of_supply <= lead_time_days THEN 'AT_RISK'
    WHEN days_of_supply <= lead_time_days * 1.5::DOUBLE THEN 'WARNING' ELSE 'OK' END
    AS warning_level FROM i_health)
"""
SQL["stockout_warning"] = "SELECT * FROM i_warning"
QUERIES["product_demand"] = lambda spark, sf: supply.product_demand(_clean_transactions(spark, sf))
ob.CTE["i_demand"] = f"""
SELECT product_type AS category, count(transaction_id) AS total_transactions,
  {ob.money('transaction_amount')} AS total_revenue,
  {ob.money_avg('transaction_amount')} AS avg_transaction_value,
  count(DISTINCT customer_id) AS unique_customers
FROM f_transactions WHERE is_failed = 0 GROUP BY product_type
"""
SQL["product_demand"] = "SELECT * FROM i_demand"


def _sop_sql(revenue, transactions):
    def count(cond):
        return f"count(*) FILTER (WHERE {cond})"

    status = ", ".join(
        f"{count(f'stock_status = {chr(39)}{s}{chr(39)}')} AS skus_{s}"
        for s in ("out_of_stock", "critical", "low", "moderate", "healthy")
    )
    at_risk = count("stock_status IN ('out_of_stock', 'critical')")
    return f"""
SELECT *, CASE WHEN pct_skus_at_risk >= 50 THEN 'HIGH RISK' WHEN pct_skus_at_risk >= 25
    THEN 'MEDIUM RISK' ELSE 'LOW RISK' END AS category_risk_level,
  CASE WHEN pct_skus_at_risk >= 50 THEN 'Immediate procurement review required'
    WHEN pct_skus_at_risk >= 25 THEN 'Schedule procurement review this week'
    ELSE 'No immediate action required' END AS sop_recommendation
FROM (
  SELECT h.category, count(product_id) AS total_skus, {ob.total('stock_level')} AS total_units_on_hand,
    {ob.money('inventory_value')} AS total_inventory_value,
    {ob.money_avg('days_of_supply', digits=1)} AS avg_days_of_supply, {status},
    {count('reorder_trigger = 1')} AS skus_needing_reorder,
    {count("obsolescence_risk = 'high'")} AS skus_high_obsolescence,
    {ob.rnd(revenue, 2)} AS total_category_revenue,
    {ob.rnd('avg(coalesce(avg_transaction_value, 0))', 2)} AS avg_transaction_value,
    CAST({transactions} AS BIGINT) AS total_transactions,
    {ob.rnd(f'{at_risk} * 100.0::DOUBLE / nullif(count(product_id), 0)', 1)} AS pct_skus_at_risk
  FROM i_health h LEFT JOIN i_demand d ON h.category = d.category GROUP BY h.category)
"""


QUERIES["sop_category"] = lambda spark, sf: supply.sop_category(
    _health(spark, sf), _clean_transactions(spark, sf)
)
SQL["sop_category"] = _sop_sql(
    "CAST(sum(CAST(coalesce(total_revenue, 0) AS DECIMAL(38,10))) AS DOUBLE)",
    "sum(coalesce(total_transactions, 0))",
)
QUERIES["sop_category_demand_once"] = lambda spark, sf: supply.sop_category(
    _health(spark, sf), _clean_transactions(spark, sf), demand_once=True
)
SQL["sop_category_demand_once"] = _sop_sql(
    "max(coalesce(total_revenue, 0))", "max(coalesce(total_transactions, 0))"
)

# --- forecasts --------------------------------------------------------------------------------


def _applications(spark, sf, by=None, zero_fill=False):
    loans = facts.clean_loans(tv.clean_entity(spark, sf, "loan_applications"))
    return forecast.daily_counts(loans, "application_date", by, zero_fill)


def _daily_sql(by):
    return f"""
SELECT {by} AS series, application_date AS ds, CAST(count(*) AS DOUBLE) AS y FROM f_loans
WHERE application_date IS NOT NULL GROUP BY 1, 2
"""


QUERIES["forecast_daily_series"] = lambda spark, sf: _applications(spark, sf, "approval_status")
ob.CTE["h_daily"] = _daily_sql("approval_status")
ob.CTE["h_daily_all"] = _daily_sql("'all'")
SQL["forecast_daily_series"] = "SELECT * FROM h_daily"
QUERIES["forecast_daily_zero_fill"] = lambda spark, sf: _applications(
    spark, sf, "approval_status", zero_fill=True
)
SQL["forecast_daily_zero_fill"] = """
SELECT s.series, s.ds, coalesce(y, 0.0::DOUBLE) AS y
FROM (SELECT series, CAST(unnest(generate_series(min(ds), max(ds), INTERVAL 1 DAY)) AS DATE) AS ds
  FROM h_daily GROUP BY series) s
LEFT JOIN h_daily d ON s.series = d.series AND s.ds = d.ds
"""


def _split(spark, sf):
    return forecast.split(_applications(spark, sf, "approval_status"), TRAIN_END)


def _parts(spark, sf):
    train, test = _split(spark, sf)
    return train.withColumn("part", F.lit("train")).unionByName(
        test.withColumn("part", F.lit("test"))
    )


QUERIES["forecast_split"] = _parts
SQL["forecast_split"] = f"""
SELECT *, CASE WHEN ds <= DATE '{TRAIN_END}' THEN 'train' ELSE 'test' END AS part FROM h_daily
"""


def _fit_ctes(prefix, source):
    """Fit and predict with joins of grouped aggregates."""
    ob.CTE[f"{prefix}_train"] = f"SELECT * FROM {source} WHERE ds <= DATE '{TRAIN_END}'"
    ob.CTE[f"{prefix}_line"] = f"""
SELECT series, min(ds) AS d0, max(ds) AS d1,
  regr_slope(y, date_diff('day', m, ds)) AS slope,
  regr_intercept(y, date_diff('day', m, ds)) AS intercept
FROM (SELECT *, min(ds) OVER (PARTITION BY series) AS m FROM {prefix}_train) GROUP BY series
"""
    ob.CTE[f"{prefix}_days"] = f"""
SELECT d.series, d.ds, y, intercept + slope * date_diff('day', d0, d.ds) AS trend
FROM (SELECT series, ds FROM {prefix}_train UNION ALL
  SELECT series, CAST(unnest(generate_series(d1 + 1, d1 + 365, INTERVAL 1 DAY)) AS DATE)
  FROM {prefix}_line) d
JOIN {prefix}_line l ON d.series = l.series
LEFT JOIN {prefix}_train t ON d.series = t.series AND d.ds = t.ds
"""
    ob.CTE[f"{prefix}_week"] = f"""
SELECT series, dayofweek(ds) AS dow, avg(y - trend) AS weekly FROM {prefix}_days GROUP BY 1, 2
"""
    ob.CTE[f"{prefix}_weekly"] = f"""
SELECT d.*, coalesce(weekly, 0) AS weekly FROM {prefix}_days d LEFT JOIN {prefix}_week w
  ON d.series = w.series AND dayofweek(d.ds) = w.dow
"""
    ob.CTE[f"{prefix}_month"] = f"""
SELECT series, month(ds) AS mon, avg(y - trend - weekly) AS yearly FROM {prefix}_weekly
GROUP BY 1, 2
"""
    ob.CTE[f"{prefix}_point"] = f"""
SELECT d.*, coalesce(yearly, 0) AS yearly, trend + weekly + coalesce(yearly, 0) AS yhat
FROM {prefix}_weekly d LEFT JOIN {prefix}_month m ON d.series = m.series AND month(d.ds) = m.mon
"""
    ob.CTE[f"{prefix}_fit"] = f"""
SELECT p.*, yhat - 1.2815515655446004::DOUBLE * sd AS yhat_lower,
  yhat + 1.2815515655446004::DOUBLE * sd AS yhat_upper
FROM {prefix}_point p JOIN (SELECT series, stddev_samp(y - yhat) AS sd FROM {prefix}_point
  GROUP BY series) s ON p.series = s.series
"""


_fit_ctes("h", "h_daily")
_fit_ctes("ha", "h_daily_all")
_FIGURES = ["trend", "weekly", "yearly", "yhat", "yhat_lower", "yhat_upper"]


def _fitted(spark, sf, by="approval_status"):
    train, _ = forecast.split(_applications(spark, sf, by), TRAIN_END)
    return forecast.fit_predict(train)


QUERIES["forecast_fit_components"] = lambda spark, sf: _fitted(spark, sf).select(
    "series", "ds", "y", *[expr.rnd(c, 4).alias(c) for c in _FIGURES]
)
SQL["forecast_fit_components"] = (
    f"SELECT series, ds, y, {', '.join(f'{ob.rnd(c, 4)} AS {c}' for c in _FIGURES)} FROM h_fit"
)


# The normal equations of the seasonal regression: right side and diagonal of the Gram matrix.
def _equations(spark, sf):
    found = seasonal.equations(_applications(spark, sf, "approval_status"))
    p = seasonal.n_terms()
    place = [i * p - i * (i - 1) // 2 for i in range(p)]  # of the diagonal in the upper half
    return found.select(
        "series", "n", "first_day", "last_day",
        *(expr.rnd(F.col("side")[i], 3).alias(f"side_{i}") for i in range(p)),
        *(expr.rnd(F.col("gram")[k], 3).alias(f"gram_{i}") for i, k in enumerate(place)),
    )


QUERIES["forecast_equations"] = _equations
_years = "(date_diff('day', DATE '2000-01-01', ds) / 365.25::DOUBLE)"
_terms = ["1.0::DOUBLE", _years]
_terms += [f"{f}({2 * k}::DOUBLE * pi() * {_years})" for k in (1, 2, 3) for f in ("sin", "cos")]
_terms += [f"CASE WHEN isodow(ds) = {d} THEN 1.0::DOUBLE ELSE 0.0 END" for d in range(1, 7)]
SQL["forecast_equations"] = (
    "SELECT series, count(*) AS n, min(ds) AS first_day, max(ds) AS last_day, "
    + ", ".join(f"{ob.rnd(f'sum({x} * y)', 3)} AS side_{i}, {ob.rnd(f'sum({x} * {x})', 3)} AS gram_{i}" for i, x in enumerate(_terms))
    + " FROM h_daily GROUP BY series"
)


def _evaluation(spark, sf):
    return forecast.backtest(_applications(spark, sf, "approval_status"), TRAIN_END)


ob.CTE["h_eval"] = f"""
SELECT t.*, yhat, abs(t.y - yhat) AS e FROM (SELECT * FROM h_daily WHERE ds > DATE '{TRAIN_END}') t
LEFT JOIN h_fit f ON t.series = f.series AND t.ds = f.ds
"""
QUERIES["forecast_evaluation"] = lambda spark, sf: forecast.evaluate(
    _split(spark, sf)[1], _fitted(spark, sf)
).select("series", "ds", "y", expr.rnd("yhat", 4).alias("yhat"), expr.rnd("abs_error", 4).alias("abs_error"))
SQL["forecast_evaluation"] = (
    f"SELECT series, ds, y, {ob.rnd('yhat', 4)} AS yhat, {ob.rnd('e', 4)} AS abs_error FROM h_eval"
)
QUERIES["forecast_accuracy"] = lambda spark, sf: forecast.accuracy(_evaluation(spark, sf))
SQL["forecast_accuracy"] = f"""
SELECT series, count(e) AS days, {ob.rnd('avg(e / nullif(y, 0) * 100)', 4)} AS mape,
  {ob.rnd('sqrt(avg(e * e))', 4)} AS rmse, {ob.rnd('avg(e)', 4)} AS mae
FROM h_eval GROUP BY series
"""
QUERIES["forecast_monthly_accuracy"] = lambda spark, sf: forecast.monthly_accuracy(
    _evaluation(spark, sf)
)
ob.CTE["h_monthly"] = f"""
SELECT series, strftime(ds, '%Y-%m') AS month, {ob.rnd('sum(y)', 4)} AS actual_total,
  {ob.rnd('sum(yhat)', 4)} AS forecast_total, {ob.rnd('avg(e)', 4)} AS mae,
  {ob.rnd('avg(e / nullif(y, 0) * 100)', 4)} AS mape,
  {ob.rnd('sum(y) - sum(yhat)', 4)} AS variance,
  {ob.rnd('(sum(y) - sum(yhat)) / nullif(sum(y), 0) * 100', 4)} AS variance_pct
FROM h_eval GROUP BY 1, 2
"""
SQL["forecast_monthly_accuracy"] = "SELECT * FROM h_monthly"
QUERIES["forecast_best_worst_month"] = lambda spark, sf: forecast.best_worst(
    forecast.monthly_accuracy(_evaluation(spark, sf))
)
SQL["forecast_best_worst_month"] = """
SELECT series, (list(month ORDER BY mape, month))[1] AS best_month, min(mape) AS best_mape,
  (list(month ORDER BY mape DESC, month))[1] AS worst_month, max(mape) AS worst_mape
FROM h_monthly WHERE mape IS NOT NULL GROUP BY series
"""


def _published(spark, sf, by=None):
    return forecast.publish(
        _fitted(spark, sf, by=by), "trend_v1", TRAIN_END, "2001-04-01 06:00:00"
    )


QUERIES["forecast_publish"] = _published
ob.CTE["h_published"] = (
    "SELECT series, ds AS forecast_date, "
    + ", ".join(
        f"{ob.rnd(f'CASE WHEN {c} < 0 THEN 0.0::DOUBLE ELSE {c} END', 2)} AS {name}"
        for c, name in (
            ("yhat", "predicted_applications"),
            ("yhat_lower", "predicted_lower"),
            ("yhat_upper", "predicted_upper"),
        )
    )
    + f", 'trend_v1' AS model_version, DATE '{TRAIN_END}' AS trained_through,"
    " TIMESTAMP '2001-04-01 06:00:00' AS created_at"
    f" FROM ha_fit WHERE ds > DATE '{TRAIN_END}'"
)
SQL["forecast_publish"] = "SELECT * FROM h_published"
QUERIES["sku_variance"] = lambda spark, sf: supply.sku_variance(
    supply.stockout_warning(_health(spark, sf)), _published(spark, sf), AS_OF
)
ob.CTE["i_forecast"] = f"""
SELECT {ob.rnd('avg(predicted_applications)', 2)} AS avg_daily_forecast,
  {ob.money('predicted_applications')} AS total_forecast_30d
FROM h_published WHERE forecast_date >= DATE '{AS_OF}' AND forecast_date < DATE '{AS_OF}' + 30
"""
_VARIANCE = f"""
SELECT * EXCLUDE (snapshot_date, v), {ob.rnd('v', 2)} AS supply_demand_variance,
  CASE WHEN v < 0 THEN 'DEFICIT' WHEN v < reorder_point THEN 'TIGHT' ELSE 'SURPLUS' END
    AS variance_status,
  {ob.rnd('CAST(stock_level AS DOUBLE) / nullif(avg_daily_forecast, 0)', 1)} AS forecast_days_of_supply
FROM (SELECT *, stock_level - avg_daily_forecast * lead_time_days AS v
  FROM i_warning CROSS JOIN {{figures}})
"""
SQL["sku_variance"] = _VARIANCE.format(figures="i_forecast")
# One forecast per approval status: a day's demand is the sum of the series.
QUERIES["sku_variance_by_series"] = lambda spark, sf: supply.sku_variance(
    supply.stockout_warning(_health(spark, sf)), _published(spark, sf, "approval_status"), AS_OF
)
ob.CTE["h_published_series"] = ob.CTE["h_published"].replace("ha_fit", "h_fit")
ob.CTE["i_forecast_series"] = f"""
SELECT {ob.rnd('avg(d)', 2)} AS avg_daily_forecast, CAST(round(sum(d), 2) AS DOUBLE) AS total_forecast_30d
FROM (SELECT forecast_date, sum(CAST(predicted_applications AS DECIMAL(38,10))) AS d
  FROM h_published_series
  WHERE forecast_date >= DATE '{AS_OF}' AND forecast_date < DATE '{AS_OF}' + 30 GROUP BY forecast_date)
"""
SQL["sku_variance_by_series"] = _VARIANCE.format(figures="i_forecast_series")
QUERIES["warnings_by_severity"] = lambda spark, sf: supply.order_by_severity(
    supply.stockout_warning(_health(spark, sf)), "days_of_supply"
).select(
    "product_id", "warning_level", "severity_rank",
    F.row_number().over(Window.partitionBy("warning_level").orderBy("days_of_supply", "product_id")).alias("place"),
)
SQL["warnings_by_severity"] = """
SELECT product_id, warning_level, severity_rank, CAST(row_number() OVER (PARTITION BY warning_level
  ORDER BY days_of_supply NULLS FIRST, product_id) AS INTEGER) AS place FROM i_warning
"""

# --- experiments ------------------------------------------------------------------------------


def _experiment(spark, sf):
    """Arms by event parity, experiments by user; the last experiment never succeeds."""
    user = F.col("user_id") % 4
    bought = F.when((F.col("event_type") == "purchase") & (user != 3), 1).otherwise(0)
    return tv.table(spark, sf, "events").select(
        user.alias("experiment"),
        F.when(F.col("event_id") % 2 == 0, "control").otherwise("treatment").alias("group"),
        bought.alias("success"),
        "value",
    )


ob.CTE["x_events"] = """
SELECT user_id % 4 AS experiment, CASE WHEN event_id % 2 = 0 THEN 'control' ELSE 'treatment' END
    AS "group",
  CASE WHEN event_type = 'purchase' AND user_id % 4 <> 3 THEN 1 ELSE 0 END AS success, value
FROM events
"""
QUERIES["ab_summary"] = lambda spark, sf: abtest.summary(
    _experiment(spark, sf), "experiment", "group", "success"
)
SQL["ab_summary"] = f"""
SELECT experiment, "group", {ob.total('success')} AS successes, count(success) AS n,
  {ob.rnd('avg(success)', 4)} AS rate FROM x_events GROUP BY experiment, "group"
"""


def _proportions(spark, sf, **options):
    return abtest.proportions(_experiment(spark, sf), "experiment", outcome="success", **options)


_ARMS = """
SELECT experiment, count({v}) FILTER (WHERE "group" = 'control') AS n0,
  count({v}) FILTER (WHERE "group" = 'treatment') AS n1,
  avg({v}) FILTER (WHERE "group" = 'control') AS m0,
  avg({v}) FILTER (WHERE "group" = 'treatment') AS m1,
  var_samp({v}) FILTER (WHERE "group" = 'control') AS v0,
  var_samp({v}) FILTER (WHERE "group" = 'treatment') AS v1
FROM x_events GROUP BY experiment
"""
ob.CTE["x_rate_arms"] = _ARMS.format(v="success")
ob.CTE["x_value_arms"] = _ARMS.format(v="value")
ob.CTE["x_z"] = """
SELECT *, (m1 - m0) / nullif(sqrt(q * (1 - q) * (1.0::DOUBLE / n0 + 1.0::DOUBLE / n1)), 0) AS z,
  1.959963984540054::DOUBLE * sqrt(m0 * (1 - m0) / n0 + m1 * (1 - m1) / n1) AS half
FROM (SELECT *, (m0 * n0 + m1 * n1) / (n0 + n1) AS q FROM x_rate_arms)
"""
# Tail areas by Simpson's rule with 2000 steps between 0 and the statistic.
_SIMPSON = """
SELECT experiment, 1 - 2 * sum(
  CASE WHEN i IN (0, 2000) THEN 1 WHEN i % 2 = 1 THEN 4 ELSE 2 END * {density}) * {x} / 6000 AS p
FROM {source}, generate_series(0, 2000) AS g(i) WHERE {x} IS NOT NULL GROUP BY experiment, {x}
"""
ob.CTE["x_z_p"] = _SIMPSON.format(
    source="(SELECT experiment, abs(z) AS a FROM x_z)",
    x="a",
    density="exp(-pow(a * i / 2000, 2) / 2) / sqrt(2 * pi())",
)
ob.CTE["x_proportions"] = f"""
SELECT r.experiment, n0 AS n_control, n1 AS n_treatment, {ob.rnd('m0', 6)} AS control_value,
  {ob.rnd('m1', 6)} AS treatment_value, {ob.rnd('(m1 - m0) * 100', 4)} AS lift_pp,
  {ob.rnd('m1 / nullif(m0, 0) * 100 - 100', 4)} AS relative_lift_pct, {ob.rnd('z', 6)} AS statistic,
  {ob.rnd('p', 6)} AS p_value, {ob.rnd('m1 - m0 - half', 6)} AS ci_low,
  {ob.rnd('m1 - m0 + half', 6)} AS ci_high, p < 0.05 AS significant
FROM x_z r LEFT JOIN x_z_p p ON r.experiment = p.experiment
"""
QUERIES["ab_proportions"] = _proportions
SQL["ab_proportions"] = "SELECT * FROM x_proportions"


def _means(spark, sf, **options):
    return abtest.means(_experiment(spark, sf), "experiment", outcome="value", **options)


QUERIES["ab_means"] = _means
ob.CTE["x_t"] = """
SELECT *, (m1 - m0) / nullif(sqrt(s0 + s1), 0) AS t,
  pow(s0 + s1, 2) / nullif(s0 * s0 / (n0 - 1) + s1 * s1 / (n1 - 1), 0) AS nu,
  1.959963984540054::DOUBLE * sqrt(s0 + s1) AS half
FROM (SELECT *, v0 / n0 AS s0, v1 / n1 AS s1 FROM x_value_arms)
"""
ob.CTE["x_t_p"] = _SIMPSON.format(
    source="(SELECT experiment, abs(t) AS a, nu FROM x_t)",
    x="a",
    density="exp(lgamma((nu + 1) / 2) - lgamma(nu / 2)) / sqrt(nu * pi())"
    " * pow(1 + pow(a * i / 2000, 2) / nu, -(nu + 1) / 2)",
)
ob.CTE["x_means"] = f"""
SELECT r.experiment, n0 AS n_control, n1 AS n_treatment, {ob.rnd('m0', 4)} AS control_value,
  {ob.rnd('m1', 4)} AS treatment_value, {ob.rnd('m1 - m0', 4)} AS difference,
  {ob.rnd('(m1 - m0) / nullif(m0, 0) * 100', 4)} AS relative_lift_pct,
  {ob.rnd('t', 6)} AS statistic, {ob.rnd('nu', 4)} AS degrees_of_freedom,
  {ob.rnd('p', 6)} AS p_value, {ob.rnd('m1 - m0 - half', 4)} AS ci_low,
  {ob.rnd('m1 - m0 + half', 4)} AS ci_high, p < 0.05 AS significant
FROM x_t r LEFT JOIN x_t_p p ON r.experiment = p.experiment
"""
SQL["ab_means"] = "SELECT * FROM x_means"

_Z = "(1.959963984540054::DOUBLE + 0.8416212335729143::DOUBLE)"
QUERIES["ab_required_n_rates"] = lambda spark, sf: abtest.required_n(
    _experiment(spark, sf), "experiment", "success", mde=0.03
)
_REQUIRED = """
SELECT segment, {baseline} AS baseline, {sd} AS std_dev, {effect} AS effect_size,
  CAST(ceil({n}) AS BIGINT) AS n_per_group, CAST(2 * ceil({n}) AS BIGINT) AS n_total
FROM (SELECT *, {h} AS h FROM (SELECT experiment AS segment, avg({v}) AS m, stddev_samp({v}) AS sd
  FROM x_events GROUP BY experiment))
"""
SQL["ab_required_n_rates"] = _REQUIRED.format(
    v="success",
    baseline=ob.rnd("m", 4),
    sd=ob.rnd("sd", 4),
    effect=ob.rnd("h", 6),
    h="2 * (asin(sqrt(m + 0.03::DOUBLE)) - asin(sqrt(m)))",
    n=f"2 * pow({_Z} / h, 2)",
)
QUERIES["ab_required_n_means"] = lambda spark, sf: abtest.required_n(
    _experiment(spark, sf), "experiment", "value", mde=5.0, kind="means"
)
SQL["ab_required_n_means"] = _REQUIRED.format(
    v="value",
    baseline=ob.rnd("m", 4),
    sd=ob.rnd("sd", 4),
    effect=ob.rnd("h", 6),
    h="5.0::DOUBLE / nullif(sd, 0)",
    n=f"2 * pow({_Z} / h, 2) + pow(1.959963984540054::DOUBLE, 2) / 4",
)


def _assumptions(spark, sf):
    """Value per experiment: the average order of the customers with the same remainder."""
    kinds = F.array(
        F.struct(F.lit("rate-").alias("kind"), F.lit(52).alias("periods")),
        F.struct(F.lit("value-").alias("kind"), F.lit(12).alias("periods")),
    )
    per_segment = (
        tv.table(spark, sf, "orders")
        .groupBy((F.col("o_custkey") % 4).alias("segment"))
        .agg(expr.money_avg("o_totalprice").alias("factor"))
    )
    return per_segment.select("segment", "factor", F.inline(kinds)).select(
        F.concat("kind", F.col("segment").cast("string")).alias("experiment"), "factor", "periods"
    )


QUERIES["ab_report"] = lambda spark, sf: abtest.report(
    abtest.as_result(_proportions(spark, sf, exact=True), "Z-test (proportions)", "rate-").unionByName(
        abtest.as_result(_means(spark, sf, exact=True), "T-test (means)", "value-")
    ),
    _assumptions(spark, sf),
)
SQL["ab_report"] = f"""
SELECT r.* EXCLUDE (d), {ob.rnd('d * factor * periods', 2)} AS annual_impact
FROM (
  SELECT 'rate-' || p.experiment AS experiment, 'Z-test (proportions)' AS method, control_value,
    treatment_value, relative_lift_pct, p_value, significant, m1 - m0 AS d
  FROM x_proportions p JOIN x_rate_arms a ON p.experiment = a.experiment
  UNION ALL
  SELECT 'value-' || t.experiment, 'T-test (means)', control_value, treatment_value,
    relative_lift_pct, p_value, significant, m1 - m0
  FROM x_means t JOIN x_value_arms a ON t.experiment = a.experiment) r
LEFT JOIN (
  SELECT kind || s AS experiment, factor, periods
  FROM (SELECT o_custkey % 4 AS s, {ob.money_avg('o_totalprice')} AS factor FROM orders GROUP BY 1)
  CROSS JOIN (VALUES ('rate-', 52), ('value-', 12)) k(kind, periods)) a
ON r.experiment = a.experiment
"""
