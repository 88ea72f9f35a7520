"""DuckDB SQL building blocks: the entities of ``sources.testviews`` and their cleaned forms."""

from __future__ import annotations

import re
from types import SimpleNamespace


def rnd(e: str, digits: int) -> str:
    """Half-up rounding on the shortest decimal form, as in ``functions.expr.rnd``."""
    return f"CAST(round(CAST(CAST(({e}) AS VARCHAR) AS DECIMAL(38,10)), {digits}) AS DOUBLE)"


def exact(e: str) -> str:
    """Sum on a wide decimal, not rounded."""
    return f"CAST(sum(CAST({e} AS DECIMAL(38,10))) AS DOUBLE)"


def money(e: str, digits: int = 2) -> str:
    """The sum of the amounts as they are, rounded once."""
    return f"CAST(round(sum(CAST({e} AS DECIMAL(38,10))), {digits}) AS DOUBLE)"


def money_avg(e: str, digits: int = 2) -> str:
    return rnd(f"{exact(e)} / nullif(count({e}), 0)", digits)


def total(e: str) -> str:
    return f"CAST(sum({e}) AS BIGINT)"


def title(e: str) -> str:
    words = f"string_split(lower({e}), ' ')"
    return f"array_to_string(list_transform({words}, lambda w: upper(w[1]) || w[2:]), ' ')"


def days(start: str, end: str) -> str:
    return f"CAST(date_diff('day', {start}, {end}) AS INTEGER)"


DATE_PARSE = "['%Y-%m-%d', '%m/%d/%Y', '%B %d %Y', '%Y/%m/%d']"
TS_PARSE = (
    "['%Y-%m-%d %H:%M:%S', '%m/%d/%Y %H:%M:%S', '%B %d %Y %H:%M:%S', '%Y/%m/%d %H:%M:%S',"
    " '%Y-%m-%d', '%m/%d/%Y', '%B %d %Y', '%Y/%m/%d']"
)


def parse_date(e: str) -> str:
    return f"CAST(try_strptime({e}, {DATE_PARSE}) AS DATE)"


def parse_ts(e: str) -> str:
    return f"try_strptime({e}, {TS_PARSE})"


CTE: dict[str, str] = {}

CTE["b_customers"] = f"""
SELECT c_custkey AS customer_id,
  split_part(c_name, '#', 1) AS first_name,
  split_part(c_name, '#', 2) AS last_name,
  CASE WHEN c_custkey % 20 <> 7 THEN 'c' || c_custkey || '@example.com' END AS email,
  DATE '1950-01-01' + CAST(c_custkey * 31 % 15000 AS INTEGER) AS date_of_birth,
  CASE WHEN c_custkey % 20 <> 3
    THEN (['Male', 'Female', 'Non-binary'])[c_custkey % 3 + 1] END AS gender,
  {title('r_name')} AS region,
  CASE c_mktsegment WHEN 'AUTOMOBILE' THEN 'Email' WHEN 'BUILDING' THEN 'Social'
    WHEN 'FURNITURE' THEN 'Direct' WHEN 'HOUSEHOLD' THEN 'Referral'
    WHEN 'MACHINERY' THEN 'Email' END AS acquisition_channel,
  DATE '1995-01-01' + CAST(c_custkey * 13 % 1500 AS INTEGER) AS signup_date,
  CASE WHEN c_custkey % 20 < 12 THEN 'Prime' WHEN c_custkey % 20 < 17 THEN 'Near-Prime'
    ELSE 'Subprime' END AS credit_tier,
  CAST(300 + c_custkey * 37 % 550 AS INTEGER) AS credit_score,
  CASE WHEN c_custkey % 20 <> 11 THEN {rnd('c_acctbal * 10', 2)} END AS annual_income,
  c_custkey % 20 <> 5 AS is_active
FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
"""

CTE["b_transactions"] = f"""
SELECT o_orderkey AS transaction_id, o_custkey AS customer_id,
  {rnd('o_totalprice * CASE WHEN o_orderkey % 101 = 0 THEN 20 ELSE 1 END', 2)} AS amount,
  (['ECONOMY', 'LARGE', 'MEDIUM', 'PROMO', 'SMALL', 'STANDARD'])[o_orderkey % 6 + 1]
    AS product_type,
  CASE WHEN o_orderkey % 20 <> 7 THEN
    CASE WHEN o_orderkey % 25 = 0 THEN 'Refunded' WHEN o_orderstatus = 'F' THEN 'Completed'
      WHEN o_orderstatus = 'O' THEN 'Pending' ELSE 'Failed' END END AS status,
  o_orderdate AS timestamp,
  CASE WHEN o_orderkey % 20 <> 8 THEN o_orderpriority END AS merchant_category
FROM orders
"""

CTE["b_loan_applications"] = f"""
SELECT l_orderkey || '-' || l_linenumber AS application_id, o_custkey AS customer_id,
  CAST(l_shipdate AS DATE) AS application_date, l_extendedprice AS requested_amount,
  CASE l_returnflag WHEN 'A' THEN 'Approved' WHEN 'R' THEN 'Declined'
    WHEN 'N' THEN 'Under Review' END AS approval_status,
  CASE WHEN l_returnflag = 'A' THEN {rnd('l_extendedprice * (1 - l_discount)', 2)}
    ELSE 0.0 END AS loan_amount,
  CASE WHEN l_returnflag = 'A' THEN {rnd('l_discount * 50 + 5', 2)} END AS interest_rate,
  CAST(l_linenumber % 5 * 12 + 12 AS INTEGER) AS loan_term_months,
  l_returnflag = 'A' AND l_tax >= 0.08::DOUBLE AS default_flag,
  CASE WHEN l_partkey % 20 <> 3 THEN
    CASE l_linestatus WHEN 'O' THEN 'Home improvement' WHEN 'F' THEN 'Debt consolidation' END
  END AS purpose
FROM lineitem JOIN orders ON l_orderkey = o_orderkey
"""

CTE["b_marketing_touches"] = """
SELECT event_id AS touch_id, user_id * 10 + event_id % 10 AS customer_id, channel, campaign,
  CAST(ts AS DATE) AS touchpoint_date,
  CASE WHEN event_id % 20 <> 9 THEN value END AS cost,
  CASE WHEN event_id % 97 <> 5 THEN event_id % 13 = 0 END AS converted,
  CASE WHEN event_id % 20 <> 1 THEN lower(channel) END AS utm_source,
  CASE WHEN event_id % 20 <> 2 THEN lower(replace(campaign, ' ', '_')) END AS utm_campaign
FROM (
  SELECT *, CASE channel
      WHEN 'Email' THEN (['Welcome Series', 'Re-engagement', 'Promotional'])[event_id % 3 + 1]
      WHEN 'Social' THEN (['Brand Awareness', 'Retargeting', 'Lookalike'])[event_id % 3 + 1]
      WHEN 'Digital' THEN
        (['Search Retargeting', 'Display Prospecting', 'Search Retargeting'])[event_id % 3 + 1]
      WHEN 'Direct Mail' THEN
        (['Seasonal Offer', 'Pre-approved Offer', 'Seasonal Offer'])[event_id % 3 + 1]
    END AS campaign
  FROM (
    SELECT *, CASE event_type WHEN 'click' THEN 'Email' WHEN 'error' THEN 'Email'
      WHEN 'view' THEN 'Social' WHEN 'purchase' THEN 'Digital'
      WHEN 'signup' THEN 'Direct Mail' END AS channel
    FROM events))
"""

CTE["b_product_inventory"] = f"""
SELECT p_partkey AS product_id, 'SKU-' || p_partkey AS sku, p_name AS product_name,
  {title('p_type')} AS category,
  {rnd('p_retailprice * ([0.3::DOUBLE, 0.45::DOUBLE, 0.6::DOUBLE, 0.75::DOUBLE, 0.9::DOUBLE])[p_partkey % 5 + 1]', 2)} AS unit_cost,
  CASE WHEN p_partkey % 20 <> 7 THEN
    CASE WHEN p_partkey % 200 = 199 THEN 0.0 ELSE p_retailprice END END AS selling_price,
  CAST(p_partkey * 7 % 500 AS INTEGER) AS stock_level,
  CAST(p_size + 20 AS INTEGER) AS reorder_point,
  CAST(CASE WHEN p_partkey % 100 = 50 THEN 0 ELSE 1 + p_partkey * 11 % 400 END AS INTEGER)
    AS reorder_quantity,
  CAST(p_size % 27 + 3 AS INTEGER) AS lead_time_days,
  CASE WHEN p_partkey % 20 <> 9 THEN p_brand END AS supplier,
  p_partkey % 10 <> 3 AS is_active
FROM part
"""

CTE["b_events_raw"] = """
SELECT event_id,
  'web-' || user_id || '-' || strftime(ts, '%Y-%m-%d') AS session_id,
  CASE WHEN event_id % 3 <> 0 THEN user_id * 10 END AS customer_id,
  CASE WHEN event_type = 'purchase' THEN 'conversion' ELSE event_type END AS event_type,
  (['/home', '/apply', '/rates', '/help', '/thanks'])[
    CAST(regexp_extract(props, '"k": (\\d+)', 1) AS INTEGER) % 5 + 1] AS page,
  ts AS timestamp,
  CASE WHEN event_id % 20 <> 3
    THEN (['desktop', 'mobile', 'tablet'])[event_id % 3 + 1] END AS device,
  CASE event_type WHEN 'click' THEN 'email' WHEN 'error' THEN 'email' WHEN 'view' THEN 'social'
    WHEN 'purchase' THEN 'digital' WHEN 'signup' THEN 'direct mail' END AS utm_source,
  CASE WHEN event_id % 20 <> 4 THEN 'c' || event_id % 7 END AS utm_campaign,
  event_id % 20 = 0 AS is_bot
FROM events
"""

# Numeric key and upper-cased columns per entity, as in ``testviews``.
DIRT = {
    "customers": ("customer_id", ["gender", "region", "acquisition_channel", "credit_tier"]),
    "transactions": ("transaction_id", ["product_type", "status"]),
    "loan_applications": ("customer_id", ["approval_status", "purpose"]),
    "marketing_touches": ("touch_id", ["channel"]),
    "product_inventory": ("product_id", []),
    "events_raw": ("event_id", ["event_type", "device"]),
}


# What cleaning does to each entity, written out a second time, so that a change of
# the code's recipes shows.
def _expected(key, columns, title="", lower="", dates="", timestamps="", mean="", remap=None, fill=None,
              flags=None, bots=False):
    return SimpleNamespace(
        key=key, columns=columns.split(), title=title.split(), lower=lower.split(), dates=dates.split(),
        timestamps=timestamps.split(), fill_mean=mean.split(), mapping=remap or {}, fill=fill or {},
        flags=flags or [], bots=bots,
    )


EXPECTED = {
    "customers": _expected(
        "customer_id",
        "customer_id first_name last_name email date_of_birth gender region "
        "acquisition_channel signup_date credit_tier credit_score annual_income is_active ",
        title="gender region acquisition_channel credit_tier",
        dates="signup_date date_of_birth",
        mean="annual_income",
        remap={"acquisition_channel": {"Direct": "Direct Mail"}},
        fill={"email": "unknown@unknown.com", "gender": "Unknown"},
        flags=[("annual_income", "is_income_outlier", "0.2")],
    ),
    "transactions": _expected(
        "transaction_id",
        "transaction_id customer_id amount product_type status timestamp merchant_category ",
        title="product_type status merchant_category",
        timestamps="timestamp",
        fill={"status": "Unknown", "merchant_category": "Unknown"},
        flags=[("amount", "is_amount_outlier", "0.2")],
    ),
    "loan_applications": _expected(
        "application_id",
        "application_id customer_id application_date requested_amount approval_status "
        "loan_amount interest_rate loan_term_months default_flag purpose ",
        title="approval_status purpose",
        dates="application_date",
        fill={"purpose": "Unknown"},
        flags=[("requested_amount", "is_requested_amount_outlier", "0.1"), ("loan_amount", "is_loan_amount_outlier", "0.1")],
    ),
    "marketing_touches": _expected(
        "touch_id",
        "touch_id customer_id channel campaign touchpoint_date cost converted utm_source "
        "utm_campaign ",
        title="channel",
        dates="touchpoint_date",
        remap={"channel": {"Digital": "Referral"}},
        fill={"cost": 0.0, "utm_source": "unknown", "utm_campaign": "unknown"},
        flags=[("cost", "is_cost_outlier", "0.2")],
    ),
    "product_inventory": _expected(
        "product_id",
        "product_id sku product_name category unit_cost selling_price stock_level "
        "reorder_point reorder_quantity lead_time_days supplier is_active ",
        mean="selling_price",
        fill={"supplier": "Unknown"},
        flags=[("unit_cost", "is_unit_cost_outlier", "0.1"), ("selling_price", "is_selling_price_outlier", "0.1")],
    ),
    "events_raw": _expected(
        "event_id",
        "event_id session_id customer_id event_type page timestamp device utm_source "
        "utm_campaign is_bot ",
        lower="event_type device",
        timestamps="timestamp",
        fill={"device": "unknown", "utm_campaign": "unknown"},
        bots=True,
    ),
}
STAGED = {
    "customers": ", ".join([*EXPECTED["customers"].columns, "is_income_outlier", "is_duplicate", "data_quality_score"]),
    "transactions": ", ".join([*EXPECTED["transactions"].columns, "is_amount_outlier", "is_duplicate", "data_quality_score"]),
    "loan_applications": ", ".join([*EXPECTED["loan_applications"].columns, "is_requested_amount_outlier", "is_loan_amount_outlier", "is_duplicate", "data_quality_score"]),
    "marketing_touches": ", ".join([*EXPECTED["marketing_touches"].columns, "is_cost_outlier", "is_duplicate", "data_quality_score"]),
    "product_inventory": ", ".join([*EXPECTED["product_inventory"].columns, "is_unit_cost_outlier", "is_selling_price_outlier", "is_duplicate", "data_quality_score"]),
    "events_raw": ", ".join([*EXPECTED["events_raw"].columns, "is_duplicate", "data_quality_score"]),
}


def _as_text(c: str, key: str, time: str) -> str:
    return (
        f"CASE WHEN {key} % 10 = 0 THEN strftime({c}, '%Y/%m/%d{time}')"
        f" WHEN {key} % 10 = 1 THEN strftime({c}, '%m/%d/%Y{time}')"
        f" WHEN {key} % 10 = 2 THEN strftime({c}, '%B %d %Y')"
        f" WHEN {key} % 40 = 33 THEN 'n/a' ELSE strftime({c}, '%Y-%m-%d{time}') END"
    )


def _raw(name: str) -> str:
    key, shouted = DIRT[name]
    changes = {c: f"CASE WHEN {key} % 12 = 0 THEN upper({c}) ELSE {c} END" for c in shouted}
    changes |= {c: _as_text(c, key, "") for c in EXPECTED[name].dates}
    changes |= {c: _as_text(c, key, " %H:%M:%S") for c in EXPECTED[name].timestamps}
    replace = ", ".join(f"{e} AS {c}" for c, e in changes.items())
    star = f"* REPLACE ({replace})" if replace else "*"
    return (
        f"SELECT {star}, unnest(CASE WHEN {key} % 50 = 0"
        " THEN ['2024-01-01', '2024-02-01', '2024-02-01'] ELSE ['2024-02-01'] END) AS load_date"
        f" FROM b_{name}"
    )


def dedup(source: str, keys: list[str], newest: list[str], ties: list[str]) -> str:
    order = [f"{c} DESC NULLS LAST" for c in newest] + [f"{c} ASC NULLS FIRST" for c in ties]
    return (
        f"SELECT * EXCLUDE (_rn) FROM (SELECT *, row_number() OVER (PARTITION BY {', '.join(keys)}"
        f" ORDER BY {', '.join(order)}) AS _rn FROM {source}) WHERE _rn = 1"
    )


def _conform(name: str, text_dates: bool) -> str:
    """SELECT list that normalises casing, dates and constant fills."""
    r = EXPECTED[name]
    out: dict[str, str] = {}
    for c in r.title:
        out[c] = title(c)
    for c in r.lower:
        out[c] = f"lower({c})"
    for c, pairs in r.mapping.items():
        whens = " ".join(f"WHEN '{old}' THEN '{new}'" for old, new in pairs.items())
        out[c] = f"CASE {out.get(c, c)} {whens} ELSE {out.get(c, c)} END"
    if text_dates:
        out |= {c: parse_date(c) for c in r.dates}
        out |= {c: parse_ts(c) for c in r.timestamps}
    for c, value in r.fill.items():
        literal = f"'{value}'" if isinstance(value, str) else f"{value}::DOUBLE"
        out[c] = f"coalesce({out.get(c, c)}, {literal})"
    replace = ", ".join(f"{e} AS {c}" for c, e in out.items())
    return f"* REPLACE ({replace})" if replace else "*"


def _refine(name: str, prefix: str, source: str, text_dates: bool, unique: bool) -> None:
    """Add the CTE chain ``<prefix>_<entity>_1..4`` and ``<prefix>_<entity>``."""
    r = EXPECTED[name]
    base = f"{prefix}_{name}"
    columns = r.columns
    if unique:
        CTE[f"{base}_1"] = f"SELECT * FROM {source}"
    else:
        newest = ["load_date"] if text_dates else []
        CTE[f"{base}_1"] = dedup(source, [r.key], newest, [c for c in columns if c != r.key])
    bots = " WHERE NOT is_bot" if r.bots else ""
    CTE[f"{base}_2"] = f"SELECT {_conform(name, text_dates)} FROM {base}_1{bots}"
    means = ", ".join(
        f"coalesce({c}, {rnd(f'(SELECT avg({c}) FROM {base}_2)', 2)}) AS {c}" for c in r.fill_mean
    )
    star = f"* REPLACE ({means})" if means else "*"
    CTE[f"{base}_3"] = f"SELECT {star} FROM {base}_2"
    flags = "".join(
        f", coalesce({c} > (SELECT avg({c}) + 3 * stddev_samp({c}) FROM {base}_3), false) AS {flag}"
        for c, flag, _ in r.flags
    )
    CTE[f"{base}_4"] = f"SELECT *{flags}, false AS is_duplicate FROM {base}_3"
    score = "1.0" + "".join(
        f" - CASE WHEN {flag} THEN {penalty} ELSE 0.0 END" for _, flag, penalty in r.flags
    )
    CTE[base] = f"SELECT *, CAST({score} AS DOUBLE) AS data_quality_score FROM {base}_4"


for _name in EXPECTED:
    CTE[f"raw_{_name}"] = _raw(_name)
    _refine(_name, "silver", f"raw_{_name}", text_dates=True, unique=False)
    _refine(
        _name, "c", f"b_{_name}", text_dates=False, unique=_name != "loan_applications"
    )


def with_ctes(body: str) -> str:
    """Prefix ``body`` with the CTEs it needs, each after the ones it reads itself."""
    ordered: list[str] = []

    def visit(text: str) -> None:
        for name in sorted(CTE.keys() & set(re.findall(r"[a-z_0-9]+", text))):
            if name not in ordered:
                visit(CTE[name])
                ordered.append(name)

    visit(body)
    parts = [f"{name} AS ({CTE[name].strip()})" for name in ordered]
    return (f"WITH {', '.join(parts)} " if parts else "") + body.strip()
