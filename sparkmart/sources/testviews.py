"""The six entities as projections of the TPC-H-like test tables.

``raw(spark, sf_dir)`` adds dirt (text dates in mixed formats, upper-cased values, repeated loads)
for the cleaning operators. ``clean(spark, sf_dir)`` gives typed, flagged and scored entities, as
the gold operators would read them from silver tables. Loan applications come from line items,
which repeat (order, line number), so they are always deduplicated.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkmart.functions import expr
from sparkmart.plans import silver

# Fixed values of the projections.
CHANNELS = {
    "click": "Email", "error": "Email", "view": "Social", "purchase": "Digital",
    "signup": "Direct Mail",
}
CAMPAIGNS = {
    "Email": ["Welcome Series", "Re-engagement", "Promotional"],
    "Social": ["Brand Awareness", "Retargeting", "Lookalike"],
    "Digital": ["Search Retargeting", "Display Prospecting", "Search Retargeting"],
    "Direct Mail": ["Seasonal Offer", "Pre-approved Offer", "Seasonal Offer"],
}
SEGMENTS = {
    "AUTOMOBILE": "Email", "BUILDING": "Social", "FURNITURE": "Direct", "HOUSEHOLD": "Referral",
    "MACHINERY": "Email",
}
GENDERS = ["Male", "Female", "Non-binary"]
PRODUCT_TYPES = ["ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD"]
PAGES = ["/home", "/apply", "/rates", "/help", "/thanks"]
DEVICES = ["desktop", "mobile", "tablet"]
UNIT_COST_SHARE = [0.3, 0.45, 0.6, 0.75, 0.9]
LOAD_DATE, EARLIER_LOAD = "2024-02-01", "2024-01-01"
AS_OF = "2024-02-01"


# Layout of the tables in use. Given to the reader, it saves the job that infers it.
TABLES = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": (
        "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string"
    ),
    "part": (
        "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int,"
        " p_retailprice double"
    ),
    "orders": (
        "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double,"
        " o_orderdate timestamp_ntz, o_orderpriority string"
    ),
    "lineitem": (
        "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int,"
        " l_quantity double, l_extendedprice double, l_discount double, l_tax double,"
        " l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz"
    ),
    "events": (
        "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double,"
        " props string"
    ),
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(TABLES[name]).parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _pick(items: list, index: Column) -> Column:
    return F.element_at(F.array(*[F.lit(i) for i in items]), (index + 1).cast("int"))


def _lookup(c: Column, mapping: dict) -> Column:
    return expr.cases([(c == old, new) for old, new in mapping.items()])


def _blank(value: Column, cond: Column) -> Column:
    return F.when(~cond, value)


def customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    c, n = table(spark, sf_dir, "customer"), table(spark, sf_dir, "nation")
    r = table(spark, sf_dir, "region")
    key = F.col("c_custkey")
    slot = key % 20
    days = (key * 13 % 1500).cast("int")
    return (
        c.join(n, c.c_nationkey == n.n_nationkey)
        .join(r, n.n_regionkey == r.r_regionkey)
        .select(
            key.alias("customer_id"),
            F.substring_index("c_name", "#", 1).alias("first_name"),
            F.substring_index("c_name", "#", -1).alias("last_name"),
            _blank(F.concat(F.lit("c"), key, F.lit("@example.com")), slot == 7).alias("email"),
            F.date_add(F.lit("1950-01-01").cast("date"), (key * 31 % 15000).cast("int")).alias(
                "date_of_birth"
            ),
            _blank(_pick(GENDERS, key % 3), slot == 3).alias("gender"),
            expr.title("r_name").alias("region"),
            _lookup(F.col("c_mktsegment"), SEGMENTS).alias("acquisition_channel"),
            F.date_add(F.lit("1995-01-01").cast("date"), days).alias("signup_date"),
            expr.cases([(slot < 12, "Prime"), (slot < 17, "Near-Prime")], "Subprime").alias(
                "credit_tier"
            ),
            (F.lit(300) + key * 37 % 550).cast("int").alias("credit_score"),
            _blank(expr.rnd(F.col("c_acctbal") * 10, 2), slot == 11).alias("annual_income"),
            (slot != 5).alias("is_active"),
        )
    )


def transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("o_orderkey")
    status = expr.cases(
        [
            (key % 25 == 0, "Refunded"),
            (F.col("o_orderstatus") == "F", "Completed"),
            (F.col("o_orderstatus") == "O", "Pending"),
        ],
        "Failed",
    )
    spike = F.when(key % 101 == 0, F.lit(20)).otherwise(F.lit(1))
    return table(spark, sf_dir, "orders").select(
        key.alias("transaction_id"),
        F.col("o_custkey").alias("customer_id"),
        expr.rnd(F.col("o_totalprice") * spike, 2).alias("amount"),
        _pick(PRODUCT_TYPES, key % 6).alias("product_type"),
        _blank(status, key % 20 == 7).alias("status"),
        F.col("o_orderdate").cast("timestamp_ntz").alias("timestamp"),
        _blank(F.col("o_orderpriority"), key % 20 == 8).alias("merchant_category"),
    )


def loan_applications(spark: SparkSession, sf_dir: str) -> DataFrame:
    line = table(spark, sf_dir, "lineitem")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    approved = F.col("l_returnflag") == "A"
    amount = expr.rnd(F.col("l_extendedprice") * (1 - F.col("l_discount")), 2)
    purpose = _lookup(F.col("l_linestatus"), {"O": "Home improvement", "F": "Debt consolidation"})
    return line.join(orders, line.l_orderkey == orders.o_orderkey).select(
        F.concat_ws("-", "l_orderkey", "l_linenumber").alias("application_id"),
        F.col("o_custkey").alias("customer_id"),
        F.to_date("l_shipdate").alias("application_date"),
        F.col("l_extendedprice").alias("requested_amount"),
        _lookup(
            F.col("l_returnflag"), {"A": "Approved", "R": "Declined", "N": "Under Review"}
        ).alias("approval_status"),
        F.when(approved, amount).otherwise(F.lit(0.0)).alias("loan_amount"),
        F.when(approved, expr.rnd(F.col("l_discount") * 50 + 5, 2)).alias("interest_rate"),
        (F.col("l_linenumber") % 5 * 12 + 12).cast("int").alias("loan_term_months"),
        (approved & (F.col("l_tax") >= 0.08)).alias("default_flag"),
        _blank(purpose, F.col("l_partkey") % 20 == 3).alias("purpose"),
    )


def marketing_touches(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("event_id")
    channel = _lookup(F.col("event_type"), CHANNELS)
    campaign = F.coalesce(
        *[F.when(channel == c, _pick(names, key % 3)) for c, names in CAMPAIGNS.items()]
    )
    slug = F.lower(F.replace(campaign, F.lit(" "), F.lit("_")))
    return table(spark, sf_dir, "events").select(
        key.alias("touch_id"),
        (F.col("user_id") * 10 + key % 10).alias("customer_id"),
        channel.alias("channel"),
        campaign.alias("campaign"),
        F.to_date("ts").alias("touchpoint_date"),
        _blank(F.col("value"), key % 20 == 9).alias("cost"),
        _blank(key % 13 == 0, key % 97 == 5).alias("converted"),
        _blank(F.lower(channel), key % 20 == 1).alias("utm_source"),
        _blank(slug, key % 20 == 2).alias("utm_campaign"),
    )


def product_inventory(spark: SparkSession, sf_dir: str) -> DataFrame:
    key, price = F.col("p_partkey"), F.col("p_retailprice")
    selling = F.when(key % 200 == 199, F.lit(0.0)).otherwise(price)
    reorder = F.when(key % 100 == 50, F.lit(0)).otherwise(F.lit(1) + key * 11 % 400)
    return table(spark, sf_dir, "part").select(
        key.alias("product_id"),
        F.concat(F.lit("SKU-"), key).alias("sku"),
        F.col("p_name").alias("product_name"),
        expr.title("p_type").alias("category"),
        expr.rnd(price * _pick(UNIT_COST_SHARE, key % 5), 2).alias("unit_cost"),
        _blank(selling, key % 20 == 7).alias("selling_price"),
        (key * 7 % 500).cast("int").alias("stock_level"),
        (F.col("p_size") + 20).cast("int").alias("reorder_point"),
        reorder.cast("int").alias("reorder_quantity"),
        (F.col("p_size") % 27 + 3).cast("int").alias("lead_time_days"),
        _blank(F.col("p_brand"), key % 20 == 9).alias("supplier"),
        (key % 10 != 3).alias("is_active"),
    )


def events_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("event_id")
    k = F.regexp_extract("props", r'"k": (\d+)', 1).cast("int")
    kind = F.when(F.col("event_type") == "purchase", F.lit("conversion")).otherwise(
        F.col("event_type")
    )
    return table(spark, sf_dir, "events").select(
        key.alias("event_id"),
        F.concat_ws("-", F.lit("web"), "user_id", F.to_date("ts").cast("string")).alias(
            "session_id"
        ),
        _blank(F.col("user_id") * 10, key % 3 == 0).alias("customer_id"),
        kind.alias("event_type"),
        _pick(PAGES, k % 5).alias("page"),
        F.col("ts").cast("timestamp_ntz").alias("timestamp"),
        _blank(_pick(DEVICES, key % 3), key % 20 == 3).alias("device"),
        F.lower(_lookup(F.col("event_type"), CHANNELS)).alias("utm_source"),
        _blank(F.concat(F.lit("c"), (key % 7).cast("string")), key % 20 == 4).alias("utm_campaign"),
        (key % 20 == 0).alias("is_bot"),
    )


ENTITIES = {
    "customers": customers,
    "transactions": transactions,
    "loan_applications": loan_applications,
    "marketing_touches": marketing_touches,
    "product_inventory": product_inventory,
    "events_raw": events_raw,
}

# Columns that ``raw`` upper-cases on part of the rows.
_SHOUTED = {
    "customers": ["gender", "region", "acquisition_channel", "credit_tier"],
    "transactions": ["product_type", "status"],
    "loan_applications": ["approval_status", "purpose"],
    "marketing_touches": ["channel"],
    "product_inventory": [],
    "events_raw": ["event_type", "device"],
}
# The numeric key that decides where dirt goes.
_DIRT_KEY = {
    "customers": "customer_id",
    "transactions": "transaction_id",
    "loan_applications": "customer_id",
    "marketing_touches": "touch_id",
    "product_inventory": "product_id",
    "events_raw": "event_id",
}


def _as_text(value: Column, key: Column, time: str = "") -> Column:
    """A date or timestamp in one of the raw spellings, or unreadable."""
    slot = key % 10
    return (
        F.when(slot == 0, F.date_format(value, "yyyy/MM/dd" + time))
        .when(slot == 1, F.date_format(value, "MM/dd/yyyy" + time))
        .when(slot == 2, F.date_format(value, "MMMM dd yyyy"))
        .when(key % 40 == 33, F.lit("n/a"))
        .otherwise(F.date_format(value, "yyyy-MM-dd" + time))
    )


def raw_entity(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    df, recipe = ENTITIES[name](spark, sf_dir), silver.RECIPES[name]
    key = F.col(_DIRT_KEY[name])
    loads = F.when(
        key % 50 == 0, F.array(F.lit(EARLIER_LOAD), F.lit(LOAD_DATE), F.lit(LOAD_DATE))
    ).otherwise(F.array(F.lit(LOAD_DATE)))
    shouted = {c: F.when(key % 12 == 0, F.upper(c)).otherwise(F.col(c)) for c in _SHOUTED[name]}
    text = {c: _as_text(F.col(c), key) for c in recipe.dates}
    text |= {c: _as_text(F.col(c), key, " HH:mm:ss") for c in recipe.timestamps}
    return df.withColumns(shouted | text).withColumn("load_date", F.explode(loads))


def clean_entity(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    unique = name != "loan_applications"
    return silver.entity(name, ENTITIES[name](spark, sf_dir), deduplicated=unique)
