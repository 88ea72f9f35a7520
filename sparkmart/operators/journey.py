"""Touchpoints before sessions, and the one-row-per-customer journey."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sparkmart.functions import expr
from sparkmart.operators import skew
from sparkmart.sources import io

# The customer columns of the journey table.
CUSTOMER_COLUMNS = [
    "customer_id", "first_name", "last_name", "email", "gender", "region",
    "acquisition_channel", "signup_date", "credit_tier", "credit_score", "annual_income",
    "is_active",
]


def enrich(touches: DataFrame, customers: DataFrame) -> DataFrame:
    """Add customer attributes. AQE splits a hot customer on the touch side of this join."""
    attributes = customers.select("customer_id", "credit_tier", "region", "acquisition_channel")
    return touches.join(attributes, "customer_id", "left")


def _day_bucket(day: Column, width: int) -> Column:
    return F.floor(F.unix_date(day) / width)


def interval_join(
    touches: DataFrame,
    sessions: DataFrame,
    lookback_days: int = 30,
    spread: str = "touch_id",
    hot: DataFrame | None = None,
    bounded: bool = False,
    share: float = skew.HOT_SHARE,
    salts: int = skew.SALTS,
) -> DataFrame:
    """Pairs where the touch is 0 to ``lookback_days`` days before the session of its customer.

    Days are cut into buckets of the lookback width: a session has one bucket, a touch reaches two,
    so customer and bucket form an equi-key that yields each pair once. A customer has at most one
    session per timeout, which bounds the session rows per key; the touches of ``hot`` customers
    (found by counting, unless given) are salted on top; ``bounded`` says that a given list comes
    from ``skew.hot_keys``. Below that share AQE splits the touch side of the join.
    """
    if hot is None:
        hot, bounded = skew.hot_keys(touches, "customer_id", share), True
    width = max(1, lookback_days)
    day = F.col("touchpoint_date")
    reach = F.array_distinct(
        F.array(_day_bucket(day, width), _day_bucket(F.date_add(day, lookback_days), width))
    )
    session_day = F.to_date("session_start")
    left = touches.where(day.isNotNull()).withColumn("_bucket", F.explode(reach))
    right = sessions.withColumn("_bucket", _day_bucket(session_day, width))
    ahead = F.datediff(session_day, day)
    return (
        skew.salted_join(
            left, right, ["customer_id", "_bucket"], "customer_id", F.col(spread), hot,
            salts=salts, bounded=bounded,
        )
        .where(ahead.between(0, lookback_days))
        .withColumn("days_before_session", ahead)
        .drop("_bucket")
    )


def asof_touches(
    sessions: DataFrame, touches: DataFrame, columns: Sequence[str], lookback_days: int = 30, tie: str = "touch_id"
) -> DataFrame:
    """Every session with the last touch of its customer at or before its day, at most ``lookback_days``
    days ago: ``columns`` of that touch (NULL: none) and ``days_before_session``.

    No pairs are formed. Touches are reduced to the last one of each customer and day (ties in day: the
    greatest ``tie``). Days are cut into buckets of the lookback width, so that a session's touch lies in
    its own bucket or the one before; the last touch of each bucket opens the next one. Both sides then
    run through one window in order of (customer, bucket, day), which carries the last touch forward. A
    window holds a bucket's days and sessions of one customer, however many touches there are. Sessions
    without a customer or a time have no touch; touches without a day take no part.
    """
    width = lookback_days + 1
    day = F.unix_date("touchpoint_date")
    carried = F.struct(day.alias("_day"), F.col(tie).alias("_tie"), *(F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(columns)))
    known = touches.where(F.col("touchpoint_date").isNotNull() & F.col("customer_id").isNotNull())
    daily = known.groupBy(F.col("customer_id").alias("_who"), day.alias("_day")).agg(F.max(carried).alias("_touch"))
    daily = daily.withColumn("_bucket", F.floor(F.col("_day") / width))
    # A bucket's last touch, as the first row of the next bucket.
    opening = daily.groupBy("_who", "_bucket").agg(F.max("_touch").alias("_touch"))
    opening = opening.select("_who", (F.col("_bucket") + 1).alias("_bucket"), F.col("_touch._day").alias("_day"), "_touch")
    rows = daily.select("_who", "_bucket", "_day", "_touch").unionByName(opening)
    session_day = F.unix_date(F.to_date("session_start"))
    # Sessions that can have no touch are spread over the buckets of nobody.
    spread = F.pmod(F.xxhash64(*sessions.columns), F.lit(1 << 20))
    open_ = F.col("customer_id").isNotNull() & session_day.isNotNull()
    visits = sessions.select(
        F.col("customer_id").alias("_who"), F.when(open_, F.floor(session_day / width)).otherwise(spread).alias("_bucket"), session_day.alias("_day"),
        F.struct(*(F.col(f"`{c}`") for c in sessions.columns)).alias("_session"),
    )
    both = rows.withColumn("_session", F.lit(None).cast(visits.schema["_session"].dataType)).unionByName(
        visits.withColumn("_touch", F.lit(None).cast(rows.schema["_touch"].dataType))
    )
    # Of one day, touches come before sessions.
    order = Window.partitionBy("_who", "_bucket").orderBy("_day", F.col("_session").isNotNull())
    last = F.last("_touch", ignorenulls=True).over(order.rowsBetween(Window.unboundedPreceding, 0))
    found = both.withColumn("_last", last).where(F.col("_session").isNotNull())
    ahead = F.col("_day") - F.col("_last._day")
    found = found.withColumn("_last", F.when(F.col("_who").isNotNull() & (ahead <= lookback_days), F.col("_last")))
    return found.select(
        "_session.*",
        *(F.col(f"_last.c{i}").alias(c) for i, c in enumerate(columns)),
        (F.col("_day") - F.col("_last._day")).alias("days_before_session"),
    )


def touchpoints(
    touches: DataFrame,
    customers: DataFrame,
    sessions: DataFrame,
    lookback_days: int = 30,
    share: float = skew.HOT_SHARE,
    salts: int = skew.SALTS,
    load_date: str | None = None,
) -> DataFrame:
    """Touches with customer attributes, paired with the sessions that follow them."""
    visits = sessions.select(
        "true_session_id",
        "customer_id",
        "session_start",
        "session_end",
        F.col("converted").alias("session_converted"),
        "entry_page",
        "exit_page",
    )
    hot = skew.hot_keys(touches, "customer_id", share)
    enriched = enrich(touches, customers)
    pairs = interval_join(enriched, visits, lookback_days, hot=hot, salts=salts, bounded=True)
    return io.stamp_silver(pairs, load_date)


def _spending(txns: DataFrame) -> DataFrame:
    """Completed, non-outlier transactions per customer, combined per product first."""
    clean = txns.where((F.col("status") == "Completed") & ~F.col("is_amount_outlier"))
    per_product = clean.groupBy("customer_id", "product_type").agg(
        F.count("transaction_id").alias("_txns"),
        F.count("amount").alias("_amounts"),
        expr.money_total("amount").alias("_spend"),
    )
    # Ties for the most used product go to the smaller name.
    favourite = F.min(F.struct((-F.col("_txns")).alias("n"), F.col("product_type").alias("name")))
    spend = F.sum("_spend").cast("double")
    return per_product.groupBy("customer_id").agg(
        F.sum("_txns").alias("total_transactions"),
        expr.rnd(spend, 2).alias("total_spend"),
        expr.ratio(spend, F.sum("_amounts"), digits=2).alias("avg_transaction_amount"),
        favourite.getField("name").alias("most_used_product"),
    )


def _marketing(touches: DataFrame) -> DataFrame:
    return (
        touches.where(~F.col("is_cost_outlier"))
        .groupBy("customer_id")
        .agg(
            F.count("touch_id").alias("total_touches"),
            expr.money_sum("cost").alias("total_marketing_cost"),
            expr.money_avg("cost").alias("avg_touch_cost"),
            expr.rnd(F.avg(F.col("converted").cast("double")), 4).alias("touch_conversion_rate"),
        )
    )


def customer_360(
    customers: DataFrame, txns: DataFrame, touches: DataFrame, load_date: str | None = None
) -> DataFrame:
    """Every customer with spending and marketing totals; NULLs when there is no activity."""
    out = (
        customers.select(*CUSTOMER_COLUMNS)
        .join(_spending(txns), "customer_id", "left")
        .join(_marketing(touches), "customer_id", "left")
    )
    return io.stamp_silver(out, load_date)
