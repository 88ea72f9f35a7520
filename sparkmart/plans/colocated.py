"""Facts and customers in tables with the same buckets, so that they meet without a shuffle.

Both are dealt into buckets by (customer, slice). Almost all customers have slice 0. A customer with
more than a share of the rows is hot: its fact rows get a slice by a hash of their own id, and its
customer row is written once for each slice. So no bucket, and no task, holds more of a hot customer
than a slice of it; the list of hot customers has at most 1 / share rows (``skew.hot_keys``), which
bounds the copies and is why it may be broadcast. Every fact row still meets its customer exactly once.

Each fact has its own hot customers, so a fact and the customers dealt for it are written as a pair.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkmart.functions import expr
from sparkmart.operators import skew
from sparkmart.sources import io

KEY, SLICE = "customer_id", "_slice"


def sliced(
    fact: DataFrame, customers: DataFrame, row_id: str, share: float = skew.HOT_SHARE, slices: int = skew.SALTS
) -> tuple[DataFrame, DataFrame]:
    """Both sides with their slices. ``fact`` should be a written table: it is read twice."""
    hot = skew.hot_keys(fact, KEY, share).withColumn("_hot", F.lit(True))
    of_row = F.when(F.col("_hot"), F.pmod(F.xxhash64(row_id), F.lit(slices)) + 1).otherwise(F.lit(0)).cast("int")
    rows = fact.join(F.broadcast(hot), KEY, "left").withColumn(SLICE, of_row).drop("_hot")
    copies = F.when(F.col("_hot"), F.sequence(F.lit(1), F.lit(slices))).otherwise(F.array(F.lit(0)))
    spread = customers.join(F.broadcast(hot), KEY, "left").withColumn(SLICE, F.explode(copies)).drop("_hot")
    return rows, spread


def write_pair(
    fact: DataFrame,
    customers: DataFrame,
    row_id: str,
    names: tuple[str, str],
    buckets: int,
    partition_by: Sequence[str] = (),
    share: float = skew.HOT_SHARE,
    slices: int = skew.SALTS,
) -> tuple[int, int]:
    """Write a fact and its customers as bucketed tables; rows of each. Choose ``buckets`` so that one of
    them fits a task; rows without a customer go to slices of their own, as if hot."""
    rows, spread = sliced(fact, customers, row_id, share, slices)
    lost = F.pmod(F.xxhash64(row_id), F.lit(slices)).cast("int")
    rows = rows.withColumn(SLICE, F.when(F.col(KEY).isNull(), lost).otherwise(F.col(SLICE)))
    by = (buckets, [KEY, SLICE])
    return io.write_table(rows, names[0], partition_by=partition_by, bucket_by=by), io.write_table(spread, names[1], bucket_by=by)


def with_customer(spark: SparkSession, names: tuple[str, str], columns: Sequence[str]) -> DataFrame:
    """The fact with columns of its customers: a left join of two bucketed tables, without a shuffle."""
    fact, customers = (spark.read.table(name) for name in names)
    # A broadcast would also do without a shuffle of the fact, but only for few customers.
    out = fact.join(customers.select(KEY, SLICE, *columns).hint("merge"), [KEY, SLICE], "left")
    return out.select(*(c for c in fact.columns if c != SLICE), *columns)


def cohort(spark: SparkSession, names: tuple[str, str]) -> DataFrame:
    """Completed activity per signup cohort and month since signup, as ``marts.cohort`` gives it.

    A fact's rows are reduced to one for each customer, slice and month where they lie, and meet their
    customers there. Only what is left of hot customers is put together before cohorts are counted, in
    partial sums that have as many rows as slices.
    """
    fact, customers = (spark.read.table(name) for name in names)
    month = F.trunc("transaction_date", "month")
    activity = fact.where((F.col("status") == "Completed") & F.col(KEY).isNotNull()).groupBy(KEY, SLICE, month.alias("_month"))
    activity = activity.agg(F.count("transaction_id").alias("_txns"), expr.money_total("transaction_amount").alias("_spend"))
    known = ("signup_date", "credit_tier", "region", "acquisition_channel")
    met = customers.select(KEY, SLICE, *known).hint("merge").join(activity, [KEY, SLICE])
    by = [KEY, "_month", *known]
    sums = [F.sum("_txns").alias("_txns"), F.sum("_spend").alias("_spend")]
    cold = met.where(F.col(SLICE) == 0).select(*by, "_txns", "_spend")
    hot = met.where(F.col(SLICE) > 0).groupBy(*by).agg(*sums)
    number = lambda day: F.year(day) * 12 + F.month(day)
    rows = cold.unionByName(hot).withColumns(
        {"cohort_month": F.date_format("signup_date", "yyyy-MM"), "months_since_signup": number("_month") - number("signup_date")}
    )
    spend = F.sum("_spend")
    return (
        rows.where(F.col("months_since_signup") >= 0)
        .groupBy("cohort_month", *known[1:], "months_since_signup")
        .agg(
            F.count(KEY).alias("active_customers"),
            F.sum("_txns").alias("total_transactions"),
            F.round(spend, 2).cast("double").alias("total_spend"),
            expr.ratio(spend, F.count("_spend"), digits=2).alias("avg_spend_per_customer"),
        )
    )
