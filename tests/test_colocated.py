"""Bucketed facts and customers: same rows, no shuffle of the fact, hot customers in slices."""

import datetime as dt

import pytest
from conftest import final_plan
from pyspark.sql import functions as F

from sparkmart.operators import facts, marts
from sparkmart.plans import colocated

NAMES = ("near.fct_transactions", "near.customers_of_transactions")


@pytest.fixture(scope="module")
def frames(spark):
    """A third of all rows belong to one customer, some to none, some to an unknown one."""
    who = F.when(F.col("id") % 3 == 0, F.lit("hot")).when(F.col("id") % 41 == 0, F.lit(None)).otherwise(F.concat(F.lit("c"), F.col("id") % 50))
    txns = spark.range(6000).select(
        F.col("id").alias("transaction_id"), who.alias("customer_id"),
        F.date_add(F.lit(dt.date(2024, 1, 1)), (F.col("id") % 200).cast("int")).alias("transaction_date"),
        F.when(F.col("id") % 5 == 0, "Failed").otherwise("Completed").alias("status"), (F.col("id") % 97 / 4).alias("transaction_amount"),
    )
    customers = spark.range(45).select(
        F.when(F.col("id") == 0, "hot").otherwise(F.concat(F.lit("c"), F.col("id"))).alias("customer_id"),
        F.date_add(F.lit(dt.date(2023, 11, 1)), (F.col("id") * 3).cast("int")).alias("signup_date"),
        F.lit("Prime").alias("credit_tier"), F.when(F.col("id") % 2 == 0, "West").alias("region"), F.lit("Email").alias("acquisition_channel"),
    )
    spark.sql("CREATE DATABASE IF NOT EXISTS near")
    counts = colocated.write_pair(txns, customers, "transaction_id", NAMES, buckets=8, share=0.1, slices=16)
    assert counts == (6000, 45 + 15)
    return txns, customers


def rows_of(df):
    return sorted(map(str, df.select(sorted(df.columns)).collect()))


def below_joins(plan):
    """Lines of the plan that lie below a join, by their depth."""
    depth = lambda line: len(line) - len(line.lstrip(" :+-*"))
    out, within = [], None
    for line in plan.splitlines():
        if within is not None and depth(line) <= within:
            within = None
        if within is not None:
            out.append(line)
        elif "SortMergeJoin" in line:
            within = depth(line)
    return out


def test_fact_with_customer_needs_no_shuffle(spark, frames):
    txns, customers = frames
    joined = colocated.with_customer(spark, NAMES, ["signup_date", "region"])
    assert rows_of(joined) == rows_of(facts.with_customer(txns, customers, ["signup_date", "region"]))
    plan = final_plan(joined)
    assert "SortMergeJoin" in plan and "Exchange" not in plan


def test_cohorts_need_no_shuffle_below_the_join(spark, frames):
    txns, customers = frames
    out = colocated.cohort(spark, NAMES)
    assert rows_of(out) == rows_of(marts.cohort(customers, txns))
    plan = final_plan(out)
    below = below_joins(plan)
    assert sum("Scan parquet" in line for line in below) == 4 and not [line for line in below if "Exchange" in line], plan


def test_a_hot_customer_is_spread_over_the_buckets(spark, frames):
    files = spark.read.table(NAMES[0]).groupBy(F.col("_metadata.file_name")).agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("customer_id") == "hot").alias("hot"))
    rows = files.collect()
    assert len(rows) == 8 and max(r.hot for r in rows) < 2000 / 2 and max(r.n for r in rows) < 6000 / 3
