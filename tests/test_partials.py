"""Marts merged from states of loads against the marts over all rows."""

import random

import pytest
from pyspark.sql import functions as F

from sparkmart.operators import marts, roi
from sparkmart.plans import partials

DATES = ["2024-01-01", "2024-01-02", "2024-01-03"]
SPEND = "touch_id string, customer_id string, channel string, campaign string, utm_source string, utm_campaign string, credit_tier string, region string, touch_cost double, is_converted int, converted_spend double, unconverted_spend double, load string"
LOANS = "application_id string, credit_tier string, approval_status string, purpose string, loan_term_months int, is_approved int, is_declined int, is_default int, requested_amount double, loan_amount double, interest_rate double, annual_interest_amount double, amount_gap double, credit_score int, days_since_signup_at_application int, load string"


def rows(ddl, seed, n=240):
    draw = random.Random(seed)
    out = []
    for i in range(n):
        row = []
        for column in ddl.split(", "):
            name, kind = column.split(" ")
            if name == "load":
                value = draw.choice(DATES)
            elif draw.random() < 0.1:
                value = None
            elif kind == "double":
                value = draw.choice([0.004, 1.25, 99.995, 1e6])
            elif kind == "int":
                value = draw.randint(0, 1) if name.startswith("is_") else draw.randint(0, 30)
            else:
                value = f"{name}{draw.randint(0, 60 if name.endswith('_id') else 2)}"
            row.append(value)
        out.append(tuple(row))
    return out


def as_set(df):
    return sorted(map(str, df.select(sorted(df.columns)).collect()))


@pytest.mark.parametrize("mart,direct,ddl", [
    (partials.CHANNEL_PERFORMANCE, marts.channel_performance, SPEND), (partials.CREDIT_RISK, marts.credit_risk, LOANS), (partials.CHANNEL_CAC, roi.channel_cac, SPEND),
])
def test_merged_states_equal_the_mart(spark, tmp_path, mart, direct, ddl):
    fact = spark.createDataFrame(rows(ddl, 3), ddl)
    states = partials.States(spark, f"file://{tmp_path}", mart, "load")
    assert states.loads() == []
    states.refresh(fact, DATES)
    out = states.merged(fact)
    assert states.loads() == DATES and as_set(out) == as_set(direct(fact.drop("load")))
    assert [f.dataType for f in out.schema] == [direct(fact).schema[c].dataType for c in out.columns]
    # The second load comes again with other rows, and the third one empty; the first is not touched.
    other = fact.where(F.col("load") == DATES[0]).unionByName(spark.createDataFrame(rows(ddl, 4, 90), ddl).withColumn("load", F.lit(DATES[1])))
    before = {f for f in spark.read.parquet(f"file://{tmp_path}/groups/load={DATES[0]}").inputFiles()}
    states.refresh(other, DATES[1:])
    assert as_set(states.merged(other)) == as_set(direct(other.drop("load")))
    assert before == set(spark.read.parquet(f"file://{tmp_path}/groups/load={DATES[0]}").inputFiles())


def test_distinct_sketches_stay_within_their_error(spark, tmp_path):
    touches = spark.range(60_000).select(
        F.concat(F.lit("t"), "id").alias("touch_id"), F.concat(F.lit("c"), F.col("id") % 20_000).alias("customer_id"),
        F.when(F.col("id") % 3 == 0, "Email").otherwise("Social").alias("channel"), F.lit(1.0).alias("touch_cost"), F.lit(0).alias("is_converted"),
        F.element_at(F.array(*map(F.lit, DATES)), (F.col("id") % 7 % 3 + 1).cast("int")).alias("load"),
    )
    states = partials.States(spark, f"file://{tmp_path}", partials.CHANNEL_CAC, "load", sketch=True)
    states.refresh(touches, DATES)
    exact = {r.channel: r.total_customers_touched for r in roi.channel_cac(touches).collect()}
    for r in states.merged(touches).collect():
        assert abs(r.total_customers_touched / exact[r.channel] - 1) < 4 * 1.04 / (2**partials.SKETCH_BITS) ** 0.5


@pytest.mark.parametrize("mart,ddl,passes", [(partials.CREDIT_RISK, LOANS, 1), (partials.CHANNEL_CAC, SPEND, 2)])
def test_several_loads_are_aggregated_in_one_pass(spark, tmp_path, mart, ddl, passes):
    seen = spark.sparkContext.accumulator(0)

    def see(row):
        seen.add(1)
        return row

    data = rows(ddl, 5)
    states = partials.States(spark, f"file://{tmp_path}", mart, "load")
    states.refresh(spark.createDataFrame(spark.sparkContext.parallelize(data, 3).map(see), ddl), DATES)
    assert states.loads() == DATES and seen.value == passes * len(data)
    states.refresh(spark.createDataFrame(data, ddl), [])
    assert states.loads() == DATES
