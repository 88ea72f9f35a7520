"""Plan shapes that keep the operators scalable."""

import datetime

from conftest import final_plan
from pyspark.sql import Window
from pyspark.sql import functions as F

from sparkmart.operators import attribution, clean, facts, forecast, marts, sessions, skew, supply
from sparkmart.sources import testviews as tv

SF = "/root/testdata/sf0.001"


def _initial(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_dedup_limits_before_the_shuffle(spark):
    plan = _initial(clean.dedup(tv.table(spark, SF, "lineitem"), ["l_orderkey", "l_linenumber"]))
    before, after = plan.split("Exchange hashpartitioning", 1)
    assert "WindowGroupLimit" in before and "WindowGroupLimit" in after


def test_pruned_and_pushed_scan(spark):
    df = tv.table(spark, SF, "orders").where("o_orderstatus = 'F'").select("o_totalprice")
    plan = _initial(df)
    assert "PushedFilters: [IsNotNull(o_orderstatus), EqualTo(o_orderstatus,F)]" in plan
    assert "ReadSchema: struct<o_orderstatus:string,o_totalprice:double>" in plan


def test_comparison_needs_no_join_and_one_touch_shuffle(spark):
    touches = facts.clean_touches(tv.clean_entity(spark, SF, "marketing_touches"))
    plan = _initial(attribution.compare(touches))
    assert "Join" not in plan
    # cells, customer windows, channel totals, model totals
    assert plan.count("Exchange hashpartitioning") == 4


def test_sessions_shuffle_the_events_once(spark):
    events = tv.clean_entity(spark, SF, "events_raw")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        plan = final_plan(sessions.assign(events))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    wide = [line for line in plan.splitlines() if "FileScan" in line and "props" in line]
    assert plan.count("FileScan") == 2 and len(wide) == 1
    # seconds, buckets, visitors; the two sides of the join
    assert plan.count("- Exchange hashpartitioning") == 5


def test_forecast_is_one_pass(spark):
    counts = forecast.daily_counts(tv.table(spark, SF, "orders"), "o_orderdate", "o_orderstatus")
    plan = _initial(forecast.fit_predict(counts))
    assert plan.count("FileScan") == 1 and plan.count("Exchange hashpartitioning") == 2


def test_sku_variance_joins_nothing(spark):
    health = supply.inventory_health(tv.clean_entity(spark, SF, "product_inventory"), "2001-07-01")
    fc = spark.createDataFrame([], "forecast_date date, predicted_applications double")
    assert "Join" not in _initial(supply.sku_variance(supply.stockout_warning(health), fc, "2001-07-01"))


def test_adaptive_execution_splits_a_hot_customer(spark):
    conf = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20000",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10000",
    }
    touches = spark.range(0, 60000, 1, 8).select(
        F.col("id").alias("touch_id"),
        F.when(F.col("id") % 3 == 0, F.lit(1)).otherwise(F.col("id")).alias("customer_id"),
    )
    customers = spark.range(60000).select(F.col("id").alias("customer_id"), F.lit("West").alias("region"))
    for key, value in conf.items():
        spark.conf.set(key, value)
    try:
        df = facts.with_customer(touches, customers, ["region"])
        plan = final_plan(df)
        assert "skew=true" in plan or "isSkew" in plan or "SortMergeJoin(skew" in plan, plan[:2000]
        assert df.where("region = 'West'").count() == 60000
    finally:
        for key in conf:
            spark.conf.unset(key)


def test_hot_customer_is_spread_over_cells(spark, monkeypatch):
    """No cell holds many of the touches of a customer's day, for any kind of id, also ids that grow
    with time and a single id far away from all others."""
    monkeypatch.setattr(skew, "SLICE_ROWS", 1000)
    monkeypatch.setattr(skew.add_slices, "__defaults__", (1000, 256))
    base = spark.range(30000).select(
        F.col("id"), F.lit("HOT").alias("customer_id"), F.lit("Email").alias("channel"),
        F.lit("k").alias("campaign"),
        F.date_add(F.lit("2024-01-01").cast("date"), (F.col("id") / 10000).cast("int")).alias("touchpoint_date"),
        F.lit(1.0).alias("touch_cost"), (F.col("id") % 10 == 0).cast("int").alias("is_converted"),
    )
    ids = {
        "time-ordered": F.col("id"),
        "random": F.xxhash64("id"),
        "counter": F.format_string("TOUCH_%07d", F.col("id")),
        "hash": F.md5(F.col("id").cast("string")),
        "stray number": F.when(F.col("id") == 5, F.lit(1 << 60)).otherwise(F.col("id")),
        "stray text": F.when(F.col("id") == 5, F.lit("zzz")).otherwise(F.format_string("a%09d", F.col("id"))),
    }
    for kind, touch_id in ids.items():
        touches = base.withColumn("touch_id", touch_id).drop("id")
        cells = attribution._keyed(touches, ranked=True).groupBy(*attribution._CELL).count()
        cells_of_customer, largest = cells.agg(F.count("count"), F.max("count")).first()
        assert cells_of_customer <= 3 * 60 and largest <= 4000, (kind, cells_of_customer, largest)
        ranked = attribution.position_based(touches)
        order = Window.partitionBy("customer_id").orderBy("touchpoint_date", "touch_id")
        wrong = ranked.withColumn("_p", F.row_number().over(order)).where("_p != touch_position")
        assert wrong.count() == 0 and ranked.count() == 30000, kind


def test_model_tables_come_from_one_shuffle_of_the_touches(spark):
    touches = facts.clean_touches(tv.clean_entity(spark, "/root/testdata/sf0.001", "marketing_touches"))
    credited = attribution.credits(touches)
    for model in attribution.MODELS:
        own = sorted(map(str, getattr(attribution, model)(touches).collect()))
        assert own == sorted(map(str, attribution.of_model(credited, model).collect()))
        narrow = attribution.of_model(spark.createDataFrame([], credited.schema), model)
        assert "Exchange" not in _initial(narrow) and "Join" not in _initial(narrow)


def test_backtest_joins_nothing_and_equals_the_two_step_way(spark):
    loans = facts.clean_loans(tv.clean_entity(spark, "/root/testdata/sf0.001", "loan_applications"))
    counted = forecast.daily_counts(loans, "application_date", "approval_status").collect()
    daily = spark.createDataFrame(counted, "series string, ds date, y double")
    one = forecast.backtest(daily, "2001-03-31")
    train, test = forecast.split(daily, "2001-03-31")
    two = forecast.evaluate(test, forecast.fit_predict(train))
    shape = lambda df: sorted((r.series, r.ds, r.y, r.yhat and round(r.yhat, 6)) for r in df.collect())
    assert shape(one) == shape(two) and one.columns == two.columns
    plan = _initial(forecast.backtest(daily, "2001-03-31"))
    assert "Join" not in plan and plan.count("Exchange") == 1


def test_cohorts_count_customers_without_a_distinct(spark):
    customers = spark.createDataFrame(
        [(1, datetime.date(2024, 1, 5), "Prime", "West", "Email")],
        "customer_id int, signup_date date, credit_tier string, region string, acquisition_channel string",
    )
    txns = spark.createDataFrame(
        [(i, 1, datetime.date(2024, 2, i), "Completed", 0.004) for i in range(1, 6)],
        "transaction_id int, customer_id int, transaction_date date, status string, transaction_amount double",
    )
    out = marts.cohort(customers, txns)
    assert "Expand" not in _initial(out)
    (row,) = out.collect()
    assert (row.active_customers, row.total_spend, row.total_transactions) == (1, 0.02, 5)
