"""From CSV files to gold tables, and the small contracts around it."""

import datetime

import pytest
from pyspark.sql import functions as F

from sparkmart.functions import expr, stats
from sparkmart.operators import journey, marts, sessions, skew, supply
from sparkmart.plans import build, models

CSV = {
    "customers": (
        "customer_id,first_name,last_name,email,date_of_birth,gender,region,acquisition_channel,signup_date,"
        "credit_tier,credit_score,annual_income,is_active",
        ["C1,Ann,Lee,,1980-01-02,female,WEST,Direct,01/05/2024,prime,700,50000,true",
         "C1,Ann,Lee,,1980-01-02,female,WEST,Direct,01/05/2024,prime,700,50000,true",
         "C2,Bob,Ray,b@x.org,1990-02-03,,south,email,2024/01/06,subprime,600,40000,true"],
    ),
    "transactions": (
        "transaction_id,customer_id,amount,product_type,status,timestamp,merchant_category",
        ["T1,C1,10.004,credit card,completed,2024-01-10 10:00:00,food", "T2,C2,20.004,savings,failed,2024-01-11 10:00:00,",
         "T3,C1,oops,credit card,completed,2024-01-12 10:00:00,food"],
    ),
    "loan_applications": (
        "application_id,customer_id,application_date,requested_amount,approval_status,loan_amount,interest_rate,"
        "loan_term_months,default_flag,purpose",
        [f"L{i},C{1 + i % 2},2024-01-{10 + i},{1000 + i},approved,{900 + i},5.5,12,false,home" for i in range(8)],
    ),
    "marketing_touches": (
        "touch_id,customer_id,channel,campaign,touchpoint_date,cost,converted,utm_source,utm_campaign",
        ["M1,C1,email,Promotional,2024-01-08,0.004,true,e,p", "M2,C2,social,Lookalike,2024-01-09,0.004,false,s,l",
         "M3,,digital,Retargeting,January 09 2024,0.004,false,d,r"],
    ),
    "product_inventory": (
        "product_id,sku,product_name,category,unit_cost,selling_price,stock_level,reorder_point,reorder_quantity,"
        "lead_time_days,supplier,is_active",
        ["P1,S1,Card,Credit Card,1.0,2.5,5,10,20,7,Acme,true", "P2,S2,Box,Savings,2.0,,50,10,20,7,,true"],
    ),
    "events_raw": (
        "event_id,session_id,customer_id,event_type,page,timestamp,device,utm_source,utm_campaign,is_bot",
        ["E1,w1,C1,VIEW,/home,2024-01-09 10:00:00,Mobile,e,p,false", "E2,w1,C1,click,/apply,2024-01-09 10:30:00,mobile,e,p,false",
         "E3,w1,C1,conversion,/x,2024-01-09 11:00:01,mobile,e,p,false", "E4,w2,,view,/home,2024-01-09 10:00:00,,,,true"],
    ),
}


def test_raw_files_to_gold_tables(spark, tmp_path):
    files = {}
    for entity, (header, lines) in CSV.items():
        files[entity] = f"{tmp_path}/raw/{entity}.csv"
        (tmp_path / "raw").mkdir(exist_ok=True)
        (tmp_path / "raw" / f"{entity}.csv").write_text("\n".join([header, *lines]) + "\n")
    spark.sql("CREATE DATABASE IF NOT EXISTS built")
    bronze = f"{tmp_path}/bronze"
    build.bronze(spark, files, bronze, "2024-01-31")
    build.silver_tables(spark, bronze, "2024-01-31", "built")
    gold = models.gold("2024-02-01", "2024-01-14", "2024-02-01 06:00:00", ("2024-01-01", "2024-03-01"), load_date="2024-02-01")
    # A second load; the first one's partitions stay.
    counts = build.run(
        spark, files, bronze, "2024-02-01", gold, "built", partitions={"fct_transactions": ["transaction_date"]}
    )
    assert counts["bronze"] == {e: len(lines) for e, (_, lines) in CSV.items()}
    assert counts["silver"]["customers"] == 2 and counts["silver"]["events_raw"] == 3
    assert counts["gold"]["fct_transactions"] == spark.read.table("built.fct_transactions").count() == 3
    assert counts["gold"]["mart_channel_performance"] > 0
    assert {r.load_date for r in spark.read.parquet(f"{bronze}/customers").select(F.col("load_date").cast("string")).distinct().collect()} == {
        "2024-01-31", "2024-02-01",
    }
    kept = spark.read.table("built.silver_customers").groupBy("silver_load_date").count().collect()
    assert {str(r.silver_load_date): r["count"] for r in kept} == {"2024-01-31": 2, "2024-02-01": 2}
    customer = {r.customer_id: r for r in build.entities(spark, "2024-02-01", "built")["customers"].collect()}
    assert (customer["C1"].acquisition_channel, customer["C1"].email) == ("Direct Mail", "unknown@unknown.com")
    assert customer["C2"].signup_date == datetime.date(2024, 1, 6)
    assert {r.silver_load_date for r in spark.read.table("built.silver_sessions").collect()} == {"2024-02-01"}
    assert spark.read.table("built.silver_sessions").count() == 2
    day = spark.read.table("built.fct_transactions").where("transaction_date = DATE '2024-01-10'")
    plan = day._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(transaction_date" in plan and day.count() == 1
    assert spark.read.table("built.stg_customers").columns[0] == "customer_id"
    assert spark.read.table("built.srv_channel_performance").count() == counts["gold"]["mart_channel_performance"]


def test_money_below_a_cent_and_unknown_amounts(spark):
    rows = spark.range(1000).select(
        F.lit("t").alias("touch_id"), F.lit(0.004).alias("touch_cost"), F.lit(1).alias("is_converted"),
        *[F.lit("x").alias(c) for c in ("channel", "campaign", "utm_source", "utm_campaign", "credit_tier", "region")],
        F.lit(0.004).alias("converted_spend"), F.lit(0.0).alias("unconverted_spend"),
    )
    (row,) = marts.channel_performance(rows).collect()
    assert (row.total_spend, row.avg_cost_per_touch, row.converted_spend) == (4.0, 0.0, 4.0)
    odd = spark.createDataFrame([(1.0,), (float("nan"),), (3.0,), (None,)], "x double")
    assert tuple(odd.agg(expr.money_sum("x"), expr.money_avg("x")).first()) == (4.0, 2.0)


def test_timestamps_do_not_depend_on_the_session_zone(spark):
    df = spark.createDataFrame([("2024-03-10 02:30:00",), ("03/10/2024 02:30:00",), ("n/a",), (None,)], "t string")
    before = spark.conf.get("spark.sql.session.timeZone")
    try:
        for zone in ("UTC", "America/New_York"):  # that hour does not exist in New York
            spark.conf.set("spark.sql.session.timeZone", zone)
            got = [r[0] for r in df.select(expr.parse_ts("t").cast("string")).collect()]
            assert got == ["2024-03-10 02:30:00", "2024-03-10 02:30:00", None, None]
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_session_ids_of_busy_customers_are_unique(spark):
    minutes = F.col("id") * 31
    events = spark.range(10_002).select(
        F.col("id").alias("event_id"), F.lit("1").alias("customer_id"),
        (F.lit(datetime.datetime(2024, 1, 1)).cast("timestamp_ntz") + F.make_dt_interval(F.lit(0), F.lit(0), minutes.cast("int"), F.lit(0))).alias("timestamp"),
    ).unionByName(
        spark.createDataFrame([(99999, "11", datetime.datetime(2024, 1, 1))], "event_id long, customer_id string, timestamp timestamp_ntz")
    )
    ids = sessions.assign(events).select("customer_id", "true_session_id").distinct()
    assert ids.count() == ids.select("true_session_id").distinct().count() == 10_003
    dashed = {r[0] for r in sessions.assign(events, separator="-").select("true_session_id").collect()}
    assert {"1-0001", "1-10001", "11-0001"} <= dashed
    with pytest.raises(ValueError):
        sessions.assign(events, timeout_s=0, bucket_s=10**9)


def test_shares_of_hot_keys_are_bounded(spark):
    df = spark.range(10).withColumnRenamed("id", "customer_id")
    with pytest.raises(ValueError):
        skew.hot_keys(df, "customer_id", share=1e-9)
    given = spark.range(3).withColumnRenamed("id", "customer_id")
    right = df.withColumn("y", F.col("customer_id"))
    joined = skew.salted_join(df, right, ["customer_id"], "customer_id", F.col("customer_id"), given)
    assert "ResolvedHint" not in joined._jdf.queryExecution().analyzed().toString() and joined.count() == 10
    assert journey.interval_join.__defaults__[3] is False


def test_variance_of_several_series_adds_up_the_days(spark):
    days = [(s, datetime.date(2024, 1, d), 5.0) for s in "ab" for d in range(1, 31)]
    fc = spark.createDataFrame(days, "series string, forecast_date date, predicted_applications double")
    warnings = spark.createDataFrame(
        [("P", 100, 3, 10, datetime.date(2024, 1, 1))],
        "product_id string, stock_level int, lead_time_days int, reorder_point int, snapshot_date date",
    )
    row = supply.sku_variance(warnings, fc, "2024-01-01").first()
    assert (row.avg_daily_forecast, row.total_forecast_30d, row.supply_demand_variance) == (10.0, 300.0, 70.0)


def test_t_tail_of_very_many_degrees_of_freedom():
    p = stats.t_two_sided([1.959963984540054, 3.0], [1e11, 1e12])
    assert p == pytest.approx([0.05, 0.0026997960632602], rel=1e-9)
