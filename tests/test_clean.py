import datetime as dt

from pyspark.sql import functions as F

from sparkmart.functions import expr
from sparkmart.operators import clean
from sparkmart.plans import silver

CUSTOMERS = [
    ("CUST_00001", "Alice", 50000, "2026-02-23"),
    ("CUST_00002", "Bob", 75000, "2026-02-23"),
    ("CUST_00003", "Carol", 60000, "2026-02-23"),
    ("CUST_00001", "Alice", 50000, "2026-02-23"),
]
CUSTOMER_DDL = "customer_id string, first_name string, annual_income int, load_date string"


def _amounts(spark):
    rows = [(f"TXN_{i:03d}", float(151 + i)) for i in range(100)]
    rows += [("TXN_100", 25000.0), ("TXN_101", 30000.0)]
    return spark.createDataFrame(rows, "transaction_id string, amount double")


def test_dedup_keeps_one_row_per_key(spark):
    out = clean.dedup(spark.createDataFrame(CUSTOMERS, CUSTOMER_DDL), "customer_id")
    ids = [r.customer_id for r in out.collect()]
    assert sorted(ids) == ["CUST_00001", "CUST_00002", "CUST_00003"]
    assert clean.dedup(out, "customer_id").count() == 3


def test_dedup_newest_load_wins_then_ties_are_ordered(spark):
    rows = [
        ("A", "old", 1, "2026-01-01"), ("A", "zed", 9, "2026-02-01"), ("A", "abe", 9, "2026-02-01"),
        ("A", None, 9, "2026-02-01"), ("B", "only", 2, None),
    ]
    df = spark.createDataFrame(rows, CUSTOMER_DDL)
    for partitions in (1, 3, 5):
        out = clean.dedup(df.repartition(partitions), "customer_id", ties=["first_name"])
        assert {r.customer_id: r.first_name for r in out.collect()} == {"A": None, "B": "only"}


def test_outliers_are_the_extremes(spark):
    out = clean.flag_outliers(_amounts(spark), {"amount": "is_amount_outlier"}).collect()
    assert {r.amount for r in out if r.is_amount_outlier} == {25000.0, 30000.0}
    assert sum(not r.is_amount_outlier for r in out) == 100


def test_outlier_bound_is_mean_plus_three_sample_deviations(spark):
    df = _amounts(spark)
    bound = df.limit(1).select(clean.outlier_bounds(df, ["amount"]).getField("amount")).first()[0]
    values = [r.amount for r in df.collect()]
    mean = sum(values) / len(values)
    sd = (sum((v - mean) ** 2 for v in values) / (len(values) - 1)) ** 0.5
    assert abs(bound - (mean + 3 * sd)) < 1e-6


def test_null_is_no_outlier_and_scores_are_exact(spark):
    df = _amounts(spark).unionByName(
        spark.createDataFrame([("N", None)], "transaction_id string, amount double")
    )
    out = clean.quality_score(
        clean.flag_outliers(df, {"amount": "is_amount_outlier"}), {"is_amount_outlier": "0.2"}
    )
    scores = {r.transaction_id: r.data_quality_score for r in out.collect()}
    assert scores["N"] == 1.0 and scores["TXN_100"] == 0.8 and scores["TXN_000"] == 1.0


def test_mixed_dates(spark):
    texts = ["2024-01-02", "2024/01/02", "01/02/2024", "January 02 2024", "garbage", None]
    df = spark.createDataFrame([(t,) for t in texts], "d string")
    days = [r.d for r in clean.parse_dates(df, ["d"]).collect()]
    assert days == [dt.date(2024, 1, 2)] * 4 + [None, None]
    stamps = [f"{t} 03:04:05" if t else None for t in texts[:3]] + ["January 02 2024", "x"]
    df = spark.createDataFrame([(t,) for t in stamps], "d string")
    got = [r.d for r in clean.parse_dates(df, ["d"], kind="timestamp").collect()]
    assert got == [dt.datetime(2024, 1, 2, 3, 4, 5)] * 3 + [dt.datetime(2024, 1, 2), None]


def test_timestamps_do_not_depend_on_the_session_zone(spark):
    df = spark.createDataFrame([("2024-03-31 02:30:00",)], "d string")
    zone = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")
        got = clean.parse_dates(df, ["d"], kind="timestamp").first().d
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
    assert got == dt.datetime(2024, 3, 31, 2, 30)


def test_casing_and_remap(spark):
    df = spark.createDataFrame([("NEAR-PRIME", "dIRECT"), (None, "email")], "tier string, ch string")
    out = clean.casing(df, title=["tier", "ch"], mapping={"ch": {"Direct": "Direct Mail"}}).collect()
    assert [tuple(r) for r in out] == [("Near-prime", "Direct Mail"), (None, "Email")]


def test_fill_mean_uses_the_rounded_mean(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (2.0,), (None,)], "x double")
    assert sorted(r.x for r in clean.fill_mean(df, ["x"]).collect()) == [1.0, 1.67, 2.0, 2.0]


def test_customer_recipe_order(spark):
    """Fill mean is taken after dedup, the outlier bound after the fill."""
    rows = [("C1", "male", 100.0), ("C1", "male", 100.0), ("C2", None, 200.0), ("C3", "FEMALE", None)]
    df = spark.createDataFrame(rows, "customer_id string, gender string, annual_income double")
    for c in ("region", "acquisition_channel", "credit_tier", "signup_date", "date_of_birth", "email"):
        df = df.withColumn(c, F.lit(None).cast("string"))
    df = df.withColumn("load_date", F.lit("2024-01-01"))
    out = {r.customer_id: r for r in silver.customers(df, load_date="2024-01-02").collect()}
    assert out["C3"].annual_income == 150.0
    assert out["C2"].gender == "Unknown" and out["C3"].gender == "Female"
    assert out["C1"].email == "unknown@unknown.com" and out["C1"].silver_load_date == "2024-01-02"
    assert not any(r.is_duplicate or r.is_income_outlier for r in out.values())


def test_events_recipe_removes_bots(spark):
    ddl = (
        "event_id string, session_id string, customer_id string, event_type string, page string,"
        " timestamp string, device string, utm_source string, utm_campaign string, is_bot boolean"
    )
    rows = [
        ("E1", "s", None, "PAGE_VIEW", "/", "2024-01-01 10:00:00", None, None, None, False),
        ("E2", "s", "C", "CLICK", "/", "2024-01-01 10:00:00", "MOBILE", "x", "y", True),
    ]
    (row,) = silver.events(spark.createDataFrame(rows, ddl)).collect()
    assert (row.event_type, row.device, row.utm_campaign, row.customer_id) == (
        "page_view", "unknown", "unknown", None,
    )
    assert row.timestamp == dt.datetime(2024, 1, 1, 10) and row.data_quality_score == 1.0


def test_surrogate_key_marks_nulls(spark):
    df = spark.createDataFrame([("a", "b"), ("a", None), (None, "a")], "x string, y string")
    keys = [r.k for r in df.select(expr.surrogate_key("x", "y").alias("k")).collect()]
    assert len(set(keys)) == 3
    import hashlib

    assert keys[0] == hashlib.md5(b"a-b").hexdigest()
    assert keys[1] == hashlib.md5(b"a-_dbt_utils_surrogate_key_null_").hexdigest()


def test_rounding_is_half_up_without_float_noise(spark):
    df = spark.createDataFrame([(1.005,), (100.49999999999999,), (-2.675,), (None,)], "x double")
    assert [r[0] for r in df.select(expr.rnd("x", 2)).collect()] == [1.01, 100.5, -2.68, None]
