import datetime as dt
import random

from sparkmart.operators import journey, skew

T_DDL = "touch_id bigint, customer_id bigint, touchpoint_date date"
S_DDL = (
    "true_session_id string, customer_id bigint, session_start timestamp_ntz,"
    " session_end timestamp_ntz, converted boolean, entry_page string, exit_page string"
)


def _sessions(spark, rows):
    return spark.createDataFrame(
        [(s, c, t, t, False, "/", "/") for s, c, t in rows], S_DDL
    )


def test_lookback_limits(spark):
    start = dt.datetime(2024, 3, 1, 0, 0)
    days = {1: 0, 2: 30, 3: 31, 4: -1}
    touches = spark.createDataFrame(
        [(t, 7, start.date() - dt.timedelta(days=d)) for t, d in days.items()] + [(5, 7, None)], T_DDL
    )
    out = journey.interval_join(touches, _sessions(spark, [("s", 7, start)])).collect()
    assert {r.touch_id: r.days_before_session for r in out} == {1: 0, 2: 30}


def _pairs(touches, sessions, lookback):
    return sorted(
        (t, s)
        for t, c, d in touches
        for s, c2, start in sessions
        if c == c2 and 0 <= (start.date() - d).days <= lookback
    )


def test_every_pair_once_with_and_without_salt(spark):
    rng = random.Random(5)
    day = dt.date(1969, 12, 1)  # spans day numbers below zero
    customer = lambda: 1 if rng.random() < 0.4 else rng.randrange(20)
    touches = [(i, customer(), day + dt.timedelta(days=rng.randrange(90))) for i in range(400)]
    sessions = [
        (f"s{i}", customer(), dt.datetime(1969, 12, 1) + dt.timedelta(hours=rng.randrange(24 * 90)))
        for i in range(200)
    ]
    t, s = spark.createDataFrame(touches, T_DDL), _sessions(spark, sessions)
    for lookback in (0, 7, 30):
        want = _pairs(touches, sessions, lookback)
        for share, salts in ((1.0, 1), (0.1, 8), (1e-4, 3)):
            out = journey.interval_join(t, s, lookback, share=share, salts=salts).collect()
            assert sorted((r.touch_id, r.true_session_id) for r in out) == want


def test_asof_is_the_first_of_the_interval_join(spark):
    rng = random.Random(8)
    day = dt.date(1969, 12, 1)
    customer = lambda: 1 if rng.random() < 0.4 else rng.choice([None, *range(12)])
    touches = [(i, customer(), rng.choice([None, *[day + dt.timedelta(days=rng.randrange(90))] * 9])) for i in range(300)]
    sessions = [(f"s{i}", customer(), dt.datetime(1969, 12, 1) + dt.timedelta(hours=rng.randrange(24 * 90))) for i in range(200)]
    sessions += [("no time", 1, None), sessions[0]]
    t, s = spark.createDataFrame(touches, T_DDL), _sessions(spark, sessions)
    for lookback in (0, 7, 30):
        out = journey.asof_touches(s, t, ["touch_id", "customer_id"], lookback)
        assert "Cartesian" not in out._jdf.queryExecution().executedPlan().toString()
        assert " Join" not in out._jdf.queryExecution().optimizedPlan().toString()
        got = sorted(((r[0], r[7], r.days_before_session) for r in out.collect()), key=str)
        want = []
        for name, c, at in sessions:
            fits = [(d, i) for i, o, d in touches if at and c is not None and o == c and d and 0 <= (at.date() - d).days <= lookback]
            want.append((name, max(fits)[1], (at.date() - max(fits)[0]).days) if fits else (name, None, None))
        assert got == sorted(want, key=str)
    none = spark.createDataFrame([], T_DDL)
    assert journey.asof_touches(s, none, ["touch_id"]).where("touch_id IS NULL AND days_before_session IS NULL").count() == len(sessions)


def test_hot_keys_are_few_and_right(spark):
    df = spark.createDataFrame([(1,)] * 50 + [(i,) for i in range(2, 52)] + [(None,)] * 90, "k bigint")
    assert [r.k for r in skew.hot_keys(df, "k", 0.3).collect()] == [1]


def test_customer_360(spark):
    customers = spark.createDataFrame(
        [(1, *["x"] * 6, None, "Prime", 700, 1.0, True), (2, *["x"] * 6, None, "Prime", 700, 1.0, True)],
        "customer_id bigint, first_name string, last_name string, email string, gender string,"
        " region string, acquisition_channel string, signup_date date, credit_tier string,"
        " credit_score int, annual_income double, is_active boolean",
    )
    txns = spark.createDataFrame(
        [
            ("a", 1, "Savings", 10.10, "Completed", False), ("b", 1, "Card", 0.20, "Completed", False),
            ("c", 1, "Card", 99.0, "Failed", False), ("d", 1, "Card", 1e6, "Completed", True),
        ],
        "transaction_id string, customer_id bigint, product_type string, amount double,"
        " status string, is_amount_outlier boolean",
    )
    touches = spark.createDataFrame(
        [(1, 1, 1.0, True, False), (2, 1, 2.0, False, False), (3, 1, 2.0, None, False)],
        "touch_id bigint, customer_id bigint, cost double, converted boolean, is_cost_outlier boolean",
    )
    out = {r.customer_id: r for r in journey.customer_360(customers, txns, touches).collect()}
    one, two = out[1], out[2]
    assert (one.total_transactions, one.total_spend, one.avg_transaction_amount) == (2, 10.3, 5.15)
    assert one.most_used_product == "Card"  # tie: smaller name
    assert (one.total_touches, one.total_marketing_cost, one.avg_touch_cost) == (3, 5.0, 1.67)
    assert one.touch_conversion_rate == 0.5
    assert two.total_transactions is None and two.touch_conversion_rate is None
