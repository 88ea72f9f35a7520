import datetime as dt
import random

from pyspark.sql import functions as F

from sparkmart.operators import sessions

DDL = (
    "event_id string, session_id string, customer_id string, event_type string, page string,"
    " timestamp timestamp_ntz, device string, utm_source string, utm_campaign string"
)
BASE = dt.datetime(2024, 1, 1, 10, 0, 0)


def _events(spark, rows):
    """rows: (event_id, customer_id, seconds after base or None, event_type)"""
    full = [
        (
            e, f"web-{e[-1]}", c, kind, f"/p{e}",
            None if s is None else BASE + dt.timedelta(seconds=s), None, None, None,
        )
        for e, c, s, kind in rows
    ]
    return spark.createDataFrame(full, DDL)


def _numbers(df, **options):
    out = sessions.assign(df, **options)
    return {r.event_id: r.session_number for r in out.collect()}


def test_reference_fixture(spark):
    rows = [(f"EVT_00{i}", "C1", m * 60, "page_view") for i, m in enumerate([0, 10, 20, 60, 70], 1)]
    assert list(_numbers(_events(spark, rows)).values()).count(1) == 3
    out = {r.event_id: r.true_session_id for r in sessions.assign(_events(spark, rows)).collect()}
    assert out["EVT_001"] == out["EVT_003"] == "C10001" and out["EVT_004"] == "C10002"


def test_gap_limits_and_ties(spark):
    rows = [
        ("a", "C1", 0, "x"), ("b", "C1", 1800, "x"), ("c", "C1", 3601, "x"), ("d", "C1", 3601, "x"),
        ("e", "C2", 5, "x"),
    ]
    assert _numbers(_events(spark, rows)) == {"a": 1, "b": 1, "c": 2, "d": 2, "e": 1}


def test_gap_counts_whole_seconds(spark):
    rows = [("a", "C1", 0.9, "x"), ("b", "C1", 1800.95, "x"), ("c", "C1", 3601.0, "x")]
    assert _numbers(_events(spark, rows)) == {"a": 1, "b": 1, "c": 2}


def _brute(rows, timeout=1800):
    """Row-by-row reading of the definition, with unreadable times first."""
    out = {}
    for customer in {r[1] for r in rows if r[1] is not None}:
        mine = [r for r in rows if r[1] == customer]
        unread = [r for r in mine if r[2] is None]
        number = len(unread)
        out |= {r[0]: number for r in unread}
        last = None
        for r in sorted((r for r in mine if r[2] is not None), key=lambda r: r[2]):
            if last is None or int(r[2]) - int(last) > timeout:
                number += 1
            last = r[2]
            out[r[0]] = number
    return out


def test_buckets_do_not_change_the_result(spark):
    rng = random.Random(7)
    rows = []
    for i in range(4000):
        customer = "HOT" if rng.random() < 0.4 else rng.choice(["A", "B", "C", None])
        seconds = rng.choice([rng.randrange(0, 40 * 86400), rng.randrange(0, 7200)])
        rows.append((f"e{i}", customer, None if rng.random() < 0.01 else seconds, "x"))
    want = _brute(rows)
    df = _events(spark, rows)
    for bucket in (60, 3600, 86400, 10**8):
        assert _numbers(df, bucket_s=bucket) == want


def test_more_than_9999_sessions_keep_all_digits(spark):
    df = spark.range(10050).select(
        F.col("id").cast("string").alias("event_id"), F.lit("s").alias("session_id"),
        F.lit("C").alias("customer_id"), F.lit("x").alias("event_type"), F.lit("/").alias("page"),
        F.timestamp_seconds(F.col("id") * 2000).cast("timestamp_ntz").alias("timestamp"),
    )
    ids = sessions.assign(df).select("true_session_id").distinct()
    assert ids.count() == 10050 and ids.where("true_session_id = 'C-10050'").count() == 1


def test_anonymous_events(spark):
    rows = [("a", None, 0, "x"), ("b", None, 10, "x"), ("c", "C1", 20, "x")]
    df = _events(spark, rows)
    assert set(_numbers(df)) == {"c"}
    by_client = sessions.assign(df, anonymous="by_client_session")
    assert {r.event_id: r.true_session_id for r in by_client.collect()} == {
        "a": "anonymous-web-a0001", "b": "anonymous-web-b0001", "c": "C10001",
    }
    kept = sessions.rollup(sessions.assign(df, anonymous="keep")).collect()
    assert sorted((r.true_session_id, r.event_count) for r in kept if r.true_session_id) == [("C10001", 1)]
    assert [r.event_count for r in kept if r.true_session_id is None] == [2]


def test_rollup_follows_time(spark):
    rows = [
        ("b", "C1", 60, "conversion"), ("a", "C1", 0, "view"), ("c", "C1", 120, "view"),
        ("d", "C1", 9999, None),
    ]
    out = {r.true_session_id: r for r in sessions.rollup(sessions.assign(_events(spark, rows))).collect()}
    first = out["C10001"]
    assert (first.entry_page, first.exit_page, first.converted) == ("/pa", "/pc", True)
    assert (first.event_count, first.session_duration_seconds) == (3, 120)
    assert out["C10002"].converted is False and out["C10002"].session_start == out["C10002"].session_end
