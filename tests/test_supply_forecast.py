import datetime as dt

import pytest
from pyspark.sql import functions as F

from sparkmart.operators import forecast, supply

PRODUCT_DDL = (
    "product_id bigint, product_name string, category string, unit_cost double,"
    " selling_price double, stock_level int, reorder_point int, reorder_quantity int,"
    " lead_time_days int, supplier string, is_duplicate boolean"
)


def _health(spark, rows):
    """rows: (id, stock, reorder point, reorder quantity, lead time)"""
    full = [(i, "n", "c", 2.0, 3.0, s, p, q, lead, "x", False) for i, s, p, q, lead in rows]
    return supply.inventory_health(spark.createDataFrame(full, PRODUCT_DDL), "2024-01-01")


ROWS = [
    (1, 0, 5, 10, 4), (2, 5, 5, 10, 4), (3, 4, 5, 10, 4), (4, 40, 5, 10, 4), (5, 55, 5, 10, 4),
    (6, 1000, 5, 10, 4), (7, 2000, 5, 10, 4), (8, 50, 5, 0, 4), (9, 50, 5, None, 4),
    (10, 310, 5, 10, 4), (11, 610, 5, 10, 4),
]


def test_health_levels(spark):
    out = {r.product_id: r for r in _health(spark, ROWS).collect()}
    assert [out[i].stock_status for i in (1, 2, 4, 10, 11, 8, 9)] == [
        "out_of_stock", "critical", "low", "moderate", "healthy", "healthy", "healthy",
    ]
    assert [out[i].obsolescence_risk for i in (6, 7, 8, 4)] == ["medium", "high", "low", "low"]
    assert out[8].days_of_supply is None and out[4].days_of_supply == 4.0
    assert out[2].reorder_trigger == 1 and out[4].reorder_trigger == 0
    assert out[4].inventory_value == 80.0 and out[4].snapshot_date == dt.date(2024, 1, 1)


def test_warnings(spark):
    out = {r.product_id: r for r in supply.stockout_warning(_health(spark, ROWS)).collect()}
    assert [out[i].warning_level for i in (1, 2, 4, 5, 6, 8)] == [
        "STOCKOUT", "CRITICAL", "AT_RISK", "WARNING", "OK", "OK",
    ]
    # Below the reorder point: the reorder quantity; at it: the early order of a quarter more.
    assert [out[i].recommended_order_qty for i in (3, 2, 5, 6, 9)] == [10, 13, 13, 0, 0]
    assert [out[i].days_until_stockout for i in (1, 4, 5)] == [0, 4, None]
    assert out[6].recommended_action == "No action required"
    ordered = supply.order_by_severity(supply.stockout_warning(_health(spark, ROWS)), "days_of_supply")
    assert [r.severity_rank for r in ordered.collect()] == sorted(r.severity_rank for r in out.values())


def test_sop_counts_demand_per_sku_or_once(spark):
    txns = spark.createDataFrame(
        [(1, 7, "c", 10.0, 0), (2, 7, "c", 5.0, 0), (3, 8, "c", 99.0, 1)],
        "transaction_id bigint, customer_id bigint, product_type string,"
        " transaction_amount double, is_failed int",
    )
    row = supply.sop_category(_health(spark, ROWS), txns).first()
    assert (row.total_skus, row.total_transactions, row.total_category_revenue) == (11, 22, 165.0)
    assert (row.pct_skus_at_risk, row.category_risk_level) == (27.3, "MEDIUM RISK")
    once = supply.sop_category(_health(spark, ROWS), txns, demand_once=True).first()
    assert (once.total_transactions, once.total_category_revenue) == (2, 15.0)
    none = supply.sop_category(_health(spark, ROWS), txns.where("false")).first()
    assert (none.total_transactions, none.avg_transaction_value) == (0, 0.0)


def test_sku_variance(spark):
    warnings = supply.stockout_warning(_health(spark, [(1, 7, 5, 10, 4), (2, 12, 5, 10, 4), (3, 90, 5, 10, 4)]))
    days = [(dt.date(2024, 1, 1) + dt.timedelta(days=i), 2.0 if i < 30 else 100.0) for i in range(40)]
    fc = spark.createDataFrame(days, "forecast_date date, predicted_applications double")
    out = {r.product_id: r for r in supply.sku_variance(warnings, fc, "2024-01-01").collect()}
    assert (out[1].avg_daily_forecast, out[1].total_forecast_30d) == (2.0, 60.0)
    assert [out[i].variance_status for i in (1, 2, 3)] == ["DEFICIT", "TIGHT", "SURPLUS"]
    assert out[1].supply_demand_variance == -1.0 and out[3].forecast_days_of_supply == 45.0
    empty = supply.sku_variance(warnings, fc.where("false"), "2024-01-01").collect()
    assert all(r.variance_status == "SURPLUS" and r.avg_daily_forecast is None for r in empty)


WEEK = [3.0, 1.0, 0.0, -1.0, -1.0, -2.0, 0.0]


def _series(spark, n=70):
    start = dt.date(2024, 1, 1)
    rows = [("s", start + dt.timedelta(days=i), 50.0 + 0.5 * i + WEEK[i % 7]) for i in range(n)]
    rows += [("flat", start, 4.0)]
    return spark.createDataFrame(rows, "series string, ds date, y double")


def test_forecast_recovers_trend_and_week(spark):
    out = forecast.fit_predict(_series(spark), horizon=14, yearly=False).where("series = 's'")
    rows = {r.ds: r for r in out.collect()}
    assert len(rows) == 84
    for i in range(70, 84):
        r = rows[dt.date(2024, 1, 1) + dt.timedelta(days=i)]
        assert r.y is None and abs(r.yhat - (50 + 0.5 * i + WEEK[i % 7])) < 0.3
        assert r.yhat_lower <= r.yhat <= r.yhat_upper
        assert abs(r.trend + r.weekly + r.yearly - r.yhat) < 1e-9


def test_single_day_series_is_flat(spark):
    out = forecast.fit_predict(_series(spark), horizon=3).where("series = 'flat'").collect()
    assert len(out) == 4 and all(r.yhat == 4.0 for r in out)


def test_daily_counts(spark):
    days = [dt.date(2024, 1, 1)] * 2 + [dt.date(2024, 1, 4), None]
    df = spark.createDataFrame([(d, "k") for d in days], "d date, k string")
    got = sorted((r.series, str(r.ds), r.y) for r in forecast.daily_counts(df, "d").collect())
    assert got == [("all", "2024-01-01", 2.0), ("all", "2024-01-04", 1.0)]
    filled = sorted((str(r.ds)[-2:], r.y) for r in forecast.daily_counts(df, "d", "k", True).collect())
    assert filled == [("01", 2.0), ("02", 0.0), ("03", 0.0), ("04", 1.0)]


def test_accuracy(spark):
    d = [dt.date(2024, 1, 30), dt.date(2024, 1, 31), dt.date(2024, 2, 1)]
    actual = spark.createDataFrame(
        [("s", d[0], 10.0), ("s", d[1], 0.0), ("s", d[2], 5.0)], "series string, ds date, y double"
    )
    fc = spark.createDataFrame(
        [("s", x, 8.0, 0.0, 0.0) for x in d],
        "series string, ds date, yhat double, yhat_lower double, yhat_upper double",
    )
    evaluation = forecast.evaluate(actual, fc)
    row = forecast.accuracy(evaluation).first()
    assert (row.days, row.mape, row.mae) == (3, 40.0, pytest.approx(4.3333))
    assert row.rmse == pytest.approx((77 / 3) ** 0.5, abs=1e-4)
    months = {r.month: r for r in forecast.monthly_accuracy(evaluation).collect()}
    assert (months["2024-01"].mape, months["2024-02"].variance_pct) == (20.0, -60.0)
    best = forecast.best_worst(forecast.monthly_accuracy(evaluation)).first()
    assert (best.best_month, best.worst_month, best.worst_mape) == ("2024-01", "2024-02", 60.0)


def test_publish_clips_at_zero(spark):
    fc = spark.createDataFrame(
        [("s", dt.date(2024, 1, 1), -1.0, -2.0, 0.456), ("s", dt.date(2024, 1, 2), None, -2.0, 1.0)],
        "series string, ds date, yhat double, yhat_lower double, yhat_upper double",
    )
    out = forecast.publish(fc, "v1", "2023-12-31", "2024-01-01 05:00:00").orderBy("forecast_date").collect()
    assert (out[0].predicted_applications, out[0].predicted_upper) == (0.0, 0.46)
    assert out[1].predicted_applications is None and out[0].created_at == dt.datetime(2024, 1, 1, 5)
    assert forecast.publish(fc, "v1", "2024-01-02", "2024-01-01").count() == 0


def test_split(spark):
    train, test = forecast.split(_series(spark), "2024-01-10")
    assert train.agg(F.max("ds")).first()[0] == dt.date(2024, 1, 10)
    assert test.agg(F.min("ds")).first()[0] == dt.date(2024, 1, 11)
