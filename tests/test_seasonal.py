"""Seasonal regression against numpy, one series at a time."""

import datetime as dt
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from sparkmart.operators import forecast, seasonal

START = dt.date(2022, 1, 1)


def value(series, k):
    day = START + dt.timedelta(days=k)
    year = 2 * math.pi * (day - dt.date(2000, 1, 1)).days / 365.25
    return 100 + series + 0.02 * k + 12 * math.sin(year) + 5 * math.cos(2 * year) + (8 if day.weekday() >= 5 else 0) + (k * 37 % 11) / 5


@pytest.fixture(scope="module")
def days(spark):
    rows = [(f"s{s}", START + dt.timedelta(days=k), value(s, k)) for s in range(4) for k in range(900)]
    rows += [("short", START + dt.timedelta(days=k), float(k)) for k in range(3)] + [("one", START, 5.0), ("gap", START, None), ("gap", START + dt.timedelta(days=9), 4.0)]
    return spark.createDataFrame(rows, "series string, ds date, y double").repartition(5)


def design(dates):
    out = []
    for d in dates:
        years = ((d - dt.date(1970, 1, 1)).days - 10957) / 365.25
        waves = [f(2 * math.pi * k * years) for k in (1, 2, 3) for f in (math.sin, math.cos)]
        out.append([1.0, years, *waves, *(float((d.weekday() + 1) % 7 + 1 == w) for w in range(2, 8))])
    return np.array(out)


def test_coefficients_equal_a_plain_solution(days):
    rows = {}
    for r in days.where("y IS NOT NULL").collect():
        rows.setdefault(r.series, []).append((r.ds, r.y))
    for r in seasonal.fit(days).collect():
        dates, y = zip(*sorted(rows[r.series]))
        x = design(dates)
        want, *_ = np.linalg.lstsq(x, np.array(y), rcond=None)
        fitted = x @ np.array(r.coefficients)
        assert np.allclose(fitted, x @ want, atol=1e-5), r.series
        if len(y) > 100:
            assert np.allclose(r.coefficients, want, rtol=1e-5, atol=1e-5)
            assert r.deviation == pytest.approx(np.sqrt(((np.array(y) - fitted) ** 2).sum() / (len(y) - 1)), rel=1e-6)
        assert (r.n, r.first_day, r.last_day) == (len(y), min(dates), max(dates))


def test_thousands_of_series_in_one_shuffle(spark):
    many = spark.range(40_000).select(
        F.concat(F.lit("s"), F.col("id") % 2000).alias("series"), F.date_add(F.lit(START), (F.col("id") / 2000).cast("int") * 9).alias("ds"), (F.col("id") % 13).alias("y")
    )
    model = seasonal.fit(many)
    assert model.count() == 2000
    assert model._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[-1].count("Exchange") == 1


def test_forecast_beats_means_of_months_and_of_all_days(spark, days):
    long = days.where("series LIKE 's_'")
    cut = str(START + dt.timedelta(days=760))
    scores = {r.series: r for r in seasonal.holdout(long, cut).collect()}
    months = {r.series: r.mae for r in forecast.backtest(long, cut).groupBy("series").agg(F.avg(F.abs(F.col("y") - F.col("yhat"))).alias("mae")).collect()}
    for name, r in scores.items():
        assert r.days == 139 and r.mae < 1.0 < months[name] and r.mae < r.mae_of_mean
    ahead = seasonal.predict(seasonal.future(seasonal.fit(long), 30), seasonal.fit(long)).collect()
    assert len(ahead) == 4 * 30
    for r in ahead:
        k = (r.ds - START).days
        assert abs(r.yhat - value(int(r.series[1:]), k)) < 3 and r.yhat_lower < r.yhat < r.yhat_upper
        assert r.yhat == pytest.approx(r.trend + r.yearly + r.weekly)


def test_no_days(spark):
    none = spark.createDataFrame([], "series string, ds date, y double")
    assert seasonal.fit(none).collect() == [] and seasonal.holdout(none, "2024-01-01").collect() == []
