"""Seasonal regression of many daily series at once, by normal equations.

Every day of a series is described by the same terms: a constant, a trend, sines and cosines of the year
and a step for each weekday. The sums of their products (the Gram matrix) and of their products with the
counts add up, so one grouped aggregate with map-side combine gives the equations of all series in one
shuffle, whatever the number of days: a few hundred numbers a series. Each small system is then solved by
Cholesky in an Arrow step; where the days do not determine all terms (short series), the solution of
least length is taken. No step holds the days of a series.

Days with an unknown count take no part. Trends count years from 2000, in which the terms are of one size.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from statistics import NormalDist

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WAVES = 3  # sines and cosines of the year
YEAR, EPOCH = 365.25, 10957  # days; 2000-01-01
SINGULAR = 1e-10  # of the greatest eigenvalue


def terms(day: Column, waves: int = WAVES) -> list[Column]:
    """Constant, trend, waves of the year, weekdays but one."""
    years = (F.unix_date(day) - EPOCH) / F.lit(YEAR)
    turn = [2 * math.pi * k * years for k in range(1, waves + 1)]
    wave = [f(x) for x in turn for f in (F.sin, F.cos)]
    steps = [F.when(F.dayofweek(day) == d, 1.0).otherwise(0.0) for d in range(2, 8)]
    return [F.lit(1.0), years, *wave, *steps]


def n_terms(waves: int = WAVES) -> int:
    return 8 + 2 * waves


def equations(series: DataFrame, waves: int = WAVES) -> DataFrame:
    """series, n, first and last day, sum of squares and, as arrays, the upper half of the Gram matrix and
    the right side: one grouped aggregate."""
    p = n_terms(waves)
    rows = series.where(F.col("y").isNotNull()).select("series", "ds", F.col("y").cast("double").alias("y"), F.array(*terms(F.col("ds"), waves)).alias("x"))
    x = [F.col("x")[i] for i in range(p)]
    gram = [F.sum(x[i] * x[j]) for i in range(p) for j in range(i, p)]
    side = [F.sum(x[i] * F.col("y")) for i in range(p)]
    return rows.groupBy("series").agg(
        F.count(F.lit(1)).alias("n"), F.min("ds").alias("first_day"), F.max("ds").alias("last_day"), F.sum(F.col("y") * F.col("y")).alias("squares"),
        F.array(*gram).alias("gram"), F.array(*side).alias("side"),
    )


def solve(gram: np.ndarray, side: np.ndarray) -> np.ndarray:
    """Coefficients of one system: by Cholesky, or of least length if the terms are not independent."""
    scale = np.sqrt(np.diag(gram))
    scale[scale == 0] = 1.0
    even = gram / scale[:, None] / scale[None, :]
    try:
        lower = np.linalg.cholesky(even)
        if (np.diag(lower) ** 2).min() > SINGULAR:
            return np.linalg.solve(lower.T, np.linalg.solve(lower, side / scale)) / scale
    except np.linalg.LinAlgError:
        pass
    return np.linalg.pinv(even, rcond=SINGULAR, hermitian=True) @ (side / scale) / scale


def fit(series: DataFrame, waves: int = WAVES) -> DataFrame:
    """series, n, first_day, last_day, coefficients and the deviation of the residuals."""
    import pyarrow as pa

    p = n_terms(waves)
    upper = np.triu_indices(p)

    def task(batches) -> Iterator:
        for batch in batches:
            found, spread = [], []
            for n, squares, gram, side in zip(*(batch.column(c).to_pylist() for c in ("n", "squares", "gram", "side"))):
                full = np.zeros((p, p))
                full[upper] = gram
                full = full + np.triu(full, 1).T
                right = np.array(side)
                beta = solve(full, right)
                left = max(0.0, squares - 2 * beta @ right + beta @ full @ beta)
                found.append(beta.tolist())
                spread.append(math.sqrt(left / (n - 1)) if n > 1 else None)
            kept = [batch.column(c) for c in ("series", "n", "first_day", "last_day")]
            yield pa.RecordBatch.from_arrays(
                [*kept, pa.array(found, pa.list_(pa.float64())), pa.array(spread, pa.float64())],
                ["series", "n", "first_day", "last_day", "coefficients", "deviation"],
            )

    declared = "series string, n long, first_day date, last_day date, coefficients array<double>, deviation double"
    return equations(series, waves).mapInArrow(task, declared)


def _weighted(coefficients: Column, day: Column, waves: int, chosen: range | None = None) -> Column:
    x = terms(day, waves)
    return sum((coefficients[i] * x[i] for i in chosen or range(len(x))), F.lit(0.0))


def predict(days: DataFrame, model: DataFrame, waves: int = WAVES, interval: float = 0.8) -> DataFrame:
    """``days`` (series, ds, ...) with trend, yearly and weekly parts, forecast and band."""
    beta, day = F.col("coefficients"), F.col("ds")
    z = NormalDist().inv_cdf(0.5 + interval / 2)
    rows = days.join(model.select("series", "coefficients", "deviation"), "series")
    rows = rows.withColumns({
        "trend": _weighted(beta, day, waves, range(2)),
        "yearly": _weighted(beta, day, waves, range(2, 2 + 2 * waves)),
        "weekly": _weighted(beta, day, waves, range(2 + 2 * waves, n_terms(waves))),
    }).withColumn("yhat", F.col("trend") + F.col("yearly") + F.col("weekly"))
    margin = z * F.col("deviation")
    return rows.withColumns({"yhat_lower": F.col("yhat") - margin, "yhat_upper": F.col("yhat") + margin}).drop("coefficients", "deviation")


def future(model: DataFrame, horizon: int = 365) -> DataFrame:
    """(series, ds): the days after the last known one of each series."""
    return model.select("series", F.explode(F.sequence(F.date_add("last_day", 1), F.date_add("last_day", horizon))).alias("ds"))


def holdout(series: DataFrame, train_end: str, waves: int = WAVES) -> DataFrame:
    """series, days, mean absolute error of the forecast on the days after ``train_end``, and that of the
    plain mean of the days up to it."""
    cut = F.to_date(F.lit(train_end))
    known = series.where(F.col("ds") <= cut)
    model = fit(known, waves)
    plain = known.groupBy("series").agg(F.avg("y").alias("_mean"))
    rows = predict(series.where(F.col("ds") > cut), model, waves).join(plain, "series")
    return rows.groupBy("series").agg(
        F.count("y").alias("days"), F.avg(F.abs(F.col("y") - F.col("yhat"))).alias("mae"), F.avg(F.abs(F.col("y") - F.col("_mean"))).alias("mae_of_mean")
    )
