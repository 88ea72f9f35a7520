"""Daily demand forecasts for any number of series.

Trend, weekly and yearly effects are closed-form aggregates over each series' days, written as
windows on one shuffle by series. A window partition holds the days of one series (a few thousand
rows however large the source), because counting per day comes first.
"""

from __future__ import annotations

from statistics import NormalDist

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sparkmart.functions import expr


def daily_counts(
    df: DataFrame, date_col: str, by: str | None = None, zero_fill: bool = False
) -> DataFrame:
    """(series, ds, y): rows per day; days without rows appear only with ``zero_fill``."""
    series = F.col(by).cast("string") if by else F.lit("all")
    counts = (
        df.where(F.col(date_col).isNotNull())
        .groupBy(series.alias("series"), F.to_date(date_col).alias("ds"))
        .agg(F.count(F.lit(1)).cast("double").alias("y"))
    )
    if not zero_fill:
        return counts
    # Each day also stands for the empty days up to the next one: no second pass, no join.
    following = F.lead("ds").over(Window.partitionBy("series").orderBy("ds"))
    until = F.coalesce(F.date_sub(following, 1), F.col("ds"))
    return (
        counts.withColumn("_until", until)
        .withColumn("_day", F.explode(F.sequence("ds", "_until")))
        .select(
            "series",
            F.col("_day").alias("ds"),
            F.when(F.col("_day") == F.col("ds"), F.col("y")).otherwise(F.lit(0.0)).alias("y"),
        )
    )


def split(series: DataFrame, train_end: Column | str) -> tuple[DataFrame, DataFrame]:
    """Days up to and including ``train_end``, and the days after it."""
    cut = F.to_date(F.lit(train_end)) if isinstance(train_end, str) else train_end
    return series.where(F.col("ds") <= cut), series.where(F.col("ds") > cut)


def fit_predict(
    series: DataFrame,
    horizon: int = 365,
    weekly: bool = True,
    yearly: bool = True,
    interval: float = 0.8,
) -> DataFrame:
    """History plus ``horizon`` days: trend, weekly and yearly effect, forecast and band.

    ``yhat = trend + weekly + yearly``: a least-squares line, the mean residual per weekday, and
    the mean remaining residual per calendar month. The last day of a series is expanded into the
    future days, whose ``y`` is unknown and ignored by aggregates, so fitting and predicting are
    the same pass over one shuffle.
    """
    by_series = Window.partitionBy("series")
    is_last = F.col("ds") == F.max("ds").over(by_series)
    expanded = F.when(is_last, F.sequence("ds", F.date_add("ds", horizon))).otherwise(F.array("ds"))
    known = F.when(F.col("_day") == F.col("ds"), F.col("y").cast("double"))
    rows = (
        series.select("series", "ds", "y")
        .withColumn("_days", expanded)
        .withColumn("_day", F.explode("_days"))
        .select("series", F.col("_day").alias("ds"), known.alias("y"))
    )

    return _fit(rows, weekly, yearly, interval)


def backtest(
    series: DataFrame,
    train_end: Column | str,
    horizon: int = 365,
    weekly: bool = True,
    yearly: bool = True,
    interval: float = 0.8,
) -> DataFrame:
    """Days after ``train_end`` next to the forecast of a fit on the days up to it, with errors.

    The same figures as ``evaluate`` of ``split`` and ``fit_predict``, in one pass and without a
    join: days after the cut stay in the frame, but their counts are hidden from the fit.
    """
    cut = F.to_date(F.lit(train_end)) if isinstance(train_end, str) else train_end
    by_series = Window.partitionBy("series")
    trained = F.col("ds") <= cut
    rows = series.select(
        "series",
        "ds",
        F.when(trained, F.col("y").cast("double")).alias("y"),
        F.col("y").alias("_actual"),
        F.max(F.when(trained, F.col("ds"))).over(by_series).alias("_last"),
    )
    within = F.col("ds") <= F.date_add("_last", horizon)
    fitted = _fit(rows, weekly, yearly, interval, keep=("_actual", "_last")).where(~trained)
    figures = [F.when(within, F.col(c)).alias(c) for c in ("yhat", "yhat_lower", "yhat_upper")]
    return _with_errors(fitted.select("series", "ds", F.col("_actual").alias("y"), *figures))


def _fit(
    rows: DataFrame, weekly: bool, yearly: bool, interval: float, keep: tuple[str, ...] = ()
) -> DataFrame:
    """Components and band for every day; days whose ``y`` is NULL take no part in the fit."""
    by_series = Window.partitionBy("series")
    zero = F.lit(0.0)
    y, x, trend = F.col("y"), F.col("_x").cast("double"), F.col("trend")
    slope = F.coalesce(F.regr_slope(y, x).over(by_series), zero)
    center_y, center_x = F.avg(y).over(by_series), F.avg(F.when(y.isNotNull(), x)).over(by_series)
    by_weekday = Window.partitionBy("series", F.dayofweek("ds"))
    by_month = Window.partitionBy("series", F.month("ds"))
    week_effect = F.coalesce(F.avg(y - trend).over(by_weekday), zero) if weekly else zero
    left_over = y - trend - F.col("weekly")
    year_effect = F.coalesce(F.avg(left_over).over(by_month), zero) if yearly else zero
    z = NormalDist().inv_cdf(0.5 + interval / 2)
    margin = F.lit(z) * F.stddev(y - F.col("yhat")).over(by_series)
    return (
        rows.withColumn("_x", F.datediff("ds", F.min("ds").over(by_series)))
        .withColumns({"_slope": slope, "_cy": center_y, "_cx": center_x})
        .withColumn("trend", F.col("_cy") + F.col("_slope") * (x - F.col("_cx")))
        .withColumn("weekly", week_effect)
        .withColumn("yearly", year_effect)
        .withColumn("yhat", trend + F.col("weekly") + F.col("yearly"))
        .withColumn("_margin", margin)
        .select(
            "series",
            "ds",
            "y",
            "trend",
            "weekly",
            "yearly",
            "yhat",
            (F.col("yhat") - F.col("_margin")).alias("yhat_lower"),
            (F.col("yhat") + F.col("_margin")).alias("yhat_upper"),
            *keep,
        )
    )


def evaluate(actual: DataFrame, forecast: DataFrame) -> DataFrame:
    """Actual days next to their forecast, with errors."""
    predicted = forecast.select("series", "ds", "yhat", "yhat_lower", "yhat_upper")
    return _with_errors(actual.select("series", "ds", "y").join(predicted, ["series", "ds"], "left"))


def _with_errors(rows: DataFrame) -> DataFrame:
    error = F.col("y") - F.col("yhat")
    return rows.withColumns(
        {
            "error": error,
            "abs_error": F.abs(error),
            "pct_error": expr.ratio(F.abs(error), "y", 100.0),
            "squared_error": error * error,
        }
    )


def accuracy(evaluation: DataFrame) -> DataFrame:
    return evaluation.groupBy("series").agg(
        F.count("abs_error").alias("days"),
        expr.rnd(F.avg("pct_error"), 4).alias("mape"),
        expr.rnd(F.sqrt(F.avg("squared_error")), 4).alias("rmse"),
        expr.rnd(F.avg("abs_error"), 4).alias("mae"),
    )


def monthly_accuracy(evaluation: DataFrame) -> DataFrame:
    actual, predicted = F.sum("y"), F.sum("yhat")
    return evaluation.groupBy("series", F.date_format("ds", "yyyy-MM").alias("month")).agg(
        expr.rnd(actual, 4).alias("actual_total"),
        expr.rnd(predicted, 4).alias("forecast_total"),
        expr.rnd(F.avg("abs_error"), 4).alias("mae"),
        expr.rnd(F.avg("pct_error"), 4).alias("mape"),
        expr.rnd(actual - predicted, 4).alias("variance"),
        expr.ratio(actual - predicted, actual, 100.0, 4).alias("variance_pct"),
    )


def best_worst(monthly: DataFrame) -> DataFrame:
    """Months with the smallest and largest MAPE per series; ties go to the earlier month."""
    known = monthly.where(F.col("mape").isNotNull())
    best = F.min(F.struct("mape", "month"))
    worst = F.min(F.struct((-F.col("mape")).alias("minus_mape"), "month"))
    return known.groupBy("series").agg(
        best.getField("month").alias("best_month"),
        best.getField("mape").alias("best_mape"),
        worst.getField("month").alias("worst_month"),
        (-worst.getField("minus_mape")).alias("worst_mape"),
    )


def _published(c: str) -> Column:
    """Not below zero, two digits; NULL stays NULL."""
    return expr.rnd(F.when(F.col(c) < 0, F.lit(0.0)).otherwise(F.col(c)), 2)


def publish(
    forecast: DataFrame, version: str, trained_through: Column | str, created_at: Column | str
) -> DataFrame:
    """Serving rows after the training cut, with lineage columns."""
    cut = F.to_date(F.lit(trained_through)) if isinstance(trained_through, str) else trained_through
    created = F.lit(created_at) if isinstance(created_at, str) else created_at
    return forecast.where(F.col("ds") > cut).select(
        "series",
        F.col("ds").alias("forecast_date"),
        _published("yhat").alias("predicted_applications"),
        _published("yhat_lower").alias("predicted_lower"),
        _published("yhat_upper").alias("predicted_upper"),
        F.lit(version).alias("model_version"),
        cut.alias("trained_through"),
        created.cast("timestamp_ntz").alias("created_at"),
    )
