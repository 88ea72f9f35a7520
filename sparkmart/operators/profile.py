"""Column profiles. Each one is a constant number of passes, whatever the number of columns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkmart.functions import expr
from sparkmart.operators import clean


def nulls(df: DataFrame) -> DataFrame:
    """(column, nulls, pct) for every column, from one aggregate."""
    counts = df.agg(
        F.count(F.lit(1)).alias("_rows"),
        *[F.count_if(F.col(c).isNull()).alias(c) for c in df.columns],
    )
    return counts.unpivot("_rows", df.columns, "column", "nulls").select(
        "column", "nulls", expr.ratio("nulls", "_rows", 100.0, 2).alias("pct")
    )


def duplicates(df: DataFrame, keys: Sequence[str] | None = None) -> DataFrame:
    """(total_rows, distinct_rows, duplicates, pct) over whole rows or over ``keys``."""
    groups = df.groupBy(*(keys or df.columns)).agg(F.count(F.lit(1)).alias("_n"))
    return groups.agg(
        F.coalesce(F.sum("_n"), F.lit(0)).alias("total_rows"),
        F.count(F.lit(1)).alias("distinct_rows"),
    ).select(
        "total_rows",
        "distinct_rows",
        (F.col("total_rows") - F.col("distinct_rows")).alias("duplicates"),
        expr.ratio(F.col("total_rows") - F.col("distinct_rows"), "total_rows", 100.0, 2).alias("pct"),
    )


def numeric(df: DataFrame, k: float = 3.0) -> DataFrame:
    """(column, min, max, avg, stddev, outliers) for every numeric column that has a value."""
    columns = expr.numeric_columns(df)
    bounds = clean.outlier_bounds(df, columns, k)
    stats = df.agg(
        *[
            F.struct(
                F.lit(c).alias("column"),
                F.min(c).cast("double").alias("min"),
                F.max(c).cast("double").alias("max"),
                expr.rnd(F.avg(c), 2).alias("avg"),
                expr.rnd(F.stddev(c), 2).alias("stddev"),
                F.count_if(F.col(c) > bounds.getField(c)).alias("outliers"),
            ).alias(c)
            for c in columns
        ]
    )
    return stats.select(F.inline(F.array(*columns))).where(F.col("avg").isNotNull())


def values(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column, value, count, pct) per distinct value, NULL included, from one scan."""
    total = df.agg(F.count(F.lit(1))).scalar()
    long = df.select(*[F.col(c).cast("string").alias(c) for c in columns]).unpivot(
        [], list(columns), "column", "value"
    )
    counts = long.groupBy("column", "value").agg(F.count(F.lit(1)).alias("count"))
    return counts.withColumn("pct", expr.ratio("count", total, 100.0, 1))
