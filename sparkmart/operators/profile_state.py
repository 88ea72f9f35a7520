"""Profiles that add up: one small summary of each load, from which the profile of any set of loads and
the drift between loads are read without the rows.

A summary has one row for each column: rows, NULLs, and for numbers values, least, greatest, mean and
sum of squared differences from it. Those of several loads combine exactly (counts, extremes) or as one
pass would have it but for rounding (mean, deviation, by the pairwise rule, which loses nothing to large
means). Three more parts have stated bounds:

* distinct values: a HyperLogLog sketch of 2 ** ``DISTINCT_BITS`` registers, a relative standard error
  of 1.04 / sqrt(registers) = 1.6 %;
* quantiles of numbers: a KLL sketch with k = ``QUANTILE_K``, a rank error below 1.65 % for one quantile
  with 99 % certainty, which merging does not raise;
* frequent values: every value with more than 1 / ``FREQUENT`` of a load's rows, with its exact count
  there; at most ``FREQUENT`` of each column. Merged counts are too small by no more than 1 / ``FREQUENT``
  of all rows, and every value with a larger share than that is listed.

NaN counts as no value. Tables without rows have summaries of zeros.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkmart.functions import expr

DISTINCT_BITS, QUANTILE_K, FREQUENT, TRACKED = 12, 200, 64, 1024
SCHEMA = (
    "column string, rows long, nulls long, values long, least double, greatest double, mean double,"
    " squares double, distinct binary, quantiles binary, frequent array<struct<value:string,count:long>>"
)


def _totals(df: DataFrame, part: str | None = None) -> DataFrame:
    """All numbers and sketches of each column in one pass, and in ``often`` the hash of each value that may
    be frequent.

    The sketch of frequent items tracks ``TRACKED`` hashes or more, so its counts are too large by less than
    4 / ``TRACKED`` of the rows and never too small: it misses no frequent value, and adds few.
    """
    columns = [c for c in df.columns if c != part]
    numbers = set(expr.numeric_columns(df))
    load = F.lit(None).cast("string") if part is None else F.col(f"`{part}`").cast("string")
    # Texts are made once for both sketches.
    texts = [F.col(f"`{c}`").cast("string").alias(f"t{k}") for k, c in enumerate(columns)]
    df = df.select(load.alias("load"), *(F.col(f"`{c}`").alias(f"v{k}") for k, c in enumerate(columns)), *texts)
    parts = []
    for k, c in enumerate(columns):
        key = F.when(F.col(f"t{k}").isNotNull(), F.xxhash64(f"t{k}"))
        value = F.nanvl(F.col(f"v{k}").cast("double"), F.lit(None)) if c in numbers else F.lit(None).cast("double")
        parts.append(
            F.struct(
                F.lit(c).alias("column"),
                F.count(F.lit(1)).alias("rows"),
                F.count_if(F.col(f"v{k}").isNull()).alias("nulls"),
                F.count(value).alias("values"),
                F.min(value).alias("least"),
                F.max(value).alias("greatest"),
                F.avg(value).alias("mean"),
                (F.var_pop(value) * F.count(value)).alias("squares"),
                F.hll_sketch_agg(f"t{k}", F.lit(DISTINCT_BITS)).alias("distinct"),
                (F.kll_sketch_agg_double(value, F.lit(QUANTILE_K)) if c in numbers else F.lit(None).cast("binary")).alias("quantiles"),
                F.call_function("approx_top_k", key, F.lit(2 * FREQUENT), F.lit(TRACKED)).alias("often"),
            ).alias(f"c{k}")
        )
    totals = df.groupBy(*([] if part is None else ["load"])).agg(*parts)
    of = F.inline(F.array(*(f"c{k}" for k in range(len(parts)))))
    totals = totals.select(of, load.alias("load") if part is None else "load")
    often = F.filter("often", lambda x: x["item"].isNotNull() & (x["count"] * FREQUENT > F.col("rows")))
    return totals.withColumn("often", F.transform(often, lambda x: x["item"]))


def _with_frequent(totals: DataFrame, df: DataFrame, part: str | None = None) -> DataFrame:
    """``totals`` with the exact counts of the frequent values, by a second pass over the rows."""
    columns = [c for c in df.columns if c != part]
    load = F.lit(None).cast("string") if part is None else F.col(f"`{part}`").cast("string")
    long = df.select(load.alias("_load"), *(F.col(f"`{c}`").cast("string").alias(f"v{k}") for k, c in enumerate(columns)))
    pairs = F.array(*(F.struct(F.lit(c).alias("_column"), F.col(f"v{k}").alias("value")) for k, c in enumerate(columns)))
    often = totals.select(F.col("load").alias("_of"), F.col("column").alias("_in"), "rows", F.explode("often").alias("_key"))
    same = (F.col("_column") == F.col("_in")) & (F.xxhash64("value") == F.col("_key")) & F.col("_load").eqNullSafe(F.col("_of"))
    counts = long.select("_load", F.inline(pairs)).where(F.col("value").isNotNull()).join(F.broadcast(often), same)  # at most the size of the result
    counts = counts.groupBy("_load", "_column", "value").agg(F.count(F.lit(1)).alias("count"), F.first("rows").alias("rows"))
    counts = counts.where(F.col("count") * FREQUENT > F.col("rows")).groupBy("_load", "_column")
    counts = counts.agg(F.sort_array(F.collect_list(F.struct("value", "count"))).alias("frequent"))  # at most FREQUENT
    out = totals.join(counts, (F.col("column") == F.col("_column")) & F.col("load").eqNullSafe(F.col("_load")), "left")
    empty = F.array().cast("array<struct<value:string,count:long>>")
    out = out.withColumn("frequent", F.coalesce("frequent", empty))
    return out.select(*(f.split()[0] for f in SCHEMA.split(", ")), "load")


def summary(df: DataFrame) -> DataFrame:
    """One row for each column of a load: one pass for all numbers and sketches, one for frequent values
    (and one more for what these may be, unless the totals are kept, as ``save`` does)."""
    return _with_frequent(_totals(df), df).drop("load")


def save(df: DataFrame, folder: str, load: str) -> None:
    """Keep the summary of a load; a load that comes again replaces its own. The rows are read twice."""
    totals = _totals(df).persist()
    try:
        _write(_with_frequent(totals, df).drop("load"), folder, load)
    finally:
        totals.unpersist()


def save_loads(df: DataFrame, folder: str, part: str, loads: Sequence[str]) -> None:
    """Keep the summaries of several loads, each as ``save`` would, from two passes over the rows of all.

    ``part`` is the column that names the load, as text; it is not profiled.
    """
    if not loads:
        return
    rows = df.where(F.col(f"`{part}`").cast("string").isin(*loads))
    totals = _totals(rows, part).persist()
    every = _with_frequent(totals, rows, part).persist()
    try:
        found = {r.load for r in every.select("load").distinct().collect()}
        for load in loads:
            if load in found:
                _write(every.where(F.col("load") == load).drop("load"), folder, load)
            else:
                save(df.drop(part).where(F.lit(False)), folder, load)
    finally:
        every.unpersist()
        totals.unpersist()


def _write(rows: DataFrame, folder: str, load: str) -> None:
    rows.coalesce(1).write.mode("overwrite").parquet(f"{folder.rstrip('/')}/load={load}")


def saved(spark: SparkSession, folder: str, loads: Sequence[str] | None = None) -> DataFrame:
    """Summaries of all loads below a folder, or of some; ``load`` names theirs."""
    rows = spark.read.schema(SCHEMA + ", load string").parquet(folder)
    return rows.where(F.col("load").isin(*loads)) if loads is not None else rows


def merged(summaries: DataFrame) -> DataFrame:
    """The summary of all given loads together."""
    total = summaries.groupBy("column").agg(
        F.sum("rows").alias("rows"), F.sum("nulls").alias("nulls"), F.sum("values").alias("values"),
        F.min("least").alias("least"), F.max("greatest").alias("greatest"),
        (F.sum(F.col("mean") * F.col("values")) / F.nullif(F.sum("values"), F.lit(0))).alias("mean"),
        F.hll_union_agg("distinct").alias("distinct"),
        F.kll_merge_agg_double("quantiles").alias("quantiles"),
        F.max(F.col("quantiles").isNotNull()).alias("_numeric"),
    )
    centres = total.select(F.col("column").alias("_column"), F.col("mean").alias("_mean"))
    apart = summaries.join(centres, F.col("column") == F.col("_column"))
    apart = apart.groupBy("_column").agg(F.sum(F.col("squares") + F.col("values") * (F.col("mean") - F.col("_mean")) ** 2).alias("squares"))
    often = summaries.select("column", F.inline("frequent")).groupBy("column", "value").agg(F.sum("count").alias("count"))
    often = often.groupBy(F.col("column").alias("_often")).agg(F.sort_array(F.collect_list(F.struct("value", "count"))).alias("frequent"))
    out = total.join(apart, F.col("column") == F.col("_column")).join(often, F.col("column") == F.col("_often"), "left")
    empty = F.array().cast("array<struct<value:string,count:long>>")
    out = out.withColumns({"quantiles": F.when(F.col("_numeric"), F.col("quantiles")), "frequent": F.coalesce("frequent", empty)})
    return out.select(*(f.split()[0] for f in SCHEMA.split(", ")))


def profile(summaries: DataFrame, points: Sequence[float] = (0.25, 0.5, 0.75)) -> DataFrame:
    """column, rows, nulls, null_pct, min, max, avg, stddev, distinct (estimate), quantiles (estimates), and
    the frequent values of the given loads."""
    rows = merged(summaries)
    deviation = F.sqrt(F.col("squares") / F.nullif(F.col("values") - 1, F.lit(0)))
    at = [F.when(F.col("values") > 0, F.kll_sketch_get_quantile_double("quantiles", F.lit(float(p)))) for p in points]
    return rows.select(
        "column", "rows", "nulls", expr.ratio("nulls", "rows", 100.0, 2).alias("null_pct"),
        F.col("least").alias("min"), F.col("greatest").alias("max"), expr.rnd("mean", 2).alias("avg"), expr.rnd(deviation, 2).alias("stddev"),
        F.hll_sketch_estimate("distinct").alias("distinct"), F.when(F.col("values") > 0, F.array(*at)).alias("quantiles"), "frequent",
    )


def drift(before: DataFrame, after: DataFrame, points: int = 50) -> DataFrame:
    """How far the loads of ``after`` moved from those of ``before``, column by column, from summaries alone:
    the change of the NULL share, of the mean in deviations of ``before``, the ratio of distinct values, the
    greatest difference of ranks at the quantiles of ``after`` (to within 1 / ``points``), and half the
    difference of frequent shares."""
    a, b = merged(before), merged(after)
    b = b.select(*(F.col(c).alias(f"b_{c}") for c in b.columns))
    both = a.join(b, F.col("column") == F.col("b_column"))
    share = lambda p: F.col(f"{p}nulls") / F.nullif(F.col(f"{p}rows"), F.lit(0))
    spread = F.nullif(F.sqrt(F.col("squares") / F.nullif(F.col("values") - 1, F.lit(0))), F.lit(0.0))
    numeric = (F.col("values") > 0) & (F.col("b_values") > 0)
    at = lambda p: F.array(*(F.kll_sketch_get_quantile_double(f"{p}quantiles", F.lit(k / points)) for k in range(1, points)))
    both = both.withColumns({"_a": F.when(numeric, at("")), "_b": F.when(numeric, at("b_"))})

    def off(value: Column, k: Column) -> Column:
        """How far the share of a quantile of ``after`` lies outside the shares of that value in ``before``."""
        under = F.size(F.filter("_a", lambda x: x < value))
        upto = F.size(F.filter("_a", lambda x: x <= value))
        return F.greatest(F.lit(0), under - (k + 1), (k + 1) - (upto + 1)) / points

    part = lambda p, sign: F.transform(f"{p}frequent", lambda x: F.struct(x["value"].alias("v"), (sign * x["count"] / F.col(f"{p}rows")).alias("s")))
    mixed = both.select(
        "column",
        (share("b_") - share("")).alias("null_share_change"),
        ((F.col("b_mean") - F.col("mean")) / spread).alias("mean_shift"),
        (F.hll_sketch_estimate("b_distinct") / F.nullif(F.hll_sketch_estimate("distinct"), F.lit(0))).alias("distinct_ratio"),
        F.array_max(F.transform("_b", off)).alias("rank_distance"),
        F.concat(part("b_", F.lit(1.0)), part("", F.lit(-1.0))).alias("_shares"),
    )
    shares = mixed.select("column", F.inline_outer("_shares")).groupBy("column", "v").agg(F.sum("s").alias("s"))
    shares = shares.groupBy(F.col("column").alias("_c")).agg((F.sum(F.abs("s")) / 2).alias("frequent_change"))
    out = mixed.drop("_shares").join(shares, F.col("column") == F.col("_c")).drop("_c")
    return out.withColumn("frequent_change", F.coalesce("frequent_change", F.lit(0.0)))
