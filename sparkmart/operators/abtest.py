"""Experiment statistics from one aggregate per experiment; no observation leaves its task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkmart.functions import expr, stats

RESULT_COLUMNS = [
    "experiment", "method", "control_value", "treatment_value", "relative_lift_pct", "p_value",
    "significant",
]


def summary(df: DataFrame, by: str, group: str, outcome: str) -> DataFrame:
    """Successes, sample size and rate per experiment and arm; a NULL outcome is not observed."""
    return df.groupBy(by, group).agg(
        F.sum(outcome).cast("bigint").alias("successes"),
        F.count(outcome).alias("n"),
        expr.rnd(F.avg(outcome), 4).alias("rate"),
    )


def _arms(
    df: DataFrame, by: str, group: str, outcome: str, control: object, treatment: object
) -> DataFrame:
    """One row per experiment: size, mean and variance of both arms."""
    value = F.col(outcome).cast("double")
    measures = []
    for name, label in (("control", control), ("treatment", treatment)):
        arm = F.when(F.col(group) == label, value)
        measures += [
            F.count(arm).alias(f"n_{name}"),
            F.avg(arm).alias(f"m_{name}"),
            F.var_samp(arm).alias(f"v_{name}"),
        ]
    return df.groupBy(F.col(by).alias("experiment")).agg(*measures)


def _over(numerator: Column, denominator: Column) -> Column:
    return numerator / F.nullif(denominator, F.lit(0.0))


def proportions(
    df: DataFrame,
    by: str,
    group: str = "group",
    outcome: str = "outcome",
    control: object = "control",
    treatment: object = "treatment",
    alpha: float = 0.05,
    exact: bool = False,
) -> DataFrame:
    """Two-proportion z-test per experiment; ``exact`` adds the difference as it is, not rounded.

    The statistic uses the pooled standard error, the confidence interval the unpooled one. Without
    any variation (all successes or none) the statistic is NULL.
    """
    p0, p1 = F.col("m_control"), F.col("m_treatment")
    n0, n1 = F.col("n_control"), F.col("n_treatment")
    pooled = _over(p0 * n0 + p1 * n1, (n0 + n1).cast("double"))
    se_pooled = F.sqrt(pooled * (1 - pooled) * (F.lit(1.0) / n0 + F.lit(1.0) / n1))
    se = F.sqrt(p0 * (1 - p0) / n0 + p1 * (1 - p1) / n1)
    margin = F.lit(stats.z_crit(alpha)) * se
    both = (n0 > 0) & (n1 > 0)
    return (
        _arms(df, by, group, outcome, control, treatment)
        .withColumn("_z", F.when(both, _over(p1 - p0, se_pooled)))
        .withColumn("_p", stats.two_sided_p(F.col("_z")))
        .select(
            "experiment",
            "n_control",
            "n_treatment",
            expr.rnd(p0, 6).alias("control_value"),
            expr.rnd(p1, 6).alias("treatment_value"),
            expr.rnd((p1 - p0) * 100, 4).alias("lift_pp"),
            expr.rnd(_over(p1, p0) * 100 - 100, 4).alias("relative_lift_pct"),
            expr.rnd("_z", 6).alias("statistic"),
            expr.rnd("_p", 6).alias("p_value"),
            F.when(both, expr.rnd(p1 - p0 - margin, 6)).alias("ci_low"),
            F.when(both, expr.rnd(p1 - p0 + margin, 6)).alias("ci_high"),
            (F.col("_p") < alpha).alias("significant"),
            *_exact(p1 - p0, exact),
        )
    )


def _exact(difference: Column, wanted: bool) -> list[Column]:
    return [difference.alias("exact_difference")] if wanted else []


def means(
    df: DataFrame,
    by: str,
    group: str = "group",
    outcome: str = "outcome",
    control: object = "control",
    treatment: object = "treatment",
    alpha: float = 0.05,
    exact: bool = False,
) -> DataFrame:
    """Welch's t-test per experiment, with a normal confidence interval for the difference."""
    m0, m1 = F.col("m_control"), F.col("m_treatment")
    n0, n1 = F.col("n_control"), F.col("n_treatment")
    s0 = F.col("v_control") / F.nullif(n0, F.lit(0))
    s1 = F.col("v_treatment") / F.nullif(n1, F.lit(0))
    se = F.sqrt(s0 + s1)
    df_welch = _over(
        (s0 + s1) * (s0 + s1),
        s0 * s0 / F.nullif(n0 - 1, F.lit(0)) + s1 * s1 / F.nullif(n1 - 1, F.lit(0)),
    )
    margin = F.lit(stats.z_crit(alpha)) * se
    return (
        _arms(df, by, group, outcome, control, treatment)
        .withColumns({"_t": _over(m1 - m0, se), "_df": df_welch})
        .withColumn("_p", F.nanvl(stats.t_two_sided_p(F.col("_t"), F.col("_df")), F.lit(None)))
        .select(
            "experiment",
            "n_control",
            "n_treatment",
            expr.rnd(m0, 4).alias("control_value"),
            expr.rnd(m1, 4).alias("treatment_value"),
            expr.rnd(m1 - m0, 4).alias("difference"),
            expr.rnd(_over(m1 - m0, m0) * 100, 4).alias("relative_lift_pct"),
            expr.rnd("_t", 6).alias("statistic"),
            expr.rnd("_df", 4).alias("degrees_of_freedom"),
            expr.rnd("_p", 6).alias("p_value"),
            expr.rnd(m1 - m0 - margin, 4).alias("ci_low"),
            expr.rnd(m1 - m0 + margin, 4).alias("ci_high"),
            (F.col("_p") < alpha).alias("significant"),
            *_exact(m1 - m0, exact),
        )
    )


def required_n(
    df: DataFrame,
    by: str,
    outcome: str,
    mde: float,
    alpha: float = 0.05,
    power: float = 0.8,
    kind: str = "proportions",
) -> DataFrame:
    """Sample size per arm for each segment, from the segment's own baseline.

    Proportions use Cohen's h of the arcsine-transformed rates, means use d = mde / sigma with the
    usual correction of the normal approximation for estimating sigma.
    """
    z = stats.z_crit(alpha) + stats.z_power(power)
    value = F.col(outcome).cast("double")
    base = df.groupBy(F.col(by).alias("segment")).agg(
        F.avg(value).alias("_mean"), F.stddev(value).alias("_sd")
    )
    if kind == "proportions":
        target = F.col("_mean") + mde
        raised = F.when(target <= 1, F.asin(F.sqrt(target)))
        effect = 2 * (raised - F.asin(F.sqrt("_mean")))
        extra = 0.0
    else:
        effect = _over(F.lit(float(mde)), F.col("_sd"))
        extra = stats.z_crit(alpha) ** 2 / 4
    size = 2 * (F.lit(z) / F.nullif(F.col("_effect"), F.lit(0.0))) ** 2 + F.lit(extra)
    per_arm = F.ceil(size).cast("bigint")
    return base.withColumn("_effect", effect).select(
        "segment",
        expr.rnd("_mean", 4).alias("baseline"),
        expr.rnd("_sd", 4).alias("std_dev"),
        expr.rnd("_effect", 6).alias("effect_size"),
        per_arm.alias("n_per_group"),
        (per_arm * 2).alias("n_total"),
    )


def as_result(test: DataFrame, method: str, prefix: str = "") -> DataFrame:
    """A test's rows in the layout shared by all methods, with the exact difference if it has one."""
    named = F.concat(F.lit(prefix), F.col("experiment").cast("string"))
    rounded = F.col("treatment_value") - F.col("control_value")
    exact = F.col("exact_difference") if "exact_difference" in test.columns else rounded
    return test.withColumns(
        {"experiment": named, "method": F.lit(method), "exact_difference": exact}
    ).select(*RESULT_COLUMNS, "exact_difference")


def report(results: DataFrame, assumptions: DataFrame) -> DataFrame:
    """Add the yearly effect: difference between the arms times value factor times periods.

    ``assumptions`` has one row per experiment: ``experiment, factor, periods``. The effect uses the
    tests' exact differences (``exact=True``); without them those of the rounded arms.
    """
    difference = F.col("treatment_value") - F.col("control_value")
    if "exact_difference" in results.columns:
        difference = F.coalesce("exact_difference", difference)
    impact = expr.rnd(difference * F.col("factor") * F.col("periods"), 2)
    return results.join(assumptions, "experiment", "left").select(
        *RESULT_COLUMNS, impact.alias("annual_impact")
    )
