import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from sparkmart.functions import stats
from sparkmart.operators import abtest


def test_normal_tail(spark):
    zs = [-8.0, -1.96, -0.3, 0.0, 0.5, 1.959963985, 3.0, 7.07, 7.08, 9.0, 20.0]
    df = spark.createDataFrame([(z,) for z in zs], "z double")
    for z, p in zip(zs, [r[0] for r in df.select(stats.norm_sf(F.col("z"))).collect()]):
        assert p == pytest.approx(0.5 * math.erfc(z / math.sqrt(2)), rel=1e-8)


def _t_tail(t, df, n=200000):
    """Numerical integral of the density, in x = tan(u)."""
    u = (np.arange(n) + 0.5) / n * (math.pi / 2 - math.atan(t)) + math.atan(t)
    x = np.tan(u)
    log_c = math.lgamma((df + 1) / 2) - math.lgamma(df / 2) - 0.5 * math.log(df * math.pi)
    f = np.exp(log_c - (df + 1) / 2 * np.log1p(x * x / df)) * (1 + x * x)
    return 2 * float(f.mean() * (math.pi / 2 - math.atan(t)))


@pytest.mark.parametrize("t,df", [(0.1, 1.5), (1.0, 3), (2.0, 10.7), (0.01, 5000), (2.5, 5000), (6.0, 40), (12.0, 8)])
def test_t_tail(t, df):
    got = stats.t_two_sided(np.array([t, -t]), np.array([df, df]))
    assert got[0] == got[1] == pytest.approx(_t_tail(t, df), rel=1e-6)


def test_t_limits():
    got = stats.t_two_sided(np.array([0.0, np.nan, 1.0]), np.array([5.0, 5.0, np.nan]))
    assert got[0] == 1.0 and np.isnan(got[1]) and np.isnan(got[2])
    assert stats.z_crit(0.05) == pytest.approx(1.959964, abs=1e-6)


def _arms(spark, control, treatment, name="e"):
    rows = [(name, "control", v) for v in control] + [(name, "treatment", v) for v in treatment]
    return spark.createDataFrame(rows, "experiment string, `group` string, outcome double")


def test_z_test(spark):
    df = _arms(spark, [1.0] * 220 + [0.0] * 780, [1.0] * 265 + [0.0] * 735 + [None] * 5)
    row = abtest.proportions(df, "experiment").first()
    pooled = 485 / 2000
    z = 0.045 / math.sqrt(pooled * (1 - pooled) * 2 / 1000)
    assert row.n_treatment == 1000 and row.statistic == pytest.approx(z, abs=1e-6)
    assert row.p_value == pytest.approx(math.erfc(z / math.sqrt(2)), abs=1e-6)
    se = math.sqrt(0.22 * 0.78 / 1000 + 0.265 * 0.735 / 1000)
    assert row.ci_low == pytest.approx(0.045 - 1.959964 * se, abs=1e-6)
    assert (row.lift_pp, row.relative_lift_pct, row.significant) == (4.5, 20.4545, True)


def test_z_test_without_variation(spark):
    row = abtest.proportions(_arms(spark, [0.0] * 5, [0.0] * 5), "experiment").first()
    assert row.statistic is None and row.p_value is None and row.relative_lift_pct is None
    assert row.significant is None
    one_arm = abtest.proportions(_arms(spark, [1.0, 0.0], []), "experiment").first()
    assert one_arm.statistic is None and one_arm.n_treatment == 0


def test_welch(spark):
    a, b = [1.0, 2.0, 3.0, 4.0, 5.0], [2.0, 4.0, 6.0, 9.0]
    row = abtest.means(_arms(spark, a, b), "experiment").first()
    va, vb = np.var(a, ddof=1) / 5, np.var(b, ddof=1) / 4
    t = (np.mean(b) - np.mean(a)) / math.sqrt(va + vb)
    nu = (va + vb) ** 2 / (va**2 / 4 + vb**2 / 3)
    assert row.statistic == pytest.approx(t, abs=1e-6)
    assert row.degrees_of_freedom == pytest.approx(nu, abs=1e-4)
    assert row.p_value == pytest.approx(_t_tail(t, nu), abs=1e-6)
    constant = abtest.means(_arms(spark, [1.0, 1.0], [1.0, 1.0]), "experiment").first()
    assert constant.statistic is None and constant.p_value is None and constant.significant is None


def test_required_sample_sizes(spark):
    """Published planning cases: 22 % + 3 pp, 4.2 % + 0.8 pp, and 700 on a deviation of 3100."""
    rates = spark.createDataFrame([("m", 1.0)] * 22 + [("m", 0.0)] * 78, "segment_id string, y double")
    n = abtest.required_n(rates, "segment_id", "y", mde=0.03).first()
    h = 2 * (math.asin(math.sqrt(0.25)) - math.asin(math.sqrt(0.22)))
    assert n.n_per_group == math.ceil(2 * (2.801585 / h) ** 2) and n.n_total == 2 * n.n_per_group
    spread = 3100 / math.sqrt(2)
    means = spark.createDataFrame([("m", 9200 - spread), ("m", 9200 + spread)], "segment_id string, y double")
    assert abtest.required_n(means, "segment_id", "y", mde=700, kind="means").first().n_per_group == 309
    sure = abtest.required_n(rates.where("y = 1"), "segment_id", "y", mde=0.03).first()
    assert sure.n_per_group is None


def test_report_uses_the_computed_significance(spark):
    df = _arms(spark, [1.0] * 10 + [0.0] * 10, [1.0] * 11 + [0.0] * 9)
    results = abtest.as_result(abtest.proportions(df, "experiment"), "Z-test", "x-")
    assumptions = spark.createDataFrame([("x-e", 2.0, 12)], "experiment string, factor double, periods int")
    row = abtest.report(results, assumptions).first()
    assert row.experiment == "x-e" and row.significant is False
    assert row.annual_impact == pytest.approx(0.05 * 2 * 12)
