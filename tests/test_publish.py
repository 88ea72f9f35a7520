"""A version is served only after its checks have passed."""

import pytest

from sparkmart.operators.dq import Check
from sparkmart.plans import publish
from sparkmart.plans.models import Model

MODELS = {
    "dim_x": Model(("raw_x",), lambda x: x.select("k", "name")),
    "fct_y": Model(("raw_y", "dim_x"), lambda y, x: y.join(x, "k", "left")),
    "mart_z": Model(("fct_y",), lambda y: y.groupBy("name").count()),
}
SUITE = [Check("dim_x", "k", "unique"), Check("dim_x", "name", "not_null"), Check("fct_y", "k", "relationships", ("dim_x", "k")), Check("mart_z", "count", "not_null")]
VIEWS = {"srv_z": ("mart_z", "Rows by name")}


@pytest.fixture
def entities(spark):
    def make(xs, ys):
        return {"raw_x": spark.createDataFrame(xs, "k long, name string"), "raw_y": spark.createDataFrame(ys, "k long, v long")}

    return make


def served(spark):
    return {(r.name, r["count"]) for r in spark.read.table("served.srv_z").collect()}


def test_a_failing_check_leaves_the_served_views(spark, entities):
    good = entities([(1, "a"), (2, "b")], [(1, 5), (1, 6), (2, 7)])
    one = publish.run(spark, good, MODELS, SUITE, "served", "2024-01-01", views=VIEWS)
    assert one.passed and one.counts == {"dim_x": 2, "fct_y": 3, "mart_z": 2} and served(spark) == {("a", 2), ("b", 1)}
    bad = entities([(1, "a"), (1, "c"), (2, None)], [(1, 5), (3, 9)])
    two = publish.run(spark, bad, MODELS, SUITE, "served", "2024-01-02", views=VIEWS)
    assert not two.passed
    assert two.failed == (("dim_x", "k", "unique", 1), ("dim_x", "name", "not_null", 1), ("fct_y", "k", "relationships", 1))
    assert served(spark) == {("a", 2), ("b", 1)} and spark.read.table("served.dim_x").count() == 2
    assert spark.read.table(f"{two.database}.{publish.REPORT}").count() == len(SUITE)
    # The same version again, mended.
    again = publish.run(spark, entities([(1, "a"), (2, "c")], [(1, 5), (2, 9), (2, 8)]), MODELS, SUITE, "served", "2024-01-02", views=VIEWS)
    assert again.passed and served(spark) == {("a", 1), ("c", 2)}
    publish.publish(spark, "served", "2024-01-01", list(one.counts), VIEWS)  # back to the version before
    assert served(spark) == {("a", 2), ("b", 1)}


def test_a_run_lost_before_its_audit_can_be_repeated(spark, entities):
    some = entities([(1, "a")], [(1, 5)])
    publish.run(spark, some, MODELS, SUITE, "served", "2024-02-01", views=VIEWS)
    before = served(spark)
    publish.write(spark, entities([(1, "q")], [(1, 5), (1, 5)]), MODELS, "served", "2024-02-02")  # lost here
    assert served(spark) == before == {("a", 1)}
    assert publish.run(spark, entities([(1, "q")], [(1, 5), (1, 5)]), MODELS, SUITE, "served", "2024-02-02", views=VIEWS).passed
    assert served(spark) == {("q", 2)}
