"""Every registered query against its DuckDB oracle on the smallest data set."""

import pytest
from compare import differences, duck

import __spark_entry__ as entry

SF = "/root/testdata/sf0.001"
QUERIES = {k: q for k, q in entry.queries().items() if k not in entry.EXTRA_QUERIES}
ORACLE = {k: q for k, q in entry.oracle_sql().items() if k not in entry.EXTRA_SQL}


@pytest.fixture(scope="module")
def con():
    return duck(SF)


def test_every_query_has_an_oracle():
    assert QUERIES.keys() == ORACLE.keys()


def _assert_scalable(plan):
    """No cross join, and a single partition only for the last step of a global aggregate."""
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    lines = plan.splitlines()
    for line, below in zip(lines, lines[1:]):
        if "Exchange SinglePartition" in line:
            assert "Aggregate" in below, below


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_matches_oracle(spark, con, name):
    df = QUERIES[name](spark, SF)
    assert differences(name, df, con, ORACLE[name]) is None
    _assert_scalable(df._jdf.queryExecution().executedPlan().toString())


def test_entry(spark):
    assert entry.entry(spark).count() == 20
