"""Every registered query against its SQL twin, on the smallest tables."""

from __future__ import annotations

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from boxlake.plans.queries import QUERIES
from boxlake.plans.twins import TWINS
from tests.oracle import compare


def test_all_queries_have_twins():
    assert set(QUERIES) == set(TWINS)
    assert set(QUERIES) <= set(queries()) and set(TWINS) <= set(oracle_sql())


def test_entry(spark):
    assert entry(spark).count() > 0


@pytest.mark.parametrize("name", sorted(TWINS))
def test_twin(spark, duckdb_con, sf_dir, name):
    df = QUERIES[name](spark, sf_dir)
    plan = df._jdf.queryExecution().executedPlan().toString()
    for node in ("BatchEvalPython", "ArrowEvalPython", "PythonUDF", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert node not in plan
    problems, n, _, diff = compare(duckdb_con, df, TWINS[name])
    assert not problems, (problems, diff)
    assert n > 0
