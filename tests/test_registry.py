"""Every registered query with SQL, compared at the smallest scale."""

import pytest

import __spark_entry__ as entry
from tools.check import compare, connect
from wardlog.checks import registry

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def tables():
    return connect(SF)


def test_every_query_has_sql():
    assert set(registry.QUERIES) == set(registry.ORACLES)
    assert set(entry.oracle_sql()) >= set(registry.ORACLES)


@pytest.mark.parametrize("name", sorted(registry.ORACLES))
def test_against_sql(spark, tables, name):
    seen = []

    def run(session, folder):
        seen.append(entry.queries()[name](session, folder))
        return seen[0]

    ok, _, n, note = compare(spark, tables, SF, name, run, entry.oracle_sql()[name])
    assert ok, note
    plan = seen[0]._jdf.queryExecution().executedPlan().toString()
    for operator in ("CartesianProduct", "NestedLoopJoin", "PythonUDF", "EvalPython", "InPandas", "InArrow"):
        assert operator not in plan, operator


def test_entry(spark):
    rows = entry.entry(spark).collect()
    assert [r["threat_level"] for r in sorted(rows, key=lambda r: r["count"])] == ["high", "medium", "low"]
    assert sorted(r["count"] for r in rows) == [29, 157, 211]
