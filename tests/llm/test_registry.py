"""The registered queries with SQL, compared at the smallest scale, and the style of those that must be native."""

import pytest

import __spark_entry__ as entry
from tools.check import compare, connect
from wardlog.llm import queries


@pytest.fixture(scope="module")
def tables(sf_small):
    return connect(sf_small)


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_against_sql(spark, tables, sf_small, name):
    seen = []

    def run(session, folder):
        seen.append(entry.queries()[name](session, folder))
        return seen[0]

    ok, _, _, note = compare(spark, tables, sf_small, name, run, entry.oracle_sql()[name])
    assert ok, note
    plan = seen[0]._jdf.queryExecution().executedPlan().toString()
    for operator in ("CartesianProduct", "NestedLoopJoin"):
        assert operator not in plan
    if name in ("op2_mix_sources", "op9_quality_rules"):
        for operator in ("Python", "Pandas", "Arrow"):
            assert operator not in plan


def test_all_are_registered():
    names = set(entry.queries())
    assert {n.split("_")[0] for n in queries.QUERIES} == {f"op{k}" for k in range(1, 14)}
    assert set(queries.QUERIES) | {"pipeline"} <= names
