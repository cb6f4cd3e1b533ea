"""The text queries that SQL can express, against it; and that the native ones stay free of Python."""

from __future__ import annotations

import pytest

import __spark_entry__ as entry
from findlake.llm.oracles import ORACLES
from findlake.llm.queries import QUERIES
from tests.compare import compare, connect

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def db():
    return connect(SF)


def test_all_are_registered():
    assert {*QUERIES, "pipeline"} <= set(entry.queries())
    assert sorted(int(name[2:].split("_")[0]) for name in QUERIES) == list(range(1, 14))
    assert set(ORACLES) <= set(QUERIES) and set(ORACLES) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", ORACLES)
def test_matches_sql(spark, db, name):
    ok, note = compare(spark, db, name, SF)
    assert ok, note


@pytest.mark.parametrize("name", ["op2_url_filter", "op3_secret_index", "op5_quality_rules", "op6_line_dedup"])
def test_no_python_and_no_cross_join(spark, name):
    plan = QUERIES[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
    for operator in ("Python", "Pandas", "Arrow", "CartesianProduct", "NestedLoopJoin", "Exchange SinglePartition"):
        assert operator not in plan, operator
