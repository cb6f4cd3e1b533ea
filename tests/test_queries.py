"""Every registered query against its SQL, and the shape of its plan."""

from __future__ import annotations

import re

import pytest

import __spark_entry__ as entry
from catalog.oracles import ORACLES
from catalog.queries import QUERIES
from tests.compare import compare, connect

SF = "/root/testdata/sf0.001"
STREAMS = {name for name in QUERIES if name.startswith("stream_")}


@pytest.fixture(scope="module")
def db():
    return connect(SF)


def test_every_query_has_its_sql():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(entry.queries()) and set(QUERIES) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", QUERIES)
def test_matches_sql(spark, db, name):
    ok, note = compare(spark, db, name, SF)
    assert ok, note


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


# The two flows over all tools are built from the same parts; their plans are long, not different.
@pytest.mark.parametrize("name", [n for n in QUERIES if n not in STREAMS and n not in ("union_findings", "scan_flow", "flow_switches", "file_inventory")])
def test_plan_shape(spark, name):
    plan = plan_of(QUERIES[name](spark, SF))
    for operator in ("CartesianProduct", "NestedLoopJoin", "PythonUDF", "ArrowEval", "MapInPandas", "Exchange SinglePartition"):
        assert operator not in plan, operator
    if "row_number() <= " in plan or name in ("dedup_keep_first", "top10", "sarif_rules"):
        assert "WindowGroupLimit" in plan  # hot groups are cut before the shuffle


@pytest.mark.parametrize("name", ["section_numbering", "report_json", "sarif_doc", "report_markdown", "ci_log", "severity_listing"])
def test_whole_findings_are_neither_joined_nor_shuffled_again(spark, name):
    """Once written in order, findings meet one broadcast row a range, whatever is made of them."""
    plan = plan_of(QUERIES[name](spark, SF))
    wide = [i for i, line in enumerate(plan.splitlines()) if "ReadSchema" in line and "description" in line]
    lines = plan.splitlines()
    depth = [len(line) - len(line.lstrip(" :+-")) for line in lines]
    for i in wide:
        above, at = [], depth[i]
        for j in range(i, -1, -1):
            if depth[j] < at:
                above.append(lines[j])
                at = depth[j]
        rules = any("row_number() <= " in line or "WindowGroupLimit" in line for line in above)  # cut to one row a rule
        moved = [line for line in above if "Exchange" in line or "SortMergeJoin" in line]
        assert rules or not moved, moved


def test_no_report_text_is_shuffled_for_the_login_cut(spark):
    for name in ("norm_safety", "safety_auth_cut"):
        plan = plan_of(QUERIES[name](spark, SF))
        assert plan.count("from_json(") <= (2 if name == "norm_safety" else 0)
        for exchange in re.findall(r"Exchange hashpartitioning\(scan_id[^\n]*\n[^\n]*", plan):
            assert "stdout" not in exchange


@pytest.mark.parametrize("name", ["norm_tfsec", "norm_trivy", "norm_pylint", "severity_map", "rule_exclusion", "path_exclusion"])
def test_row_level_queries_do_not_shuffle(spark, name):
    plan = plan_of(QUERIES[name](spark, SF))
    assert not re.search(r"Exchange hashpartitioning\((?!e#)", plan)  # but for the inputs' own spreading


def test_scans_read_only_the_columns_they_need(spark):
    plan = plan_of(QUERIES["secrets_scan"](spark, SF))
    assert "ReadSchema: struct<doc_id:bigint,text:string" in plan
    assert "n_chars" not in plan and "lang" not in plan


def test_entry(spark):
    df = entry.entry(spark)
    assert df.columns == ["scan_id", "severity", "findings"]
    assert df.count() > 0
