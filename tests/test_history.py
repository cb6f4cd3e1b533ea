"""Runs kept for later comparison."""

from __future__ import annotations

import datetime as dt
import hashlib
import uuid

import pytest

from findlake.operators import history
from findlake.session import shared_dir

RUNS = "scan_id string, repository string, scan_ts timestamp"


@pytest.fixture
def kept(spark):
    """(append, name): append(findings, (scan, repository, day), ...)"""
    name, folder = f"history_{uuid.uuid4().hex}", shared_dir(spark, "test-history")

    def append(found, *runs):
        rows = [(scan, repository, dt.datetime(2026, 1, day)) for scan, repository, day in runs]
        history.append_runs(found, spark.createDataFrame(rows, RUNS), name, folder)

    yield append, name
    for table in ("keys", "runs"):
        spark.sql(f"DROP TABLE IF EXISTS {name}_{table}")


def of(scan, *rules):
    return [{"scan_id": scan, "rule_id": rule} for rule in rules]


RULE_OF = {hashlib.md5(f"a.tf:1:{rule}:t".encode()).hexdigest(): rule for rule in "ABCD"}


def changes(spark, name, wanted=None):
    return sorted((r.scan_id, r.previous or "", RULE_OF[r.key], r.state) for r in history.run_changes(spark, name, wanted).collect())


def test_each_run_meets_the_one_before(spark, findings, kept):
    append, name = kept
    append(findings(*of("a", "A", "B", "B"), *of("x", "D")), ("a", "r", 1), ("x", "q", 9))
    append(findings(*of("c", "B", "C")), ("c", "r", 3), ("none", "r", 4))  # a run without findings is one
    append(findings(*of("e", "C"), *of("u", "A")), ("e", "r", 5), ("u", None, 6))
    want = [
        ("a", "", "A", "new"), ("a", "", "B", "new"),
        ("c", "a", "A", "fixed"), ("c", "a", "B", "same"), ("c", "a", "C", "new"),
        ("e", "none", "C", "new"),
        ("none", "c", "B", "fixed"), ("none", "c", "C", "fixed"),
        ("u", "", "A", "new"), ("x", "", "D", "new"),
    ]
    assert changes(spark, name) == want
    assert changes(spark, name, spark.createDataFrame([("c",), ("c",)], "scan_id string")) == want[2:5]
    trend = {(r.scan_id, r.findings, r.previous) for r in history.trend(history.stored_runs(spark, name)).collect()}
    assert {("a", 2, None), ("c", 2, 2), ("none", 0, 2), ("e", 1, 0)} <= trend


def test_appending_again_changes_nothing(spark, findings, kept):
    append, name = kept
    for _ in range(2):  # as after a failure between the two tables
        append(findings(*of("a", "A"), *of("b", "A", "B")), ("a", "r", 1), ("b", "r", 2))
    assert changes(spark, name) == [("a", "", "A", "new"), ("b", "a", "A", "same"), ("b", "a", "B", "new")]
    assert sorted((r.scan_id, r.findings) for r in history.stored_runs(spark, name).collect()) == [("a", 1), ("b", 2)]


def test_nothing_kept(spark, findings, kept):
    append, name = kept
    append(findings())
    assert changes(spark, name) == []


def test_findings_of_no_run_are_not_shown(spark, findings, kept):
    append, name = kept
    append(findings(*of("a", "A"), *of(None, "B"), *of("stray", "C")), ("a", "r", 1), ("b", "r", 2))
    assert changes(spark, name) == [("a", "", "A", "new"), ("b", "a", "A", "fixed")]
    assert changes(spark, name, spark.createDataFrame([], "scan_id string")) == []


def test_later_appends_keep_the_buckets(spark, findings, kept):
    append, name = kept
    append(findings(*of("a", "A")), ("a", "r", 1))
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "5")
    try:
        append(findings(*of("b", "B")), ("b", "r", 2))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert [c[2:] for c in changes(spark, name)] == [("A", "new"), ("A", "fixed"), ("B", "new")]


def test_stored_keys_stay_in_their_buckets(spark, findings, kept):
    """No exchange between the earlier runs' stored keys and the join; one above the later runs'."""
    append, name = kept
    append(findings(*of("a", "A"), *of("b", "B")), ("a", "r", 1), ("b", "r", 2))
    plan = history.run_changes(spark, name)._jdf.queryExecution().executedPlan().toString().splitlines()
    depth = [len(line) - len(line.lstrip(" :+-")) for line in plan]
    shuffles = []
    for i, line in enumerate(plan):
        if f"{name}_keys" in line:
            at, above = depth[i], 0
            for j in range(i, -1, -1):
                if depth[j] < at:
                    above += "Exchange hashpartitioning" in plan[j]
                    at = depth[j]
            shuffles.append(above)
    assert sorted(shuffles) == [0, 1], "\n".join(plan)


def test_many_runs_meet_their_keys_by_a_salted_join(spark, findings, kept, monkeypatch):
    append, name = kept
    append(findings(*of("a", "A", "C"), *of("b", "A", "B")), ("a", "r", 1), ("b", "r", 2))
    few = changes(spark, name)
    monkeypatch.setattr(history, "MOST_RUNS", 0)
    assert changes(spark, name) == few and len(few) == 5
    plan = history.run_changes(spark, name)._jdf.queryExecution().optimizedPlan().toString()
    assert "_salt" in plan
