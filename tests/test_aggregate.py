"""Dedup, counts, summaries, gates and history, with the invariants between them."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from findlake.operators import aggregate, history


@pytest.fixture(scope="module")
def found(findings):
    return findings(
        {"tool": "checkov", "severity": "LOW"},
        {"tool": "tfsec", "severity": "HIGH"},  # same key as the first, other tool
        {"tool": "tfsec", "severity": "HIGH", "line_number": None},
        {"tool": "trivy", "severity": "INFO", "line_number": None},  # same as the one before
        {"tool": "trivy", "severity": "CRITICAL", "file_path": None},
        {"tool": "trivy", "severity": "MEDIUM", "file_path": ""},
        {"tool": "bandit", "severity": "INFO", "file_path": "b.py"},
        {"scan_id": "u", "tool": "tfsec", "severity": "LOW"},
    )


@pytest.fixture(scope="module")
def scans(spark):
    rows = [("s", "repo", None, "T", "CRITICAL", False), ("u", "repo", "b", "T", None, False), ("v", "none", None, "T", "INFO", True)]
    return spark.createDataFrame(rows, "scan_id string, repository string, branch string, scan_timestamp string, fail_on string, errored boolean")


def test_dedup_keeps_the_first_of_any_tool(found):
    kept = aggregate.deduplicate(found)
    assert [(r.scan_id, r.seq, r.tool) for r in kept.orderBy("seq").collect()] == [
        ("s", 0, "checkov"), ("s", 2, "tfsec"), ("s", 4, "trivy"), ("s", 5, "trivy"), ("s", 6, "bandit"), ("u", 7, "tfsec"),
    ]
    assert aggregate.deduplicate(kept).count() == kept.count()
    assert aggregate.deduplicate(found, enabled=False).count() == found.count()


def test_normalized_dedup(findings):
    same = findings({"file_path": "./a//b.tf"}, {"file_path": "a/b.tf"}, {"file_path": None})
    assert aggregate.deduplicate(same).count() == 3
    assert aggregate.deduplicate(same, normalize_paths=True).count() == 2


def test_summary(found, scans):
    summary = {r.scan_id: r for r in aggregate.summarize(found, scans.drop("fail_on", "errored")).collect()}
    s, v = summary["s"], summary["v"]
    assert (s.total_raw_findings, s.total_findings, s.unique_files) == (7, 5, 2)
    assert (s.critical, s.high, s.medium, s.low, s.info) == (1, 1, 1, 1, 1)
    assert s.scanners_run == ["checkov", "tfsec", "trivy", "bandit"]  # trivy's first finding was a duplicate
    assert [tuple(t) for t in s.by_tool] == [("checkov", 1), ("tfsec", 1), ("trivy", 2), ("bandit", 1)]
    assert (v.total_raw_findings, v.total_findings, v.unique_files, v.scanners_run, v.by_tool) == (0, 0, 0, [], [])


def test_sums_agree(found):
    kept = aggregate.deduplicate(found)
    total = {r.scan_id: r.total_findings for r in aggregate.scan_totals(found).collect()}
    for counts in (aggregate.count_by_severity(kept), aggregate.count_by_tool(kept)):
        assert {r.scan_id: r.n for r in counts.groupBy("scan_id").agg(F.sum("findings").alias("n")).collect()} == total


def test_gate_and_status(found, scans):
    gates = scans.select("scan_id", "fail_on")
    gated = aggregate.gate(found, gates)
    assert {r.scan_id: r.failed for r in gated.collect()} == {"s": True, "u": False, "v": False}
    status = {r.scan_id: (r.exit_code, r.status) for r in aggregate.scan_status(gated, scans).collect()}
    assert status == {"s": (2, "failed"), "u": (0, "passed"), "v": (1, "error")}


@pytest.mark.parametrize(
    ("fail_on", "failed"), [("NONE", False), ("CRITICAL", False), ("HIGH", True), ("LOW", True), ("what", True), (None, True)]
)
def test_gate_levels(spark, findings, fail_on, failed):
    gates = spark.createDataFrame([("s", fail_on)], "scan_id string, fail_on string")
    assert aggregate.gate(findings({"severity": "HIGH"}), gates).first().failed is failed


def test_top_and_ranking(found):
    top = aggregate.top_findings(found, 3).where("scan_id = 's'").orderBy("place")
    assert [(r.place, r.seq) for r in top.collect()] == [(1, 4), (2, 1), (3, 2)]
    ranked = aggregate.tools_ranked(found).where("scan_id = 's'").orderBy("place")
    assert [(r.tool, r.findings) for r in ranked.collect()] == [("trivy", 3), ("tfsec", 2), ("checkov", 1), ("bandit", 1)]


def test_by_file(found):
    got = {(r.scan_id, r.file_path): (r.findings, r.worst_severity) for r in aggregate.by_file(found).collect()}
    assert got == {("s", "a.tf"): (4, "HIGH"), ("s", "b.py"): (1, "INFO"), ("u", "a.tf"): (1, "LOW")}


def test_baseline(findings):
    now = findings({"rule_id": "A"}, {"rule_id": "A"}, {"rule_id": "B"})
    before = findings({"rule_id": "B"}, {"rule_id": "C"}, {"rule_id": "C"})
    states = sorted(r.state for r in history.baseline_diff(now, before).collect())
    assert states == ["fixed", "new", "same"]
    kept = history.suppress(now, aggregate.with_key(before))
    assert [r.rule_id for r in kept.collect()] == ["A"]


def test_trend(spark):
    day = lambda n: dt.datetime(2026, 1, n)
    rows = [("r", day(3), "c", 5), ("r", day(1), "a", 9), ("r", day(2), "b", 4), ("q", day(1), "d", 7), ("r", day(3), "e", 6)]
    counts = spark.createDataFrame(rows, "repository string, scan_ts timestamp, scan_id string, findings bigint")
    got = [(r.repository, r.run, r.scan_id, r.previous, r.change) for r in history.trend(counts).orderBy("repository", "run").collect()]
    assert got == [("q", 1, "d", None, None), ("r", 1, "a", None, None), ("r", 2, "b", 9, -5), ("r", 3, "c", 4, 1), ("r", 4, "e", 5, 1)]


def test_layers(found):
    got = {(r.scan_id, r.layer): r.findings for r in history.by_layer(found).collect()}
    assert got == {("s", "security"): 7, ("u", "security"): 1}
