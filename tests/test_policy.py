"""Exclusions, filters and enrichments."""

from __future__ import annotations

from pyspark.sql import functions as F

from findlake.operators import policy
from findlake.operators.remediation import BANDIT_ADVICE, BANDIT_DEFAULT
from findlake.sources.config import POLICY_CONFIG


def column(df, name="rule_id"):
    return [r[0] for r in df.orderBy("seq").select(name).collect()]


def test_rules_match_exactly_and_by_tool(spark, findings):
    rules = policy.exclude_rules_dim(spark, POLICY_CONFIG)
    found = findings(
        {"tool": "bandit", "rule_id": "B404"},
        {"tool": "bandit", "rule_id": "b404"},
        {"tool": "tfsec", "rule_id": "B404"},
        {"tool": "pylint", "rule_id": "R0917"},  # configured with a space after it
        {"tool": "checkov-cfn", "rule_id": "CKV_AWS_116"},
        {"tool": "bandit", "rule_id": None},
    )
    assert column(policy.drop_excluded_rules(found, rules), "seq") == [1, 2, 3, 5]
    counts = {r.tool: r.excluded_count for r in policy.excluded_counts(found, rules).collect()}
    assert counts == {"bandit": 1, "checkov-cfn": 1}


def test_no_rules(spark, findings):
    rules = policy.exclude_rules_dim(spark, {})
    assert policy.drop_excluded_rules(findings({}, {}), rules).count() == 2


def test_pylint_by_id_or_symbol(spark, findings):
    rules = policy.exclude_rules_dim(spark, POLICY_CONFIG)
    found = findings(
        {"tool": "pylint", "rule_id": "C0301", "metadata": '{"symbol":"x"}'},
        {"tool": "pylint", "rule_id": "W1", "metadata": '{"symbol":"R0913"}'},
        {"tool": "pylint", "rule_id": "W1", "metadata": '{"symbol":""}'},
        {"tool": "pylint", "rule_id": "W1"},
    )
    assert column(policy.drop_excluded_pylint(found, rules), "seq") == [2, 3]


def test_paths(findings):
    paths = ["src/latest/a.tf", ".github/x", "a//node_modules/b", "src/a.tf", None, "", "x/fixtures/y", "a.pyc"]
    found = findings(*[{"file_path": p} for p in paths])
    patterns = POLICY_CONFIG["repository"]["excluded_paths"]
    kept = column(policy.drop_excluded_paths(found, patterns), "file_path")
    assert kept == ["src/a.tf", None, "", "a.pyc"]


def test_severity_floor(findings):
    found = findings(*[{"severity": s} for s in ("INFO", "LOW", "MEDIUM", "HIGH", "CRITICAL")])
    assert column(policy.severity_floor(found, "MEDIUM"), "severity") == ["MEDIUM", "HIGH", "CRITICAL"]
    assert policy.severity_floor(found, "unknown").count() == 5


def test_container_filter(spark):
    df = spark.createDataFrame([("high", "1"), ("HIGH", ""), ("HIGH", None), ("low", "1"), (None, "1")], "s string, f string")
    keep = policy.container_filter(F.col("s"), F.col("f"), "UNKNOWN, HIGH", ignore_unfixed=True)
    assert [tuple(r) for r in df.where(keep).collect()] == [("high", "1"), (None, "1")]
    keep = policy.container_filter(F.col("s"), F.col("f"), "HIGH", ignore_unfixed=False)
    assert df.where(keep).count() == 3


def test_auth_failure_cuts_later_manifests(spark):
    rows = [
        ("a", 1, 0, "api"), ("a", 2, 1, "boom"), ("a", 3, 1, "needs an API key"), ("a", 4, 0, ""), ("a", 5, 1, "EOF when reading"),
        ("b", 9, 1, "eof when reading"),
    ]
    reports = spark.createDataFrame(rows, "scan_id string, seq bigint, return_code int, stderr string")
    kept = policy.cut_at_auth_failure(reports)
    assert kept.columns == reports.columns
    assert sorted((r.scan_id, r.seq) for r in kept.collect()) == [("a", 1), ("a", 2), ("b", 9)]


def test_template_joins(spark, findings):
    files = spark.createDataFrame(
        [("s", "x/a.template"), ("s", "d.template/b.template"), ("s", "d.yaml/b.template"), ("t", "c.template")],
        "scan_id string, path string",
    )
    renames = {(r.scan_id, r.renamed): r.original for r in policy.template_renames(files).collect()}
    assert renames == {
        ("s", "x/a.yaml"): "x/a.template",
        ("s", "d.yaml/b.yaml"): "d.yaml/b.template",  # two originals, the greater path
        ("t", "c.yaml"): "c.template",
    }
    found = findings({"file_path": "x/a.yaml"}, {"file_path": "c.yaml"}, {"file_path": None})
    restored = policy.restore_template_paths(found, policy.template_renames(files))
    assert column(restored, "file_path") == ["x/a.template", "c.yaml", None]
    found = findings({"file_path": "/other/a.template"}, {"file_path": "c.template"}, {"file_path": None})
    assert column(policy.keep_template_files(found, files), "seq") == [0]


def test_bandit_advice(findings):
    assert len(BANDIT_ADVICE) == 57
    found = policy.bandit_remediation(findings({"rule_id": "B101"}, {"rule_id": "B703"}, {"rule_id": None}))
    assert column(found, "remediation") == [BANDIT_DEFAULT, BANDIT_ADVICE["B703"], BANDIT_DEFAULT]
