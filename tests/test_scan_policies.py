"""Configurations by scan against one run for each configuration; the path index against brute force."""

from __future__ import annotations

import json
import random

import pytest
from pyspark.sql import functions as F

from findlake.functions import path_excluded
from findlake.model import RAW_REPORTS
from findlake.operators import classify, path_index
from findlake.plans.scan_flow import normalize_all, run_scans
from findlake.session import shuffle_partitions
from findlake.sources import policies
from findlake.sources.config import POLICY_CONFIG

CONFIGS = {
    "plain": {},
    "rules": {"tools": {"terraform": {"exclude_rules": {"tfsec": ["A", "B"], "checkov": None}}, "python": {"exclude_rules": {"pylint": ["long", "C1"]}}}},
    "paths": {"repository": {"excluded_paths": ["tests", "**/gen", " x.tf "], "default_path": "/work"}},
    "all-paths": {"repository": {"excluded_paths": ["**"]}},
    "off": {"tools": {"terraform": {"tfsec": None, "terraform_fmt": False}, "npm": {"enabled": 0}, "container": {"enabled": ""}}},
    "limits": {
        "tool_config": {"snyk": {"severity_threshold": "high"}},
        "severity": {"fail_on": "LOW"},
        "aggregation": {"deduplicate": False},
        "tools": {"container": {"severities": "HIGH, critical", "ignore_unfixed": True, "image_name_prefix": "own-"}},
    },
    "ready": {"tools": {"container": {"build_images": False}}, "tool_config": {"snyk": {"severity_threshold": "bogus"}}},
    "null": {"tools": None, "severity": {"fail_on": None}, "repository": {"excluded_paths": None}},
}
REPORTS = [
    ("tfsec", ".", 0, json.dumps({"results": [{"rule_id": r, "severity": "HIGH", "location": {"filename": f}} for r in "ABC" for f in ("tests/a", "src/x.tf")]})),
    ("tfsec", ".", 0, json.dumps({"results": [{"rule_id": "C", "severity": "HIGH", "location": {"filename": "src/x.tf"}}]})),
    ("checkov", ".", 0, json.dumps({"results": {"failed_checks": [{"check_id": "CKV_AWS_116"}, {"check_id": "A"}]}})),
    ("terraform-fmt", ".", 3, "a.tf\nsrc/x.tf\ngen/y.tf\ntests/z.tf\n"),
    ("bandit", ".", 1, json.dumps({"results": [{"test_id": "B404", "filename": "/work/a.py"}, {"test_id": "B1", "filename": "/repo/b.py"}]})),
    ("pylint", ".", 1, json.dumps([{"message-id": "C1", "symbol": "s", "path": "/repo/a"}, {"message-id": "C2", "symbol": "long", "path": "/work/a"}, {"message-id": "C3"}])),
    ("npm-audit", "tests/package.json", 1, json.dumps({"vulnerabilities": {"p": {"severity": "high"}}})),
    ("snyk-iac", ".", 1, json.dumps([{"targetFile": "a", "infrastructureAsCodeIssues": [{"id": s, "severity": s} for s in ("low", "high", "odd")]}])),
    ("container-build", "svc/Dockerfile", 1, ""),
    ("trivy-container", "svc/Dockerfile", 0, json.dumps({"Results": [{"Vulnerabilities": [{"VulnerabilityID": i, "Severity": s, "FixedVersion": v} for i, s, v in
     [("1", "HIGH", "2"), ("2", "LOW", "2"), ("3", "CRITICAL", ""), ("4", None, "1")]]}]})),
]


@pytest.fixture(scope="module")
def reports(spark):
    names = [*CONFIGS, "none", "broken"]
    rows = [(n, tool, target, i, code, out, "failed" if code else "") for n in names for i, (tool, target, code, out) in enumerate(REPORTS)]
    return spark.createDataFrame(rows, RAW_REPORTS)


@pytest.fixture(scope="module")
def configs(spark):
    return spark.createDataFrame([*((n, json.dumps(c)) for n, c in CONFIGS.items()), ("broken", "{no json"), ("other", "{}")], "scan_id string, config string")


@pytest.fixture(scope="module")
def by_scan(spark, reports, configs):
    rows = [(n, "r", None, "T", False) for n in [*CONFIGS, "none", "broken", "empty"]]
    scans = spark.createDataFrame(rows, "scan_id string, repository string, branch string, scan_timestamp string, errored boolean")
    return scans, run_scans(reports, None, scans, configs)


def of(df, scan):
    return sorted(map(tuple, df.where(F.col("scan_id") == scan).select(sorted(df.columns)).collect()), key=str)


@pytest.mark.parametrize("name", ["rules", "paths", "off", "limits", "null", "none"])
def test_a_scan_gets_what_its_configuration_alone_would_give(reports, by_scan, name):
    scans, result = by_scan
    config = CONFIGS.get(name, POLICY_CONFIG if name == "none" else {})
    single = run_scans(reports.where(F.col("scan_id") == name), None, scans.where(F.col("scan_id") == name), config)
    assert of(result.findings, name) == of(single.findings, name)
    assert of(result.reported, name) == of(single.reported, name)
    assert of(result.status, name) == of(single.status, name)
    summary = [c for c in single.summary.columns if c != "by_tool"]
    assert of(result.summary.select(summary), name) == of(single.summary.select(summary), name)


def test_every_finding_and_scan_is_there(by_scan):
    scans, result = by_scan
    assert result.status.count() == scans.count() == result.summary.count()
    kept = {r.scan_id: r["n"] for r in result.findings.groupBy("scan_id").agg(F.count("*").alias("n")).collect()}
    assert kept["plain"] == max(kept.values()) and kept["all-paths"] < kept["paths"] < kept["plain"] and kept["off"] < kept["plain"]


def test_tables_of_a_configuration(spark, configs):
    scans = configs.select("scan_id")
    parsed = policies.parsed_configs(scans, configs, {})
    rules = {tuple(r) for r in policies.excluded_rules(parsed).collect()}
    assert rules == {("rules", "tfsec", "A"), ("rules", "tfsec", "B"), ("rules", "pylint", "long"), ("rules", "pylint", "C1")}
    off = {tuple(r) for r in policies.switched_off(parsed).collect()}
    assert off == {
        ("off", "tfsec"), ("off", "terraform-fmt"), ("off", "npm-audit"), ("off", "snyk-iac"), ("off", "snyk-iac-template"),
        ("off", "container-build"), ("off", "trivy-container"), ("ready", "container-build"),
    }
    assert policies.settings(parsed).count() == scans.count()
    assert policies.settings(parsed.where("false")).count() == 0


def test_plan_by_scan(spark, configs):
    paths = ["a.tf", "tests/package.json", "web/package.json", "gen/Dockerfile", "svc/Dockerfile", "src/app.py", "tests/t.py", "requirements.txt", "t.template"]
    names = [*CONFIGS, "none"]
    files = spark.createDataFrame([(n, "r", p, "Resources: AWSTemplateFormatVersion AWS::S3", True) for n in names for p in paths], "scan_id string, repo string, path string, content string, read_ok boolean")
    parsed = policies.parsed_configs(files, configs, POLICY_CONFIG)
    got = classify.tool_plan_by_scan(files, policies.switched_off(parsed), policies.excluded_patterns(parsed)).collect()
    for name in names:
        config = CONFIGS.get(name, POLICY_CONFIG)
        patterns = (config.get("repository") or {}).get("excluded_paths") or []
        single = classify.tool_plan(files.where(F.col("scan_id") == name), {**config, "tools": config.get("tools") or {}}, patterns).collect()
        assert sorted(tuple(r) for r in got if r.scan_id == name) == sorted(map(tuple, single)), name


def test_path_index(spark):
    chance = random.Random(2)
    paths = ["/".join("".join(chance.choice("abé.") for _ in range(chance.randrange(1, 6))) for _ in range(chance.randrange(1, 5))) for _ in range(300)]
    paths += ["", None, "/", "a//./b", "x\\y", "src/generated/deep/file.tf"]
    patterns = ["".join(chance.choice("abé./*") for _ in range(chance.randrange(5, 12))) for _ in range(400)]
    patterns += ["**/éb.", "aé.a**", " abab ", "generated/deep", "x/y"]
    rows = spark.createDataFrame([(i, p) for i, p in enumerate(paths)], "seq bigint, file_path string")
    listed = spark.createDataFrame([(p,) for p in patterns] + [(None,)], "pattern string")
    want = {r.seq for r in rows.where(~path_excluded(F.nullif("file_path", F.lit("")), patterns)).collect()}
    assert {r.seq for r in path_index.drop_excluded(rows, listed, []).collect()} == want
    assert 5 < len(want) < len(paths)
    only = spark.createDataFrame([("",)], "pattern string")  # every path that there is
    assert {r.file_path for r in path_index.drop_excluded(rows, only, []).collect()} == {"", None}
    assert path_index.drop_excluded(rows, listed.where("false"), []).count() == len(paths)


def test_path_index_by_scan_and_without_a_cross_join(spark):
    rows = spark.createDataFrame([(i, f"s{i % 3}", f"src/mod{i % 7}/f.tf") for i in range(60)], "seq bigint, scan_id string, file_path string")
    listed = spark.createDataFrame([("s0", "mod1"), ("s1", "mod2/f"), ("s1", "mod2"), ("none", "src"), ("s2", "nowhere")], "scan_id string, pattern string")
    kept = path_index.drop_excluded(rows, listed, ["scan_id"])
    gone = {("s0", 1), ("s1", 2)}
    assert {r.seq for r in kept.collect()} == {i for i in range(60) if (f"s{i % 3}", i % 7) not in gone}
    plan = kept._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "NestedLoopJoin" not in plan


def test_single_configuration_is_as_before(reports):
    assert normalize_all(reports.where("scan_id = 'plain'"), None, {}).count() > 15


def test_configurations_are_read_by_as_many_tasks_as_a_shuffle_starts_with(spark):
    scans = spark.range(40).selectExpr("concat('s', id) AS scan_id")
    configs = scans.selectExpr("scan_id", "'{\"severity\":{\"fail_on\":\"LOW\"}}' AS config")
    parsed = policies.parsed_configs(scans, configs, {})
    assert parsed.select("scan_id").rdd.getNumPartitions() == shuffle_partitions(spark)
    assert "Broadcast" not in parsed._jdf.queryExecution().executedPlan().toString()
    assert {r[0] for r in policies.settings(parsed).select("_fail_on").collect()} == {"LOW"} and parsed.count() == 40


def test_a_seed_is_chosen_once_for_all_scans_with_a_pattern(spark):
    shared = [(f"s{i}", "abc") for i in range(5)] + [("s0", "bcd"), ("s1", "x**/y")]
    found = path_index.seeds(spark.createDataFrame(shared, "scan_id string, pattern string"), ["scan_id"])
    got = sorted((r["scan_id"], r["_pattern"], r["_seed"]) for r in found.collect())
    assert got == sorted([(f"s{i}", "abc", "ab") for i in range(5)] + [("s0", "bcd", "cd"), ("s1", "x**/y", "**/y"), ("s1", "xy", "xy")])
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert not any("Generate" in line and "scan_id" in line and "_seed" in line for line in plan.splitlines())


def _brute(paths, patterns):
    forms = {f for p in patterns for f in ({p.strip(), p.strip().replace("**/", "").replace("**", "")} if "**" in p else {p.strip()})}
    return {p for p in paths if any(f in p for f in forms)}


@pytest.mark.parametrize("words", [8, 1])
def test_a_path_that_meets_many_patterns_is_shuffled_once(spark, monkeypatch, words):
    chance = random.Random(5)
    paths = sorted({"x/" + "".join(chance.choice("abcdeé/") for _ in range(60)).replace("//", "/a").rstrip("/") + "z" for _ in range(80)})
    patterns = sorted({p[i : i + n] for p in paths[:60] for i in range(0, 50, 3) for n in range(6, 13)})
    paths += [f"none-{i}" for i in range(300)]
    counts = []
    kept = path_index.materialize
    monkeypatch.setattr(path_index, "materialize", lambda df, name: counts.append((name, (out := kept(df, name)).count())) or out)
    if words == 1:  # a filter that lets most through
        monkeypatch.setattr(path_index, "WORDS", 1)
        monkeypatch.setattr(path_index, "BLOCKS", 4)
    rows = spark.createDataFrame([(p,) for p in paths], "path string")
    found = path_index.excluded_paths(rows, spark.createDataFrame([(p,) for p in patterns], "pattern string"), [])
    got = [r.path for r in found.collect()]
    assert len(got) == len(set(got)) and set(got) == _brute(paths, patterns) and len(patterns) > 5000
    first, rest = [n for name, n in counts if name == "path-candidates"]
    if words == 8:
        assert 60 <= first <= 80 and rest < 10  # before, a row for each of the thousands of pieces
    else:
        assert rest > 100


def test_long_patterns_are_found_by_their_seeds_beside_short_ones(spark):
    chance = random.Random(6)
    paths = sorted({"p/" + "".join(chance.choice("abcé") for _ in range(90)) for _ in range(60)})
    patterns = [p[7 : 7 + path_index.WHOLE + 1 + i % 40] for i, p in enumerate(paths[:20])]
    patterns += [p[9 : 9 + path_index.WHOLE] for p in paths[15:25]] + [paths[30][:40] + "!", "**" + paths[40][20:60] + "**/"]
    rows = spark.createDataFrame([(s, p) for s in ("s", "t", None) for p in paths], "scan_id string, path string")
    listed = spark.createDataFrame([("s", p) for p in patterns] + [(None, p) for p in paths], "scan_id string, pattern string")
    got = sorted(map(tuple, path_index.excluded_paths(rows, listed, ["scan_id"]).collect()))
    assert got == [("s", p) for p in sorted(_brute(paths, patterns))] and len(got) == 26
    longer = listed.where(f"length(pattern) > {path_index.WHOLE} and scan_id = 's'")
    alone = [p for p in patterns if len(p) > path_index.WHOLE]
    assert {r.path for r in path_index.excluded_paths(rows, longer, ["scan_id"]).collect()} == _brute(paths, alone)
