"""Configuration, file inventory, raw reports and the whole flow on files."""

from __future__ import annotations

import json
import os

import pytest
from pyspark.sql import functions as F

from findlake.model import RAW_REPORTS
from findlake.operators import classify
from findlake.operators.secrets import secret_lines
from findlake.plans.scan_flow import normalize_all, run_scans
from findlake.session import materialize, remove_written, shared_dir, shuffle_partitions
from findlake.sources import config as cfg
from findlake.sources.files import read_files, unreadable
from findlake.sources.reports import lay_out_by_tool, read_raw_reports


def test_a_good_file_is_never_empty_for_want_of_a_package(tmp_path, monkeypatch):
    good = tmp_path / "a.yaml"
    good.write_text("severity:\n  fail_on: LOW\n")
    if cfg.yaml is not None:
        assert cfg.load_config(str(good)) == {"severity": {"fail_on": "LOW"}}
    monkeypatch.setattr(cfg, "yaml", None)
    with pytest.raises(RuntimeError):
        cfg.load_config(str(good))


def test_load_config(tmp_path):
    assert cfg.load_config(None) == cfg.DEFAULT_CONFIG
    assert cfg.load_config(str(tmp_path / "absent.yaml")) == cfg.DEFAULT_CONFIG
    good, bad, empty = tmp_path / "a.json", tmp_path / "b.yaml", tmp_path / "c.yaml"
    good.write_text('{"severity": {"fail_on": "LOW"}}')
    bad.write_bytes(b"\xff\xfe")
    empty.write_text("{}")
    assert cfg.load_config(str(good)) == {"severity": {"fail_on": "LOW"}}
    assert cfg.load_config(str(bad)) == {} and cfg.load_config(str(empty)) == {}
    env = {"REPO_PATH": "/x", "REPORTS_PATH": "/r"}
    assert cfg.load_config(str(good), env) == {
        "severity": {"fail_on": "LOW"}, "repository": {"default_path": "/x"}, "output": {"directory": "/r"},
    }
    assert "repository" not in cfg.DEFAULT_CONFIG


def test_lookup():
    config = {"a": {"b": {"c": 0}, "n": None, "s": "x"}}
    assert cfg.lookup(config, "a.b.c", 9) == 0
    assert [cfg.lookup(config, k, 9) for k in ("a.n", "a.x", "a.s.t", "q")] == [9, 9, 9, 9]
    assert cfg.missing_keys({"tools": None, "output": {}}) == ["severity"]


def test_config_columns(spark):
    texts = ['{"tools":{"x":{"on":true}},"severity":null,"output":{}}', "{}", "not json", '{"tools":"text"}']
    df = spark.createDataFrame([(str(i), t) for i, t in enumerate(texts)], "scan_id string, config string")
    values = [r[0] for r in df.select(cfg.config_value(F.col("config"), "tools.x.on", "none")).collect()]
    assert values == ["true", "none", "none", "none"]
    missing = sorted((r.scan_id, r.missing_key) for r in cfg.config_check(df).collect() if r.scan_id in "03")
    assert missing == [("3", "output"), ("3", "severity")]


def test_read_files(spark, tmp_path):
    contents = {
        "s1/main.tf": b"x", "s1/a/b/t.yaml": b"AWS::\xc3\xa9", "s1/.github/w.yml": b"on: push", "s1/_private/.env": b"k=v",
        "s2/bad.py": b"\xff\xfe", "s2/pkg/__init__.py": b"", "s3/deep/er/and/deeper/x.js": b"\r\n",
        "beside.txt": b"no scan",
    }
    for path, data in contents.items():
        file = tmp_path / path
        file.parent.mkdir(parents=True, exist_ok=True)
        file.write_bytes(data)
    (tmp_path / "s3" / "loop").symlink_to(tmp_path / "s3")
    files = read_files(spark, str(tmp_path))
    got = {(r.scan_id + "/" + r.path): r.content for r in files.collect()}
    assert got == {
        "s1/main.tf": "x", "s1/a/b/t.yaml": "AWS::é", "s1/.github/w.yml": "on: push", "s1/_private/.env": "k=v",
        "s2/bad.py": "\ufffd\ufffd", "s2/pkg/__init__.py": "", "s3/deep/er/and/deeper/x.js": "\r\n",
    }
    gone = files.withColumn("read_ok", F.col("path") != "main.tf")
    assert unreadable(files).isEmpty() and [tuple(r) for r in unreadable(gone).collect()] == [("s1", "main.tf")]
    flags = {r.scan_id: r for r in classify.repo_flags(files).collect()}
    assert flags["s1"].terraform and flags["s1"].cloudformation and flags["s2"].python and flags["s3"].javascript
    assert [r.path for r in read_files(spark, str(tmp_path), "*.tf").collect()] == ["main.tf"]


def test_one_bad_byte_hides_nothing(spark, tmp_path):
    token = "AKIA" + "ABCDEFGH12345678"
    (tmp_path / "s").mkdir()
    (tmp_path / "s" / "a.py").write_bytes(b"# caf\xe9\nkey = " + token.encode())
    (tmp_path / "s" / "t.yaml").write_bytes(b"AWSTemplateFormatVersion: x\n" + b"#" * 9000 + b"\xe9")
    files = read_files(spark, str(tmp_path))
    assert [(r.path, r.line_number, r.match) for r in secret_lines(files).collect()] == [("a.py", 2, token)]
    assert [r.path for r in classify.cfn_templates(files).collect()] == ["t.yaml"]


class Unnamed:
    """A session whose settings name no shared folder."""

    def __init__(self, spark):
        self.sparkContext = spark.sparkContext
        self.conf = self

    def get(self, key, default):
        return default


def test_a_cluster_needs_a_shared_folder(spark):
    class Context:
        master, applicationId = "yarn", "x"

    on_cluster = Unnamed(spark)
    on_cluster.sparkContext = Context()
    with pytest.raises(RuntimeError):
        shared_dir(on_cluster, "x")


def test_shared_folder_is_the_sessions(spark):
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        assert shared_dir(spark, "x").startswith(named)
    own = shared_dir(Unnamed(spark), "x")
    assert own != shared_dir(Unnamed(spark), "x")
    assert own.rsplit("/", 1)[0] == shared_dir(Unnamed(spark), "x").rsplit("/", 1)[0]
    df = materialize(spark.range(3).select((F.col("id") % 2).alias("k"), "id"), "test", ["k"])
    assert df.columns == ["k", "id"] and df.count() == 3


def test_written_tables_can_be_removed(spark):
    remove_written(spark)
    df = materialize(spark.range(3), "test")
    (path,) = {f.rsplit("/", 1)[0] for f in df.inputFiles()}
    assert remove_written(spark) == 1 and remove_written(spark) == 0
    assert not os.path.exists(path.removeprefix("file:").replace("///", "/"))


@pytest.fixture(scope="module")
def lake(spark):
    """Reports of three scans: two tools agree on one finding, one report is broken."""
    tfsec = {"results": [{"rule_id": "A", "rule_description": "t", "severity": "CRITICAL", "location": {"filename": "a.tf", "start_line": 1}}]}
    checkov = {"results": {"failed_checks": [{"check_id": "A", "check_name": "t", "file_path": "a.tf", "file_line_range": [1, 2]},
                                             {"check_id": "CKV_AWS_116", "check_name": "t"}]}}
    rows = [
        ("s1", "checkov", ".", 5, 1, json.dumps(checkov), ""),
        ("s1", "tfsec", ".", 4, 1, json.dumps(tfsec), ""),
        ("s2", "terraform-fmt", ".", 0, 3, "x.tf\ntests/y.tf\n", ""),
        ("s2", "tflint", ".", 1, 1, "{broken", ""),
    ]
    return spark.createDataFrame(rows, RAW_REPORTS)


def test_layout_prunes_partitions(spark, lake, tmp_path):
    laid = lay_out_by_tool(lake)
    assert laid.count() == 4
    plan = laid.where("tool = 'tfsec'")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(tool" in plan
    lake.write.json(str(tmp_path / "raw"))
    assert read_raw_reports(spark, str(tmp_path / "raw"), "json").count() == 4


def test_whole_flow(spark, lake):
    rows = [(f"s{i}", "r", None, "T", False) for i in (1, 2, 3)]
    scans = spark.createDataFrame(rows, "scan_id string, repository string, branch string, scan_timestamp string, errored boolean")
    result = run_scans(lay_out_by_tool(lake), None, scans, cfg.POLICY_CONFIG)
    reported = [(r.scan_id, r.tool, r.severity, r.file_path) for r in result.reported.orderBy("scan_id", "seq").collect()]
    assert reported == [("s1", "tfsec", "CRITICAL", "a.tf"), ("s2", "terraform-fmt", "LOW", "x.tf")]
    assert result.findings.count() == 3
    assert {r.scan_id: (r.fail_on, r.exit_code) for r in result.status.collect()} == {"s1": ("HIGH", 2), "s2": ("HIGH", 0), "s3": ("HIGH", 0)}
    assert {r.scan_id: r.total_findings for r in result.summary.collect()} == {"s1": 1, "s2": 1, "s3": 0}
    known = scans.where("scan_id <> 's2'")  # a scan that only shows up in the reports
    strict = run_scans(lake, None, known, cfg.POLICY_CONFIG, fail_on="LOW")
    assert {r.scan_id: r.exit_code for r in strict.status.collect()} == {"s1": 2, "s2": 2, "s3": 0}
    assert {r.scan_id: (r.repository, r.total_findings) for r in strict.summary.collect()} == {"s1": ("r", 1), "s2": (None, 1), "s3": ("r", 0)}


def test_tool_thresholds(raw):
    issues = [{"id": s, "severity": s} for s in ("low", "high", "critical")]
    vulns = [{"VulnerabilityID": "a", "Severity": "LOW", "FixedVersion": "2"}, {"VulnerabilityID": "b", "Severity": "HIGH"},
             {"VulnerabilityID": "c", "Severity": "HIGH", "FixedVersion": "2"}]
    reports = raw("snyk-iac", json.dumps([{"infrastructureAsCodeIssues": issues}])).unionByName(
        raw("trivy-container", json.dumps({"Results": [{"Vulnerabilities": vulns}]}), target="Dockerfile")
    )
    config = {
        "tool_config": {"snyk": {"severity_threshold": "high"}},
        "tools": {"container": {"severities": "HIGH,CRITICAL", "ignore_unfixed": True}},
    }
    assert {r.rule_id for r in normalize_all(reports, None, config).collect()} == {"high", "critical", "c"}
    assert {r.rule_id for r in normalize_all(reports, None, {}).collect()} == {"low", "high", "critical", "a", "b", "c"}


def test_disabled_tools_do_not_run(lake):
    config = {**cfg.POLICY_CONFIG, "tools": {"terraform": {"tfsec": False}}}
    assert {r.tool for r in normalize_all(lake, None, config).collect()} == {"checkov", "terraform-fmt"}


def test_switches_of_npm_and_container(spark, raw):
    vulnerable = json.dumps({"vulnerabilities": {"p": {"severity": "high"}}})
    image = json.dumps({"Results": [{"Vulnerabilities": [{"VulnerabilityID": "C1"}]}]})
    reports = (
        raw("npm-audit", vulnerable, code=1).unionByName(raw("trivy-container", image, target="x/Dockerfile"))
        .unionByName(raw("container-build", "", code=1, stderr="e")).unionByName(raw("tflint", '{"issues":[{}]}'))
    )
    everything = {r.tool for r in normalize_all(reports, None, {}).collect()}
    assert everything == {"npm-audit", "trivy-container", "tflint"}
    off = {"tools": {"npm": {"enabled": False}, "container": {"enabled": False}}}
    assert {r.tool for r in normalize_all(reports, None, off).collect()} == {"tflint"}
    ready = {"tools": {"container": {"build_images": False}}}
    (found,) = normalize_all(reports.where("tool = 'trivy-container'"), None, ready).collect()
    assert found.file_path is None and found.resource == "x/Dockerfile" and json.loads(found.metadata)["image"] == "x/Dockerfile"


def test_a_replaced_normaliser_is_used(raw, monkeypatch):
    from findlake.operators.normalize import NORMALIZERS

    monkeypatch.setitem(NORMALIZERS, "bandit", lambda reports, config: NORMALIZERS["tflint"](reports, config))
    assert normalize_all(raw("bandit", '{"issues":[{},{}]}'), None, {}).count() == 2


def test_errors_are_listed_and_stop_nothing(spark, raw):
    scans = spark.createDataFrame([("s", "r", "m", "t", False)], "scan_id string, repository string, branch string, scan_timestamp string, errored boolean")
    reports = (
        raw("tflint", '{"issues":["odd",5,{"message":"m"},null]}', '{"issues":{"a":1}}', "broken", '{"issues":[{"range":{"start":{"line":"twelve"}}}]}')
        .unionByName(raw("trivy", '{"Results":[{"Misconfigurations":[{"ID":"x"},7]},"no"]}'))
        .unionByName(raw("tfsec", '{"results":[{}]}').withColumn("seq", F.lit(1 << 31).cast("bigint")))
        .unionByName(raw("tfsec", '{"results":[{}]}', scan=None))
    )
    result = run_scans(reports, None, scans, {})
    got = sorted((r.tool, r.reason, r.position, r.text) for r in result.errors.collect() if r.reason not in ("no scan", "number", "report"))
    assert got == [
        ("tflint", "entry", "0", "odd"), ("tflint", "entry", "1", "5"), ("tflint", "field $.range.start.line", "0", "twelve"),
        ("tflint", "list", "", '{"a":1}'), ("trivy", "entry", "0.1", "7"), ("trivy", "entry", "1", "no"),
    ]
    whole = sorted((r.tool, r.reason) for r in result.errors.collect() if r.position is None)
    assert whole == [("tflint", "report"), ("tfsec", "no scan"), ("tfsec", "number")]
    assert result.findings.count() == 3
    assert [r.scan_id for r in result.status.collect()] == ["s"]


def test_files_are_read_by_as_many_tasks_as_a_shuffle_starts_with(spark, tmp_path):
    for i in range(12):
        (tmp_path / f"s{i}").mkdir()
        (tmp_path / f"s{i}" / "a.txt").write_text("x" * i)
    files = read_files(spark, str(tmp_path))
    assert files.rdd.getNumPartitions() == shuffle_partitions(spark)
    assert sorted((r.scan_id, len(r.content)) for r in files.collect()) == sorted((f"s{i}", i) for i in range(12))


def test_tables_laid_out_by_a_column_are_not_sorted_by_it(spark, raw, monkeypatch):
    from pyspark.sql import DataFrameWriter

    key, seen, write = "spark.sql.maxConcurrentOutputFileWriters", [], DataFrameWriter.parquet
    before = spark.conf.get(key, None)
    monkeypatch.setattr(DataFrameWriter, "parquet", lambda self, *a, **k: (seen.append(int(spark.conf.get(key, "0"))), write(self, *a, **k)))
    laid = lay_out_by_tool(raw("tflint", "a", "b").union(raw("pylint", "c")))
    assert seen and seen[0] > 1 and spark.conf.get(key, None) == before
    assert sorted((r.tool, r.stdout) for r in laid.collect()) == [("pylint", "c"), ("tflint", "a"), ("tflint", "b")]


def test_more_events_are_made_into_reports_by_more_tasks(spark, tmp_path, monkeypatch):
    from catalog import inputs

    events = spark.range(100).selectExpr("id as event_id", "id % 3 as user_id", "cast(id as timestamp) as ts", "concat('k', id) as props")
    events.write.parquet(str(tmp_path / "events.parquet"))
    monkeypatch.setattr(inputs, "EVENTS_A_TASK", 4, raising=False)
    made = inputs.raw_reports(spark, str(tmp_path), "tflint")
    assert made.rdd.getNumPartitions() == 25 and made.count() == 100
