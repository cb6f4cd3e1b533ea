"""Reports: documents assembled from the written files are whole, valid and readable again."""

from __future__ import annotations

import glob
import json
import os

import pytest

from findlake.operators import aggregate
from findlake.plans import report
from findlake.sources.reports import read_report_counts, read_whole_reports


@pytest.fixture(scope="module")
def found(findings):
    many = [{"scan_id": "hot", "rule_id": f"R{i % 7}", "title": f"t{i}", "severity": ["LOW", "CRITICAL", "INFO"][i % 3],
             "tool": ["tfsec", "bandit"][i % 2], "line_number": i} for i in range(400)]
    odd = {"scan_id": "odd", "tool": "cfn-lint", "title": '1 "q" <b> & é\n', "description": "", "file_path": "/repo/./x.yaml",
           "line_number": 0, "resource": "r", "remediation": "do <it>", "metadata": '{"a":[1,"x"]}'}
    return findings(*many, odd, {"scan_id": "odd", "file_path": None, "line_number": 4, "severity": "LOW"})


@pytest.fixture(scope="module")
def scans(spark, found):
    rows = [("hot", "repo", "main", "2026-01-01T00:00:00"), ("odd", "r&d", None, "2026-01-02T00:00:00"), ("none", "r", None, "2026-01-03T00:00:00")]
    facts = spark.createDataFrame(rows, "scan_id string, repository string, branch string, scan_timestamp string")
    return aggregate.summarize(found, facts)


def documents(fragments, path):
    report.write_report(fragments, path)
    docs = {}
    for folder in glob.glob(f"{path}/scan_id=*"):
        parts = sorted(glob.glob(f"{folder}/section=*/part-*"))
        text = "".join(open(p, encoding="utf-8").read() for p in parts)
        docs[os.path.basename(folder).removeprefix("scan_id=")] = (text, len(parts))
    return docs


def test_json(spark, found, scans, tmp_path):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # keep small ranges apart
    docs = documents(report.json_report(found, scans), str(tmp_path / "json"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    hot = json.loads(docs["hot"][0])
    assert hot["summary"] == {
        "total_findings": 400, "by_severity": {"CRITICAL": 133, "LOW": 134, "INFO": 133},
        "by_tool": {"tfsec": 200, "bandit": 200}, "unique_files": 1,
    }
    assert [f["title"] for f in hot["findings"]] == [f"t{i}" for i in range(400)]
    assert hot["metadata"] == {"scanners_run": ["tfsec", "bandit"], "total_raw_findings": 400, "deduplication_enabled": True}
    assert docs["hot"][1] > 1  # a large scan is written by several tasks
    odd = json.loads(docs["odd"][0])
    assert odd["branch"] is None
    assert odd["findings"][0]["metadata"] == {"a": [1, "x"]}
    assert odd["findings"][0]["title"] == '1 "q" <b> & é\n'
    assert odd["findings"][1]["file_path"] is None
    none = json.loads(docs["none"][0])
    assert none["findings"] == [] and none["summary"]["by_severity"] == {}
    counts = {r.scan_id: (r.total, r.critical, r.high, r.medium, r.low) for r in read_report_counts(spark, str(tmp_path / "json")).collect()}
    assert counts == {"hot": (400, 133, 0, 0, 134), "odd": (2, 0, 1, 0, 1), "none": (0, 0, 0, 0, 0)}


def test_whole_reports_of_other_programs(spark, tmp_path):
    folder = tmp_path / "scan_id=a"
    folder.mkdir()
    doc = {"summary": {"total_findings": 3, "by_severity": {"HIGH": 2, "LOW": 1}}, "findings": [{"x": 1}]}
    (folder / "report.json").write_text(json.dumps(doc, indent=2))
    row = read_whole_reports(spark, str(tmp_path)).first()
    assert (row.scan_id, row.total, row.critical, row.high, row.medium, row.low) == ("a", 3, 0, 2, 0, 1)


def test_sarif(found, scans, tmp_path):
    docs = documents(report.sarif_report(found, scans), str(tmp_path / "sarif"))
    hot = json.loads(docs["hot"][0])
    assert hot["version"] == "2.1.0"
    assert [r["tool"]["driver"]["name"] for r in hot["runs"]] == ["findlake (tfsec)", "findlake (bandit)"]
    run = hot["runs"][0]
    assert [r["id"] for r in run["tool"]["driver"]["rules"]] == ["R0", "R2", "R4", "R6", "R1", "R3", "R5"]  # first seen
    assert run["tool"]["driver"]["rules"][1]["name"] == "t2"  # described by its first finding
    assert len(run["results"]) == 200
    assert run["invocations"] == [{"executionSuccessful": True, "endTimeUtc": "2026-01-01T00:00:00Z"}]
    result = json.loads(docs["odd"][0])["runs"][0]
    rule, first = result["tool"]["driver"]["rules"][0], result["results"][0]
    assert rule["name"] == "_1__q___b____é_" and rule["help"] == {"text": "do <it>", "markdown": "do <it>"}
    assert rule["fullDescription"]["text"] == '1 "q" <b> & é\n'  # no description: the title
    assert first["message"]["text"] == '1 "q" <b> & é\n | Resource: r'
    location = first["locations"][0]["physicalLocation"]
    assert location == {"artifactLocation": {"uri": "x.yaml", "uriBaseId": "%SRCROOT%"}}  # line 0 is no region
    assert "locations" not in json.loads(docs["odd"][0])["runs"][1]["results"][0]
    assert json.loads(docs["none"][0])["runs"] == []


def test_markdown(found, scans, tmp_path):
    docs = documents(report.markdown_report(found, scans), str(tmp_path / "md"))
    hot = docs["hot"][0]
    assert hot.index("### CRITICAL Severity (133 findings)") < hot.index("#### 133. t397") < hot.index("### LOW Severity (134")
    assert "**Branch:** main" in hot and "**Branch:**" not in docs["odd"][0]
    assert "- **Location:** `/repo/./x.yaml`\n- **Resource:** r\n- **Remediation:** do <it>" in docs["odd"][0]
    assert docs["none"][0].rstrip().endswith("No findings detected.")


def test_html(found, scans, tmp_path):
    docs = documents(report.html_report(found, scans), str(tmp_path / "html"))
    assert "1 &quot;q&quot; &lt;b&gt; &amp; é" in docs["odd"][0] and "r&amp;d" in docs["odd"][0]
    assert docs["hot"][0].count('<div class="finding">') == 400
    assert docs["none"][0].rstrip().endswith("</html>") and "No findings detected." in docs["none"][0]


def test_ci(spark, found, scans, tmp_path):
    gates = spark.createDataFrame(
        [("hot", "CRITICAL", False), ("odd", "NONE", False), ("none", None, True)], "scan_id string, fail_on string, errored boolean"
    )
    status = report.report_status(aggregate.gate(found, gates), gates)
    outputs = {(r.scan_id, r.name): r.value for r in report.ci_outputs(scans, status).collect()}
    assert outputs["hot", "scan-status"] == "failed" and outputs["none", "scan-status"] == "error"
    assert outputs["hot", "critical-count"] == "133" and outputs["odd", "findings-count"] == "2"
    assert len(outputs) == 24
    docs = documents(report.ci_summary(found, scans, status), str(tmp_path / "summary"))
    assert ":x: Failed - Findings detected at or above CRITICAL" in docs["hot"][0]
    assert "10. :red_circle: **CRITICAL** - t28" in docs["hot"][0]
    assert "*... and 390 more findings." in docs["hot"][0] and "more findings" not in docs["odd"][0]
    logs = documents(report.ci_log(found, scans), str(tmp_path / "log"))
    assert [logs["hot"][0].count(f"--- {s} ---") for s in ("CRITICAL", "HIGH", "LOW", "INFO")] == [1, 0, 1, 1]
    assert "Location: /repo/./x.yaml:0" in logs["odd"][0] and "Location: None:4" in logs["odd"][0]
    assert logs["none"][0].strip() == "No findings to display."


def test_outputs_name_what_was_written(spark, findings, tmp_path):
    found = findings({"scan_id": "a:b/c [1]"}, {"scan_id": "plain"})
    scans = spark.createDataFrame([("a:b/c [1]",), ("plain",)], "scan_id string").selectExpr(
        "scan_id", "'r' repository", "'main' branch", "'2026-01-01T00:00:00' scan_timestamp"
    )
    summary = aggregate.summary_of(found, found, scans, True)
    gates = scans.selectExpr("scan_id", "'HIGH' fail_on", "false errored")
    status = report.report_status(aggregate.gate(found, gates), gates)
    root = str(tmp_path)
    assert report.write_reports(found, summary, ["sarif", "ci-outputs", "ci-summary"], root, status) == ["sarif", "ci-outputs", "ci-summary"]
    lines = [r.value for r in spark.read.text(f"{root}/ci-outputs").where("scan_id <> 'plain'").collect()]
    named = dict(line.split("=", 1) for line in lines)
    document = "\n".join(open(f).read() for f in sorted(glob.glob(glob.escape(named["sarif-path"]) + "/*/*.txt")))
    assert json.loads(document)["version"] == "2.1.0"
    no_sarif = report.ci_outputs(summary, status, root, ["json"])
    assert no_sarif.where("name = 'sarif-path'").isEmpty()


def test_parts_beyond_five_digits_stay_in_order():
    names = [f"section={i // report.FILES_PER_SECTION:08d}/part-{i:05d}" for i in range(0, 250_000, 7)]
    assert names == sorted(names)


def test_unknown_formats_are_ignored(found, scans, tmp_path):
    assert report.write_reports(found, scans, ["json", "pdf"], str(tmp_path)) == ["json"]
    assert sorted(os.listdir(tmp_path)) == ["json"]
