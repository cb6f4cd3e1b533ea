"""One hand-written case per tool and shape: full rows, defaults, nulls, odd and broken reports."""

from __future__ import annotations

import json

import pytest

from findlake.model import FINDING_COLUMNS, FINDINGS, TOOL_BY_NAME
from findlake.operators import normalize as n


def rows(df):
    assert df.columns == FINDING_COLUMNS
    assert [f.dataType for f in df.schema] == [f.dataType for f in FINDINGS]
    return [r.asDict() for r in df.orderBy("seq").collect()]


# tool -> (one full report, expected fields of its single finding)
FULL = {
    "terraform-validate": (
        {"valid": False, "diagnostics": [{"severity": "error", "summary": "bad", "range": {"filename": "m.tf", "start": {"line": 3}}}]},
        {"severity": "HIGH", "rule_id": "VAL001", "description": "bad", "file_path": "m.tf", "line_number": 3},
    ),
    "tflint": (
        {"issues": [{"rule": {"name": "r", "severity": "error"}, "message": "m", "range": {"filename": "a.tf", "start": {"line": 2}}}]},
        {"severity": "HIGH", "rule_id": "r", "title": "m", "description": "m", "file_path": "a.tf", "line_number": 2},
    ),
    "tfsec": (
        {"results": [{"severity": "CRITICAL", "rule_id": "r", "rule_description": "t", "description": "d",
                      "location": {"filename": "a.tf", "start_line": 4}, "resource": "x", "links": ["l1", "l2"]}]},
        {"severity": "CRITICAL", "rule_id": "r", "title": "t", "description": "d", "file_path": "a.tf", "line_number": 4,
         "resource": "x", "remediation": "l1"},
    ),
    "checkov": (
        {"results": {"failed_checks": [{"check_id": "C", "check_name": "use imdsv2", "check_result": {"result": "FAILED"},
                                        "file_path": "/a.tf", "file_line_range": [5, 9], "resource": "x", "guideline": "g"}]}},
        {"severity": "HIGH", "rule_id": "C", "title": "use imdsv2", "description": "FAILED", "file_path": "/a.tf",
         "line_number": 5, "resource": "x", "remediation": "g"},
    ),
    "trivy": (
        {"Results": [{"Target": "none.tf"}, {"Target": "a.tf", "Misconfigurations": [
            {"ID": "D", "Severity": "LOW", "Title": "t", "Description": "d", "Resolution": "r", "CauseMetadata": {"Resource": "x"}}]}]},
        {"severity": "LOW", "rule_id": "D", "title": "t", "description": "d", "file_path": "a.tf", "line_number": None,
         "resource": "x", "remediation": "r"},
    ),
    "cfn-lint": (
        [{"Rule": {"Id": "E1", "ShortDescription": "s"}, "Level": "Error", "Message": "m", "Filename": "a.yaml",
          "Location": {"Start": {"LineNumber": 7}}}],
        {"severity": "HIGH", "rule_id": "E1", "title": "s", "description": "m", "file_path": "a.yaml", "line_number": 7},
    ),
    "cfn-nag": (
        [{"filename": "a.yaml", "file_results": {"violations": [
            {"id": "F1", "type": "FAIL", "message": "m", "line_numbers": [8, 9], "logical_resource_ids": ["A", "B"]}]}}],
        {"severity": "HIGH", "rule_id": "F1", "title": "m", "description": "m", "file_path": "a.yaml", "line_number": 8,
         "resource": "A, B"},
    ),
    "bandit": (
        {"results": [{"test_id": "B301", "test_name": "n", "issue_text": "t", "issue_severity": "low", "filename": "/repo/a.py",
                      "line_number": 6, "code": "c" * 300, "cwe": {"id": 502}, "issue_confidence": "HIGH"}]},
        {"severity": "LOW", "rule_id": "B301", "title": "t", "description": "t - n", "file_path": "a.py", "line_number": 6},
    ),
    "pylint": (
        [{"message-id": "W1", "symbol": "s", "message": "m", "type": "fatal", "path": "/repo//a.py", "line": 1, "column": 4, "module": "a"}],
        {"severity": "CRITICAL", "rule_id": "W1", "title": "s: m", "description": "m", "file_path": "a.py", "line_number": 1},
    ),
    "npm-audit": (
        {"vulnerabilities": {"p": {"severity": "moderate", "via": [{"title": "t"}], "fixAvailable": {"version": "2"}}}},
        {"severity": "INFO", "rule_id": "npm-p", "title": "Vulnerable dependency: p", "description": "t",
         "remediation": "Update to version 2", "file_path": "."},
    ),
    "snyk-iac": (
        {"targetFile": "a.tf", "infrastructureAsCodeIssues": [
            {"id": "S", "severity": "high", "lineNumber": 3, "issue": "i", "impact": "p", "title": "t", "subType": "x", "resolve": "r",
             "publicId": "S", "documentation": "u", "references": ["q"]}]},
        {"severity": "HIGH", "rule_id": "S", "title": "t", "description": "i Impact: p", "file_path": "a.tf", "line_number": 3,
         "resource": "x", "remediation": "r"},
    ),
}


@pytest.mark.parametrize("tool", FULL)
def test_full_report(raw, tool):
    report, expected = FULL[tool]
    (found,) = rows(n.NORMALIZERS[tool](raw(tool, json.dumps(report), code=1), {}))
    assert {k: found[k] for k in expected} == expected
    assert found["tool"] == TOOL_BY_NAME[tool].finding_tool
    assert found["scan_id"] == "s"
    assert json.loads(found["metadata"])


# tool -> (report with one empty result, expected defaults)
EMPTY = {
    "terraform-validate": ({"valid": False, "diagnostics": [{}]}, ("MEDIUM", "VAL001", "Terraform validation error", "Validation failed")),
    "tflint": ({"issues": [{}]}, ("MEDIUM", "UNKNOWN", "Linting issue", "")),
    "tfsec": ({"results": [{}]}, ("MEDIUM", "UNKNOWN", "Security issue detected", "")),
    "checkov": ({"results": {"failed_checks": [{}]}}, ("MEDIUM", "UNKNOWN", "Policy violation", "")),
    "checkov-cfn": ({"results": {"failed_checks": [{}]}}, ("MEDIUM", "UNKNOWN", "Policy violation", "")),
    "trivy": ({"Results": [{"Misconfigurations": [{}]}]}, ("MEDIUM", "UNKNOWN", "Misconfiguration detected", "")),
    "cfn-lint": ([{}], ("MEDIUM", "UNKNOWN", "Validation issue", "")),
    "cfn-nag": ([{"file_results": {"violations": [{}]}}], ("MEDIUM", "UNKNOWN", "Security violation", "")),
    "bandit": ({"results": [{}]}, ("MEDIUM", "UNKNOWN", "Security issue detected", " - ")),
    "safety": ([{}], ("HIGH", "UNKNOWN", "Vulnerable dependency: unknown unknown", "Known vulnerability in dependency")),
    "pylint": ([{}], ("INFO", "", ": Code quality issue", "")),
    "npm-audit": ({"vulnerabilities": {"p": {}}}, ("LOW", "npm-p", "Vulnerable dependency: p", "")),
    "snyk-iac": ([{"infrastructureAsCodeIssues": [{}]}], ("MEDIUM", "UNKNOWN", "IaC security issue", "")),
    "trivy-container": ({"Results": [{"Vulnerabilities": [{}]}]}, ("MEDIUM", "UNKNOWN", "UNKNOWN: ", "")),
}


@pytest.mark.parametrize("tool", EMPTY)
def test_defaults(raw, tool):
    report, expected = EMPTY[tool]
    (found,) = rows(n.NORMALIZERS[tool](raw(tool, json.dumps(report), code=1), {}))
    assert (found["severity"], found["rule_id"], found["title"], found["description"]) == expected
    assert found["line_number"] is None


@pytest.mark.parametrize("tool", EMPTY)
def test_null_lists_and_broken_reports_give_nothing(raw, tool):
    report = json.dumps(EMPTY[tool][0])
    broken = ["", "  \n", "null", "garbage", report[:-1], report + " x", report + report, "{}", "[]", '"text"', "5"]
    if isinstance(EMPTY[tool][0], dict):
        broken.append("[" + report + "]") if tool != "snyk-iac" else None
    empty = json.loads(report)
    if isinstance(empty, dict):
        for key in empty:
            empty[key] = False if key == "valid" else None
        broken.append(json.dumps(empty))
    assert rows(n.NORMALIZERS[tool](raw(tool, *broken, code=1), {})) == []


def test_single_quotes_are_not_json(raw):
    assert rows(n.tflint(raw("tflint", "{'issues': [{}]}"))) == []


def test_bad_neighbours_do_not_matter(raw):
    report = '{"results":[null, 5, "x", {"rule_id":"A","location":{"start_line":"no"}}, {"rule_id":"B"}]}'
    found = rows(n.tfsec(raw("tfsec", report)))
    assert [f["rule_id"] for f in found] == ["A", "B"]
    assert [f["seq"] & ((1 << 28) - 1) for f in found] == [3, 4]  # positions count what is skipped


def test_raw_result_is_kept_whole(raw):
    report = '{"issues":[{"unknown":{"deep":[1,2.5,"é"]},"message":"m"}]}'
    (found,) = rows(n.tflint(raw("tflint", report)))
    assert json.loads(found["metadata"]) == {"unknown": {"deep": [1, 2.5, "é"]}, "message": "m"}


def test_sequence_orders_tool_report_position(raw):
    two = '{"issues":[{"message":"a"},{"message":"b"}]}'
    lint = rows(n.tflint(raw("tflint", two, two)))
    assert [f["title"] for f in lint] == ["a", "b", "a", "b"]
    assert max(f["seq"] for f in rows(n.terraform_fmt(raw("terraform-fmt", "x.tf", code=1)))) < lint[0]["seq"]


def test_children_are_numbered_across_parents(raw):
    report = {"Results": [{"Target": "a", "Misconfigurations": [{"ID": "1"}, {"ID": "2"}]}, {"Target": "b", "Misconfigurations": [{"ID": "3"}]}]}
    found = rows(n.trivy(raw("trivy", json.dumps(report))))
    assert [(f["rule_id"], f["file_path"], f["seq"] & 7) for f in found] == [("1", "a", 0), ("2", "a", 1), ("3", "b", 2)]


def test_report_number_out_of_range_has_no_place(raw):
    from pyspark.sql import functions as F

    from findlake.operators.errors import report_errors, usable

    far = raw("tflint", '{"issues":[{}]}').withColumn("seq", F.lit(1 << 30).cast("bigint"))
    assert [f["seq"] for f in rows(n.tflint(far))] == [None]
    assert usable(far).isEmpty() and [r.reason for r in report_errors(far).collect()] == ["number"]


def test_terraform_fmt(raw):
    text = "\n  a.tf \n\nb.tf\t\n \n c.tf\n"
    found = rows(n.terraform_fmt(raw("terraform-fmt", text, code=3)))
    assert [f["file_path"] for f in found] == ["a.tf", "b.tf", "c.tf"]
    assert found[2]["description"] == "File  c.tf is not properly formatted"
    assert found[0]["severity"] == "LOW" and found[0]["remediation"] == "Run: terraform fmt"
    assert rows(n.terraform_fmt(raw("terraform-fmt", text, code=0))) == []


def test_validate_needs_a_failed_run(raw):
    bad, good = '{"valid":false,"diagnostics":[{}]}', '{"valid":true,"diagnostics":[{}]}'
    assert rows(n.terraform_validate(raw("terraform-validate", bad, code=0))) == []
    assert rows(n.terraform_validate(raw("terraform-validate", good, code=1))) == []
    assert rows(n.terraform_validate(raw("terraform-validate", '{"diagnostics":[{}]}', code=1))) == []


@pytest.mark.parametrize("wrap", ["%s", '{"vulnerabilities":%s}', '{"scanned_packages":{"vulnerabilities":%s}}'])
def test_safety_shapes_and_names(raw, wrap):
    items = [
        {"cve": "CVE-1", "package": "p", "installed_version": "1", "affected_versions": "<2", "advisory": "a"},
        {"cve": "", "vulnerability_id": "44", "package_name": "q", "analyzed_version": "3", "vulnerable_spec": "<4", "description": "d"},
    ]
    one, two = rows(n.safety(raw("safety", wrap % json.dumps(items), target="/repo/requirements.txt")))
    assert (one["rule_id"], one["title"], one["description"]) == ("CVE-1", "Vulnerable dependency: p 1", "a")
    assert (two["rule_id"], two["title"], two["description"]) == ("44", "Vulnerable dependency: q 3", "d")
    assert two["remediation"] == "Update q to a secure version. Vulnerable: <4"
    assert one["file_path"] == "requirements.txt"
    assert json.loads(one["metadata"]) == {"package": "p", "installed_version": "1", "affected_versions": "<2", "cve": "CVE-1"}


def test_bandit_metadata(raw):
    (found,) = rows(n.bandit(raw("bandit", json.dumps(FULL["bandit"][0]))))
    assert json.loads(found["metadata"]) == {"confidence": "HIGH", "code": "c" * 200, "cwe": {"id": 502}}
    (bare,) = rows(n.bandit(raw("bandit", '{"results":[{}]}')))
    assert json.loads(bare["metadata"]) == {"confidence": "UNKNOWN", "code": "", "cwe": {}}


def test_pylint_metadata(raw):
    (found,) = rows(n.pylint(raw("pylint", json.dumps(FULL["pylint"][0]))))
    assert json.loads(found["metadata"]) == {"column": 4, "symbol": "s", "message_type": "fatal", "module": "a"}


def test_npm_audit_odd_values(raw):
    report = {
        "vulnerabilities": {
            "a": {"via": ["x"], "fixAvailable": True},
            "b": {"via": [], "fixAvailable": False},
            "c": {"via": "plain", "fixAvailable": {}},
            "d": {"via": [{"url": "u"}], "fixAvailable": {"name": "n"}},
        }
    }
    found = rows(n.npm_audit(raw("npm-audit", json.dumps(report), target="web/package.json")))
    assert [(f["description"], f["remediation"]) for f in found] == [
        ("Dependency vulnerability", "Update to version latest"),
        ("Dependency vulnerability", "Review and update dependency"),
        ("plain", "Review and update dependency"),
        ("Dependency vulnerability", "Update to version latest"),
    ]
    assert {f["file_path"] for f in found} == {"web/package.json"}


def test_snyk_list_object_error(raw):
    report = FULL["snyk-iac"][0]
    outputs = [json.dumps(report), json.dumps([report, {"targetFile": "b"}, None]), '{"error":"no"}']
    assert len(rows(n.snyk_iac(raw("snyk-iac", *outputs)))) == 2
    (found,) = rows(n.snyk_iac(raw("snyk-iac", outputs[0])))
    assert json.loads(found["metadata"]) == {"publicId": "S", "documentation": "u", "references": ["q"]}
    zero = {"infrastructureAsCodeIssues": [{"lineNumber": 0}]}
    (found,) = rows(n.snyk_iac_template(raw("snyk-iac-template", json.dumps(zero))))
    assert (found["line_number"], found["file_path"], found["tool"]) == (None, "unknown", "snyk-iac")


def test_container(raw):
    item = {"VulnerabilityID": "CVE-1", "PkgName": "p", "InstalledVersion": "1", "FixedVersion": "2", "Severity": "UNKNOWN",
            "Description": "d", "References": ["r"], "CVSS": {"nvd": {"score": 5}}}
    report = {"Results": [{"Target": "alpine", "Type": "os", "Vulnerabilities": [item]}, {"Vulnerabilities": [{"PkgName": "q"}]}]}
    one, two = rows(n.trivy_container(raw("trivy-container", json.dumps(report), target="svc/Dockerfile.prod")))
    assert (one["title"], one["remediation"], one["resource"]) == ("CVE-1: p (1)", "Upgrade p to version 2", "alpine (os)")
    assert (one["severity"], one["file_path"]) == ("INFO", "svc/Dockerfile.prod")
    assert json.loads(one["metadata"]) == {
        "image": "scan-svc:latest", "package": "p", "installed_version": "1", "fixed_version": "2",
        "references": ["r"], "cvss": {"nvd": {"score": 5}},
    }
    assert (two["title"], two["remediation"], two["resource"]) == ("UNKNOWN: q", "No fix available yet", "scan-svc:latest")


def test_build_failure(raw):
    (found,) = rows(n.container_build(raw("container-build", "", code=1, stderr="e" * 900, target="Dockerfile")))
    assert found["description"] == "Failed to build Docker image from Dockerfile: " + "e" * 500
    assert (found["severity"], found["rule_id"], found["tool"]) == ("HIGH", "BUILD_FAILURE", "trivy-container")
    assert rows(n.container_build(raw("container-build", "", code=0))) == []


def test_parse_errors(raw):
    reports = raw("tflint", '{"issues":[]}', "", "[]", "{", "{} x").unionByName(raw("cfn-lint", "[]", "{}"))
    reports = reports.unionByName(raw("safety", "[]", "{}", "5")).unionByName(raw("terraform-fmt", "a.tf"))
    got = {(r.tool, r.stdout) for r in n.parse_errors(reports).collect()}
    assert got == {("tflint", "[]"), ("tflint", "{"), ("tflint", "{} x"), ("cfn-lint", "{}"), ("safety", "5")}


def test_registry_takes_new_tools(raw):
    from pyspark.sql import functions as F

    def mine(reports):
        listed = n.read(n.results(reports, n.top_list()), "id string")
        return n.findings_of(listed, "tflint", severity=F.lit("LOW"), rule_id=F.col("id"), title=F.lit("t"), description=F.lit(""))

    registry = {**n.NORMALIZERS, "mine": mine}
    (found,) = rows(registry["mine"](raw("mine", '[{"id":"M1"}]')))
    assert found["rule_id"] == "M1"
