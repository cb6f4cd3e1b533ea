"""Schemas of the tables and the fixed dimensions of the findings model."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import types as T

# --- fixed values: severity levels, lowest first; the position is the rank -------------------
SEVERITIES = ["INFO", "LOW", "MEDIUM", "HIGH", "CRITICAL"]
# ---------------------------------------------------------------------------------------------

SEVERITIES_DESC = SEVERITIES[::-1]


class Tool(NamedTuple):
    """One normalised tool: its place in the run order and the policy that applies to it."""

    name: str  # value of raw_reports.tool
    finding_tool: str  # value of findings.tool
    rank: int  # run order, the most significant part of findings.seq
    scanner: str  # scanner type in the configuration
    flag: str  # enable flag under tools.<scanner>
    exclude_key: str | None  # key under tools.<scanner>.exclude_rules
    path_filtered: bool  # excluded paths are dropped by us, not by the tool
    layer: str


# --- fixed values: run order, configuration keys and layers of the tools ---------------------
TOOLS = [
    Tool("terraform-fmt", "terraform-fmt", 0, "terraform", "terraform_fmt", None, True, "lint"),
    Tool("terraform-validate", "terraform-validate", 1, "terraform", "terraform_validate", None, False, "lint"),
    Tool("tflint", "tflint", 2, "terraform", "tflint", "tflint", True, "lint"),
    Tool("tfsec", "tfsec", 3, "terraform", "tfsec", "tfsec", False, "security"),
    Tool("checkov", "checkov", 4, "terraform", "checkov", "checkov", False, "security"),
    Tool("trivy", "trivy", 5, "terraform", "trivy", "trivy", False, "security"),
    Tool("cfn-lint", "cfn-lint", 6, "cloudformation", "cfn_lint", "cfn_lint", False, "lint"),
    Tool("cfn-nag", "cfn-nag", 7, "cloudformation", "cfn_nag", "cfn_nag", False, "security"),
    Tool("checkov-cfn", "checkov-cfn", 8, "cloudformation", "checkov", "checkov", False, "security"),
    Tool("bandit", "bandit", 9, "python", "bandit", "bandit", False, "security"),
    Tool("safety", "safety", 10, "python", "safety", "safety", False, "dependency"),
    Tool("pylint", "pylint", 11, "python", "pylint", "pylint", False, "lint"),
    Tool("npm-audit", "npm-audit", 12, "npm", "npm_audit", None, True, "dependency"),
    Tool("snyk-iac-template", "snyk-iac", 13, "npm", "snyk", "snyk", True, "security"),
    Tool("snyk-iac", "snyk-iac", 14, "npm", "snyk", "snyk", False, "security"),
    Tool("container-build", "trivy-container", 15, "container", "build_images", None, False, "dependency"),
    Tool("trivy-container", "trivy-container", 15, "container", "enabled", "trivy", False, "dependency"),
    Tool("secrets", "secrets", 16, "secrets", "gitleaks", "gitleaks", False, "secrets"),
]
# ---------------------------------------------------------------------------------------------

TOOL_BY_NAME = {t.name: t for t in TOOLS}

FILES = T.StructType(
    [
        T.StructField("scan_id", T.StringType()),
        T.StructField("repo", T.StringType()),
        T.StructField("path", T.StringType()),
        T.StructField("content", T.StringType()),
        T.StructField("read_ok", T.BooleanType()),
    ]
)

RAW_REPORTS = T.StructType(
    [
        T.StructField("scan_id", T.StringType()),
        T.StructField("tool", T.StringType()),
        T.StructField("target", T.StringType()),
        T.StructField("seq", T.LongType()),
        T.StructField("return_code", T.IntegerType()),
        T.StructField("stdout", T.StringType()),
        T.StructField("stderr", T.StringType()),
    ]
)

FINDINGS = T.StructType(
    [
        T.StructField("scan_id", T.StringType()),
        T.StructField("seq", T.LongType()),
        T.StructField("tool", T.StringType()),
        T.StructField("severity", T.StringType()),
        T.StructField("rule_id", T.StringType()),
        T.StructField("title", T.StringType()),
        T.StructField("description", T.StringType()),
        T.StructField("file_path", T.StringType()),
        T.StructField("line_number", T.IntegerType()),
        T.StructField("resource", T.StringType()),
        T.StructField("remediation", T.StringType()),
        T.StructField("metadata", T.StringType()),
    ]
)

FINDING_COLUMNS = FINDINGS.fieldNames()

# findings.seq = tool rank | report number within the scan | position within the report. A report
# numbered beyond 30 bits and an entry placed beyond 28 are listed by ``parse_errors``, not misplaced.
POSITION_BITS = 28
REPORT_BITS = 30
