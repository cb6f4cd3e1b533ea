"""Value lists that inputs are made of, in the spelling of Spark SQL and of DuckDB.

Reports and findings are derived from ``events``: every value of a report is picked from one of
these lists by a number that follows from the event. Both sides pick alike, but only Spark builds
the JSON and parses it; DuckDB computes the expected finding straight from the event.
"""

from __future__ import annotations

SEVERITY_WORDS = [
    "critical", "HIGH", "Medium", "low", "info", "informational", "warning", "Error", "moderate", "UNKNOWN", None,
]
PATHS = [
    "main.tf",
    "modules/net/main.tf",
    "tests/a.tf",
    "/repo/latest/b.tf",
    "/repo/src/app.py",
    "cfn/t0.yaml",
    "cfn/t1.template",
    "web//index.ts",
    "./cfn/./t2.yml",
    None,
]
LINES = [1, 2, 3, 0, None]
TEXTS = ["short", "", 'with "quotes" & <tags>', "FAILED", "it's é ünï", None]
RESOURCES = ["aws_s3_bucket.b", "", "AWS::IAM::Role", None]
CHECK_NAMES = [
    "Ensure bucket is not public",
    "Ensure KMS encryption",
    "Ensure IMDSv2 is required",
    "Ensure log retention",
    "Ensure Tag is set",
    "Ensure something else",
    "No ingress from 0.0.0.0/0",
    "No ingress from 0a0b0c0/0",
    "Root account MFA",
    None,
]
RULES = {
    "tflint": ["terraform_required_version", "terraform_unused", "aws_instance_type", None],
    "tfsec": ["aws-s3-enable-versioning", "aws-vpc-no-public", None],
    "checkov": ["CKV_AWS_116", "CKV_AWS_117", "CKV_AWS_18", "CKV_AWS_21", None],
    "trivy": ["DS014", "DS026", "DS001", None],
    "cfn-lint": ["W2001", "E3012", None],
    "cfn-nag": ["W89", "W92", "F1000", None],
    "bandit": ["B404", "B603", "B110", "B112", "B101", "B301", "B703", None],
    "pylint": ["C0301", "R0913", "R0917", "W0611", None],
    "snyk": ["SNYK-CC-TF-1", "SNYK-CC-K8S-2", None],
    "cve": ["CVE-2021-44228", "CVE-2020-0001", None],
}


def spark_list(values: list) -> str:
    return "array(" + ", ".join(literal(v, "spark") for v in values) + ")"


def literal(value, dialect: str) -> str:
    if value is None:
        return "NULL"
    if isinstance(value, int):
        return str(value)
    escaped = value.replace("\\", "\\\\").replace("'", "\\'") if dialect == "spark" else value.replace("'", "''")
    return f"'{escaped}'"


def spark_pick(values: list, number: str) -> str:
    return f"element_at({spark_list(values)}, cast(({number}) % {len(values)} as int) + 1)"


def duck_pick(values: list, number: str) -> str:
    listed = ", ".join(literal(v, "duck") for v in values)
    return f"list_extract([{listed}], CAST(({number}) % {len(values)} AS BIGINT) + 1)"
