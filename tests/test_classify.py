"""File classification on small trees."""

from __future__ import annotations

import json

import pytest

from findlake.model import FILES
from findlake.operators import classify
from findlake.operators.secrets import SECRET_RULES, SecretRule, scan_secrets, secret_lines
from findlake.sources.config import POLICY_CONFIG

PATTERNS = POLICY_CONFIG["repository"]["excluded_paths"]
CFN = 'AWSTemplateFormatVersion: "2010-09-09"\nResources:\n  B:\n    Type: AWS::S3::Bucket\n'


@pytest.fixture(scope="module")
def tree(spark):
    def make(files, scan="s"):
        rows = [(scan, scan, path, text, text is not None) for path, text in files.items()]
        return spark.createDataFrame(rows, FILES)

    return make


def flags(files):
    return {k for k, v in classify.repo_flags(files).first().asDict().items() if v is True}


@pytest.mark.parametrize(
    ("files", "expected"),
    [
        ({"a/main.tf": ""}, {"terraform"}),
        ({"template.yaml": CFN}, {"cloudformation"}),
        ({"T.YAML": "x AWS:: y"}, {"cloudformation"}),
        ({"t.yaml": " " * 990 + "AWS::"}, {"cloudformation"}),
        ({"t.yaml": " " * 996 + "AWS::"}, set()),
        ({"t.txt": CFN, "u.yaml": None}, set()),
        ({"cdk.json": ""}, {"cdk"}),
        ({"a/cdk.json": ""}, set()),
        ({"package.json": "{"}, {"npm"}),
        ({"package.json": json.dumps({"devDependencies": {"aws-cdk-lib": "1"}})}, {"npm", "cdk"}),
        ({"package.json": json.dumps({"dependencies": {"@aws-cdk/core": "1"}})}, {"npm", "cdk"}),
        ({"package.json": json.dumps({"dependencies": {"aws-cdk": "1"}}) + "x"}, {"npm"}),
        ({"package.json": json.dumps({"name": "aws-cdk"})}, {"npm"}),
        ({"a/package.json": json.dumps({"dependencies": {"aws-cdk": "1"}})}, set()),
        ({"a.py": "", "b.tsx": "", "c.jsx": ""}, {"python", "typescript", "javascript"}),
        ({"tsconfig.json": "{}"}, {"typescript"}),
        ({"x/Dockerfile.dev": ""}, {"container"}),
        ({"x/Containerfile": ""}, {"container"}),
        ({"x/Dockerfile-dev": "", "MyDockerfile": ""}, set()),
    ],
)
def test_flags(tree, files, expected):
    assert flags(tree(files)) == expected


def test_scanner_order(tree):
    files = tree({"package.json": "", "a.py": "", "m.tf": "", "Dockerfile": "", "t.yaml": CFN, "cdk.json": ""})
    listed = classify.applicable_scanners(classify.repo_flags(files)).first().scanners
    assert listed == ["terraform", "cloudformation", "cdk", "npm", "python", "container", "secrets"]
    assert classify.applicable_scanners(classify.repo_flags(tree({"x": ""}))).first().scanners == ["secrets"]


@pytest.mark.parametrize(
    ("path", "text", "expected"),
    [
        ("cfn/a.yaml", CFN, True),
        ("cfn/a.template", CFN, True),
        ("cfn/a.YAML", CFN, False),
        ("latest/a.yaml", CFN, False),
        ("inspector.yaml", CFN, False),
        ("x/Package.JSON", CFN, False),
        ("a.yaml", "Resources:\n Type: AWS::X", True),
        ("a.json", '{"Resources": {"Type": "AWS::X"}}', True),
        ("a.yaml", "Type: AWS::X", False),
        ("a.json", '{"name": "AWSTemplateFormatVersion", "dependencies": {}}', False),
        ("a.json", '"compilerOptions" AWSTemplateFormatVersion', False),
        ("a.yaml", "x" * 1970 + "AWSTemplateFormatVersion", True),
        ("a.yaml", "x" * 1980 + "AWSTemplateFormatVersion", False),
        (".yaml", CFN, False),
        ("a.yaml", None, False),
        ("tests/fixtures/cloudformation/sample-template.yaml", CFN, False),
    ],
)
def test_strict_templates(tree, path, text, expected):
    assert (classify.cfn_templates(tree({path: text})).count() == 1) is expected


def test_targets(tree):
    files = tree({
        "Dockerfile": "", "tests/Dockerfile": "", "a/node_modules/Dockerfile": "", "package.json": "", "w/package.json": "",
        "node_modules/package.json": "", "requirements.txt": "", "requirements-dev.txt": "", "a/requirements.txt": "",
        "requirements/x.txt": "", "a.py": "", "test/b.py": "",
    })
    paths = lambda df: sorted(r.path for r in df.collect())
    assert paths(classify.dockerfiles(files, PATTERNS)) == ["Dockerfile"]
    assert paths(classify.audit_targets(files, PATTERNS)) == ["package.json", "w/package.json"]
    assert paths(classify.dependency_manifests(files)) == ["requirements-dev.txt", "requirements.txt"]
    assert paths(classify.pylint_targets(files, PATTERNS)) == ["a.py"]


def test_tool_plan(tree):
    files = tree({"m.tf": "", "a.py": "", "t.yaml": CFN})
    plan = classify.tool_plan(files, {"tools": {"python": {"bandit": False}}}, PATTERNS)
    tools = [r.tool for r in plan.orderBy("ord").collect()]
    assert tools == ["terraform-fmt", "terraform-validate", "tflint", "tfsec", "checkov", "trivy", "cfn-lint", "cfn-nag",
                     "checkov-cfn", "pylint", "snyk-iac", "secrets"]
    off = classify.tool_plan(tree({"Dockerfile": "", "x.json": ""}), {"tools": {"npm": {"enabled": False}, "container": {"enabled": False}}}, PATTERNS)
    assert [r.tool for r in off.collect()] == ["secrets"]


def test_file_counts(tree):
    counts = classify.file_counts(tree({"a.yml": "", "b.yaml": "", "c.js": "", "d.jsx": "", "e.ts": "", "f.tsx": "", "g.json": ""})).first()
    assert counts.asDict() == {"scan_id": "s", "terraform": 0, "python": 0, "javascript": 1, "typescript": 1, "yaml": 2, "json": 1}


def test_secrets(tree):
    key = "AKIA" + "ABCDEFGH12345678"
    text = "x\n" + f"id = {key}\n" + "y\n" * 5000 + 'Token = "' + "0f" * 20 + '"\n-----BEGIN RSA PRIVATE KEY-----'
    files = tree({"a": text, "b": "no secret", "c": None})
    hits = {(r.path, r.line_number, r.rule_id) for r in secret_lines(files).collect()}
    assert hits == {("a", 2, "aws-access-key-id"), ("a", 5003, "hex-token"), ("a", 5004, "private-key")}
    found = scan_secrets(files).collect()
    assert all(key not in str(r) for r in found)
    assert len({r.seq for r in found}) == 3


def test_every_match_of_a_line_counts(tree):
    keys = ["AKIA" + f"{i:016d}" for i in range(1000)]
    files = tree({"min.js": ";".join(keys) + ";xoxb-1234567890"})
    hits = secret_lines(files).where("rule_id = 'aws-access-key-id'").orderBy("match_number").collect()
    assert [r.match for r in hits] == keys
    assert len({r.seq for r in scan_secrets(files).collect()}) == 1001


SAMPLES = {
    "aws-access-key-id": "AKIA" + "A1" * 8,
    "private-key": "-----BEGIN EC PRIVATE KEY-----",
    "github-token": "ghs_" + "aB3" * 12,
    "slack-token": "xoxb-" + "1" * 12,
    "jwt": ".".join(["eyJ" + "a" * 10, "eyJ" + "b" * 10, "c" * 10]),
    "hex-token": 'API_KEY : "' + "ab" * 16 + '"',
    "generic-api-key": "Api-Key=" + "z9" * 8,
}


@pytest.mark.parametrize("rule", SECRET_RULES)
def test_each_secret_rule(tree, rule):
    files = tree({"a": f"x\n# {SAMPLES[rule]} #\n", "b": SAMPLES[rule][:-8] if rule != "private-key" else "BEGIN PRIVATE"})
    hits = secret_lines(files).where(f"rule_id = '{rule}'").collect()
    assert [(r.path, r.line_number) for r in hits] == [("a", 2)]


def test_rules_without_keywords(tree):
    rules = {"digits": SecretRule("[0-9]{4}", []), **SECRET_RULES}
    assert [r.match for r in secret_lines(tree({"a": "pin 12345"}), rules).collect()] == ["1234"]
