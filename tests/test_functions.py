"""Scalar functions against plain Python on many texts."""

from __future__ import annotations

import hashlib
import html
import random
from pathlib import PurePosixPath

import pytest
from pyspark.sql import functions as F

from findlake import functions as fn

random.seed(7)
PIECES = ["a", "/", "//", ".", "./", "..", "\\", "test", "tests", ".git", ".github", "é", " ", "-", "_", "x.py", "~", "1"]
TEXTS = ["", ".", "/", "//", "///", "//a", "./", "a/./b", "/./", "a//b/"] + [
    "".join(random.choices(PIECES, k=random.randint(1, 7))) for _ in range(400)
]


@pytest.fixture(scope="module")
def texts(spark):
    return spark.createDataFrame([(t,) for t in TEXTS], "t string")


def check(df, column, expected):
    got = df.select("t", column.alias("x")).collect()
    wrong = [(r.t, r.x, expected(r.t)) for r in got if r.x != expected(r.t)]
    assert not wrong, wrong[:5]


def python_normal(path):
    return str(PurePosixPath(path)).replace("\\", "/")


def test_normal_path(texts):
    check(texts, fn.normal_path(F.col("t")), python_normal)


@pytest.mark.parametrize(
    "patterns", [[".git", "test", "*.pyc"], ["**/fixtures", " tests "], ["**"], [""], [], ["a.b", "(x", "é"]]
)
def test_path_excluded(texts, patterns):
    def expected(path):
        normal = python_normal(path)
        for pattern in patterns:
            pattern = pattern.strip()
            if pattern in normal or ("**" in pattern and pattern.replace("**/", "").replace("**", "") in normal):
                return True
        return False

    check(texts, fn.path_excluded(F.col("t"), patterns), expected)


def test_missing_path_is_kept(spark):
    df = spark.sql("select cast(null as string) t")
    assert df.select(fn.path_excluded(F.col("t"), ["a"])).first()[0] is False


def test_html_escape(texts):
    odd = texts.withColumn("t", F.concat("t", F.lit("<b class='x'>&amp;\"")))
    check(odd, fn.html_escape(F.col("t")), html.escape)


def test_finding_key(spark):
    rows = [("a.tf", 3, "R", "t"), (None, None, "R", "t"), ("é:1", 0, "", ""), ("", None, "x", "y")]
    df = spark.createDataFrame(rows, "p string, n int, r string, t string")
    got = df.select("*", fn.finding_key(F.col("p"), F.col("n"), F.col("r"), F.col("t")).alias("k")).collect()
    for row in got:
        text = f"{row.p}:{row.n}:{row.r}:{row.t}"
        assert row.k == hashlib.md5(text.encode()).hexdigest()


def test_sarif_rule_name(texts):
    def expected(text):
        name = "".join(c if c.isalnum() or c == "_" else "_" for c in text)
        return ("_" + name if name[:1].isdigit() else name)[:128] or "unknown"

    long = texts.unionByName(texts.withColumn("t", F.repeat("t", 60)))
    check(long, fn.sarif_rule_name(F.col("t")), expected)


def test_sarif_path(texts):
    def expected(path):
        for prefix in ("/repo/", "/github/workspace/", "./"):
            path = path.removeprefix(prefix)
        return path.lstrip("/")

    led = texts
    for prefix in ("/repo/", "/repo/./", "/github/workspace/./", "./repo/"):
        led = led.unionByName(texts.withColumn("t", F.concat(F.lit(prefix), "t")))
    check(led, fn.sarif_path(F.col("t")), expected)


def test_basename_and_dirname(texts):
    check(texts, fn.basename(F.col("t")), lambda t: t.rsplit("/", 1)[-1])
    clean = texts.where("not t like '%//%' and t not like '/%'")
    check(clean, fn.dirname(F.col("t")), lambda t: t.rpartition("/")[0])


def test_severity_words(spark):
    words = ["CRITICAL", "high", "Medium", "low", "info", "Informational", "WARNING", "error", "moderate", "", None]
    df = spark.createDataFrame([(w,) for w in words], "w string")
    got = [r[0] for r in df.select(fn.severity_from_string(F.col("w"))).collect()]
    assert got == ["CRITICAL", "HIGH", "MEDIUM", "LOW", "INFO", "INFO", "MEDIUM", "HIGH", "INFO", "INFO", "INFO"]
    snyk = [r[0] for r in df.select(fn.snyk_severity(F.col("w"))).collect()]
    assert snyk == ["CRITICAL", "HIGH", "MEDIUM", "LOW"] + ["MEDIUM"] * 7
    bandit = [r[0] for r in df.select(fn.bandit_severity(F.col("w"))).collect()]
    assert bandit == ["MEDIUM", "HIGH", "MEDIUM", "LOW"] + ["MEDIUM"] * 7


@pytest.mark.parametrize(
    ("own", "name", "terraform", "cfn"),
    [
        ("low", "public bucket", "LOW", "LOW"),
        ("", "Ensure no PUBLIC access", "CRITICAL", "CRITICAL"),
        (None, "encryption with a password", "CRITICAL", "CRITICAL"),
        (None, "ingress 0.0.0.0/0", "CRITICAL", "CRITICAL"),
        (None, "ingress 0x0x0x0/0", "MEDIUM", "MEDIUM"),
        (None, "IMDSv2 needed", "HIGH", "MEDIUM"),
        (None, "versioning with tag", "MEDIUM", "MEDIUM"),
        (None, "has a tag", "LOW", "LOW"),
        (None, None, "MEDIUM", "MEDIUM"),
        ("bogus", "public", "INFO", "INFO"),
    ],
)
def test_checkov_severity(spark, own, name, terraform, cfn):
    df = spark.createDataFrame([(own, name)], "o string, n string")
    for flag, expected in ((True, terraform), (False, cfn)):
        assert df.select(fn.checkov_severity(F.col("o"), F.col("n"), flag)).first()[0] == expected


def test_locations(spark):
    df = spark.createDataFrame([("p", 3), ("p", 0), ("p", None), (None, 3)], "p string, n int")
    report = [r[0] for r in df.select(fn.location(F.col("p"), F.col("n"))).collect()]
    log = [r[0] for r in df.select(fn.location(F.col("p"), F.col("n"), zero_line=True)).collect()]
    assert report == ["p:3", "p", "p", None]
    assert log == ["p:3", "p:0", "p", None]


def test_tags(spark):
    tools = ["terraform-fmt", "cfn-lint", "secrets", "bandit", "npm-audit", "snyk-iac", "tfsec"]
    df = spark.createDataFrame([(t, "LOW") for t in tools] + [("tfsec", "")], "t string, s string")
    got = [r[0] for r in df.select(fn.sarif_tags(F.col("t"), F.col("s"))).collect()]
    assert got == [
        ["security", "terraform", "infrastructure-as-code", "severity-low"],
        ["security", "cloudformation", "infrastructure-as-code", "severity-low"],
        ["security", "secrets", "credentials", "severity-low"],
        ["security", "python", "severity-low"],
        ["security", "dependencies", "supply-chain", "severity-low"],
        ["security", "dependencies", "supply-chain", "severity-low"],
        ["security", "severity-low"],
        ["security"],
    ]


def test_image_and_repo_names(spark):
    df = spark.createDataFrame([("",), (".",), ("My App/Sub_Dir",), ("-x-",), ("é/b",)], "d string")
    got = [r[0] for r in df.select(fn.image_tag(F.col("d"))).collect()]
    assert got == ["scan-root:latest", "scan-root:latest", "scan-my-app-sub-dir:latest", "scan-x:latest", "scan-é-b:latest"]
    rows = [
        ("given", "https://h/u/r.git", "given"),
        ("", "https://h/u/r.git\n", "r"),
        (None, "git@h:u/r.git", "r"),
        (None, "https://h/u/r//", "r"),
        (None, "https://h/u/.git", "/p"),
        (None, None, "/p"),
    ]
    df = spark.createDataFrame(rows, "g string, u string, e string")
    for row in df.select("e", fn.repo_name(F.col("g"), F.col("u"), F.lit("/p")).alias("n")).collect():
        assert row.n == row.e
