"""Inputs derived from the driver's tables: findings, scans, files and raw tool reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from catalog.shapes import (
    CHECK_NAMES,
    LINES,
    PATHS,
    RESOURCES,
    RULES,
    SEVERITY_WORDS,
    TEXTS,
    spark_pick as pick,
)
from findlake.functions import severity_from_string
from findlake.model import FINDING_COLUMNS, TOOL_BY_NAME, TOOLS

FINDING_TOOLS = [
    "terraform-fmt", "terraform-validate", "tflint", "tfsec", "checkov", "trivy", "cfn-lint", "cfn-nag",
    "checkov-cfn", "bandit", "safety", "pylint", "npm-audit", "snyk-iac", "trivy-container", "secrets",
]
FINDING_RULES = [
    "CKV_AWS_116", "DS014", "W89", "B404", "C0301", "R0917", "terraform_required_version", "generic-api-key", "R8", "R9",
]
FINDING_DIRS = ["/repo/", "./", "/github/workspace/", "src//app/", "tests/", "latest/", "modules/./x/", "/repo/./"]


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def as_table(df: DataFrame, **columns: Column) -> DataFrame:
    """The columns as a stored table would give them: computed once per row. A projection would
    be copied into every expression of the query that uses one of the columns."""
    return df.select(F.inline(F.array(F.struct(*[c.alias(n) for n, c in columns.items()]))))


def numbered_events(spark: SparkSession, sf: str) -> DataFrame:
    """(scan_id, e, k, ts): one scan per user; ``k`` is the number in the event's properties."""
    return events_numbers(table(spark, sf, "events"))


def events_numbers(events: DataFrame) -> DataFrame:
    return events.select(
        F.concat(F.lit("scan-"), F.col("user_id").cast("string")).alias("scan_id"),
        F.col("event_id").alias("e"),
        F.regexp_extract("props", "[0-9]+", 0).cast("bigint").alias("k"),
        F.col("ts").cast("timestamp").alias("ts"),
    )


FINDING_FIELDS = {
    "seq": "e",
    "tool": pick(FINDING_TOOLS, "e"),
    "severity_word": pick(SEVERITY_WORDS[:-1], "e * 3 + k"),
    "rule_id": pick(FINDING_RULES, "k"),
    "title": "concat(case when k % 10 = 3 then '3rd: ' else 'Check ' end, "
    + pick(FINDING_RULES, "k")
    + ", ' <a&b> \"q\" it\\'s')",
    "file_path": f"case when e % 17 = 0 then null when k % 50 = 49 then '' else concat({pick(FINDING_DIRS, 'k')}, 'f', k % 5, '.tf') end",
    "line_number": "cast(case when e % 7 = 0 then null when e % 11 = 0 then 0 else e % 5 + 1 end as int)",
    "resource": "case k % 3 when 0 then null when 1 then '' else concat('aws_s3_bucket.b', k) end",
    "remediation": "case k % 4 when 0 then null when 1 then '' when 2 then 'Fix <it> & see' else repeat('advice ', 30) end",
    "metadata": "concat('{\"event\":', e, '}')",
}
# The description repeats the title, is empty, is the word FAILED, or is a long text.
DESCRIPTION = (
    "case k % 4 when 0 then title when 1 then '' when 2 then 'FAILED' "
    "else repeat('long é text ', cast(10 + k * 5 as int)) end"
)


def findings_from(events: DataFrame) -> DataFrame:
    """One finding per event, plus the tool's own severity word and the event time."""
    picked = events_numbers(events).select(
        "scan_id", "ts", "k", *[F.expr(sql).alias(name) for name, sql in FINDING_FIELDS.items()]
    )
    computed = {"severity": severity_from_string(F.col("severity_word")), "description": F.expr(DESCRIPTION)}
    return as_table(picked, **{c: computed.get(c, F.col(c)) for c in [*FINDING_COLUMNS, "severity_word", "ts"]})


def findings(spark: SparkSession, sf: str) -> DataFrame:
    return findings_from(table(spark, sf, "events")).drop("severity_word", "ts")


def baseline(spark: SparkSession, sf: str) -> DataFrame:
    """An earlier run of the same scans: the same findings, some on other lines."""
    moved = F.when(F.col("seq") % 3 == 0, F.col("line_number") + 1).otherwise(F.col("line_number"))
    return findings(spark, sf).withColumn("line_number", moved)


def scans(spark: SparkSession, sf: str) -> DataFrame:
    """One scan per customer: most have no events, so no findings."""
    return table(spark, sf, "customer").select(
        F.concat(F.lit("scan-"), F.col("c_custkey").cast("string")).alias("scan_id"),
        F.col("c_name").alias("repository"),
        F.expr("case when c_custkey % 3 = 0 then null else c_mktsegment end").alias("branch"),
        F.expr("concat('2026-01-', lpad(cast(c_custkey % 28 + 1 as string), 2, '0'), 'T00:00:00')").alias(
            "scan_timestamp"
        ),
        F.expr(pick(["CRITICAL", "HIGH", "MEDIUM", "LOW", "INFO", "NONE", "bogus", None], "c_custkey")).alias("fail_on"),
        F.expr("c_custkey % 50 = 7").alias("errored"),
    )


# Lists that the scans' own configurations are made of; a scan without one has the shipped policy.
CONFIG_RULES = [["C0301", "R8"], ["B404"], [], ["generic-api-key", "DS014", "R9"]]
CONFIG_PATHS = [["tests", "app/f1"], ["**/src"], ["latest/"], [], ["f3.tf ", "modules"]]
RULED_TOOLS = ["tflint", "bandit", "pylint", "snyk-iac", "secrets"]


def scan_configs(spark: SparkSession, sf: str) -> DataFrame:
    """(scan_id, config): a JSON configuration for six of seven customers, some of them broken."""
    lists = {t: F.expr("array(" + ", ".join("cast(array() as array<string>)" if not r else "array(" + ", ".join(f"'{x}'" for x in r) + ")" for r in CONFIG_RULES) + ")") for t in RULED_TOOLS}
    sections: dict[str, list[Column]] = {}
    for i, name in enumerate(RULED_TOOLS):
        tool = TOOL_BY_NAME[name]
        rules = F.get(lists[name], (F.col("c_custkey") + i) % len(CONFIG_RULES)).alias(tool.exclude_key)
        sections.setdefault(tool.scanner, []).append(rules)
    switch = {"npm": "enabled", "terraform": "tfsec", "container": "build_images"}
    off = {s: F.when(F.col("c_custkey") % (3 + i) == 0, F.lit(False)).alias(flag) for i, (s, flag) in enumerate(switch.items())}
    tools = [
        F.struct(F.struct(*sections.get(s, [F.lit(1).alias("x")])).alias("exclude_rules"), *([off[s]] if s in off else [])).alias(s)
        for s in dict.fromkeys([*sections, *switch])
    ]
    paths = F.expr("element_at(array(" + ", ".join("array(" + ", ".join(f"'{x}'" for x in p) + ")" if p else "cast(array() as array<string>)" for p in CONFIG_PATHS) + f"), cast(c_custkey % {len(CONFIG_PATHS)} as int) + 1)")
    threshold = F.expr(pick(["low", "HIGH", "medium", "bogus", None], "c_custkey"))
    whole = F.to_json(
        F.struct(
            F.struct(paths.alias("excluded_paths")).alias("repository"),
            F.struct(*tools).alias("tools"),
            F.struct(F.struct(threshold.alias("severity_threshold")).alias("snyk")).alias("tool_config"),
        )
    )
    text = F.when(F.col("c_custkey") % 13 == 5, F.concat(whole, F.lit(" x"))).otherwise(whole)
    scan = F.concat(F.lit("scan-"), F.col("c_custkey").cast("string"))
    return table(spark, sf, "customer").where("c_custkey % 7 <> 4").select(scan.alias("scan_id"), text.alias("config"))


FILE_PATHS = [
    "'main.tf'", "concat('infra/f', d, '.tf')", "concat('cfn/t', d % 5, '.yaml')", "concat('cfn/t', d % 5, '.template')",
    "'package.json'", "'web/package.json'", "'src/app.py'", "concat('tests/test_', d, '.py')", "'web/index.ts'",
    "'web/index.tsx'", "'web/app.js'", "'web/app.jsx'", "'Dockerfile'", "'svc/Dockerfile.prod'",
    "'node_modules/x/dockerfile'", "'requirements.txt'", "'requirements-dev.txt'", "'sub/requirements.txt'",
    "'cdk.json'", "'tsconfig.json'", "concat('Stacks/S', d % 5, '.YAML')", "concat('latest/t', d % 5, '.yml')",
    "concat('cfn/t', d % 5, '.json')", "'svc/Containerfile'",
]
FILE_HEADS = [
    "text",
    "concat('AWSTemplateFormatVersion: \"2010-09-09\"', chr(10), text)",
    "concat('Type: AWS::S3::Bucket', chr(10), text)",
    "concat('Resources:', chr(10), '  B:', chr(10), '    Type: AWS::S3::Bucket', chr(10), text)",
    "concat(repeat('x', 1200), 'AWSTemplateFormatVersion', text)",
    "concat(repeat('y', 2500), 'AWSTemplateFormatVersion AWS:: Resources:', text)",
    "concat('{\"name\":\"p\",\"dependencies\":{\"', case when d % 2 = 0 then 'left-pad' else '@aws-cdk/core' end, "
    "'\":\"1\"},\"devDependencies\":{\"', case when d % 4 = 0 then 'aws-cdk-lib' else 'jest' end, '\":\"2\"}}')",
    "concat('{\"name\":\"p\",\"dependencies\":{\"aws-cdk-lib\":\"1\"}} ', text)",
    "concat('{\"compilerOptions\":{}} AWSTemplateFormatVersion ', text)",
]


def cases(number: str, options: list[str]) -> str:
    whens = " ".join(f"when {i} then {option}" for i, option in enumerate(options))
    return f"case {number} % {len(options)} {whens} end"


# Documents whose place is taken by a package file or by one that cannot be read lie beside it.
BESIDE = "d % 41 = 0 or (d div 3) % 9 = 6"
BESIDE_PATH = "concat('docs/d', d, '.txt')"


def files(spark: SparkSession, sf: str) -> DataFrame:
    """At least eight files per scan; every document's whole text is in one of them, some behind
    template or package heads."""
    docs = table(spark, sf, "documents").select(F.col("doc_id").alias("d"), "text", "source")
    common = "'scan_id', concat('scan-', d div 8), 'repo', source"
    own = (
        f"named_struct({common}, 'path', {cases('(d * 7 + d div 8)', FILE_PATHS)}, "
        f"'content', case when d % 41 <> 0 then {cases('(d div 3)', FILE_HEADS)} end, 'read_ok', d % 41 <> 0)"
    )
    beside = f"if({BESIDE}, named_struct({common}, 'path', {BESIDE_PATH}, 'content', text, 'read_ok', true), null)"
    return docs.select(F.inline(F.expr(f"array_compact(array({own}, {beside}))")))


# --- raw reports -----------------------------------------------------------------------------


def struct(**fields: str) -> str:
    return "named_struct(" + ", ".join(f"'{k.replace('__', '-')}', {v}" for k, v in fields.items()) + ")"


def some(every: int, sql: str) -> str:
    """The value, but missing in every n-th result."""
    return f"if((e + i) % {every} = 0, null, {sql})"


def json_text(sql: str, number: str = "(e + i)") -> str:
    """JSON of a struct: NULL fields are written as null, or left out."""
    return f"if({number} % 2 = 0, to_json({sql}, map('ignoreNullFields', 'false')), to_json({sql}))"


def json_list(element: str, count: str = "e % 4") -> str:
    """JSON list of 0 to 3 results, some of which are null or a plain text instead of an object."""
    one = f"""case when (e + i) % 13 = 0 then 'null' when (e + i) % 19 = 0 then '"odd"' else {json_text(element)} end"""
    return f"concat('[', array_join(transform(slice(array(0, 1, 2), 1, cast({count} as int)), i -> {one}), ','), ']')"


V = "e + i"
EXTRA = {"extra": V}
LINE_RANGE = (
    "if((e + i) % 5 = 0, null, if((e + i) % 4 = 0, cast(array() as array<int>), array(cast((e + i) % 9 as int), 10)))"
)
CFN_PATHS = ["cfn/t0.yaml", "/cfn/t1.yaml", "x/t2.template", "cfn/t3.json", "t4.template", "cfn/t0.json", "main.tf", None]
CHECKOV = struct(
    check_id=pick(RULES["checkov"], V),
    check_name=pick(CHECK_NAMES, V),
    severity=some(2, pick(["high", "", "bogus"], V)),
    check_result=some(7, struct(result=pick(TEXTS, V))),
    file_path="{path}",
    file_line_range=LINE_RANGE,
    resource=pick(RESOURCES, V),
    guideline=pick(TEXTS, V),
    **EXTRA,
)


def checkov(paths: list) -> str:
    return (
        "concat('{\"results\":{\"failed_checks\":', " + json_list(CHECKOV.replace("{path}", pick(paths, V))) + ", '}}')"
    )


def object_with(key: str, element: str) -> str:
    return f"concat('{{\"{key}\":', {json_list(element)}, ',\"version\":\"1\"}}')"


SNYK_ISSUE = struct(
    id=pick(RULES["snyk"], V),
    severity=pick(SEVERITY_WORDS, V),
    lineNumber=pick(LINES, V),
    issue=pick(TEXTS, V),
    impact=pick(["", "data loss", None], V),
    title=pick(TEXTS, V),
    subType=pick(RESOURCES, V),
    resolve=pick(TEXTS, V),
    publicId=pick(RULES["snyk"], V),
    documentation="concat('https://docs.example.org/', e + i)",
    references="array('r1', 'r2')",
)


def snyk(targets: list) -> str:
    target = pick(targets, "e")
    one = (
        f"concat('{{\"targetFile\":', if({target} is null, 'null', concat('\"', {target}, '\"')), "
        f"',\"infrastructureAsCodeIssues\":', {json_list(SNYK_ISSUE)}, '}}')"
    )
    # a lone object, an error object, or a list
    return f"case e % 3 when 0 then {one} when 1 then concat('[', {one}, ']') else if(e % 5 = 0, '{{\"error\":\"x\"}}', concat('[', {one}, ',null]')) end"


SAFETY_ITEM = struct(
    cve=pick(["CVE-2021-44228", "", None], V),
    vulnerability_id=pick(["44715", None], V),
    package=pick(["django", None], V),
    package_name=pick(["flask", None, "jinja2"], V),
    installed_version=pick(["1.0", None], V),
    analyzed_version=pick(["2.0", "3.0", None], V),
    affected_versions=pick(["<2", None], V),
    vulnerable_spec=pick(["<3", "<4", None], V),
    advisory=pick([None, "bad", "worse"], V),
    description=pick(["desc", None], V),
)

NPM_VIA = pick(
    ['[{"title":"ReDoS","url":"u"}]', '["left-pad"]', "[]", '[{"url":"u"}]', '"lodash"', "null"], V
)
NPM_FIX = pick(["true", "false", '{"name":"a","version":"2.0.1"}', '{"name":"a"}', "null"], V)
NPM_ENTRY = (
    "concat('\"pkg', i, '\":{\"severity\":\"', "
    + pick(SEVERITY_WORDS[:-1], V)
    + f", '\",\"via\":', {NPM_VIA}, ',\"fixAvailable\":', {NPM_FIX}, ',\"extra\":', e + i, '}}')"
)

BUILD_DOCKERFILES = ["Dockerfile", "svc/Dockerfile.prod", "My App/Sub_Dir/Dockerfile", "-x-/Containerfile"]
PACKAGE_FILES = ["package.json", "web/package.json", "node_modules/x/package.json", "latest/package.json"]
TEMPLATE_TARGETS = ["cfn/t0.yaml", "cfn/t1.yaml", "cfn/t2.yaml", "cfn/t3.yaml", "cfn/t4.yaml", "other/x.yaml", None]


def nested(parents: list[str]) -> str:
    return "concat('{\"Results\":[', " + ", ',', ".join(parents) + ", ']}')"


TRIVY_ITEM = struct(
    ID=pick(RULES["trivy"], V),
    Severity=pick(SEVERITY_WORDS, V),
    Title=pick(TEXTS, V),
    Description=pick(TEXTS, V),
    Resolution=pick(TEXTS, V),
    CauseMetadata=some(7, struct(Resource=pick(RESOURCES, V))),
    **EXTRA,
)
VULN_ITEM = struct(
    VulnerabilityID=pick(RULES["cve"], V),
    PkgName=pick(["openssl", "zlib", None], V),
    InstalledVersion=pick(["1.1", "", None], V),
    FixedVersion=pick(["1.2", "", None], V),
    Severity=pick(SEVERITY_WORDS, V),
    Description=pick(TEXTS, V),
    References="array('r1')",
)

STDOUT = {
    "terraform-fmt": "concat(array_join(transform(slice(array(0, 1, 2), 1, cast(e % 4 as int)), i -> "
    f"concat(if((e + i) % 6 = 0, '  ', ''), coalesce({pick(PATHS, V)}, ' '), if((e + i) % 4 = 0, ' ', ''))), chr(10)), chr(10))",
    "terraform-validate": "concat('{\"valid\":', if(e % 5 = 0, 'true', 'false'), ',\"diagnostics\":', "
    + json_list(
        struct(
            severity=pick(["error", "warning", None], V),
            summary=pick(TEXTS, V),
            range=some(6, struct(filename=pick(PATHS, V), start=some(4, struct(line=pick(LINES, V))))),
            **EXTRA,
        )
    )
    + ", '}')",
    "tflint": object_with(
        "issues",
        struct(
            rule=some(7, struct(name=pick(RULES["tflint"], V), severity=pick(SEVERITY_WORDS, V))),
            message=pick(TEXTS, V),
            range=some(6, struct(filename=pick(PATHS, V), start=some(4, struct(line=pick(LINES, V))))),
            **EXTRA,
        ),
    ),
    "tfsec": object_with(
        "results",
        struct(
            severity=pick(SEVERITY_WORDS, V),
            rule_id=pick(RULES["tfsec"], V),
            rule_description=pick(TEXTS, V),
            description=pick(TEXTS, V),
            location=some(6, struct(filename=pick(PATHS, V), start_line=pick(LINES, V))),
            resource=pick(RESOURCES, V),
            links="if((e + i) % 5 = 0, null, if((e + i) % 3 = 0, cast(array() as array<string>), array(concat('https://x/', e + i), 'y')))",
            **EXTRA,
        ),
    ),
    "checkov": checkov(PATHS),
    "trivy": nested(
        [
            "concat('{\"Target\":\"', coalesce(" + pick(PATHS, "e") + ", 'none'), '\",\"Misconfigurations\":', "
            + json_list(TRIVY_ITEM) + ", '}')",
            "'{\"Target\":\"empty.tf\"}'",
            "concat('{\"Misconfigurations\":', " + json_list(TRIVY_ITEM, "(e + 1) % 3") + ", '}')",
        ]
    ),
    "cfn-lint": json_list(
        struct(
            Rule=some(7, struct(Id=pick(RULES["cfn-lint"], V), ShortDescription=pick(TEXTS, V))),
            Level=pick(["Error", "Warning", "Informational", None], V),
            Message=pick(TEXTS, V),
            Filename=pick(PATHS, V),
            Location=some(6, struct(Start=some(4, struct(LineNumber=pick(LINES, V))))),
            **EXTRA,
        )
    ),
    "cfn-nag": "concat('[{\"filename\":\"', coalesce(" + pick(PATHS, "e") + ", 'none'), '\",\"file_results\":{\"violations\":', "
    + json_list(
        struct(
            id=pick(RULES["cfn-nag"], V),
            type=pick(["FAIL", "WARN", None], V),
            message=pick(TEXTS, V),
            line_numbers=LINE_RANGE,
            logical_resource_ids="if((e + i) % 5 = 0, null, if((e + i) % 3 = 0, array('A'), array('A', concat('B', e))))",
            **EXTRA,
        )
    )
    + ", '}},null,{\"file_results\":null}]')",
    "checkov-cfn": checkov(CFN_PATHS),
    "bandit": object_with(
        "results",
        struct(
            test_id=pick(RULES["bandit"], V),
            test_name=pick(["name", None], V),
            issue_text=pick(TEXTS, V),
            issue_severity=pick(["HIGH", "medium", "Low", "UNDEFINED", None], V),
            issue_confidence=pick(["HIGH", None], V),
            filename=pick(PATHS, V),
            line_number=pick(LINES, V),
            code="repeat(concat(e, 'x = 1;'), 60)",
            cwe=some(3, struct(id="78")),
        ),
    ),
    "safety": "case e % 3 when 0 then " + json_list(SAFETY_ITEM)
    + " when 1 then concat('{\"vulnerabilities\":', " + json_list(SAFETY_ITEM)
    + ", '}') else concat('{\"scanned_packages\":{\"vulnerabilities\":', " + json_list(SAFETY_ITEM) + ", '}}') end",
    "pylint": json_list(
        struct(
            message__id=pick(RULES["pylint"], V),
            symbol=pick(["line-too-long", "R0914", None], "(e + i) div 2"),
            message=pick(TEXTS, V),
            type=pick(["fatal", "error", "Warning", "refactor", "convention", "info", None], V),
            path=pick(PATHS, V),
            line=pick(LINES, V),
            column="(e + i) % 80",
            module=pick(["app", None], V),
        )
    ),
    "npm-audit": "concat('{\"vulnerabilities\":{', array_join(transform(slice(array(0, 1, 2), 1, cast(e % 4 as int)), i -> "
    + NPM_ENTRY + "), ','), '}}')",
    "snyk-iac-template": snyk(TEMPLATE_TARGETS),
    "snyk-iac": snyk(PATHS),
    "container-build": "''",
    "trivy-container": nested(
        [
            "concat('{\"Target\":\"alpine\",\"Type\":\"', if(e % 2 = 0, 'os', ''), '\",\"Vulnerabilities\":', " + json_list(VULN_ITEM) + ", '}')",
            "'{\"Target\":\"clean\"}'",
            "concat('{\"Vulnerabilities\":', " + json_list(VULN_ITEM, "(e + 1) % 3") + ", '}')",
        ]
    ),
}

RETURN_CODE = {"terraform-fmt": "e % 4", "terraform-validate": "e % 3", "safety": "e % 5", "container-build": "e % 3"}
STDERR = {
    "safety": "case e % 97 when 5 then 'Please set an API key' when 6 then 'Authentication needed' "
    "when 7 then 'EOF when reading a line' when 8 then 'eof when reading' else '' end",
    "container-build": "repeat(concat('step ', e, ' failed; '), 60)",
}
TARGET = {
    "npm-audit": pick(PACKAGE_FILES, "e"),
    "container-build": pick(BUILD_DOCKERFILES, "e"),
    "trivy-container": pick(BUILD_DOCKERFILES, "e"),
    "safety": "concat('/repo/requirements', if(e % 2 = 0, '', '-dev'), '.txt')",
}
TEXT_TOOLS = ["terraform-fmt", "container-build"]
LIST_TOOLS = ["cfn-lint", "cfn-nag", "pylint"]
EITHER_TOOLS = ["safety", "snyk-iac-template", "snyk-iac"]


def damaged(tool: str) -> str:
    """Some reports are empty, cut off, of another top-level type, or followed by other text."""
    if tool in TEXT_TOOLS:
        return "body"
    other = "'{\"x\": 1}'" if tool in LIST_TOOLS else "'\"text\"'" if tool in EITHER_TOOLS else "concat('[', body, ']')"
    return (
        "case when e % 23 = 0 then '' when e % 29 = 0 then substring(body, 1, length(body) - 1) "
        f"when e % 31 = 0 then {other} when e % 37 = 0 then concat(body, ' x') else body end"
    )


def raw_report(numbers: DataFrame, tool: str) -> DataFrame:
    """One report of ``tool`` per event, built row by row: no shuffle."""
    built = as_table(
        numbers,
        scan_id=F.col("scan_id"),
        target=F.expr(TARGET.get(tool, "'.'")),
        seq=F.col("e"),
        return_code=F.expr(f"cast({RETURN_CODE.get(tool, '0')} as int)"),
        body=F.expr(STDOUT[tool]),
        stderr=F.expr(STDERR.get(tool, "''")),
    )
    stdout = F.expr(damaged(tool).replace("e %", "seq %"))
    return built.select(
        "scan_id", F.lit(tool).alias("tool"), "target", "seq", "return_code", stdout.alias("stdout"), "stderr"
    )


# Events whose reports one task makes, at most.
EVENTS_A_TASK = 100_000


def raw_reports(spark: SparkSession, sf: str, *tools: str) -> DataFrame:
    """Reports of the named tools (all by default), as one table.

    The driver's events are one file with one row group, so one task would write all the JSON;
    the narrow numbers are spread first, as the many files of a real table would be: over more
    tasks the more there are.
    """
    tasks = max(spark.sparkContext.defaultParallelism, -(-table(spark, sf, "events").count() // EVENTS_A_TASK))
    numbers = numbered_events(spark, sf).repartition(tasks, "e")
    names = tools or [t.name for t in TOOLS if t.name in STDOUT]
    out = raw_report(numbers, names[0])
    for name in names[1:]:
        out = out.unionByName(raw_report(numbers, name))
    return out
