"""Normalisers: the raw output of each tool to rows of the findings schema.

A normaliser takes the ``raw_reports`` rows of one tool and returns findings. All use the same
two steps: the report's list of results is exploded as raw JSON texts, which become ``metadata``
unchanged, and each text is then read with an explicit schema. So one odd result cannot spoil
its neighbours. Missing keys and JSON nulls both take the default.

A report is parsed once, which also tells whether it is one JSON value and nothing else (see ``Form``).
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from typing import Any, NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from findlake.functions import (
    bandit_severity,
    checkov_severity,
    dirname,
    image_tag,
    pylint_severity,
    severity_from_string,
    snyk_severity,
    strip_scan_root,
    truthy,
)
from findlake.model import FINDING_COLUMNS, POSITION_BITS, REPORT_BITS, TOOL_BY_NAME
from findlake.operators.ordering import hot_join
from findlake.operators.policy import container_filter, container_filter_by_scan, strip_roots_by_scan
from findlake.sources.config import lookup

# --- fixed values: rule ids and texts of findings whose report does not state them -------------
UNKNOWN_RULE = "UNKNOWN"
FIXED = {
    "terraform-fmt": {
        "rule_id": "FMT001",
        "title": "Terraform file needs formatting",
        "description": ("File ", " is not properly formatted"),
        "remediation": "Run: terraform fmt",
    },
    "terraform-validate": {
        "rule_id": "VAL001",
        "title": "Terraform validation error",
        "description": "Validation failed",
    },
    "tflint": {"severity": "warning", "title": "Linting issue"},
    "tfsec": {"severity": "MEDIUM", "title": "Security issue detected"},
    "checkov": {"title": "Policy violation"},
    "trivy": {"severity": "MEDIUM", "title": "Misconfiguration detected"},
    "cfn-lint": {"severity": "Warning", "title": "Validation issue"},
    "cfn-nag": {"title": "Security violation", "file_path": "unknown"},
    "bandit": {"severity": "MEDIUM", "title": "Security issue detected", "confidence": "UNKNOWN"},
    "safety": {
        "title": "Vulnerable dependency: ",
        "description": "Known vulnerability in dependency",
        "remediation": ("Update ", " to a secure version. Vulnerable: "),
        "missing": "unknown",
    },
    "pylint": {"severity": "convention", "title": "Code quality issue"},
    "npm-audit": {
        "severity": "low",
        "rule_id": "npm-",
        "title": "Vulnerable dependency: ",
        "description": "Dependency vulnerability",
        "remediation": ("Review and update dependency", "Update to version ", "latest"),
    },
    "snyk-iac": {"severity": "medium", "title": "IaC security issue", "file_path": "unknown", "impact": " Impact: "},
    "trivy-container": {
        "severity": "MEDIUM",
        "remediation": ("No fix available yet", "Upgrade ", " to version "),
    },
    "container-build": {
        "rule_id": "BUILD_FAILURE",
        "title": "Docker image build failed",
        "description": ("Failed to build Docker image from ", ": "),
    },
}
# ---------------------------------------------------------------------------------------------

STRICT_JSON = {"allowSingleQuotes": "false"}
BLANKS = " \t\r\n\f\x0b"


def parse(text: Column | str, ddl: str) -> Column:
    return F.from_json(text, ddl, STRICT_JSON)


def well_formed(text: Column) -> Column:
    """Exactly one JSON value: ``from_json`` alone would accept text after the value. A second value is
    put behind it, so text that closes the list early is seen too."""
    return F.coalesce(F.size(parse(F.concat(F.lit("["), text, F.lit(",0]")), "array<string>")) == 2, F.lit(False))


def default(value: Column | str, text: str) -> Column:
    return F.coalesce(F.col(value) if isinstance(value, str) else value, F.lit(text))


def raw_json(text: Column, otherwise: str) -> Column:
    """JSON text of an object or list as it was, else a default."""
    return F.when(text.rlike(r"^[\[{]"), text).otherwise(otherwise)


def json_object(plain: Mapping[str, Column], raw: Mapping[str, Column] | None = None) -> Column:
    """JSON object of plain values plus values that already are JSON text."""
    text = F.to_json(F.struct(*[c.alias(k) for k, c in plain.items()]), {"ignoreNullFields": "false"})
    if not raw:
        return text
    tail = [part for k, c in raw.items() for part in (F.lit(f',"{k}":'), c)]
    return F.concat(F.substr(text, F.lit(1), F.length(text) - 1), *tail, F.lit("}"))


class Form(NamedTuple):
    """How a tool's reports are read: ``text`` is a JSON list of the report and, behind it, a mark; ``ddl``
    its type; ``entries`` the results in ``_doc``, which is the report as read. A report that breaks
    off, goes on after its value or closes the list early has no mark in the second and last place."""

    text: Column
    ddl: str
    marked: Column  # over ``_mark``, what stands in the mark's place
    entries: Column


MARK = "findlake_whole"


def in_object(ddl: str, entries: Callable[[Column], Column]) -> Form:
    """The report is an object with the fields of ``ddl``."""
    text = F.concat(F.lit("["), "stdout", F.lit(f',{{"{MARK}":true}}]'))
    return Form(text, f"array<struct<{ddl}, {MARK} boolean>>", F.col(f"_mark.{MARK}"), entries(F.col("_doc")))


def top_list(entries: Callable[[Column], Column] = lambda doc: doc) -> Form:
    """The report is a list."""
    text = F.concat(F.lit("["), "stdout", F.lit(f',["{MARK}"]]'))
    return Form(text, "array<array<string>>", F.get("_mark", F.lit(0)) == MARK, entries(F.col("_doc")))


def _is_object() -> Column:
    return F.btrim(F.col("stdout"), F.lit(BLANKS)).startswith("{")


def top_list_or_object(entries: Callable[[Column], Column]) -> Form:
    """The report is a list, or the one object of a list of one."""
    wrapped = F.concat(F.lit("[["), "stdout", F.lit(f'],["{MARK}","one"]]'))
    plain = top_list(entries)
    one = (F.size("_mark") == 1) | (F.size("_doc") == 1)
    return plain._replace(text=F.when(_is_object(), wrapped).otherwise(plain.text), marked=plain.marked & one)


def _has_texts() -> Column:
    """A string of the report may begin like an object, written plainly or as an escape."""
    return F.contains("stdout", F.lit('"{')) | F.contains("stdout", F.lit('"\\u007'))


def exploded(raw: DataFrame, form: Form, *names: str) -> DataFrame:
    """One row per entry of a well-formed report, with the report's number and target, and any
    column of ``raw`` that starts with an underscore. The generator keeps it to one parse a report."""
    report = ["scan_id", "_report", "_target", "_texts", *[c for c in raw.columns if c.startswith("_")]]
    opened = raw.withColumns({"_report": F.col("seq"), "_target": F.col("target"), "_texts": _has_texts()}).select(
        *report, F.explode(F.array(parse(form.text, form.ddl))).alias("_both")
    )
    opened = opened.where(F.size("_both") == 2).select(
        *report, F.get("_both", F.lit(0)).alias("_doc"), F.get("_both", F.lit(1)).alias("_mark")
    )
    return opened.where(form.marked).select(*report, F.posexplode(form.entries).alias("_pos", *names))


def results(raw: DataFrame, form: Form) -> DataFrame:
    """One row per listed object: its report, position and JSON text."""
    return exploded(raw, form, "_raw").where(F.col("_raw").startswith("{"))


def child_results(raw: DataFrame, form: Form) -> DataFrame:
    """The same for children that carry fields of their parent (see ``children_of``)."""
    return exploded(raw, form, "_child").withColumn("_raw", F.col("_child.raw")).where(
        F.col("_raw").startswith("{")
    )


def each_object(listed: Column, ddl: str) -> Column:
    """The objects of a list of JSON texts, all read at once: starting a parse costs more than reading a short
    text. The texts are objects that Spark has written, so each has its place, and an odd field hides no other.
    Where a report may hold a plain text that looks like an object (``_texts``), each is read alone: a text
    that is no JSON would hide all others."""
    objects = F.filter(listed, lambda text: text.startswith("{"))
    together = F.array(F.concat(F.lit("["), F.array_join(objects, ","), F.lit("]")))
    texts = F.when(F.col("_texts"), objects).otherwise(together)
    return F.flatten(F.array_compact(F.transform(texts, lambda text: parse(text, f"array<struct<{ddl}>>"))))


def children_of(parents: Column, child: str, *carried: str) -> Column:
    """Children of all parents in order, each with the named fields of its parent."""

    def of(parent: Column) -> Column:
        kids = F.coalesce(parent[child], F.array().cast("array<string>"))
        return F.transform(kids, lambda kid: F.struct(kid.alias("raw"), *[parent[c].alias(c) for c in carried]))

    return F.flatten(F.transform(F.array_compact(parents), of))


def read(rows: DataFrame, ddl: str, text: str = "_raw") -> DataFrame:
    """Read each JSON text into columns. The generator keeps it to one parse per row: a plain
    projection could be copied into every later filter that looks at one of the columns."""
    return rows.select("*", F.inline(F.array(parse(text, ddl))))


def finding_seq(rank: int, report: Column, position: Column) -> Column:
    """Total order of findings within a scan: tool, report, position. Null where a number does not
    fit; the flow leaves such reports out and lists them (see ``numbered_well``)."""
    return F.when(
        numbered_well(report) & (position < (1 << POSITION_BITS)),
        F.lit(rank << (REPORT_BITS + POSITION_BITS)) + F.shiftleft(report, POSITION_BITS) + position.cast("bigint"),
    )


def numbered_well(report: Column) -> Column:
    """The report's number has a place in the order of findings."""
    return F.coalesce((report >= 0) & (report < (1 << REPORT_BITS)), F.lit(False))


def findings_of(rows: DataFrame, tool_name: str, **fields: Column) -> DataFrame:
    tool = TOOL_BY_NAME[tool_name]
    none = F.lit(None).cast("string")
    values = {
        "scan_id": F.col("scan_id"),
        "seq": finding_seq(tool.rank, F.col("_report"), F.col("_pos")),
        "tool": F.lit(tool.finding_tool),
        "file_path": none,
        "line_number": none,
        "resource": none,
        "remediation": none,
        "metadata": F.lit("{}"),
        **fields,
    }
    values["line_number"] = values["line_number"].cast("int")
    return rows.select(*[values[c].alias(c) for c in FINDING_COLUMNS])


# --- terraform -------------------------------------------------------------------------------


def terraform_fmt(raw: DataFrame) -> DataFrame:
    fixed = FIXED["terraform-fmt"]
    lines = F.split(F.btrim(F.col("stdout"), F.lit(BLANKS)), "\n")
    rows = (
        raw.where("return_code <> 0")
        .select("scan_id", F.col("seq").alias("_report"), F.posexplode(lines).alias("_pos", "_line"))
        .withColumn("_path", F.btrim(F.col("_line"), F.lit(BLANKS)))
        .where("_path <> ''")
    )
    return findings_of(
        rows,
        "terraform-fmt",
        severity=F.lit("LOW"),
        rule_id=F.lit(fixed["rule_id"]),
        title=F.lit(fixed["title"]),
        description=F.concat(F.lit(fixed["description"][0]), F.col("_line"), F.lit(fixed["description"][1])),
        file_path=F.col("_path"),
        remediation=F.lit(fixed["remediation"]),
    )


def terraform_validate(raw: DataFrame) -> DataFrame:
    fixed = FIXED["terraform-validate"]
    form = in_object("valid boolean, diagnostics array<string>", lambda doc: F.when(~doc.valid, doc.diagnostics))
    rows = results(raw.where("return_code <> 0"), form)
    rows = read(rows, "severity string, summary string, range struct<filename: string, start: struct<line: int>>")
    return findings_of(
        rows,
        "terraform-validate",
        severity=F.when(F.col("severity") == "error", "HIGH").otherwise("MEDIUM"),
        rule_id=F.lit(fixed["rule_id"]),
        title=F.lit(fixed["title"]),
        description=default("summary", fixed["description"]),
        file_path=F.col("range.filename"),
        line_number=F.col("range.start.line"),
        metadata=F.col("_raw"),
    )


def tflint(raw: DataFrame) -> DataFrame:
    fixed = FIXED["tflint"]
    rows = results(raw, in_object("issues array<string>", lambda doc: doc.issues))
    rows = read(
        rows,
        "rule struct<name: string, severity: string>, message string, "
        "range struct<filename: string, start: struct<line: int>>",
    )
    return findings_of(
        rows,
        "tflint",
        severity=severity_from_string(default("rule.severity", fixed["severity"])),
        rule_id=default("rule.name", UNKNOWN_RULE),
        title=default("message", fixed["title"]),
        description=default("message", ""),
        file_path=F.col("range.filename"),
        line_number=F.col("range.start.line"),
        metadata=F.col("_raw"),
    )


def tfsec(raw: DataFrame) -> DataFrame:
    fixed = FIXED["tfsec"]
    rows = results(raw, in_object("results array<string>", lambda doc: doc.results))
    rows = read(
        rows,
        "severity string, rule_id string, rule_description string, description string, "
        "location struct<filename: string, start_line: int>, resource string, links array<string>",
    )
    return findings_of(
        rows,
        "tfsec",
        severity=severity_from_string(default("severity", fixed["severity"])),
        rule_id=default("rule_id", UNKNOWN_RULE),
        title=default("rule_description", fixed["title"]),
        description=default("description", ""),
        file_path=F.col("location.filename"),
        line_number=F.col("location.start_line"),
        resource=default("resource", ""),
        remediation=F.get("links", F.lit(0)),
        metadata=F.col("_raw"),
    )


CHECKOV_FIELDS = (
    "check_id string, check_name string, severity string, check_result struct<result: string>, "
    "file_path string, file_line_range array<int>, resource string, guideline string"
)


def _checkov(raw: DataFrame, tool: str, terraform: bool) -> DataFrame:
    form = in_object("results struct<failed_checks: array<string>>", lambda doc: doc.results.failed_checks)
    rows = read(results(raw, form), CHECKOV_FIELDS)
    return findings_of(
        rows,
        tool,
        severity=checkov_severity(F.col("severity"), F.col("check_name"), terraform),
        rule_id=default("check_id", UNKNOWN_RULE),
        title=default("check_name", FIXED["checkov"]["title"]),
        description=default("check_result.result", ""),
        file_path=F.col("file_path"),
        line_number=F.get("file_line_range", F.lit(0)),
        resource=default("resource", ""),
        remediation=F.col("guideline"),
        metadata=F.col("_raw"),
    )


def checkov(raw: DataFrame) -> DataFrame:
    return _checkov(raw, "checkov", terraform=True)


def trivy(raw: DataFrame) -> DataFrame:
    fixed = FIXED["trivy"]
    target_ddl = "Target string, Misconfigurations array<string>"
    form = in_object(
        "Results array<string>", lambda doc: children_of(each_object(doc.Results, target_ddl), "Misconfigurations", "Target")
    )
    rows = read(
        child_results(raw, form),
        "ID string, Severity string, Title string, Description string, Resolution string, "
        "CauseMetadata struct<Resource: string>",
    )
    return findings_of(
        rows,
        "trivy",
        severity=severity_from_string(default("Severity", fixed["severity"])),
        rule_id=default("ID", UNKNOWN_RULE),
        title=default("Title", fixed["title"]),
        description=default("Description", ""),
        file_path=F.col("_child.Target"),
        resource=F.col("CauseMetadata.Resource"),
        remediation=F.col("Resolution"),
        metadata=F.col("_raw"),
    )


# --- cloudformation --------------------------------------------------------------------------


def cfn_lint(raw: DataFrame) -> DataFrame:
    fixed = FIXED["cfn-lint"]
    rows = read(
        results(raw, top_list()),
        "Rule struct<Id: string, ShortDescription: string>, Level string, Message string, Filename string, "
        "Location struct<Start: struct<LineNumber: int>>",
    )
    return findings_of(
        rows,
        "cfn-lint",
        severity=severity_from_string(default("Level", fixed["severity"])),
        rule_id=default("Rule.Id", UNKNOWN_RULE),
        title=default("Rule.ShortDescription", fixed["title"]),
        description=default("Message", ""),
        file_path=F.col("Filename"),
        line_number=F.col("Location.Start.LineNumber"),
        metadata=F.col("_raw"),
    )


def cfn_nag(raw: DataFrame) -> DataFrame:
    fixed = FIXED["cfn-nag"]
    file_ddl = "filename string, file_results struct<violations: array<string>>"

    def violations(doc: Column) -> Column:
        flat = F.transform(
            F.array_compact(each_object(doc, file_ddl)),
            lambda f: F.struct(f.filename.alias("filename"), f.file_results.violations.alias("violations")),
        )
        return children_of(flat, "violations", "filename")

    rows = read(
        child_results(raw, top_list(violations)),
        "id string, type string, message string, line_numbers array<int>, logical_resource_ids array<string>",
    )
    return findings_of(
        rows,
        "cfn-nag",
        severity=F.when(F.col("type") == "FAIL", "HIGH").otherwise("MEDIUM"),
        rule_id=default("id", UNKNOWN_RULE),
        title=default("message", fixed["title"]),
        description=default("message", ""),
        file_path=default("_child.filename", fixed["file_path"]),
        line_number=F.get("line_numbers", F.lit(0)),
        resource=F.concat_ws(", ", "logical_resource_ids"),
        metadata=F.col("_raw"),
    )


def checkov_cfn(raw: DataFrame) -> DataFrame:
    return _checkov(raw, "checkov-cfn", terraform=False)


# --- python ----------------------------------------------------------------------------------


def bandit(raw: DataFrame, scan_root: str = "/repo") -> DataFrame:
    fixed = FIXED["bandit"]
    rows = read(
        results(raw, in_object("results array<string>", lambda doc: doc.results)),
        "test_id string, test_name string, issue_text string, issue_severity string, issue_confidence string, "
        "filename string, line_number int, code string, cwe string",
    )
    return findings_of(
        rows,
        "bandit",
        severity=bandit_severity(default("issue_severity", fixed["severity"])),
        rule_id=default("test_id", UNKNOWN_RULE),
        title=default("issue_text", fixed["title"]),
        description=F.concat(default("issue_text", ""), F.lit(" - "), default("test_name", "")),
        file_path=strip_scan_root(default("filename", ""), scan_root),
        line_number=F.col("line_number"),
        metadata=json_object(
            {
                "confidence": default("issue_confidence", fixed["confidence"]),
                "code": F.substring(default("code", ""), 1, 200),  # the stored snippet is a short one
            },
            {"cwe": raw_json(F.col("cwe"), "{}")},
        ),
    )


def safety(raw: DataFrame) -> DataFrame:
    fixed = FIXED["safety"]
    missing = F.lit(fixed["missing"])
    # A list is read as a field of an object, with a mark of its own, so a report is read once.
    is_list = ~F.col(f"_mark.{MARK}")
    form = in_object(
        "vulnerabilities array<string>, scanned_packages struct<vulnerabilities: array<string>>, listed array<array<string>>",
        lambda doc: F.when(
            is_list, F.when((F.size(doc.listed) == 2) & (doc.listed[1] == F.array(F.lit(MARK))), doc.listed[0])
        ).otherwise(F.coalesce(doc.vulnerabilities, doc.scanned_packages.vulnerabilities)),
    )
    as_field = F.concat(F.lit('[{"listed":['), "stdout", F.lit(f',["{MARK}"]]}},{{"{MARK}":false}}]'))
    form = form._replace(text=F.when(_is_object(), form.text).otherwise(as_field), marked=F.col(f"_mark.{MARK}").isNotNull())
    rows = read(
        results(raw, form),
        "cve string, vulnerability_id string, package string, package_name string, installed_version string, "
        "analyzed_version string, affected_versions string, vulnerable_spec string, advisory string, "
        "description string",
    )
    rows = rows.select(
        "*",
        F.coalesce(truthy(F.col("cve")), F.col("vulnerability_id"), F.lit(UNKNOWN_RULE)).alias("_rule"),
        F.coalesce("package", "package_name", missing).alias("_package"),
        F.coalesce("installed_version", "analyzed_version", missing).alias("_installed"),
        F.coalesce("affected_versions", "vulnerable_spec", missing).alias("_affected"),
    )
    return findings_of(
        rows,
        "safety",
        severity=F.lit("HIGH"),
        rule_id=F.col("_rule"),
        title=F.concat(F.lit(fixed["title"]), F.col("_package"), F.lit(" "), F.col("_installed")),
        description=F.coalesce("advisory", "description", F.lit(fixed["description"])),
        file_path=F.substring_index("_target", "/", -1),
        remediation=F.concat(
            F.lit(fixed["remediation"][0]), F.col("_package"), F.lit(fixed["remediation"][1]), F.col("_affected")
        ),
        metadata=json_object(
            {
                "package": F.col("_package"),
                "installed_version": F.col("_installed"),
                "affected_versions": F.col("_affected"),
                "cve": F.col("_rule"),
            }
        ),
    )


def pylint(raw: DataFrame, scan_root: str = "/repo") -> DataFrame:
    fixed = FIXED["pylint"]
    rows = read(
        results(raw, top_list()),
        "`message-id` string, symbol string, message string, type string, path string, line int, "
        "`column` int, module string",
    )
    return findings_of(
        rows,
        "pylint",
        severity=pylint_severity(default("type", fixed["severity"])),
        rule_id=default("`message-id`", ""),
        title=F.concat(default("symbol", ""), F.lit(": "), default("message", fixed["title"])),
        description=default("message", ""),
        file_path=strip_scan_root(default("path", ""), scan_root),
        line_number=F.col("line"),
        metadata=json_object(
            {
                "column": F.col("column"),
                "symbol": default("symbol", ""),
                "message_type": default("type", fixed["severity"]),
                "module": F.col("module"),
            }
        ),
    )


# --- npm -------------------------------------------------------------------------------------


def npm_audit(raw: DataFrame) -> DataFrame:
    fixed = FIXED["npm-audit"]
    no_fix, update, latest = fixed["remediation"]
    by_name = in_object("vulnerabilities map<string,string>", lambda doc: doc.vulnerabilities)
    rows = exploded(raw, by_name, "_name", "_raw").where(F.col("_raw").startswith("{"))
    rows = read(rows, "severity string, via string, fixAvailable string")
    via, fix = F.col("via"), F.col("fixAvailable")
    first_via = F.get(parse(via, "array<string>"), F.lit(0))
    title = parse(F.when(first_via.startswith("{"), first_via), "title string").title
    version = parse(F.when(fix.startswith("{"), fix), "version string").version
    return findings_of(
        rows,
        "npm-audit",
        severity=severity_from_string(default("severity", fixed["severity"])),
        rule_id=F.concat(F.lit(fixed["rule_id"]), F.col("_name")),
        title=F.concat(F.lit(fixed["title"]), F.col("_name")),
        description=F.when(via.startswith("["), default(title, fixed["description"])).otherwise(
            default(via, "")
        ),
        file_path=F.col("_target"),
        remediation=F.when(
            fix.isNull() | fix.isin("false", "{}", "", "0", "[]"), no_fix
        ).otherwise(F.concat(F.lit(update), default(version, latest))),
        metadata=F.col("_raw"),
    )


def _snyk(raw: DataFrame, tool: str) -> DataFrame:
    fixed = FIXED["snyk-iac"]
    file_ddl = "targetFile string, infrastructureAsCodeIssues array<string>"
    form = top_list_or_object(lambda doc: children_of(each_object(doc, file_ddl), "infrastructureAsCodeIssues", "targetFile"))
    rows = read(
        child_results(raw, form),
        "id string, severity string, lineNumber int, issue string, impact string, title string, subType string, "
        "resolve string, publicId string, documentation string, references string",
    )
    impact = truthy(F.col("impact"))
    issue = default("issue", "")
    return findings_of(
        rows,
        tool,
        severity=snyk_severity(default("severity", fixed["severity"])),
        rule_id=default("id", UNKNOWN_RULE),
        title=default("title", fixed["title"]),
        description=F.when(impact.isNull(), issue).otherwise(F.concat(issue, F.lit(fixed["impact"]), impact)),
        file_path=default("_child.targetFile", fixed["file_path"]),
        line_number=F.nullif(F.col("lineNumber"), F.lit(0)),
        resource=default("subType", ""),
        remediation=default("resolve", ""),
        metadata=json_object(
            {"publicId": F.col("publicId"), "documentation": F.col("documentation")},
            {"references": raw_json(F.col("references"), "[]")},
        ),
    )


def snyk_iac(raw: DataFrame) -> DataFrame:
    return _snyk(raw, "snyk-iac")


def snyk_iac_template(raw: DataFrame) -> DataFrame:
    return _snyk(raw, "snyk-iac-template")


# --- container -------------------------------------------------------------------------------


def trivy_container(
    raw: DataFrame,
    image_prefix: str = "scan-",
    severities: str | None = None,
    ignore_unfixed: bool = False,
    build_images: bool = True,
    by_scan: DataFrame | None = None,
) -> DataFrame:
    """``target`` is the Dockerfile; the image is named after its directory. Where images are not
    built, ``target`` is the name of a ready image and there is no Dockerfile. Reports made
    without the severity list or the unfixed switch can be cut down by them here.

    ``by_scan`` has these settings for every scan instead (see ``policies.settings``); they meet the
    parsed results, never the reports' texts."""
    fixed = FIXED["trivy-container"]
    no_fix, upgrade, to_version = fixed["remediation"]
    result_ddl = "Target string, Type string, Vulnerabilities array<string>"
    scanned = in_object(
        "Results array<string>", lambda doc: children_of(each_object(doc.Results, result_ddl), "Vulnerabilities", "Target", "Type")
    )
    image_name = image_tag(dirname(F.col("target")), image_prefix) if build_images else F.col("target")
    named = raw if by_scan is not None else raw.withColumn("_image", image_name)  # once per report
    rows = read(
        child_results(named, scanned),
        "VulnerabilityID string, PkgName string, InstalledVersion string, FixedVersion string, Severity string, "
        "Description string, References string, CVSS string",
    )
    from_dockerfile = F.lit(build_images)
    if by_scan is not None:
        rows = hot_join(rows, by_scan, ["scan_id"], "inner", ["_report", "_pos"])
        rows = rows.where(container_filter_by_scan(F.col("Severity"), F.col("FixedVersion")))
        from_dockerfile = F.col("_build_images")
        named_here = image_tag(dirname(F.col("_target")), F.col("_prefix"))
        rows = rows.withColumn("_image", F.when(from_dockerfile, named_here).otherwise(F.col("_target")))
    elif severities or ignore_unfixed:
        rows = rows.where(container_filter(F.col("Severity"), F.col("FixedVersion"), severities, ignore_unfixed))
    image = F.col("_image")
    rule, package = default("VulnerabilityID", UNKNOWN_RULE), default("PkgName", "")
    installed, fix = truthy(F.col("InstalledVersion")), truthy(F.col("FixedVersion"))
    target, kind = F.coalesce("_child.Target", image), truthy(F.col("_child.Type"))
    return findings_of(
        rows,
        "trivy-container",
        severity=severity_from_string(default("Severity", fixed["severity"])),
        rule_id=rule,
        title=F.concat(
            rule,
            F.lit(": "),
            package,
            F.when(installed.isNull(), "").otherwise(F.concat(F.lit(" ("), installed, F.lit(")"))),
        ),
        description=default("Description", ""),
        file_path=F.when(from_dockerfile, F.col("_target")),
        resource=F.when(kind.isNull(), target).otherwise(F.concat(target, F.lit(" ("), kind, F.lit(")"))),
        remediation=F.when(fix.isNull(), no_fix).otherwise(
            F.concat(F.lit(upgrade), package, F.lit(to_version), fix)
        ),
        metadata=json_object(
            {
                "image": image,
                "package": package,
                "installed_version": default("InstalledVersion", ""),
                "fixed_version": default("FixedVersion", ""),
            },
            {"references": raw_json(F.col("References"), "[]"), "cvss": raw_json(F.col("CVSS"), "{}")},
        ),
    )


def container_build(raw: DataFrame) -> DataFrame:
    """A failed image build is itself a finding."""
    fixed = FIXED["container-build"]
    rows = raw.where("return_code <> 0").select(
        "scan_id", F.col("seq").alias("_report"), F.lit(0).alias("_pos"), F.col("target").alias("_target"), "stderr"
    )
    return findings_of(
        rows,
        "container-build",
        severity=F.lit("HIGH"),
        rule_id=F.lit(fixed["rule_id"]),
        title=F.lit(fixed["title"]),
        description=F.concat(
            F.lit(fixed["description"][0]),
            F.col("_target"),
            F.lit(fixed["description"][1]),
            F.substring(F.coalesce("stderr", F.lit("")), 1, 500),
        ),
        file_path=F.col("_target"),
    )


def _configured_bandit(raw: DataFrame, config: Mapping[str, Any]) -> DataFrame:
    return bandit(raw, lookup(config, "repository.default_path", "/repo"))


def _configured_pylint(raw: DataFrame, config: Mapping[str, Any]) -> DataFrame:
    return pylint(raw, lookup(config, "repository.default_path", "/repo"))


def _configured_images(raw: DataFrame, config: Mapping[str, Any]) -> DataFrame:
    return trivy_container(
        raw,
        lookup(config, "tools.container.image_name_prefix", "scan-"),
        lookup(config, "tools.container.severities"),
        lookup(config, "tools.container.ignore_unfixed", False),
        lookup(config, "tools.container.build_images", True),
    )


def _plain(normalizer: Callable[[DataFrame], DataFrame]) -> Normalizer:
    return lambda raw, config: normalizer(raw)


Normalizer = Callable[[DataFrame, Mapping[str, Any]], DataFrame]

# The registry is the extension point: a user adds a tool by adding a function (reports,
# configuration) -> findings here, or replaces one.
NORMALIZERS: dict[str, Normalizer] = {
    "terraform-fmt": _plain(terraform_fmt),
    "terraform-validate": _plain(terraform_validate),
    "tflint": _plain(tflint),
    "tfsec": _plain(tfsec),
    "checkov": _plain(checkov),
    "trivy": _plain(trivy),
    "cfn-lint": _plain(cfn_lint),
    "cfn-nag": _plain(cfn_nag),
    "checkov-cfn": _plain(checkov_cfn),
    "bandit": _configured_bandit,
    "safety": _plain(safety),
    "pylint": _configured_pylint,
    "npm-audit": _plain(npm_audit),
    "snyk-iac-template": _plain(snyk_iac_template),
    "snyk-iac": _plain(snyk_iac),
    "container-build": _plain(container_build),
    "trivy-container": _configured_images,
}

# Normalisers that depend on settings, for settings of every scan (see ``policies.settings``). A root
# that no path starts with leaves the paths as they are.
BY_SCAN: dict[str, Callable[[DataFrame, DataFrame], DataFrame]] = {
    "bandit": lambda raw, settings: strip_roots_by_scan(bandit(raw, "\0"), settings),
    "pylint": lambda raw, settings: strip_roots_by_scan(pylint(raw, "\0"), settings),
    "trivy-container": lambda raw, settings: trivy_container(raw, by_scan=settings),
}

# What the tools' JSON starts with; the others print plain text.
TOP_LEVEL = {
    "{": ["terraform-validate", "tflint", "tfsec", "checkov", "trivy", "checkov-cfn", "bandit", "npm-audit", "trivy-container"],
    "[": ["cfn-lint", "cfn-nag", "pylint"],
    "[{": ["safety", "snyk-iac-template", "snyk-iac"],
}


def readable(raw: DataFrame) -> Column:
    """The report's output is empty or JSON of its tool's form."""
    start = F.substring(F.btrim(F.col("stdout"), F.lit(BLANKS)), 1, 1)
    expected = F
    for chars, tools in TOP_LEVEL.items():
        expected = expected.when(F.col("tool").isin(tools), start.isin(*chars))
    ok = expected.otherwise(True) & F.when(
        F.col("tool").isin([t for tools in TOP_LEVEL.values() for t in tools]), well_formed(F.col("stdout"))
    ).otherwise(True)
    return F.coalesce((start == "") | ok, F.lit(True))


def parse_errors(raw: DataFrame) -> DataFrame:
    """Reports with output that is not JSON of the tool's form; the normalisers skip them."""
    return raw.where(~readable(raw)).select("scan_id", "tool", "target", "seq", "stdout")
