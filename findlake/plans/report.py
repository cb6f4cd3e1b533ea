"""Reports as ordered text fragments.

A report of a scan is never one value: a scan may hold a third of all findings. Every renderer
returns rows (scan_id, major, part, item, text); a document is the texts of its scan in the order
of (major, part, item), one per line. The text sink writes them range-partitioned by that order,
so a large scan spreads over many tasks and files.

A renderer takes (findings, scans): the findings to show, already deduplicated and filtered, and
one row per scan from ``summarize``.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from findlake.functions import (
    ellipsis,
    emoji,
    finding_key,
    html_escape,
    location,
    sarif_level,
    sarif_message,
    sarif_path,
    sarif_rule_name,
    sarif_score,
    sarif_tags,
    severity_rank,
    truthy,
)
from findlake.model import SEVERITIES_DESC
from findlake.operators.aggregate import count_by_severity, scan_status, top_findings
from findlake.operators.ordering import first_by, hot_join, numbered

ORDER = ["scan_id", "major", "part", "item"]
LAST = (1 << 63) - 1
TITLE = "Security Scan Report"


def fragments(df: DataFrame, text: Column, part: Column | int, major: Column | int = 0, item: Column | int = 0) -> DataFrame:
    def as_column(value, kind: str) -> Column:
        return (value if isinstance(value, Column) else F.lit(value)).cast(kind)

    return df.select(
        "scan_id",
        as_column(major, "bigint").alias("major"),
        as_column(part, "int").alias("part"),
        as_column(item, "bigint").alias("item"),
        text.alias("text"),
    )


def union_all(*parts: DataFrame) -> DataFrame:
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def text(*parts: Column | str) -> Column:
    return F.concat(*[F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts])


def lines(*parts: Column) -> Column:
    """Lines joined by newlines; NULL lines are left out."""
    return F.concat_ws("\n", *parts)


def if_set(value: Column, *parts: Column | str) -> Column:
    """A line shown only if the value is neither missing nor empty."""
    return F.when(truthy(value).isNotNull(), text(*parts))


def severity_place(severity: Column) -> Column:
    """Section order: CRITICAL 0 to INFO 4."""
    return len(SEVERITIES_DESC) - 1 - severity_rank(severity)


def section_sizes(findings: DataFrame) -> DataFrame:
    return count_by_severity(findings).withColumnRenamed("findings", "size")


# --- JSON ------------------------------------------------------------------------------------


def json_value(value: Column) -> Column:
    """JSON text of one string, number or NULL."""
    wrapped = F.to_json(F.array(value), {"ignoreNullFields": "false"})
    return F.substr(wrapped, F.lit(2), F.length(wrapped) - 2)


def json_counts(pairs: Column) -> Column:
    return F.to_json(F.map_from_entries(pairs))


def finding_json() -> Column:
    plain = ["tool", "severity", "rule_id", "title", "description", "file_path", "line_number", "resource", "remediation"]
    body = F.to_json(F.struct(*plain), {"ignoreNullFields": "false"})
    return text(F.substr(body, F.lit(1), F.length(body) - 1), ',"metadata":', F.coalesce("metadata", F.lit("{}")), "}")


def json_report(findings: DataFrame, scans: DataFrame) -> DataFrame:
    """The report object: a head line with the summary, one line per finding, a tail line."""
    entries = F.array(*[F.struct(F.lit(s).alias("k"), F.col(s.lower()).alias("v")) for s in SEVERITIES_DESC])
    head = text(
        '{"scan_timestamp":', json_value(F.col("scan_timestamp")),
        ',"repository":', json_value(F.col("repository")),
        ',"branch":', json_value(F.col("branch")),
        ',"summary":{"total_findings":', F.col("total_findings"),
        ',"by_severity":', json_counts(F.filter(entries, lambda e: e.v > 0)),
        ',"by_tool":', json_counts(F.col("by_tool")),
        ',"unique_files":', F.col("unique_files"),
        '},"findings":[',
    )
    tail = text(
        '],"metadata":{"scanners_run":', F.to_json("scanners_run"),
        ',"total_raw_findings":', F.col("total_raw_findings"),
        ',"deduplication_enabled":', F.col("deduplication_enabled"),
        "}}",
    )
    body = numbered(findings, ["scan_id"])
    comma = F.when(F.col("n") == 1, "").otherwise(",")
    return union_all(
        fragments(scans, head, 0),
        fragments(body, text(comma, finding_json()), 1, item=F.col("seq")),
        fragments(scans, tail, 2),
    )


# --- SARIF -----------------------------------------------------------------------------------

# Fixed values of the format.
SARIF_VERSION = "2.1.0"
SARIF_SCHEMA = "https://raw.githubusercontent.com/oasis-tcs/sarif-spec/master/Schemata/sarif-schema-2.1.0.json"


def sarif_rule() -> Column:
    title, description = F.col("title"), F.col("description")
    short = F.coalesce(truthy(F.substring(title, 1, 512)), F.col("rule_id"))
    full = F.coalesce(truthy(F.substring(description, 1, 4096)), title)
    advice = F.substring(truthy(F.col("remediation")), 1, 4096)
    return F.to_json(
        F.struct(
            F.col("rule_id").alias("id"),
            sarif_rule_name(title).alias("name"),
            F.struct(short.alias("text")).alias("shortDescription"),
            F.struct(full.alias("text")).alias("fullDescription"),
            F.struct(sarif_level(F.col("severity")).alias("level")).alias("defaultConfiguration"),
            F.struct(
                sarif_score(F.col("severity")).alias("security-severity"),
                sarif_tags(F.col("tool"), F.col("severity")).alias("tags"),
            ).alias("properties"),
            F.when(advice.isNotNull(), F.struct(advice.alias("text"), advice.alias("markdown"))).alias("help"),
        )
    )


def sarif_result() -> Column:
    path, line = F.col("file_path"), F.col("line_number")
    place = F.struct(
        F.struct(
            F.struct(sarif_path(path).alias("uri"), F.lit("%SRCROOT%").alias("uriBaseId")).alias("artifactLocation"),
            F.when(F.coalesce(line, F.lit(0)) != 0, F.struct(line.alias("startLine"))).alias("region"),
        ).alias("physicalLocation")
    )
    key = finding_key(path, line, F.col("rule_id"), F.col("title"))
    return F.to_json(
        F.struct(
            F.col("rule_id").alias("ruleId"),
            sarif_level(F.col("severity")).alias("level"),
            F.struct(sarif_message(F.col("title"), F.col("description"), F.col("resource")).alias("text")).alias("message"),
            F.when(truthy(path).isNotNull(), F.array(place)).alias("locations"),
            F.struct(key.alias("primaryLocationLineHash")).alias("fingerprints"),
        )
    )


def sarif_rules(findings: DataFrame) -> DataFrame:
    """The first finding of each rule of each run describes the rule."""
    return first_by(findings, ["scan_id", "tool", "rule_id"])


def sarif_report(findings: DataFrame, scans: DataFrame) -> DataFrame:
    """One run per tool in first-seen order; rules and results are one line each."""
    runs = findings.groupBy("scan_id", "tool").agg(F.min("seq").alias("_run"))
    firsts = runs.groupBy("scan_id").agg(F.min("_run").alias("_first"))
    stamped = runs.join(firsts, "scan_id").join(scans.select("scan_id", "scan_timestamp"), "scan_id")
    # Every finding gets the number of its run, the lowest of its tool, where it is put in order.
    with_run = numbered(findings, ["scan_id", "tool"], first="_run")
    rules = hot_join(sarif_rules(findings), runs, ["scan_id", "tool"], "inner")
    run = F.col("_run")
    comma = F.when(F.col("seq") == run, "").otherwise(",")
    run_head = text(
        F.when(run == F.col("_first"), "").otherwise(","),
        '{"tool":{"driver":{"name":', json_value(text("findlake (", F.col("tool"), ")")), ',"version":"1.0.0","rules":[',
    )
    run_tail = text(
        '],"invocations":[{"executionSuccessful":true,"endTimeUtc":', json_value(text(F.col("scan_timestamp"), "Z")), "}]}"
    )
    doc_head = text('{"$schema":"', SARIF_SCHEMA, '","version":"', SARIF_VERSION, '","runs":[')
    return union_all(
        fragments(scans, doc_head, 0, major=-1),
        fragments(stamped, run_head, 0, major=run),
        fragments(rules, text(comma, sarif_rule()), 1, major=run, item=F.col("seq")),
        fragments(stamped, F.lit(']}},"results":['), 2, major=run),
        fragments(with_run, text(comma, sarif_result()), 3, major=run, item=F.col("seq")),
        fragments(stamped, run_tail, 4, major=run),
        fragments(scans, F.lit("]}"), 5, major=LAST),
    )


# --- Markdown --------------------------------------------------------------------------------


def markdown_report(findings: DataFrame, scans: DataFrame) -> DataFrame:
    by_count = F.array_sort(
        F.transform(
            F.col("by_tool"),
            # most findings first; array order (first seen) breaks ties
            lambda t, i: F.struct((-t.findings).alias("n"), i.alias("i"), t.tool.alias("tool")),
        )
    )
    tool_lines = F.transform(by_count, lambda t: text("- **", t.tool, ":** ", -t.n))
    severity_lines = [
        F.when(F.col(s.lower()) > 0, text(f"- **{s}:** ", F.col(s.lower()))) for s in SEVERITIES_DESC
    ]
    head = lines(
        F.lit(f"# {TITLE}\n"),
        text("**Repository:** ", F.coalesce("repository", F.lit("None")), "\n"),
        if_set(F.col("branch"), "**Branch:** ", F.col("branch"), "\n"),
        text("**Scan Date:** ", F.coalesce("scan_timestamp", F.lit("N/A")), "\n"),
        F.lit("---\n"),
        F.lit("## Summary\n"),
        text("- **Total Findings:** ", F.col("total_findings")),
        text("- **Files Scanned:** ", F.col("unique_files")),
        text("- **Scanners Run:** ", F.array_join("scanners_run", ", "), "\n"),
        F.lit("### Findings by Severity\n"),
        *severity_lines,
        F.lit(""),
        F.lit("### Findings by Tool\n"),
        F.when(F.size("by_tool") > 0, F.array_join(tool_lines, "\n")),
        F.lit("\n---\n"),
        F.lit("## Findings Details\n"),
        F.when(F.col("total_findings") == 0, F.lit("No findings detected.\n")),
    )
    sizes = section_sizes(findings)
    section = text("### ", F.col("severity"), " Severity (", F.col("size"), " findings)\n")
    entry = lines(
        text("#### ", F.col("n"), ". ", F.col("title")),
        text("- **Severity:** ", F.col("severity")),
        text("- **Tool:** ", F.col("tool")),
        text("- **Rule:** ", F.col("rule_id")),
        if_set(F.col("file_path"), "- **Location:** `", location(F.col("file_path"), F.col("line_number")), "`"),
        if_set(F.col("resource"), "- **Resource:** ", F.col("resource")),
        if_set(F.col("description"), "- **Description:** ", F.col("description")),
        if_set(F.col("remediation"), "- **Remediation:** ", F.col("remediation")),
        F.lit(""),
    )
    place = severity_place(F.col("severity"))
    return union_all(
        fragments(scans, head, 0),
        fragments(sizes, section, 1 + place * 2),
        fragments(section_numbering(findings), entry, 2 + place * 2, item=F.col("seq")),
    )


def section_numbering(findings: DataFrame) -> DataFrame:
    """Number findings within their severity section, in report order."""
    return numbered(findings, ["scan_id", "severity"], "seq", "n")


# --- HTML ------------------------------------------------------------------------------------

STYLE = (
    "body{font-family:sans-serif;max-width:70em;margin:2em auto}"
    ".cards{display:flex;gap:1em}.card{flex:1;border:1px solid #ccc;padding:1em}"
    ".finding{border-top:1px solid #ccc;padding:.5em 0}.badge{font-weight:bold;margin-right:.5em}"
)


def html_report(findings: DataFrame, scans: DataFrame) -> DataFrame:
    def card(name: str, value: str) -> Column:
        return text(f'<div class="card"><h3>{name}</h3><p>', F.col(value), "</p></div>")

    head = lines(
        F.lit('<!DOCTYPE html>\n<html lang="en">\n<head>\n<meta charset="UTF-8">'),
        text(f"<title>{TITLE}</title>\n<style>{STYLE}</style>\n</head>\n<body>\n<h1>{TITLE}</h1>"),
        text("<p>Repository: ", html_escape(F.coalesce("repository", F.lit("N/A"))), "</p>"),
        if_set(F.col("branch"), "<p>Branch: ", html_escape(F.col("branch")), "</p>"),
        text("<p>Scan Date: ", html_escape(F.coalesce("scan_timestamp", F.lit("N/A"))), "</p>"),
        F.lit('<div class="cards">'),
        card("Total Findings", "total_findings"),
        card("Files Analyzed", "unique_files"),
        card("Critical Findings", "critical"),
        card("High Findings", "high"),
        F.lit("</div>\n<h2>Findings Details</h2>"),
        F.when(F.col("total_findings") == 0, F.lit("<p>No findings detected.</p>")),
    )
    severity = F.col("severity")
    section = text("<h3>", severity, " Severity (", F.col("size"), " findings)</h3>")
    where = location(html_escape(F.col("file_path")), F.col("line_number"))
    entry = lines(
        text('<div class="finding"><p><span class="badge severity-', severity, '">', severity, "</span>",
             html_escape(F.coalesce("title", F.lit("Untitled"))), "</p>"),
        text("<p>Severity: ", severity, " | Tool: ", html_escape(F.coalesce("tool", F.lit("Unknown"))),
             " | Rule: ", html_escape(F.coalesce("rule_id", F.lit("N/A"))),
             F.coalesce(if_set(F.col("file_path"), " | Location: <code>", where, "</code>"), F.lit("")), "</p>"),
        text("<p>", html_escape(F.coalesce("description", F.lit("No description available"))), "</p>"),
        if_set(F.col("remediation"), "<p>Remediation: ", html_escape(F.col("remediation")), "</p>"),
        F.lit("</div>"),
    )
    place = severity_place(severity)
    return union_all(
        fragments(scans, head, 0),
        fragments(section_sizes(findings), section, 1 + place * 2),
        fragments(findings, entry, 2 + place * 2, item=F.col("seq")),
        fragments(scans, F.lit("</body>\n</html>"), 100),
    )


# --- CI --------------------------------------------------------------------------------------


# Characters that a folder name of a partition column holds as % and two hex digits.
ESCAPED = r"""[\x01-\x1f\x7f"#%'*/:=?\\{\[\]^]"""


def report_folder(root: str, name: str) -> Column:
    """Where a scan's document of that name is written: a folder whose files, by path, are its parts."""
    chars = F.split(F.col("scan_id"), "")
    escaped = F.transform(
        chars, lambda c: F.when(c.rlike(ESCAPED), F.concat(F.lit("%"), F.lpad(F.hex(F.ascii(c)), 2, "0"))).otherwise(c)
    )
    return text(f"{root}/{name}/scan_id=", F.array_join(escaped, ""))


def ci_outputs(
    scans: DataFrame, status: DataFrame, report_path: str = "reports", formats: Sequence[str] = ("json", "sarif")
) -> DataFrame:
    """(scan_id, name, value): the named outputs of a CI step. The SARIF path is named if SARIF is
    among the formats written."""
    joined = scans.join(status.select("scan_id", "status"), "scan_id")
    # The names of the outputs.
    values = {
        "findings-count": F.col("total_findings").cast("string"),
        "critical-count": F.col("critical").cast("string"),
        "high-count": F.col("high").cast("string"),
        "medium-count": F.col("medium").cast("string"),
        "low-count": F.col("low").cast("string"),
        "report-path": F.lit(report_path),
        "sarif-path": report_folder(report_path, "sarif"),
        "scan-status": F.col("status"),
    }
    if "sarif" not in formats:
        del values["sarif-path"]
    wide = joined.select("scan_id", *[v.alias(n) for n, v in values.items()])
    return wide.unpivot("scan_id", list(values), "name", "value")


def ci_summary(
    findings: DataFrame, scans: DataFrame, status: DataFrame, scan_path: str = ".", formats: str = "json,sarif"
) -> DataFrame:
    """Step summary: counts, status, configuration and the ten worst findings."""
    joined = scans.join(status.select("scan_id", "fail_on", "exit_code"), "scan_id")
    level = F.coalesce("fail_on", F.lit("HIGH"))
    verdict = (
        F.when(F.col("exit_code") == 0, text(":white_check_mark: Passed - No findings at or above ", level, " severity"))
        .when(F.col("exit_code") == 2, text(":x: Failed - Findings detected at or above ", level, " severity"))
        .otherwise(F.lit(":warning: Error - Scan encountered an error"))
    )
    head = lines(
        F.lit("# Security Scan Results\n\n## Summary\n\n| Severity | Count |\n|----------|-------|"),
        *[text(f"| {s.title()} | ", F.col(s.lower()), " |") for s in SEVERITIES_DESC if s != "INFO"],
        text("| **Total** | **", F.col("total_findings"), "** |\n"),
        text("> **Status:** ", verdict),
        F.lit("\n## Scan Configuration\n"),
        F.lit(f"- **Scan Path:** `{scan_path}`"),
        F.lit(f"- **Output Formats:** {formats}"),
        text("- **Fail Threshold:** ", level, "\n"),
        F.when(F.col("total_findings") > 0, F.lit("## Top Findings\n")),
    )
    top = top_findings(findings)
    where = location(F.coalesce("file_path", F.lit("None")), F.col("line_number"))
    entry = text(
        F.col("place"), ". ", emoji(F.col("severity")), " **", F.col("severity"), "** - ", F.col("title"),
        "\n   - Location: `", where, "`\n",
    )
    more = scans.where("total_findings > 10")
    more_line = text("*... and ", F.col("total_findings") - 10, " more findings. See full report for details.*")
    return union_all(
        fragments(joined, head, 0),
        fragments(top, entry, 1, item=F.col("place")),
        fragments(more, more_line, 2),
    )


def severity_listing(findings: DataFrame) -> DataFrame:
    """All findings worst first, in report order; ``header`` marks the first of each level.

    Sorting by (scan_id, place, seq) gives the listing.
    """
    place, header = severity_place(F.col("severity")), F.col("n") == 1
    return section_numbering(findings).select(*findings.columns, place.alias("place"), header.alias("header"))


def ci_log(findings: DataFrame, scans: DataFrame) -> DataFrame:
    """Log listing of all findings with shortened texts."""
    rule = "=" * 46
    description, remediation = F.col("description"), F.col("remediation")
    where = location(F.coalesce("file_path", F.lit("None")), F.col("line_number"), zero_line=True)
    entry = lines(
        F.when(F.col("header"), text("\n--- ", F.col("severity"), " ---\n")),
        text("[", F.col("tool"), "] ", F.col("rule_id"), ": ", F.col("title")),
        text("  Location: ", where),
        if_set(F.col("resource"), "  Resource: ", F.col("resource")),
        F.when(description != "FAILED", if_set(description, "  Description: ", ellipsis(description, 200))),
        if_set(remediation, "  Remediation: ", ellipsis(remediation, 150)),
        F.lit(""),
    )
    some, none = scans.where("total_findings > 0"), scans.where("total_findings = 0")
    return union_all(
        fragments(some, F.lit(f"\n{rule}\nSECURITY FINDINGS DETAILS\n{rule}\n"), 0),
        fragments(severity_listing(findings), entry, 1 + F.col("place"), item=F.col("seq")),
        fragments(some, F.lit(f"{rule}\nEND OF FINDINGS DETAILS\n{rule}"), 9),
        fragments(none, F.lit("No findings to display."), 0),
    )


def ci_output_file(outputs: DataFrame) -> DataFrame:
    """The outputs as lines ``name=value``."""
    return fragments(outputs, text(F.col("name"), "=", F.col("value")), 0, item=F.abs(F.xxhash64("name")))


# --- registry and sink -----------------------------------------------------------------------

Renderer = Callable[[DataFrame, DataFrame], DataFrame]

# The registry is the extension point for report formats; unknown names are ignored.
RENDERERS: dict[str, Renderer] = {
    "json": json_report,
    "sarif": sarif_report,
    "markdown": markdown_report,
    "html": html_report,
    "ci-log": ci_log,
}

StatusRenderer = Callable[[DataFrame, DataFrame, DataFrame, str, Sequence[str]], DataFrame]

# Documents that also show the status of a scan and what else is written where.
STATUS_RENDERERS: dict[str, StatusRenderer] = {
    "ci-outputs": lambda findings, scans, status, path, formats: ci_output_file(ci_outputs(scans, status, path, formats)),
    "ci-summary": lambda findings, scans, status, path, formats: ci_summary(findings, scans, status, formats=",".join(formats)),
}

# Files of a scan are kept in sections of this many, so that names of one section are equally long.
FILES_PER_SECTION = 10_000


def write_report(report: DataFrame, path: str) -> None:
    """Write one folder per scan; its files, in the order of their paths, are the document.

    Range partitioning by the full order splits a large scan over many tasks. The file count
    follows the data: AQE merges small ranges. Spark numbers files with five digits, and with more
    from 100,000 on, so a padded section number stands before the file name.
    """
    ranged = report.repartitionByRange(*ORDER)
    section = F.lpad((F.spark_partition_id() / FILES_PER_SECTION).cast("int").cast("string"), 8, "0")
    ordered = ranged.withColumn("section", section).sortWithinPartitions(ORDER[0], "section", *ORDER[1:])
    ordered.select("scan_id", "section", "text").write.partitionBy("scan_id", "section").text(path)


def write_reports(
    findings: DataFrame, scans: DataFrame, formats: Sequence[str], path: str, status: DataFrame | None = None
) -> list[str]:
    """Write the documents; those that show the status need ``status`` (see ``run_scans``)."""
    known = [n for n in formats if n in RENDERERS or status is not None and n in STATUS_RENDERERS]
    for name in known:
        if name in RENDERERS:
            document = RENDERERS[name](findings, scans)
        else:
            document = STATUS_RENDERERS[name](findings, scans, status, path, [n for n in known if n in RENDERERS])
        write_report(document, f"{path}/{name}")
    return known


def report_status(gated: DataFrame, errors: DataFrame) -> DataFrame:
    return scan_status(gated, errors).join(gated.select("scan_id", "fail_on"), "scan_id")
