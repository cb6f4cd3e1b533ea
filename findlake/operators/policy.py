"""Policies: rule, path and severity filters, and the joins that decide or enrich findings."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from findlake.functions import basename, path_excluded, severity_rank, strip_scan_root, truthy
from findlake.model import POSITION_BITS, REPORT_BITS, SEVERITIES, TOOLS
from findlake.operators.ordering import hot_join
from findlake.operators.path_index import drop_excluded
from findlake.operators.remediation import BANDIT_ADVICE, BANDIT_DEFAULT
from findlake.sources.config import lookup
from findlake.sources.dims import dimension


def exclude_rules_dim(spark: SparkSession, config: Mapping) -> DataFrame:
    """(tool, rule_id) pairs excluded by the configuration. Rule ids are taken as written."""
    pairs = []
    for tool in TOOLS:
        if tool.exclude_key:
            rules = lookup(config, f"tools.{tool.scanner}.exclude_rules.{tool.exclude_key}")
            pairs += [(tool.finding_tool, rule) for rule in rules or []]
    return dimension(spark, sorted(set(pairs)), "tool string, rule_id string")


def drop_excluded_rules(findings: DataFrame, rules: DataFrame) -> DataFrame:
    """Drop findings whose (tool, rule_id) is excluded.

    ``rules`` is the job's configuration turned into rows: the planner knows its size and
    broadcasts it if small. A rules table that grows with the data is joined by shuffle.
    """
    return findings.join(rules, ["tool", "rule_id"], "left_anti").select(findings.columns)


def drop_excluded_pylint(findings: DataFrame, rules: DataFrame) -> DataFrame:
    """Pylint rules are excluded by message id or by symbol: two anti joins, no OR condition."""
    symbols = rules.select("tool", F.col("rule_id").alias("_symbol"))
    return (
        drop_excluded_rules(findings, rules)
        .withColumn("_symbol", F.get_json_object("metadata", "$.symbol"))
        .join(symbols, ["tool", "_symbol"], "left_anti")
        .select(findings.columns)
    )


def excluded_counts(findings: DataFrame, rules: DataFrame) -> DataFrame:
    """How many findings the rule exclusion drops, per tool."""
    return (
        findings.join(rules, ["tool", "rule_id"], "left_semi")
        .groupBy("tool")
        .agg(F.count(F.lit(1)).alias("excluded_count"))
    )


def drop_excluded_paths(df: DataFrame, patterns: Sequence[str], path: str = "file_path") -> DataFrame:
    return df.where(~path_excluded(truthy(F.col(path)), patterns))


def severity_floor(findings: DataFrame, minimum: str) -> DataFrame:
    """Findings at or above a level; an unknown level keeps all."""
    floor = SEVERITIES.index(minimum) if minimum in SEVERITIES else 0
    return findings.where(severity_rank(F.col("severity")) >= floor)


def container_filter(
    raw_severity: Column, fixed_version: Column, severities: str | None, ignore_unfixed: bool
) -> Column:
    """Severity list and unfixed switch of the image scan, as a predicate."""
    keep = F.lit(True)
    if severities:
        wanted = [s.strip().upper() for s in severities.split(",")]
        keep = F.upper(F.coalesce(raw_severity, F.lit("UNKNOWN"))).isin(wanted)
    return keep & truthy(fixed_version).isNotNull() if ignore_unfixed else keep


def container_filter_by_scan(raw_severity: Column, fixed_version: Column) -> Column:
    """The same by the scan's own ``_severities`` and ``_ignore_unfixed``."""
    wanted = F.transform(F.split("_severities", ","), lambda s: F.upper(F.btrim(s)))
    listed = F.array_contains(wanted, F.upper(F.coalesce(raw_severity, F.lit("UNKNOWN"))))
    keep = F.when(truthy(F.col("_severities")).isNull(), True).otherwise(listed)
    return keep & (~F.col("_ignore_unfixed") | truthy(fixed_version).isNotNull())


def at_or_above(severity: Column, threshold: str) -> Column:
    """Tool threshold such as ``low`` or ``high``, on normalised severities; an unknown word
    keeps all."""
    level = threshold.upper()
    return severity_rank(severity) >= (SEVERITIES.index(level) if level in SEVERITIES else 0)


def at_or_above_by_scan(findings: DataFrame, settings: DataFrame) -> DataFrame:
    """The same with every scan's own threshold."""
    known = settings.select("scan_id", F.upper("_threshold").alias("_level"))
    met = hot_join(findings, known, ["scan_id"])
    floor = severity_rank(F.col("_level"))
    return met.where(severity_rank(F.col("severity")) >= F.coalesce(floor, F.lit(0))).select(findings.columns)


def strip_roots_by_scan(findings: DataFrame, settings: DataFrame) -> DataFrame:
    """Paths relative to every scan's own root."""
    met = hot_join(findings, settings.select("scan_id", "_root"), ["scan_id"])
    return met.withColumn("file_path", strip_scan_root(F.col("file_path"), F.coalesce("_root", F.lit("/repo")))).select(findings.columns)


def apply_by_scan(findings: DataFrame, off: DataFrame, rules: DataFrame) -> DataFrame:
    """Findings, with the ``_tool`` of ``raw_reports`` that made them, without those of tools that
    are ``off`` for their scan and without those whose rule the scan excludes. Pylint rules count
    by message id or by symbol. A scan may own a third of the findings, so all joins are salted."""
    kept = hot_join(findings, off, ["scan_id", "_tool"], "left_anti")
    kept = hot_join(kept, rules, ["scan_id", "_tool", "rule_id"], "left_anti")
    symbols = rules.where("_tool = 'pylint'").select("scan_id", F.col("rule_id").alias("_symbol"))
    symbol = F.when(F.col("_tool") == "pylint", F.get_json_object("metadata", "$.symbol"))
    return hot_join(kept.withColumn("_symbol", symbol), symbols, ["scan_id", "_symbol"], "left_anti").select(findings.columns)


def drop_paths_by_scan(findings: DataFrame, patterns: DataFrame) -> DataFrame:
    """Findings, with their ``_tool``, without those on paths that their scan excludes, as far as it
    is on us to drop them. ``findings`` are read twice: give a written table."""
    filtered = [t.name for t in TOOLS if t.path_filtered]
    path = F.when(F.col("_tool").isin(filtered), truthy(F.col("file_path")))
    return drop_excluded(findings.withColumn("_path", path), patterns, ["scan_id"], "_path").select(findings.columns)


def needs_authentication(return_code: Column, stderr: Column) -> Column:
    """A dependency check that failed because it wants a login."""
    low = F.lower(stderr)
    return (return_code != 0) & (
        F.contains(low, F.lit("authentication"))
        | F.contains(low, F.lit("api"))
        | F.contains(stderr, F.lit("EOF when reading"))
    )


def auth_cuts(safety_reports: DataFrame) -> DataFrame:
    """(scan_id, ``_cut``): the number of a scan's first report that failed for want of a login."""
    failed = F.when(needs_authentication(F.col("return_code"), F.col("stderr")), F.col("seq"))
    return safety_reports.groupBy("scan_id").agg(F.min(failed).alias("_cut")).where("_cut is not null")


def cut_at_auth_failure(safety_reports: DataFrame) -> DataFrame:
    """Keep a scan's dependency reports before its first authentication failure. Select the columns
    that are needed: all that are kept meet the cut."""
    kept = hot_join(safety_reports, auth_cuts(safety_reports), ["scan_id"])
    return kept.where(F.col("_cut").isNull() | (F.col("seq") < F.col("_cut"))).select(safety_reports.columns)


def cut_findings_at_auth_failure(findings: DataFrame, safety_reports: DataFrame) -> DataFrame:
    """The same on the findings of the reports: their ``seq`` holds the report's number, so no
    report's text is shuffled."""
    report = F.shiftright("seq", POSITION_BITS).bitwiseAND(F.lit((1 << REPORT_BITS) - 1))
    kept = hot_join(findings, auth_cuts(safety_reports), ["scan_id"])
    return kept.where(F.col("_cut").isNull() | (report < F.col("_cut"))).select(findings.columns)


def keep_template_files(findings: DataFrame, templates: DataFrame) -> DataFrame:
    """Keep findings whose file name is that of a template of the same scan."""
    names = templates.select("scan_id", basename(F.col("path")).alias("_name")).distinct()
    named = findings.withColumn("_name", basename(F.coalesce(F.col("file_path"), F.lit(""))))
    return hot_join(named, names, ["scan_id", "_name"], "left_semi").select(findings.columns)


def template_renames(files: DataFrame) -> DataFrame:
    """(scan_id, renamed, original) of the ``.template`` files that were scanned as ``.yaml``.

    Two originals with one renamed path are settled by the greater path.
    """
    original = files.where(F.col("path").endswith(".template"))
    renamed = F.replace(F.col("path"), F.lit(".template"), F.lit(".yaml"))
    return (
        original.select("scan_id", renamed.alias("renamed"), "path")
        .groupBy("scan_id", "renamed")
        .agg(F.max("path").alias("original"))
    )


def restore_template_paths(findings: DataFrame, renames: DataFrame) -> DataFrame:
    """Give findings on renamed copies their original path; others keep the reported one."""
    mapped = hot_join(findings, renames.withColumnRenamed("renamed", "file_path"), ["scan_id", "file_path"])
    return mapped.withColumn("file_path", F.coalesce("original", "file_path")).select(findings.columns)


def bandit_remediation(findings: DataFrame) -> DataFrame:
    """Set the advice text for each rule id, or the general advice."""
    advice = dimension(findings.sparkSession, list(BANDIT_ADVICE.items()), "rule_id string, _advice string")
    return (
        findings.join(advice, "rule_id", "left")
        .withColumn("remediation", F.coalesce("_advice", F.lit(BANDIT_DEFAULT)))
        .select(findings.columns)
    )
