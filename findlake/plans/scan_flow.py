"""The whole flow: raw reports and files in; findings, summaries, gates and reports out."""

from __future__ import annotations

from collections.abc import Collection, Mapping
from typing import Any, NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from findlake.model import FINDING_COLUMNS, FINDINGS, TOOLS, Tool
from findlake.operators import aggregate, classify, policy
from findlake.operators.errors import unread, usable
from findlake.operators.normalize import BY_SCAN, NORMALIZERS
from findlake.operators.secrets import scan_secrets
from findlake.session import materialize
from findlake.sources import policies
from findlake.sources.config import POLICY_CONFIG, lookup
from findlake.sources.reports import laid_out_by_tool, lay_out_by_tool


def normalize_tool(
    raw: DataFrame, files: DataFrame | None, tool: Tool, config: Mapping[str, Any], rules: DataFrame
) -> DataFrame:
    """Findings of one tool with everything the configuration says about it."""
    patterns = lookup(config, "repository.excluded_paths", [])
    reports = raw.where(F.col("tool") == tool.name)
    found = NORMALIZERS[tool.name](reports, config)
    if tool.name == "safety":
        found = policy.cut_findings_at_auth_failure(found, reports)
    if tool.name == "bandit":
        found = policy.bandit_remediation(found)
    if tool.name == "pylint":
        found = policy.drop_excluded_pylint(found, rules)
    if tool.name == "checkov-cfn" and files is not None:
        found = policy.keep_template_files(found, classify.cfn_templates(files))
    if tool.name == "snyk-iac-template" and files is not None:
        found = policy.restore_template_paths(found, policy.template_renames(files))
    if tool.finding_tool == "snyk-iac":
        found = found.where(policy.at_or_above(F.col("severity"), lookup(config, "tool_config.snyk.severity_threshold", "low")))
    if tool.path_filtered:
        found = policy.drop_excluded_paths(found, patterns)
    if tool.exclude_key and tool.name != "pylint":
        found = policy.drop_excluded_rules(found, rules)
    return found


def normalize_all(
    raw: DataFrame, files: DataFrame | None, config: Mapping[str, Any], only: Collection[str] | None = None
) -> DataFrame:
    """All findings of all enabled tools, in run order by ``seq``; secrets come from ``files``. ``only``
    names the tools that ``raw`` has reports of, where that is known."""
    rules = policy.exclude_rules_dim(raw.sparkSession, config)
    parts = [raw.sparkSession.createDataFrame([], FINDINGS)]
    for tool in TOOLS:
        if not classify.tool_enabled(config, tool) or only is not None and tool.name not in only:
            continue
        if tool.name in NORMALIZERS:
            parts.append(normalize_tool(raw, files, tool, config, rules))
        elif files is not None:
            parts.append(policy.drop_excluded_rules(scan_secrets(files), rules))
    return aggregate.union_findings(parts)


def normalize_by_scan(raw: DataFrame, files: DataFrame | None, configs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The same by every scan's own configuration (see ``policies.parsed_configs``), and the scans'
    settings. Policies meet findings, never the reports' texts."""
    off, rules, patterns, settings = (
        materialize(table, name)
        for table, name in (
            (policies.switched_off(configs), "policy-off"),
            (policies.excluded_rules(configs), "policy-rules"),
            (policies.excluded_patterns(configs), "policy-patterns"),
            (policies.settings(configs), "policy-settings"),
        )
    )
    parts = []
    for tool in TOOLS:
        if tool.name not in NORMALIZERS:
            found = scan_secrets(files) if files is not None else None
        else:
            reports = raw.where(F.col("tool") == tool.name)
            found = BY_SCAN[tool.name](reports, settings) if tool.name in BY_SCAN else NORMALIZERS[tool.name](reports, {})
            if tool.name == "safety":
                found = policy.cut_findings_at_auth_failure(found, reports)
            if tool.name == "bandit":
                found = policy.bandit_remediation(found)
            if tool.name == "checkov-cfn" and files is not None:
                found = policy.keep_template_files(found, classify.cfn_templates(files))
            if tool.name == "snyk-iac-template" and files is not None:
                found = policy.restore_template_paths(found, policy.template_renames(files))
            if tool.finding_tool == "snyk-iac":
                found = policy.at_or_above_by_scan(found, settings)
        if found is not None:
            parts.append(found.select(*FINDING_COLUMNS, F.lit(tool.name).alias("_tool")))
    union = parts[0]
    for part in parts[1:]:
        union = union.unionByName(part)
    kept = materialize(policy.apply_by_scan(union, off, rules), "findings-by-rule", ["_tool"])
    return policy.drop_paths_by_scan(kept, patterns).select(FINDING_COLUMNS), settings


class ScanResult(NamedTuple):
    findings: DataFrame  # all, duplicates included
    reported: DataFrame  # deduplicated, what reports show
    summary: DataFrame  # one row per scan
    status: DataFrame  # gate, exit code and status word per scan
    errors: DataFrame  # reports and entries that could not be read or belong to no scan


def run_scans(
    raw: DataFrame,
    files: DataFrame | None,
    scans: DataFrame,
    config: Mapping[str, Any] | DataFrame,
    fail_on: str | None = None,
    report_minimum: str | None = None,
    default_config: Mapping[str, Any] | None = None,
) -> ScanResult:
    """``config`` is one configuration for all scans, or a table (scan_id, ``config`` as JSON text) with
    their own; scans without one get ``default_config`` (by default the tools' policy).

    ``scans`` has (scan_id, repository, branch, scan_timestamp, errored) and may have
    ``fail_on``; a given ``fail_on`` beats it, and the configuration is the last resort.

    Findings, and what is left of them after dedup, are written to the shared folder once: the
    reports are parsed once, however many summaries, gates and documents read the result.
    ``raw`` is laid out by tool first if its files are not (see ``lay_out_by_tool``). A scan that
    only shows up in the reports is added to ``scans`` without facts, so no finding goes unreported;
    reports without a scan are listed in ``errors``. ``report_minimum`` drops lower findings from
    what is reported and counted (``severity.report_minimum`` of the configuration, if wanted).
    """
    raw = raw if laid_out_by_tool(raw) else lay_out_by_tool(raw)
    errors = unread(raw)
    raw = usable(raw)
    files = files.where("scan_id is not null") if files is not None else None
    dedup: bool | DataFrame
    if isinstance(config, DataFrame):
        known = scans.select("scan_id").unionByName(raw.select("scan_id"))
        if files is not None:
            known = known.unionByName(files.select("scan_id"))
        configs = policies.parsed_configs(known, config, POLICY_CONFIG if default_config is None else default_config)
        found, settings = normalize_by_scan(raw, files, configs)
        dedup = settings
        default_gate: Column = F.coalesce("_fail_on", F.lit("HIGH"))
    else:
        found, settings = normalize_all(raw, files, config), None
        dedup = lookup(config, "aggregation.deduplicate", True)
        default_gate = F.lit(lookup(config, "severity.fail_on", "HIGH"))
    findings = materialize(found, "findings", ["tool"])
    if report_minimum is not None:
        findings = policy.severity_floor(findings, report_minimum)
    if settings is not None:
        reported = materialize(aggregate.deduplicate_by_scan(findings, settings), "reported")
    else:
        reported = materialize(aggregate.deduplicate(findings), "reported") if dedup else findings
    scans = scans.join(findings.select("scan_id").distinct(), "scan_id", "full")
    if settings is not None:
        scans = scans.join(settings.select("scan_id", "_fail_on"), "scan_id", "left")
    if fail_on is not None:
        level = F.lit(fail_on)
    elif "fail_on" in scans.columns:
        level = F.coalesce("fail_on", default_gate)
    else:
        level = default_gate
    gates = scans.select("scan_id", level.alias("fail_on"))
    gated = aggregate.gate(reported, gates)
    status = aggregate.scan_status(gated, scans).join(gated.select("scan_id", "fail_on"), "scan_id")
    facts = scans.select("scan_id", "repository", "branch", "scan_timestamp")
    return ScanResult(findings, reported, aggregate.summary_of(reported, findings, facts, dedup), status, errors)
