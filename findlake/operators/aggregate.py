"""Union, dedup, counts, summaries and gates. Every aggregate combines on the map side first."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from findlake.functions import finding_key, normal_path, severity_rank
from findlake.model import FINDING_COLUMNS, SEVERITIES, SEVERITIES_DESC
from findlake.operators.ordering import first_by, hot_join, top_by


def union_findings(parts: Sequence[DataFrame]) -> DataFrame:
    """All findings of all tools, duplicates kept; ``seq`` carries the run order."""
    union = parts[0].select(FINDING_COLUMNS)
    for part in parts[1:]:
        union = union.unionByName(part.select(FINDING_COLUMNS))
    return union


def with_key(findings: DataFrame, normalize_paths: bool = False) -> DataFrame:
    path = F.col("file_path")
    if normalize_paths:
        path = F.when(path.isNotNull(), normal_path(path))
    return findings.withColumn("key", finding_key(path, F.col("line_number"), F.col("rule_id"), F.col("title")))


def deduplicate(findings: DataFrame, enabled: bool = True, normalize_paths: bool = False) -> DataFrame:
    """First finding of each key within a scan, whichever tool reported it."""
    if not enabled:
        return findings
    return first_by(with_key(findings, normalize_paths), ["scan_id", "key"]).select(findings.columns)


def deduplicate_by_scan(findings: DataFrame, settings: DataFrame) -> DataFrame:
    """The same, but scans whose ``_deduplicate`` is false keep all their findings."""
    met = hot_join(findings, settings.select("scan_id", "_deduplicate"), ["scan_id"])
    own = F.when(~F.coalesce("_deduplicate", F.lit(True)), F.col("seq"))
    return first_by(with_key(met.withColumn("_own", own)), ["scan_id", "key", "_own"]).select(findings.columns)


def count_by_severity(findings: DataFrame) -> DataFrame:
    return findings.groupBy("scan_id", "severity").agg(F.count(F.lit(1)).alias("findings"))


def count_by_tool(findings: DataFrame) -> DataFrame:
    return findings.groupBy("scan_id", "tool").agg(
        F.count(F.lit(1)).alias("findings"), F.min("seq").alias("first_seq")
    )


def unique_files(findings: DataFrame) -> DataFrame:
    """Exact number of distinct non-empty paths. Spark first groups by (scan, path), so a hot
    scan is spread over its paths before the final count."""
    path = F.nullif(F.col("file_path"), F.lit(""))
    return findings.groupBy("scan_id").agg(F.countDistinct(path).alias("unique_files"))


def scan_totals(findings: DataFrame) -> DataFrame:
    """Findings before and after dedup, from one aggregation by key instead of two passes."""
    by_key = with_key(findings).groupBy("scan_id", "key").agg(F.count(F.lit(1)).alias("_copies"))
    return by_key.groupBy("scan_id").agg(
        F.sum("_copies").alias("total_raw_findings"), F.count(F.lit(1)).alias("total_findings")
    )


def severity_counts(findings: DataFrame) -> DataFrame:
    """One row per scan with a count per level, 0 where there is none."""
    counts = [F.count_if(F.col("severity") == s).alias(s.lower()) for s in SEVERITIES_DESC]
    return findings.groupBy("scan_id").agg(*counts)


def scanners_run(findings: DataFrame) -> DataFrame:
    """(scan_id, scanners_run, by_tool): tools with findings in first-seen order.

    The collected list has one entry per tool, so its length is bounded by the tool registry.
    """
    entry = F.struct("first_seq", "tool", "findings")
    per_scan = count_by_tool(findings).groupBy("scan_id").agg(F.array_sort(F.collect_list(entry)).alias("_tools"))
    return per_scan.select(
        "scan_id",
        F.transform("_tools", lambda t: t.tool).alias("scanners_run"),
        F.transform("_tools", lambda t: F.struct(t.tool.alias("tool"), t.findings.alias("findings"))).alias("by_tool"),
    )


def tools_ranked(findings: DataFrame) -> DataFrame:
    """Tools of a scan by number of findings, ties in first-seen order."""
    by_rank = Window.partitionBy("scan_id").orderBy(F.desc("findings"), F.asc("first_seq"))
    ranked = count_by_tool(findings).withColumn("place", F.row_number().over(by_rank))
    return ranked.select("scan_id", "place", "tool", "findings")


def gate_rank(fail_on: Column) -> Column:
    """Rank that fails a scan; NULL means never. Missing or unknown words mean HIGH."""
    rank = F.when(fail_on == "NONE", F.lit(None).cast("int"))
    for level in SEVERITIES:
        rank = rank.when(fail_on == level, SEVERITIES.index(level))
    return rank.otherwise(SEVERITIES.index("HIGH"))


def gate(findings: DataFrame, gates: DataFrame) -> DataFrame:
    """(scan_id, fail_on, failed) for every scan in ``gates``, with or without findings.

    The worst rank per scan is aggregated first, so the join sees one row per scan.
    """
    worst = findings.groupBy("scan_id").agg(F.max(severity_rank(F.col("severity"))).alias("_worst"))
    failed = F.coalesce(F.col("_worst") >= gate_rank(F.col("fail_on")), F.lit(False))
    return gates.join(worst, "scan_id", "left").select("scan_id", "fail_on", failed.alias("failed"))


def scan_status(gated: DataFrame, errors: DataFrame) -> DataFrame:
    """Exit code and status word: 1 on error, 2 on a failed gate, else 0."""
    joined = gated.join(errors.select("scan_id", "errored"), "scan_id", "left")
    errored = F.coalesce("errored", F.lit(False))
    code = F.when(errored, 1).when(F.col("failed"), 2).otherwise(0)
    word = F.when(errored, "error").when(F.col("failed"), "failed").otherwise("passed")
    return joined.select("scan_id", "failed", code.alias("exit_code"), word.alias("status"))


def summarize(findings: DataFrame, scans: DataFrame, deduplicate_findings: bool = True) -> DataFrame:
    """One row per scan with all the figures of a report; scans without findings included."""
    return summary_of(deduplicate(findings, deduplicate_findings), findings, scans, deduplicate_findings)


def summary_of(reported: DataFrame, findings: DataFrame, scans: DataFrame, deduplicated: bool | DataFrame) -> DataFrame:
    """The same when the reported findings are at hand. Counts by level, counts by tool and the
    order of the tools come from one aggregation by (scan, tool). ``deduplicated`` may be a table
    (scan_id, ``_deduplicate``)."""
    levels = [s.lower() for s in SEVERITIES_DESC]
    per_tool = reported.groupBy("scan_id", "tool").agg(
        F.count(F.lit(1)).alias("_n"),
        F.min("seq").alias("_first"),
        *[F.count_if(F.col("severity") == s).alias(s.lower()) for s in SEVERITIES_DESC],
    )
    # One entry per tool: the list is as long as the tool registry at most.
    entry = F.struct("_first", "tool", F.col("_n").alias("findings"))
    per_scan = per_tool.groupBy("scan_id").agg(
        *[F.sum(level).alias(level) for level in levels],
        F.sum("_n").alias("total_findings"),
        F.array_sort(F.collect_list(entry)).alias("_tools"),
    )
    raw = findings.groupBy("scan_id").agg(F.count(F.lit(1)).alias("total_raw_findings"))
    joined = (
        scans.join(per_scan, "scan_id", "left")
        .join(unique_files(reported), "scan_id", "left")
        .join(raw, "scan_id", "left")
        .withColumn("_tools", F.coalesce("_tools", F.array().cast(per_scan.schema["_tools"].dataType)))
    )
    figures = [*levels, "total_findings", "total_raw_findings", "unique_files"]
    whether = F.lit(deduplicated) if isinstance(deduplicated, bool) else F.coalesce("_deduplicate", F.lit(True))
    if not isinstance(deduplicated, bool):
        joined = joined.join(deduplicated.select("scan_id", "_deduplicate"), "scan_id", "left")
    return joined.select(
        *scans.columns,
        *[F.coalesce(F.col(c), F.lit(0)).cast("bigint").alias(c) for c in figures],
        F.transform("_tools", lambda t: t.tool).alias("scanners_run"),
        F.transform("_tools", lambda t: F.struct(t.tool.alias("tool"), t.findings.alias("findings"))).alias("by_tool"),
        whether.alias("deduplication_enabled"),
    )


def top_findings(findings: DataFrame, n: int = 10) -> DataFrame:
    """The n worst findings of each scan in report order, numbered: the report's top list."""
    rank = severity_rank(F.col("severity"))
    return top_by(findings, ["scan_id"], [rank.desc(), F.asc("seq")], n, "place")


def by_file(findings: DataFrame) -> DataFrame:
    """Findings and worst level per file."""
    named = findings.where("file_path <> ''")
    worst = F.max(severity_rank(F.col("severity")))
    out = named.groupBy("scan_id", "file_path").agg(F.count(F.lit(1)).alias("findings"), worst.alias("worst_rank"))
    level = F.element_at(F.array(*map(F.lit, SEVERITIES)), F.col("worst_rank") + 1)
    return out.withColumn("worst_severity", level)


