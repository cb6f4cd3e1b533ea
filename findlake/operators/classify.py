"""File classification: framework flags, counts, scan targets and the plan of tools per scan.

Each per-scan result is one aggregation over ``files`` with map-side combine; contents never
leave the map side, only booleans and counters are shuffled.
"""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from findlake.functions import basename, dirname, path_excluded
from findlake.model import TOOLS, Tool
from findlake.operators.normalize import well_formed
from findlake.operators.ordering import hot_join
from findlake.operators.path_index import excluded_paths


# --- fixed values: how files are recognised --------------------------------------------------
DOCKERFILE_NAMES = ["Dockerfile", "dockerfile", "Containerfile"]
LOOSE_TEMPLATE_SUFFIXES = [".yaml", ".yml", ".json", ".template"]
LOOSE_TEMPLATE_CHARS = 1000  # the markers count only within this head of the file
STRICT_TEMPLATE_SUFFIXES = [".template", ".yaml", ".yml", ".json"]
STRICT_TEMPLATE_CHARS = 2000
NOT_TEMPLATE_PATHS = [
    "package.json",
    "package-lock.json",
    "tsconfig.json",
    "manifest.json",
    ".eslintrc.json",
    "jest.config.json",
    "node_modules",
    ".git",
    "test",
    "spec",
]
# ---------------------------------------------------------------------------------------------


def _ends(path: Column, *suffixes: str) -> Column:
    hit = F.lit(False)
    for suffix in suffixes:
        hit = hit | path.endswith(suffix)
    return hit


def _has(text: Column, part: str) -> Column:
    return F.contains(text, F.lit(part))


def is_loose_template() -> Column:
    head = F.substring(F.col("content"), 1, LOOSE_TEMPLATE_CHARS)
    marked = _has(head, "AWSTemplateFormatVersion") | _has(head, "AWS::")
    return F.coalesce(_ends(F.lower("path"), *LOOSE_TEMPLATE_SUFFIXES) & F.col("read_ok") & marked, F.lit(False))


def is_strict_template() -> Column:
    """Template by path (substring exclusions and all), case-sensitive suffix and markers."""
    named = ~F.lower("path").rlike("|".join(re.escape(part) for part in NOT_TEMPLATE_PATHS))
    suffix = F.col("path").rlike(r"[^/]\.(template|yaml|yml|json)$")
    head = F.substring(F.col("content"), 1, STRICT_TEMPLATE_CHARS)
    resources = _has(head, '"Resources"') | _has(head, "Resources:")
    other = (_has(head, '"dependencies"') & _has(head, '"name"')) | _has(head, '"compilerOptions"')
    marked = ~other & (_has(head, "AWSTemplateFormatVersion") | (_has(head, "AWS::") & resources))
    return F.coalesce(named & suffix & F.col("read_ok") & marked, F.lit(False))


def is_dockerfile() -> Column:
    name = basename(F.col("path"))
    return name.isin(DOCKERFILE_NAMES) | name.startswith("Dockerfile.")


def has_cdk_dependency() -> Column:
    """A root package.json naming an aws-cdk package; unreadable JSON does not."""
    deps = F.from_json(
        F.when(F.col("path") == "package.json", F.col("content")),
        "dependencies map<string,string>, devDependencies map<string,string>",
        {"allowSingleQuotes": "false"},
    )
    empty = F.array().cast("array<string>")
    names = F.array_union(
        F.coalesce(F.map_keys(deps.dependencies), empty), F.coalesce(F.map_keys(deps.devDependencies), empty)
    )
    return F.coalesce(
        (F.col("path") == "package.json") & well_formed(F.col("content")) & F.exists(names, lambda n: _has(n, "aws-cdk")),
        F.lit(False),
    )


def framework_flags() -> dict[str, Column]:
    return {
        "terraform": _ends(F.col("path"), ".tf"),
        "cloudformation": is_loose_template(),
        "cdk": (F.col("path") == "cdk.json") | has_cdk_dependency(),
        "npm": F.col("path") == "package.json",
        "python": _ends(F.col("path"), ".py"),
        "typescript": _ends(F.col("path"), ".ts", ".tsx") | (F.col("path") == "tsconfig.json"),
        "javascript": _ends(F.col("path"), ".js", ".jsx"),
        "container": is_dockerfile(),
    }


def repo_flags(files: DataFrame) -> DataFrame:
    """All eight framework flags of each scan, in one pass."""
    return files.groupBy("scan_id").agg(*[F.bool_or(c).alias(n) for n, c in framework_flags().items()])


# The order in which detected scanners are listed; secrets always run, last.
SCANNER_ORDER = ["terraform", "cloudformation", "cdk", "npm", "python", "container"]


def applicable_scanners(flags: DataFrame) -> DataFrame:
    """(scan_id, scanners): ordered array of scanner types."""
    listed = F.array_compact(F.array(*[F.when(F.col(n), F.lit(n)) for n in SCANNER_ORDER], F.lit("secrets")))
    return flags.select("scan_id", listed.alias("scanners"))


def file_counts(files: DataFrame) -> DataFrame:
    kinds = {
        "terraform": _ends(F.col("path"), ".tf"),
        "python": _ends(F.col("path"), ".py"),
        "javascript": _ends(F.col("path"), ".js"),
        "typescript": _ends(F.col("path"), ".ts"),
        "yaml": _ends(F.col("path"), ".yaml", ".yml"),
        "json": _ends(F.col("path"), ".json"),
    }
    return files.groupBy("scan_id").agg(*[F.count_if(c).alias(n) for n, c in kinds.items()])


def cfn_templates(files: DataFrame) -> DataFrame:
    """Strict templates with their place in the search order (by suffix)."""
    order = F
    for rank, suffix in enumerate(STRICT_TEMPLATE_SUFFIXES):
        order = order.when(F.col("path").endswith(suffix), rank)
    return files.where(is_strict_template()).select("scan_id", "path", order.alias("ext_rank"))


def dockerfiles(files: DataFrame, patterns: Sequence[str]) -> DataFrame:
    """Dockerfiles whose directory is not excluded."""
    return files.where(is_dockerfile() & ~path_excluded(dirname(F.col("path")), patterns)).select("scan_id", "path")


def audit_targets(files: DataFrame, patterns: Sequence[str]) -> DataFrame:
    named = basename(F.col("path")) == "package.json"
    return files.where(named & ~path_excluded(F.col("path"), patterns)).select("scan_id", "path")


def dependency_manifests(files: DataFrame) -> DataFrame:
    return files.where(F.col("path").rlike(r"^requirements[^/]*\.txt$")).select("scan_id", "path")


def pylint_targets(files: DataFrame, patterns: Sequence[str]) -> DataFrame:
    return files.where(_ends(F.col("path"), ".py") & ~path_excluded(F.col("path"), patterns)).select("scan_id", "path")


def npm_applicable(files: DataFrame) -> DataFrame:
    any_target = (basename(F.col("path")) == "package.json") | _ends(F.col("path"), ".tf", ".yaml", ".yml", ".json", ".template")
    return files.groupBy("scan_id").agg(F.bool_or(any_target).alias("npm_applicable"))


# The scanners with a switch of their own, ``tools.<scanner>.enabled``.
SWITCHED_SCANNERS = ("npm", "container")


def tool_enabled(config: Mapping, tool: Tool) -> bool:
    """Whether the configuration lets a tool run: its scanner's switch and its own flag."""
    section = (config.get("tools") or {}).get(tool.scanner) or {}
    switch = section.get("enabled", True) if tool.scanner in SWITCHED_SCANNERS else True
    return bool(switch) and bool(section.get(tool.flag, True))


_MANIFEST = r"^requirements[^/]*\.txt$"


def _plan_facts(files: DataFrame) -> DataFrame:
    """What a file means for the plan: scan_id, path and flags, without the text."""
    detected = framework_flags()
    audit = basename(F.col("path")) == "package.json"
    return files.select(
        "scan_id",
        "path",
        detected["terraform"].alias("terraform"),
        detected["cloudformation"].alias("cfn_loose"),
        is_strict_template().alias("cfn_strict"),
        detected["python"].alias("python"),
        F.col("path").rlike(_MANIFEST).alias("manifest"),
        _ends(F.col("path"), ".py").alias("pylint_target"),
        audit.alias("audit_target"),
        (audit | _ends(F.col("path"), ".tf", ".yaml", ".yml", ".json", ".template")).alias("npm_target"),
        F.col("path").endswith(".template").alias("template_file"),
        is_dockerfile().alias("image_target"),
    )


def _planned(facts: DataFrame, path_gone: Column, directory_gone: Column) -> DataFrame:
    """(scan_id, ``runs``): the tools that the files of a scan call for."""
    own = {"pylint_target": ~path_gone, "audit_target": ~path_gone, "image_target": ~directory_gone}
    names = [c for c in facts.columns if c not in ("scan_id", "path") and not c.startswith("_")]
    per_scan = facts.groupBy("scan_id").agg(*[F.bool_or(F.col(n) & own.get(n, F.lit(True))).alias(n) for n in names])
    needs = {
        "terraform": F.col("terraform"),
        "cloudformation": F.col("cfn_loose") & F.col("cfn_strict"),
        "python": F.col("python"),
        "npm": F.col("npm_target"),
        "container": F.col("image_target"),
        "secrets": F.lit(True),
    }
    extra = {
        "safety": F.col("manifest"),
        "pylint": F.col("pylint_target"),
        "npm-audit": F.col("audit_target"),
        "snyk-iac-template": F.col("template_file"),
    }
    runs = [
        F.when(needs[t.scanner] & extra.get(t.name, F.lit(True)), F.struct(F.lit(t.name).alias("tool"), F.lit(t.rank).alias("ord")))
        for t in TOOLS
    ]
    return per_scan.select("scan_id", F.inline(F.array_compact(F.array(*runs))))


def tool_plan(files: DataFrame, config: Mapping, patterns: Sequence[str]) -> DataFrame:
    """(scan_id, tool, ord): the tools that run on each scan, by detection and by flag."""
    path = F.col("path")
    planned = _planned(_plan_facts(files), path_excluded(path, patterns), path_excluded(dirname(path), patterns))
    return planned.where(F.col("tool").isin([t.name for t in TOOLS if tool_enabled(config, t)]))


def tool_plan_by_scan(files: DataFrame, off: DataFrame, patterns: DataFrame) -> DataFrame:
    """The same by every scan's own configuration: tools switched ``off`` (scan_id, ``_tool``) and
    excluded ``patterns`` (scan_id, pattern). The files' texts are not shuffled."""
    facts = _plan_facts(files).withColumn("_directory", dirname(F.col("path")))
    targets = facts.where("pylint_target OR audit_target OR image_target")
    paths = targets.select("scan_id", F.explode(F.array("path", "_directory")).alias("path"))
    gone = excluded_paths(paths, patterns, ["scan_id"])
    for column, mark in (("path", "_path_gone"), ("_directory", "_directory_gone")):
        marked = gone.select("scan_id", F.col("path").alias(column), F.lit(True).alias(mark))
        facts = hot_join(facts, marked, ["scan_id", column], "left", ["path"])
    planned = _planned(facts, F.coalesce("_path_gone", F.lit(False)), F.coalesce("_directory_gone", F.lit(False)))
    return planned.join(off.withColumnRenamed("_tool", "tool"), ["scan_id", "tool"], "left_anti").select("scan_id", "tool", "ord")
