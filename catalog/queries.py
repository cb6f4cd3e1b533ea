"""Every operator as a query on the driver's tables: name -> (spark, sf_dir) -> DataFrame."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from catalog import inputs
from catalog.shapes import CHECK_NAMES, SEVERITY_WORDS
from catalog.shapes import spark_pick as pick
from findlake import functions as fn
from findlake.model import TOOL_BY_NAME, TOOLS
from findlake.operators import aggregate, classify, errors, history, policy
from findlake.operators import path_index as path_exclusion_index
from findlake.operators.normalize import NORMALIZERS, parse_errors
from findlake.operators.ordering import frequent, hot_join
from findlake.operators.remediation import BANDIT_ADVICE
from findlake.operators.secrets import redact, secret_lines
from findlake.plans import report
from findlake.plans.scan_flow import normalize_all, normalize_tool, run_scans
from findlake.session import materialize, shared_dir
from findlake.sources import policies
from findlake.sources.config import POLICY_CONFIG, config_check, config_value, lookup
from findlake.sources.files import read_files
from findlake.sources.reports import lay_out_by_tool, report_line_counts
from findlake.streaming import arrivals

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
PATTERNS = lookup(POLICY_CONFIG, "repository.excluded_paths")


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


def rules_dim(spark: SparkSession) -> DataFrame:
    return policy.exclude_rules_dim(spark, POLICY_CONFIG)


# --- scalar functions ------------------------------------------------------------------------


@query
def severity_map(spark, sf):
    found = inputs.findings_from(inputs.table(spark, sf, "events"))
    severity = fn.severity_from_string(F.col("severity_word"))
    return found.select(
        "seq",
        "severity_word",
        severity.alias("severity"),
        fn.severity_rank(severity).alias("severity_rank"),
        fn.emoji(severity).alias("emoji"),
    )


def _checks(spark, sf, terraform):
    numbers = inputs.numbered_events(spark, sf)
    own, name = F.expr(pick(["high", "", None, "bogus", None], "e")), F.expr(pick(CHECK_NAMES, "k + e"))
    return numbers.select("e", fn.checkov_severity(own, name, terraform).alias("severity"))


@query
def checkov_severity(spark, sf):
    return _checks(spark, sf, terraform=True)


@query
def cfn_checkov_severity(spark, sf):
    return _checks(spark, sf, terraform=False)


@query
def tool_severity_maps(spark, sf):
    word = F.expr(pick([*SEVERITY_WORDS, "fatal", "Refactor", "convention"], "e + k"))
    return inputs.numbered_events(spark, sf).select(
        "e",
        fn.bandit_severity(word).alias("bandit"),
        fn.pylint_severity(word).alias("pylint"),
        fn.snyk_severity(word).alias("snyk"),
    )


@query
def sarif_fields(spark, sf):
    title, description = F.col("title"), F.col("description")
    return inputs.findings(spark, sf).select(
        "seq",
        fn.sarif_level(F.col("severity")).alias("level"),
        fn.sarif_score(F.col("severity")).alias("score"),
        F.array_join(fn.sarif_tags(F.col("tool"), F.col("severity")), ",").alias("tags"),
        fn.sarif_path(F.col("file_path")).alias("uri"),
        fn.sarif_rule_name(title).alias("rule_name"),
        F.substring(description, 1, 512).alias("short_text"),
        fn.sarif_message(title, description, F.col("resource")).alias("message"),
    )


@query
def path_relative(spark, sf):
    path = F.col("file_path")
    return inputs.findings(spark, sf).select("seq", fn.strip_scan_root(path, "/repo").alias("relative"))


@query
def path_normal_form(spark, sf):
    path = F.concat(F.expr(pick(["", "/", "//", "///", "./", ".", "a\\b/"], "page_id")), F.col("url"))
    return inputs.table(spark, sf, "pages").select("page_id", fn.normal_path(path).alias("normal"))


@query
def image_tag(spark, sf):
    docker = F.expr(pick(["Dockerfile", "./Dockerfile", "My App/Sub_Dir/Dockerfile", "-x-/Dockerfile.é"], "e"))
    path = F.concat(F.coalesce("file_path", F.lit("")), F.lit("/"), docker)
    joined = inputs.findings(spark, sf).withColumn("e", F.col("seq"))
    directory = fn.dirname(F.when(F.col("e") % 3 == 0, docker).otherwise(path))
    return joined.select("seq", fn.image_tag(directory).alias("image"))


@query
def repo_name(spark, sf):
    given = F.expr(pick(["given", "", None, None], "page_id"))
    url = F.expr("concat(case when page_id % 9 = 0 then '' else url end, case page_id % 3 when 0 then '.git' when 1 then '.git//' else ' ' end)")
    return inputs.table(spark, sf, "pages").select(
        "page_id", fn.repo_name(given, F.when(F.col("page_id") % 8 != 3, url), F.lit("/repo")).alias("name")
    )


@query
def location_text(spark, sf):
    path, line = F.col("file_path"), F.col("line_number")
    return inputs.findings(spark, sf).select(
        "seq", fn.location(path, line).alias("report"), fn.location(path, line, zero_line=True).alias("log")
    )


@query
def html_escape(spark, sf):
    escaped = fn.html_escape(F.col("html"))
    return inputs.table(spark, sf, "pages").select(
        "page_id", F.md5(escaped).alias("digest"), F.length(escaped).cast("bigint").alias("chars")
    )


@query
def text_limits(spark, sf):
    text = F.col("text")
    return inputs.table(spark, sf, "documents").select(
        "doc_id",
        F.md5(F.substring(text, 1, 4096)).alias("long_text"),
        fn.ellipsis(text, 200).alias("log_text"),
        fn.sarif_rule_name(text).alias("name"),
        F.coalesce(fn.truthy(F.expr(pick(["", "a", None], "doc_id"))), F.lit("b")).alias("a_or_b"),
    )


@query
def finding_key(spark, sf):
    return aggregate.with_key(inputs.findings(spark, sf)).select("seq", "key")


# --- filters and joins -----------------------------------------------------------------------


@query
def rule_exclusion(spark, sf):
    return policy.drop_excluded_rules(inputs.findings(spark, sf), rules_dim(spark)).select("scan_id", "seq", "tool", "rule_id")


@query
def excluded_counts(spark, sf):
    return policy.excluded_counts(inputs.findings(spark, sf), rules_dim(spark))


@query
def path_exclusion(spark, sf):
    return policy.drop_excluded_paths(inputs.findings(spark, sf), PATTERNS).select("scan_id", "seq", "file_path")


@query
def pylint_exclusion(spark, sf):
    symbol = F.expr(pick(["line-too-long", "R0914", "C0301", "unused"], "seq div 3"))
    found = inputs.findings(spark, sf).withColumns(
        {"tool": F.lit("pylint"), "metadata": F.to_json(F.struct(symbol.alias("symbol")))}
    )
    return policy.drop_excluded_pylint(found, rules_dim(spark)).select("scan_id", "seq", "rule_id")


@query
def severity_floor(spark, sf):
    return policy.severity_floor(inputs.findings(spark, sf), "HIGH").select("scan_id", "seq", "severity")


@query
def container_filters(spark, sf):
    fixed = F.expr(pick(["1.2", "", None], "seq"))
    keep = policy.container_filter(F.col("severity_word"), fixed, "UNKNOWN,HIGH,CRITICAL", ignore_unfixed=True)
    found = inputs.findings_from(inputs.table(spark, sf, "events"))
    return found.where(keep).select("scan_id", "seq", "severity_word")


@query
def snyk_threshold(spark, sf):
    severity = fn.snyk_severity(F.col("severity_word"))
    found = inputs.findings_from(inputs.table(spark, sf, "events"))
    return found.where(policy.at_or_above(severity, "high")).select("scan_id", "seq", severity.alias("severity"))


def _on_templates(spark, sf):
    path = F.expr(pick(inputs.CFN_PATHS, "seq"))
    return inputs.findings(spark, sf).withColumn("file_path", path)


@query
def template_semi_join(spark, sf):
    templates = classify.cfn_templates(inputs.files(spark, sf))
    return policy.keep_template_files(_on_templates(spark, sf), templates).select("scan_id", "seq", "file_path")


@query
def template_rename(spark, sf):
    renames = policy.template_renames(inputs.files(spark, sf))
    return policy.restore_template_paths(_on_templates(spark, sf), renames).select("scan_id", "seq", "file_path")


@query
def bandit_remediation(spark, sf):
    ids = [*BANDIT_ADVICE, "B999", None]
    found = inputs.findings(spark, sf).withColumn("rule_id", F.expr(pick(ids, "seq")))
    return policy.bandit_remediation(found).select("seq", "rule_id", "remediation")


@query
def safety_auth_cut(spark, sf):
    return policy.cut_at_auth_failure(inputs.raw_reports(spark, sf, "safety")).select("scan_id", "seq", "target")


# --- aggregations, dedup, order --------------------------------------------------------------


@query
def dedup_keep_first(spark, sf):
    return aggregate.deduplicate(inputs.findings(spark, sf)).select("scan_id", "seq", "tool", "severity", "title")


@query
def dedup_by_severity(spark, sf):
    return aggregate.count_by_severity(aggregate.deduplicate(inputs.findings(spark, sf)))


@query
def count_by_severity(spark, sf):
    return aggregate.count_by_severity(inputs.findings(spark, sf))


@query
def count_by_tool(spark, sf):
    return aggregate.count_by_tool(inputs.findings(spark, sf))


@query
def unique_files(spark, sf):
    return aggregate.unique_files(inputs.findings(spark, sf))


@query
def scan_totals(spark, sf):
    return aggregate.scan_totals(inputs.findings(spark, sf))


@query
def scanners_run(spark, sf):
    ran = aggregate.scanners_run(aggregate.deduplicate(inputs.findings(spark, sf)))
    counts = F.transform("by_tool", lambda t: F.concat(t.tool, F.lit("="), t.findings.cast("string")))
    return ran.select(
        "scan_id", F.array_join("scanners_run", ",").alias("scanners_run"), F.array_join(counts, ",").alias("by_tool")
    )


@query
def gate(spark, sf):
    return aggregate.gate(inputs.findings(spark, sf), inputs.scans(spark, sf))


@query
def scan_status(spark, sf):
    scans = inputs.scans(spark, sf)
    return aggregate.scan_status(aggregate.gate(inputs.findings(spark, sf), scans), scans)


@query
def severity_pivot(spark, sf):
    return aggregate.severity_counts(inputs.findings(spark, sf))


@query
def scan_summary(spark, sf):
    summary = aggregate.summarize(inputs.findings(spark, sf), inputs.scans(spark, sf).drop("fail_on", "errored"))
    return summary.drop("by_tool").withColumn("scanners_run", F.array_join("scanners_run", ","))


@query
def section_numbering(spark, sf):
    kept = aggregate.deduplicate(inputs.findings(spark, sf))
    return report.section_numbering(kept).select("scan_id", "severity", "seq", F.col("n").cast("bigint").alias("n"))


@query
def section_sizes(spark, sf):
    return report.section_sizes(aggregate.deduplicate(inputs.findings(spark, sf)))


@query
def sarif_rules(spark, sf):
    return report.sarif_rules(inputs.findings(spark, sf)).select("scan_id", "tool", "rule_id", "seq", "title", "severity")


@query
def sarif_runs(spark, sf):
    runs = aggregate.count_by_tool(aggregate.deduplicate(inputs.findings(spark, sf)))
    return runs.withColumnRenamed("findings", "results")


@query
def top10(spark, sf):
    return aggregate.top_findings(inputs.findings(spark, sf)).select("scan_id", "place", "seq", "severity", "title")


@query
def tools_ranked(spark, sf):
    return aggregate.tools_ranked(inputs.findings(spark, sf))


@query
def severity_listing(spark, sf):
    return report.severity_listing(inputs.findings(spark, sf)).select("scan_id", "place", "seq", "severity", "header")


# --- files -----------------------------------------------------------------------------------


@query
def repo_flags(spark, sf):
    return classify.repo_flags(inputs.files(spark, sf))


@query
def scanner_list(spark, sf):
    listed = classify.applicable_scanners(classify.repo_flags(inputs.files(spark, sf)))
    return listed.select("scan_id", F.array_join("scanners", ",").alias("scanners"))


@query
def file_counts(spark, sf):
    return classify.file_counts(inputs.files(spark, sf))


@query
def cfn_templates(spark, sf):
    return classify.cfn_templates(inputs.files(spark, sf))


@query
def dockerfiles(spark, sf):
    return classify.dockerfiles(inputs.files(spark, sf), PATTERNS)


@query
def audit_targets(spark, sf):
    return classify.audit_targets(inputs.files(spark, sf), PATTERNS)


@query
def manifests(spark, sf):
    return classify.dependency_manifests(inputs.files(spark, sf))


@query
def pylint_targets(spark, sf):
    return classify.pylint_targets(inputs.files(spark, sf), PATTERNS)


@query
def npm_applicable(spark, sf):
    return classify.npm_applicable(inputs.files(spark, sf))


PLAN_CONFIG = {"tools": {"terraform": {"tfsec": False}, "python": {"pylint": True}, "container": {"build_images": False}}}


@query
def tool_plan(spark, sf):
    return classify.tool_plan(inputs.files(spark, sf), PLAN_CONFIG, PATTERNS)


# --- normalisers -----------------------------------------------------------------------------

# Where in ``metadata`` each tool keeps a value that only the raw result or the event knows.
META_PATHS = {
    "bandit": "$.confidence",
    "safety": "$.affected_versions",
    "pylint": "$.symbol",
    "snyk-iac": "$.publicId",
    "snyk-iac-template": "$.publicId",
    "trivy-container": "$.image",
}


def norm_query(name: str) -> Query:
    tool = TOOL_BY_NAME[name]

    def run(spark, sf):
        raw = inputs.raw_reports(spark, sf, name)
        files = inputs.files(spark, sf) if name in ("checkov-cfn", "snyk-iac-template") else None
        found = normalize_tool(raw, files, tool, POLICY_CONFIG, rules_dim(spark))
        meta = F.get_json_object("metadata", META_PATHS.get(name, "$.extra"))
        return found.withColumn("meta", meta).drop("metadata")

    return run


for _tool in TOOLS:
    if _tool.name in NORMALIZERS:
        _key = "norm_build_failure" if _tool.name == "container-build" else "norm_" + _tool.name.replace("-", "_")
        QUERIES[_key] = norm_query(_tool.name)


@query
def report_parse_errors(spark, sf):
    return parse_errors(inputs.raw_reports(spark, sf)).select("scan_id", "tool", "seq")


@query
def result_errors(spark, sf):
    """Results that are no objects, one row each."""
    found = errors.result_errors(inputs.raw_reports(spark, sf))
    return found.select("scan_id", "tool", "seq", "reason", "position", "text")


@query
def flow_switches(spark, sf):
    """Findings per scan and tool with the npm and container scanners switched off, of severity
    LOW and above."""
    tools = {**POLICY_CONFIG["tools"]}
    for scanner in ("npm", "container"):
        tools[scanner] = {**tools[scanner], "enabled": False}
    result = run_scans(
        inputs.raw_reports(spark, sf), inputs.files(spark, sf), inputs.scans(spark, sf), {**POLICY_CONFIG, "tools": tools}, report_minimum="LOW"
    )
    return result.findings.groupBy("scan_id", "tool").agg(F.count("*").alias("findings"))


@query
def union_findings(spark, sf):
    """All tools and the secrets scan together, with their policies."""
    raw = lay_out_by_tool(inputs.raw_reports(spark, sf))
    found = normalize_all(raw, inputs.files(spark, sf), POLICY_CONFIG)
    return found.select("scan_id", "tool", "severity", "rule_id", "title", "file_path", "line_number", "resource")


@query
def scan_flow(spark, sf):
    """The whole flow: raw reports and files to the gate of each scan."""
    raw = lay_out_by_tool(inputs.raw_reports(spark, sf))
    result = run_scans(raw, inputs.files(spark, sf), inputs.scans(spark, sf), POLICY_CONFIG)
    figures = result.summary.select("scan_id", "total_findings", "total_raw_findings", "critical", "high", "unique_files")
    return result.status.join(figures, "scan_id")


# --- configuration ---------------------------------------------------------------------------


def configs(spark, sf):
    """One JSON configuration per scan, with keys missing or null here and there."""
    text = F.expr(
        "concat('{', if(c_custkey % 5 = 0, '', '\"tools\":{\"terraform\":{\"enabled\":'), "
        "if(c_custkey % 5 = 0, '', if(c_custkey % 2 = 0, 'true', 'null')), if(c_custkey % 5 = 0, '', ',\"name\":\"n'), "
        "if(c_custkey % 5 = 0, '', concat(c_mktsegment, '\"}},')), "
        "case c_custkey % 3 when 0 then '' when 1 then '\"severity\":null,' else '\"severity\":{\"fail_on\":\"LOW\"},' end, "
        "if(c_custkey % 7 = 0, '\"x\":1', '\"output\":{}'), '}')"
    )
    return inputs.table(spark, sf, "customer").select(
        F.concat(F.lit("scan-"), F.col("c_custkey").cast("string")).alias("scan_id"), text.alias("config")
    )


@query
def config_lookup(spark, sf):
    config = F.col("config")
    return configs(spark, sf).select(
        "scan_id",
        config_value(config, "severity.fail_on", "HIGH").alias("fail_on"),
        config_value(config, "tools.terraform.enabled", "default").alias("terraform_enabled"),
        config_value(config, "tools.terraform.name").alias("name"),
    )


@query
def config_check_keys(spark, sf):
    return config_check(configs(spark, sf))


def _parsed_configs(spark, sf, scans):
    return policies.parsed_configs(scans, inputs.scan_configs(spark, sf), POLICY_CONFIG)


@query
def scan_policies(spark, sf):
    """Findings that are left when every scan has a configuration of its own: switches, rules, paths
    and threshold."""
    found = inputs.findings(spark, sf).withColumn("_tool", F.col("tool"))
    parsed = _parsed_configs(spark, sf, found)
    off, rules, settings = (materialize(t, "scan-policy") for t in (policies.switched_off(parsed), policies.excluded_rules(parsed), policies.settings(parsed)))
    kept = policy.apply_by_scan(found, off, rules)
    snyk = F.col("_tool") == "snyk-iac"
    above = policy.at_or_above_by_scan(kept.where(snyk), settings)
    kept = materialize(kept.where(~snyk).unionByName(above), "scan-policy-findings")
    return policy.drop_paths_by_scan(kept, policies.excluded_patterns(parsed)).select("scan_id", "seq", "tool", "rule_id", "file_path")


@query
def scan_policy_tables(spark, sf):
    """What the configurations say, one row for each rule, path and switch."""
    parsed = _parsed_configs(spark, sf, inputs.scans(spark, sf))
    rules = policies.excluded_rules(parsed).select("scan_id", F.lit("rule").alias("kind"), F.concat_ws(" ", "_tool", "rule_id").alias("value"))
    paths = policies.excluded_patterns(parsed).select("scan_id", F.lit("path").alias("kind"), F.col("pattern").alias("value"))
    off = policies.switched_off(parsed).select("scan_id", F.lit("off").alias("kind"), F.col("_tool").alias("value"))
    return rules.unionByName(paths).unionByName(off)


@query
def path_index(spark, sf):
    """Paths made of the documents' texts that contain a pattern made of them: a pattern a document."""
    docs = inputs.table(spark, sf, "documents")
    paths = docs.select(F.col("doc_id").alias("seq"), F.expr("concat('a/', translate(substring(text, 1, 90), ' .', '//'))").alias("path"))
    patterns = docs.select(F.expr("nullif(trim(translate(substring(text, 70 + doc_id % 40, 7 + doc_id % 12), ' .', '//')), '')").alias("pattern"))
    gone = path_exclusion_index.excluded_paths(paths, patterns, [])
    return hot_join(paths, gone, ["path"], "left_semi", hot=frequent(paths, ["path"])).select("seq", "path")


# --- reports ---------------------------------------------------------------------------------


def reported(spark, sf):
    """Deduplicated findings, written once for all the parts of a report, and the summary."""
    found = inputs.findings(spark, sf)
    scans = inputs.scans(spark, sf).drop("fail_on", "errored")
    kept = materialize(aggregate.deduplicate(found), "reported")
    return kept, aggregate.summary_of(kept, found, scans, True)


def status(spark, sf, kept):
    scans = inputs.scans(spark, sf)
    return report.report_status(aggregate.gate(kept, scans), scans)


@query
def report_json(spark, sf):
    return report.json_report(*reported(spark, sf))


@query
def sarif_doc(spark, sf):
    return report.sarif_report(*reported(spark, sf))


@query
def report_markdown(spark, sf):
    return report.markdown_report(*reported(spark, sf))


@query
def report_html(spark, sf):
    return report.html_report(*reported(spark, sf))


@query
def report_readback(spark, sf):
    """Counts read back from the lines of the JSON report."""
    return report_line_counts(report.json_report(*reported(spark, sf)))


@query
def ci_outputs(spark, sf):
    kept, summary = reported(spark, sf)
    return report.ci_outputs(summary, status(spark, sf, kept))


@query
def ci_summary(spark, sf):
    kept, summary = reported(spark, sf)
    return report.ci_summary(kept, summary, status(spark, sf, kept))


@query
def ci_log(spark, sf):
    return report.ci_log(*reported(spark, sf))


# --- secrets ---------------------------------------------------------------------------------


@query
def file_inventory(spark, sf):
    """The documents as files, a folder for every eight, listed and read again as bytes."""
    folder = shared_dir(spark, "checkouts")
    texts = inputs.table(spark, sf, "documents").select(F.expr("concat('s', doc_id div 8)").alias("scan"), "text")
    # A folder for every eight documents: tasks put their own in place, not the driver one by one.
    placed = texts.repartition("scan").write.option("mapreduce.fileoutputcommitter.algorithm.version", "2")
    placed.partitionBy("scan").text(folder)
    found = read_files(spark, folder, "*.txt")
    return found.groupBy("scan_id").agg(
        F.count_if("read_ok").alias("files"), F.sum(F.length("content")).alias("chars"), F.sum(F.octet_length("content")).alias("bytes")
    )


@query
def secrets_scan(spark, sf):
    hits = secret_lines(inputs.files(spark, sf))
    found = hits.select("scan_id", "path", "line_number", "rule_id", redact(F.col("match")).alias("match"))
    tool = F.lit("secrets").alias("tool")
    return policy.drop_excluded_rules(found.select(tool, "*"), rules_dim(spark)).drop("tool")


# --- history ---------------------------------------------------------------------------------


@query
def report_floor(spark, sf):
    kept = aggregate.deduplicate(inputs.findings(spark, sf))
    floor = lookup(POLICY_CONFIG, "severity.report_minimum")
    return policy.severity_floor(kept, floor).select("scan_id", "seq", "severity")


@query
def by_file(spark, sf):
    return aggregate.by_file(inputs.findings(spark, sf))


@query
def baseline_diff(spark, sf):
    return history.baseline_diff(inputs.findings(spark, sf), inputs.baseline(spark, sf))


@query
def run_changes(spark, sf):
    """Each user's events are a run of one of ten repositories. The runs are kept in two appends, and
    every run is compared with the one before it."""
    events = inputs.table(spark, sf, "events")
    users = events.groupBy("user_id").agg(F.min(F.col("ts").cast("timestamp")).alias("scan_ts"))
    scan, repository = F.expr("concat('scan-', user_id)"), F.expr("concat('repo-', user_id % 10)")
    runs = users.select(scan.alias("scan_id"), repository.alias("repository"), "scan_ts")
    name, folder = f"findlake_history_{uuid.uuid4().hex}", shared_dir(spark, "history")
    odd = F.expr("cast(substr(scan_id, 6) as bigint) % 2 = 1")
    for part in (odd, ~odd):  # together all of them
        history.append_runs(inputs.findings(spark, sf).where(part), runs.where(part), name, folder)
    return history.run_changes(spark, name)


@query
def suppression(spark, sf):
    accepted = aggregate.with_key(inputs.baseline(spark, sf).where("rule_id like 'R%'"))
    return history.suppress(inputs.findings(spark, sf), accepted).select("scan_id", "seq", "rule_id")


@query
def trend(spark, sf):
    """Scans of a repository over time: each user's events are a scan, ten repositories."""
    events = inputs.table(spark, sf, "events")
    counts = events.groupBy("user_id").agg(F.min(F.col("ts").cast("timestamp")).alias("scan_ts"), F.count("*").alias("findings"))
    per_scan = counts.select(
        F.expr("concat('repo-', user_id % 10)").alias("repository"),
        "scan_ts",
        F.expr("concat('scan-', user_id)").alias("scan_id"),
        "findings",
    )
    return history.trend(per_scan).withColumn("run", F.col("run").cast("bigint"))


@query
def by_layer(spark, sf):
    return history.by_layer(inputs.findings(spark, sf))


@query
def normalized_dedup(spark, sf):
    kept = aggregate.deduplicate(inputs.findings(spark, sf), normalize_paths=True)
    return kept.select("scan_id", "seq", "file_path")


# --- streams ---------------------------------------------------------------------------------


def event_stream(spark, sf):
    """The events in eight files, each over the whole period, taken three at a time: most rows of
    the later batches are older than what came before."""
    events = inputs.table(spark, sf, "events")
    folder = shared_dir(spark, "arriving-events")
    events.repartition(8, "event_id").write.parquet(folder)
    return arrivals.read_arrivals(spark, folder, events.schema, files_per_batch=3)


@query
def stream_normalize(spark, sf):
    raw = inputs.raw_report(inputs.events_numbers(event_stream(spark, sf)), "tflint")
    found = arrivals.normalize_stream(raw, lambda reports: NORMALIZERS["tflint"](reports, POLICY_CONFIG))
    return arrivals.run_to_table(found, shared_dir(spark, "stream_normalize")).drop("metadata")


@query
def stream_dedup_keys(spark, sf):
    found = inputs.findings_from(event_stream(spark, sf))
    return arrivals.run_to_table(arrivals.dedup_stream(found), shared_dir(spark, "stream_dedup"))


@query
def stream_windowed_counts(spark, sf):
    counts = arrivals.count_to_table(inputs.findings_from(event_stream(spark, sf)), shared_dir(spark, "stream_counts"))
    return counts.select(F.date_format("window_start", "yyyy-MM-dd").alias("day"), "severity", "findings")


@query
def stream_dedup_rows(spark, sf):
    """Whole findings that are left of all that arrived."""
    found = inputs.findings_from(event_stream(spark, sf)).drop("ts", "severity_word")
    kept = arrivals.dedup_to_table(found, shared_dir(spark, "stream_dedup_rows"))
    return kept.select("scan_id", "seq", "tool", "severity", "title")


@query
def stream_errors(spark, sf):
    """What could not be read of the reports that arrived."""
    raw = inputs.raw_report(inputs.events_numbers(event_stream(spark, sf)), "tflint")
    arrived = arrivals.ingest(raw, shared_dir(spark, "stream_errors"), POLICY_CONFIG)
    return arrived.errors.select("scan_id", "tool", "seq", "reason", "position")
