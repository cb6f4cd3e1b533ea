"""DuckDB SQL for the queries, written against the driver's tables without any JSON parsing."""

from __future__ import annotations

from catalog import inputs
from catalog.expected import (
    BANDIT_WORDS,
    CHECK_NAME_WORDS,
    EMOJI,
    EXCLUDED_PATHS,
    EXCLUDED_RULES,
    GENERIC_WORDS,
    NOT_TEMPLATE_PATHS,
    PYLINT_WORDS,
    SARIF_LEVELS,
    SARIF_SCORES,
    SECRET_PATTERNS,
    SEVERITIES,
    SEVERITIES_DESC,
    SNYK_WORDS,
)
from catalog.shapes import (
    CHECK_NAMES,
    LINES,
    PATHS,
    RESOURCES,
    RULES,
    SEVERITY_WORDS,
    TEXTS,
    literal,
)
from catalog.shapes import duck_pick as pick
from findlake.model import TOOL_BY_NAME, TOOLS
from findlake.operators.remediation import BANDIT_ADVICE, BANDIT_DEFAULT
from findlake.plans.report import SARIF_SCHEMA, STYLE, TITLE

ORACLES: dict[str, str] = {}


def lookup(word: str, table: dict[str, str], default: str) -> str:
    whens = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in table.items())
    return f"CASE {word} {whens} ELSE '{default}' END"


def severity(word: str) -> str:
    return lookup(f"lower({word})", GENERIC_WORDS, "INFO")


def rank(level: str) -> str:
    return f"CASE {level} " + " ".join(f"WHEN '{s}' THEN {i}" for i, s in enumerate(SEVERITIES)) + " ELSE 0 END"


def checkov(own: str, name: str, terraform: bool) -> str:
    whens = []
    for level, words in CHECK_NAME_WORDS.items():
        words = words + (["imdsv2"] if terraform and level == "HIGH" else [])
        hit = " OR ".join(f"contains(lower(coalesce({name}, '')), '{w}')" for w in words)
        whens.append(f"WHEN {hit} THEN '{level}'")
    return f"CASE WHEN coalesce({own}, '') <> '' THEN {severity(own)} {' '.join(whens)} ELSE 'MEDIUM' END"


def normal(path: str) -> str:
    lead = f"CASE WHEN regexp_matches({path}, '^//([^/]|$)') THEN '//' WHEN starts_with({path}, '/') THEN '/' ELSE '' END"
    body = f"array_to_string(list_filter(string_split({path}, '/'), lambda s: s <> '' AND s <> '.'), '/')"
    return f"replace(coalesce(nullif({lead} || {body}, ''), '.'), '\\', '/')"


def excluded(path: str) -> str:
    patterns = []
    for pattern in EXCLUDED_PATHS:
        patterns += [pattern] + ([pattern.replace("**/", "").replace("**", "")] if "**" in pattern else [])
    hits = " OR ".join(f"contains({normal(path)}, '{p}')" for p in patterns)
    return f"coalesce({hits}, FALSE)"


def excluded_rules() -> list[tuple[str, str]]:
    pairs = []
    for tool in TOOLS:
        rules = EXCLUDED_RULES.get(tool.scanner, {}).get(tool.exclude_key) or []
        pairs += [(tool.finding_tool, rule) for rule in rules]
    return sorted(set(pairs))


def rules_cte() -> str:
    rows = ", ".join(f"('{t}', '{r}')" for t, r in excluded_rules())
    return f"rules(tool, rule_id) AS (VALUES {rows})"


NUMBERS = "r AS (SELECT 'scan-' || user_id AS scan_id, event_id AS e, CAST(regexp_extract(props, '[0-9]+') AS BIGINT) AS k, ts FROM events)"

FINDINGS = f"""{NUMBERS}, f0 AS (
  SELECT scan_id, e AS seq, e, k, ts, {pick(inputs.FINDING_TOOLS, "e")} AS tool,
    {pick(SEVERITY_WORDS[:-1], "e * 3 + k")} AS severity_word, {pick(inputs.FINDING_RULES, "k")} AS rule_id,
    CASE WHEN e % 17 = 0 THEN NULL WHEN k % 50 = 49 THEN '' ELSE {pick(inputs.FINDING_DIRS, "k")} || 'f' || (k % 5) || '.tf' END AS file_path,
    CAST(CASE WHEN e % 7 = 0 THEN NULL WHEN e % 11 = 0 THEN 0 ELSE e % 5 + 1 END AS INTEGER) AS line_number,
    CASE k % 3 WHEN 0 THEN NULL WHEN 1 THEN '' ELSE 'aws_s3_bucket.b' || k END AS resource,
    CASE k % 4 WHEN 0 THEN NULL WHEN 1 THEN '' WHEN 2 THEN 'Fix <it> & see' ELSE repeat('advice ', 30) END AS remediation
  FROM r), f1 AS (
  SELECT *, {severity("severity_word")} AS severity,
    (CASE WHEN k % 10 = 3 THEN '3rd: ' ELSE 'Check ' END) || rule_id || ' <a&b> "q" it''s' AS title FROM f0), f AS (
  SELECT *, CASE k % 4 WHEN 0 THEN title WHEN 1 THEN '' WHEN 2 THEN 'FAILED' ELSE repeat('long é text ', 10 + k * 5) END AS description,
    md5(coalesce(file_path, 'None') || ':' || coalesce(CAST(line_number AS VARCHAR), 'None') || ':' || rule_id || ':' || title) AS key
  FROM f1)"""
DEDUP = f"{FINDINGS}, d AS (SELECT * FROM f QUALIFY row_number() OVER (PARTITION BY scan_id, key ORDER BY seq) = 1)"
FAIL_ON = ["CRITICAL", "HIGH", "MEDIUM", "LOW", "INFO", "NONE", "bogus", None]
SCANS = f"""scans AS (SELECT 'scan-' || c_custkey AS scan_id, c_name AS repository,
    CASE WHEN c_custkey % 3 = 0 THEN NULL ELSE c_mktsegment END AS branch,
    '2026-01-' || lpad(CAST(c_custkey % 28 + 1 AS VARCHAR), 2, '0') || 'T00:00:00' AS scan_timestamp,
    {pick(FAIL_ON, "c_custkey")} AS fail_on, c_custkey % 50 = 7 AS errored FROM customer)"""


def duck(sql: str) -> str:
    return sql.replace(" div ", " // ")


FILES = f"""files AS (SELECT 'scan-' || (d // 8) AS scan_id, {duck(inputs.cases("(d * 7 + d div 8)", inputs.FILE_PATHS))} AS path,
    CASE WHEN d % 41 <> 0 THEN {duck(inputs.cases("(d div 3)", inputs.FILE_HEADS))} END AS content, d % 41 <> 0 AS read_ok
  FROM (SELECT doc_id AS d, text FROM documents)
  UNION ALL SELECT 'scan-' || (doc_id // 8), 'docs/d' || doc_id || '.txt', text, true
  FROM documents WHERE doc_id % 41 = 0 OR (doc_id // 3) % 9 = 6)"""
BASENAME = "string_split(path, '/')[-1]"
DIRNAME = "regexp_replace(path, '/?[^/]*$', '')"
HEAD = "substring(content, 1, 2000)"
STRICT = (
    "(NOT (" + " OR ".join(f"contains(lower(path), '{p}')" for p in NOT_TEMPLATE_PATHS) + ")"
    " AND regexp_matches(path, '[^/]\\.(template|yaml|yml|json)$') AND read_ok"
    f" AND NOT ((contains({HEAD}, '\"dependencies\"') AND contains({HEAD}, '\"name\"')) OR contains({HEAD}, '\"compilerOptions\"'))"
    f" AND (contains({HEAD}, 'AWSTemplateFormatVersion') OR (contains({HEAD}, 'AWS::')"
    f" AND (contains({HEAD}, '\"Resources\"') OR contains({HEAD}, 'Resources:')))))"
)
DOCKERFILE = f"({BASENAME} IN ('Dockerfile', 'dockerfile', 'Containerfile') OR starts_with({BASENAME}, 'Dockerfile.'))"


def add(name: str, ctes: str, select: str) -> None:
    ORACLES[name] = f"WITH {ctes} {select}"


# --- scalar functions ------------------------------------------------------------------------

add(
    "severity_map",
    FINDINGS,
    f"SELECT seq, severity_word, severity, {rank('severity')} AS severity_rank, {lookup('severity', EMOJI, ':white_circle:')} AS emoji FROM f",
)
for _name, _terraform in (("checkov_severity", True), ("cfn_checkov_severity", False)):
    _sql = checkov(pick(["high", "", None, "bogus", None], "e"), pick(CHECK_NAMES, "k + e"), _terraform)
    add(_name, NUMBERS, f"SELECT e, {_sql} AS severity FROM r")
_word = "lower(" + pick([*SEVERITY_WORDS, "fatal", "Refactor", "convention"], "e + k") + ")"
add(
    "tool_severity_maps",
    NUMBERS,
    f"SELECT e, {lookup(_word, BANDIT_WORDS, 'MEDIUM')} AS bandit, {lookup(_word, PYLINT_WORDS, 'INFO')} AS pylint, "
    f"{lookup(_word, SNYK_WORDS, 'MEDIUM')} AS snyk FROM r",
)


def sarif_uri(path: str) -> str:
    for prefix in ("/repo/", "/github/workspace/", "./"):
        path = f"regexp_replace({path}, '^{prefix.replace('.', '[.]')}', '')"
    return f"ltrim({path}, '/')"


RULE_NAME = (
    "substring(CASE WHEN title = '' THEN 'unknown' WHEN regexp_matches(title, '^\\p{Nd}') THEN '_' ELSE '' END "
    "|| regexp_replace(title, '[^\\p{L}\\p{N}_]', '_', 'g'), 1, 128)"
)
TAGS = """'security' || CASE WHEN contains(tool, 'terraform') THEN ',terraform,infrastructure-as-code'
    WHEN contains(tool, 'cfn') THEN ',cloudformation,infrastructure-as-code' WHEN contains(tool, 'secret') THEN ',secrets,credentials'
    WHEN contains(tool, 'bandit') THEN ',python' WHEN contains(tool, 'npm') OR contains(tool, 'snyk') THEN ',dependencies,supply-chain'
    ELSE '' END || ',severity-' || lower(severity)"""
MESSAGE = """substring(title || CASE WHEN description <> '' AND description <> title THEN ' | ' || description ELSE '' END
    || CASE WHEN coalesce(resource, '') <> '' THEN ' | Resource: ' || resource ELSE '' END, 1, 4096)"""
add(
    "sarif_fields",
    FINDINGS,
    f"SELECT seq, {lookup('severity', SARIF_LEVELS, 'note')} AS level, {lookup('severity', SARIF_SCORES, '1.0')} AS score, "
    f"{TAGS} AS tags, {sarif_uri('file_path')} AS uri, {RULE_NAME} AS rule_name, "
    f"substring(description, 1, 512) AS short_text, {MESSAGE} AS message FROM f",
)


def relative(path: str) -> str:
    return f"CASE WHEN starts_with({path}, '/repo') THEN ltrim(substring({path}, 6), '/') ELSE {path} END"


add("path_relative", FINDINGS, f"SELECT seq, {relative('file_path')} AS relative FROM f")
ORACLES["path_normal_form"] = (
    f"SELECT page_id, {normal('p')} AS normal FROM (SELECT page_id, "
    f"{pick(['', '/', '//', '///', './', '.', 'a' + chr(92) + 'b/'], 'page_id')} || url AS p FROM pages)"
)


def image(directory: str) -> str:
    safe = f"trim(regexp_replace(lower({directory}), '[^\\p{{L}}\\p{{N}}-]', '-', 'g'), '-')"
    return f"'scan-' || CASE WHEN {directory} IN ('', '.') THEN 'root' ELSE {safe} END || ':latest'"


_docker = pick(["Dockerfile", "./Dockerfile", "My App/Sub_Dir/Dockerfile", "-x-/Dockerfile.é"], "e")
add(
    "image_tag",
    f"{FINDINGS}, g AS (SELECT seq, CASE WHEN e % 3 = 0 THEN {_docker} ELSE coalesce(file_path, '') || '/' || {_docker} END AS path FROM f)",
    f"SELECT seq, {image(DIRNAME)} AS image FROM g",
)
ORACLES["repo_name"] = f"""SELECT page_id, coalesce(nullif({pick(["given", "", None, None], "page_id")}, ''), nullif(regexp_replace(
    string_split(rtrim(trim(u, ' '), '/'), '/')[-1], '\\.git$', ''), ''), '/repo') AS name
  FROM (SELECT page_id, CASE WHEN page_id % 8 <> 3 THEN (CASE WHEN page_id % 9 = 0 THEN '' ELSE url END)
    || (CASE page_id % 3 WHEN 0 THEN '.git' WHEN 1 THEN '.git//' ELSE ' ' END) END AS u FROM pages)"""


def location(path: str, line: str = "line_number", zero: bool = False) -> str:
    shown = f"{line} IS NOT NULL" if zero else f"coalesce({line}, 0) <> 0"
    return f"CASE WHEN {shown} THEN {path} || ':' || {line} ELSE {path} END"


add(
    "location_text",
    FINDINGS,
    f"SELECT seq, {location('file_path')} AS report, {location('file_path', zero=True)} AS log FROM f",
)


def escape(text: str) -> str:
    for char, entity in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;"), ("''", "&#x27;")):
        text = f"replace({text}, '{char}', '{entity}')"
    return text


ORACLES["html_escape"] = f"SELECT page_id, md5({escape('html')}) AS digest, length({escape('html')}) AS chars FROM pages"


def dots(text: str, limit: int) -> str:
    return f"CASE WHEN length({text}) > {limit} THEN substring({text}, 1, {limit}) || '...' ELSE {text} END"


ORACLES["text_limits"] = (
    f"SELECT doc_id, md5(substring(text, 1, 4096)) AS long_text, {dots('text', 200)} AS log_text, "
    f"{RULE_NAME.replace('title', 'text')} AS name, coalesce(nullif({pick(['', 'a', None], 'doc_id')}, ''), 'b') AS a_or_b FROM documents"
)
add("finding_key", FINDINGS, "SELECT seq, key FROM f")

# --- filters and joins -----------------------------------------------------------------------

add("rule_exclusion", f"{FINDINGS}, {rules_cte()}", "SELECT scan_id, seq, tool, rule_id FROM f ANTI JOIN rules USING (tool, rule_id)")
add(
    "excluded_counts",
    f"{FINDINGS}, {rules_cte()}",
    "SELECT tool, count(*) AS excluded_count FROM f SEMI JOIN rules USING (tool, rule_id) GROUP BY tool",
)
add("path_exclusion", FINDINGS, f"SELECT scan_id, seq, file_path FROM f WHERE NOT {excluded("nullif(file_path, '')")}")
PYLINT_RULES = ", ".join(f"'{r}'" for r in EXCLUDED_RULES["python"]["pylint"])
add(
    "pylint_exclusion",
    FINDINGS,
    f"SELECT scan_id, seq, rule_id FROM f WHERE rule_id NOT IN ({PYLINT_RULES}) "
    f"AND {pick(['line-too-long', 'R0914', 'C0301', 'unused'], 'seq // 3')} NOT IN ({PYLINT_RULES})",
)
add("severity_floor", FINDINGS, "SELECT scan_id, seq, severity FROM f WHERE severity IN ('HIGH', 'CRITICAL')")
add(
    "container_filters",
    FINDINGS,
    f"SELECT scan_id, seq, severity_word FROM f WHERE upper(severity_word) IN ('UNKNOWN', 'HIGH', 'CRITICAL') AND {pick(['1.2', '', None], 'seq')} <> ''",
)
_snyk = lookup("lower(severity_word)", SNYK_WORDS, "MEDIUM")
add(
    "snyk_threshold",
    FINDINGS,
    f"SELECT scan_id, seq, {_snyk} AS severity FROM f WHERE {_snyk} IN ('HIGH', 'CRITICAL')",
)
TEMPLATES = f"{FILES}, templates AS (SELECT DISTINCT scan_id, {BASENAME} AS name FROM files WHERE {STRICT})"
RENAMES = f"{FILES}, renames AS (SELECT scan_id, replace(path, '.template', '.yaml') AS renamed, max(path) AS original FROM files WHERE path LIKE '%.template' GROUP BY 1, 2)"
ON_TEMPLATES = f"g AS (SELECT scan_id, seq, {pick(inputs.CFN_PATHS, 'seq')} AS path FROM f)"
add(
    "template_semi_join",
    f"{FINDINGS}, {TEMPLATES}, {ON_TEMPLATES}",
    f"SELECT scan_id, seq, path AS file_path FROM g WHERE (scan_id, {BASENAME}) IN (SELECT (scan_id, name) FROM templates)",
)
add(
    "template_rename",
    f"{FINDINGS}, {RENAMES}, {ON_TEMPLATES}",
    "SELECT g.scan_id, seq, coalesce(original, path) AS file_path FROM g LEFT JOIN renames n ON n.scan_id = g.scan_id AND renamed = path",
)
_ids = [*BANDIT_ADVICE, "B999", None]
ADVICE = "advice(id, words) AS (VALUES " + ", ".join(f"({literal(i, 'duck')}, {literal(t, 'duck')})" for i, t in BANDIT_ADVICE.items()) + ")"
add(
    "bandit_remediation",
    f"{NUMBERS}, {ADVICE}, g AS (SELECT e AS seq, {pick(_ids, 'e')} AS rule_id FROM r)",
    f"SELECT seq, rule_id, coalesce(words, {literal(BANDIT_DEFAULT, 'duck')}) AS remediation FROM g LEFT JOIN advice ON id = rule_id",
)
SAFETY_CUT = "cuts AS (SELECT scan_id, min(e) FILTER (e % 5 <> 0 AND e % 97 IN (5, 6, 7)) AS cut FROM r GROUP BY scan_id)"
SAFETY_TARGET = "'/repo/requirements' || CASE WHEN e % 2 = 0 THEN '' ELSE '-dev' END || '.txt'"
add(
    "safety_auth_cut",
    f"{NUMBERS}, {SAFETY_CUT}",
    f"SELECT scan_id, e AS seq, {SAFETY_TARGET} AS target FROM r JOIN cuts USING (scan_id) WHERE cut IS NULL OR e < cut",
)

# --- aggregations, dedup, order --------------------------------------------------------------

add("dedup_keep_first", DEDUP, "SELECT scan_id, seq, tool, severity, title FROM d")
add("dedup_by_severity", DEDUP, "SELECT scan_id, severity, count(*) AS findings FROM d GROUP BY ALL")
add("count_by_severity", FINDINGS, "SELECT scan_id, severity, count(*) AS findings FROM f GROUP BY ALL")
add("count_by_tool", FINDINGS, "SELECT scan_id, tool, count(*) AS findings, min(seq) AS first_seq FROM f GROUP BY ALL")
add("unique_files", FINDINGS, "SELECT scan_id, count(DISTINCT nullif(file_path, '')) AS unique_files FROM f GROUP BY ALL")
add(
    "scan_totals",
    FINDINGS,
    "SELECT scan_id, count(*) AS total_raw_findings, count(DISTINCT key) AS total_findings FROM f GROUP BY ALL",
)
BY_TOOL = "t AS (SELECT scan_id, tool, count(*) AS n, min(seq) AS first_seq FROM d GROUP BY ALL)"
RAN = f"{BY_TOOL}, ran AS (SELECT scan_id, string_agg(tool, ',' ORDER BY first_seq) AS scanners_run, string_agg(tool || '=' || n, ',' ORDER BY first_seq) AS by_tool FROM t GROUP BY scan_id)"
add("scanners_run", f"{DEDUP}, {RAN}", "SELECT * FROM ran")
GATE_RANK = "CASE fail_on WHEN 'NONE' THEN 9 WHEN 'CRITICAL' THEN 4 WHEN 'HIGH' THEN 3 WHEN 'MEDIUM' THEN 2 WHEN 'LOW' THEN 1 WHEN 'INFO' THEN 0 ELSE 3 END"
GATE = f"{SCANS}, worst AS (SELECT scan_id, max({rank('severity')}) AS w FROM f GROUP BY scan_id), gate AS (SELECT scan_id, fail_on, errored, coalesce(w >= {GATE_RANK}, FALSE) AS failed FROM scans LEFT JOIN worst USING (scan_id))"
STATUS = f"{GATE}, status AS (SELECT *, CASE WHEN errored THEN 1 WHEN failed THEN 2 ELSE 0 END AS exit_code, CASE WHEN errored THEN 'error' WHEN failed THEN 'failed' ELSE 'passed' END AS status FROM gate)"
add("gate", f"{FINDINGS}, {GATE}", "SELECT scan_id, fail_on, failed FROM gate")
add("scan_status", f"{FINDINGS}, {STATUS}", "SELECT scan_id, failed, exit_code, status FROM status")
COUNTS = ", ".join(f"count(*) FILTER (severity = '{s}') AS {s.lower()}" for s in SEVERITIES_DESC)
add("severity_pivot", FINDINGS, f"SELECT scan_id, {COUNTS} FROM f GROUP BY scan_id")
LEVELS = ", ".join(f"coalesce({s.lower()}, 0) AS {s.lower()}" for s in SEVERITIES_DESC)
SUMMARY = f"""{SCANS}, {RAN}, c AS (SELECT scan_id, {COUNTS}, count(*) AS total_findings, count(DISTINCT nullif(file_path, '')) AS unique_files FROM d GROUP BY scan_id),
  raw AS (SELECT scan_id, count(*) AS total_raw_findings FROM f GROUP BY scan_id),
  s AS (SELECT scan_id, repository, branch, scan_timestamp, {LEVELS}, coalesce(total_findings, 0) AS total_findings,
    coalesce(total_raw_findings, 0) AS total_raw_findings, coalesce(unique_files, 0) AS unique_files,
    coalesce(scanners_run, '') AS scanners_run, coalesce(by_tool, '') AS by_tool, TRUE AS deduplication_enabled
  FROM scans LEFT JOIN c USING (scan_id) LEFT JOIN ran USING (scan_id) LEFT JOIN raw USING (scan_id))"""
add("scan_summary", f"{DEDUP}, {SUMMARY}", "SELECT * EXCLUDE (by_tool) FROM s")
SECTION_N = "row_number() OVER (PARTITION BY scan_id, severity ORDER BY seq)"
add("section_numbering", DEDUP, f"SELECT scan_id, severity, seq, {SECTION_N} AS n FROM d")
add("section_sizes", DEDUP, "SELECT scan_id, severity, count(*) AS size FROM d GROUP BY ALL")
add(
    "sarif_rules",
    FINDINGS,
    "SELECT scan_id, tool, rule_id, seq, title, severity FROM f QUALIFY row_number() OVER (PARTITION BY scan_id, tool, rule_id ORDER BY seq) = 1",
)
add("sarif_runs", DEDUP, "SELECT scan_id, tool, count(*) AS results, min(seq) AS first_seq FROM d GROUP BY ALL")
TOP = f"CAST(row_number() OVER (PARTITION BY scan_id ORDER BY {rank('severity')} DESC, seq) AS INTEGER)"
add("top10", FINDINGS, f"SELECT scan_id, {TOP} AS place, seq, severity, title FROM f QUALIFY place <= 10")
add(
    "tools_ranked",
    f"{FINDINGS}, t AS (SELECT scan_id, tool, count(*) AS findings, min(seq) AS s FROM f GROUP BY ALL)",
    "SELECT scan_id, CAST(row_number() OVER (PARTITION BY scan_id ORDER BY findings DESC, s) AS INTEGER) AS place, tool, findings FROM t",
)
PLACE = f"4 - {rank('severity')}"
HEADER = f"coalesce(lag(severity) OVER (PARTITION BY scan_id ORDER BY {rank('severity')} DESC, seq) <> severity, TRUE)"
add("severity_listing", FINDINGS, f"SELECT scan_id, {PLACE} AS place, seq, severity, {HEADER} AS header FROM f")

# --- files -----------------------------------------------------------------------------------

ENDS = "(" + " OR ".join(f"lower(path) LIKE '%{x}'" for x in (".yaml", ".yml", ".json", ".template")) + ")"
HEAD1000 = "substring(content, 1, 1000)"
LOOSE = f"({ENDS} AND read_ok AND (contains({HEAD1000}, 'AWSTemplateFormatVersion') OR contains({HEAD1000}, 'AWS::')))"
# A package.json counts as readable JSON only with the one head that writes no text after it.
CDK_CONTENT = "(path = 'package.json' AND content LIKE '{%}' AND NOT contains(content, '}} ') AND contains(content, 'aws-cdk'))"
FLAGS = f"""flags AS (SELECT scan_id, bool_or(path LIKE '%.tf') AS terraform, bool_or(coalesce({LOOSE}, FALSE)) AS cloudformation,
  bool_or(path = 'cdk.json' OR coalesce({CDK_CONTENT}, FALSE)) AS cdk, bool_or(path = 'package.json') AS npm,
  bool_or(path LIKE '%.py') AS python, bool_or(path LIKE '%.ts' OR path LIKE '%.tsx' OR path = 'tsconfig.json') AS typescript,
  bool_or(path LIKE '%.js' OR path LIKE '%.jsx') AS javascript, bool_or({DOCKERFILE}) AS container FROM files GROUP BY scan_id)"""
add("repo_flags", f"{FILES}, {FLAGS}", "SELECT * FROM flags")
add(
    "scanner_list",
    f"{FILES}, {FLAGS}",
    "SELECT scan_id, array_to_string(list_filter(["
    + ", ".join(f"CASE WHEN {n} THEN '{n}' END" for n in ("terraform", "cloudformation", "cdk", "npm", "python", "container"))
    + ", 'secrets'], lambda x: x IS NOT NULL), ',') AS scanners FROM flags",
)
add(
    "file_counts",
    FILES,
    "SELECT scan_id, count(*) FILTER (path LIKE '%.tf') AS terraform, count(*) FILTER (path LIKE '%.py') AS python, "
    "count(*) FILTER (path LIKE '%.js') AS javascript, count(*) FILTER (path LIKE '%.ts') AS typescript, "
    "count(*) FILTER (path LIKE '%.yaml' OR path LIKE '%.yml') AS yaml, count(*) FILTER (path LIKE '%.json') AS json FROM files GROUP BY scan_id",
)
add(
    "cfn_templates",
    FILES,
    f"SELECT scan_id, path, CASE WHEN path LIKE '%.template' THEN 0 WHEN path LIKE '%.yaml' THEN 1 WHEN path LIKE '%.yml' THEN 2 ELSE 3 END AS ext_rank FROM files WHERE {STRICT}",
)
add("dockerfiles", FILES, f"SELECT scan_id, path FROM files WHERE {DOCKERFILE} AND NOT {excluded(DIRNAME)}")
AUDIT = f"({BASENAME} = 'package.json' AND NOT {excluded('path')})"
MANIFEST = "regexp_matches(path, '^requirements[^/]*\\.txt$')"
PYLINT_TARGET = f"(path LIKE '%.py' AND NOT {excluded('path')})"
NPM_TARGET = f"({BASENAME} = 'package.json' OR path LIKE '%.tf' OR path LIKE '%.yaml' OR path LIKE '%.yml' OR path LIKE '%.json' OR path LIKE '%.template')"
add("audit_targets", FILES, f"SELECT scan_id, path FROM files WHERE {AUDIT}")
add("manifests", FILES, f"SELECT scan_id, path FROM files WHERE {MANIFEST}")
add("pylint_targets", FILES, f"SELECT scan_id, path FROM files WHERE {PYLINT_TARGET}")
add("npm_applicable", FILES, f"SELECT scan_id, bool_or({NPM_TARGET}) AS npm_applicable FROM files GROUP BY scan_id")
PLAN_CONDITIONS = {
    "terraform-fmt": "tf", "terraform-validate": "tf", "tflint": "tf", "checkov": "tf", "trivy": "tf",
    "cfn-lint": "cfn", "cfn-nag": "cfn", "checkov-cfn": "cfn", "bandit": "py", "safety": "py AND manifest",
    "pylint": "py AND pylint_target", "npm-audit": "npm AND audit_target", "snyk-iac-template": "npm AND template_file",
    "snyk-iac": "npm", "trivy-container": "image_target", "secrets": "TRUE",
}
add(
    "tool_plan",
    f"""{FILES}, facts AS (SELECT scan_id, bool_or(path LIKE '%.tf') AS tf, bool_or(coalesce({LOOSE}, FALSE)) AND bool_or(coalesce({STRICT}, FALSE)) AS cfn,
    bool_or(path LIKE '%.py') AS py, bool_or({MANIFEST}) AS manifest, bool_or({PYLINT_TARGET}) AS pylint_target, bool_or({AUDIT}) AS audit_target,
    bool_or({NPM_TARGET}) AS npm, bool_or(path LIKE '%.template') AS template_file, bool_or({DOCKERFILE} AND NOT {excluded(DIRNAME)}) AS image_target
    FROM files GROUP BY scan_id)""",
    " UNION ALL ".join(
        f"SELECT scan_id, '{tool}' AS tool, {TOOL_BY_NAME[tool].rank} AS ord FROM facts WHERE {cond}" for tool, cond in PLAN_CONDITIONS.items()
    ),
)

# --- normalisers -----------------------------------------------------------------------------

OK = "e % 23 <> 0 AND e % 29 <> 0 AND e % 31 <> 0 AND e % 37 <> 0"
V = "v"


def some(every: int, value: str) -> str:
    return f"CASE WHEN v % {every} = 0 THEN NULL ELSE {value} END"


def each_result(where: str = OK, count: str = "e % 4") -> str:
    return (
        f"x0 AS (SELECT *, i AS pos FROM (SELECT r.*, unnest(range(0, {count})) AS i FROM r WHERE {where})), "
        "x AS (SELECT *, e + i AS v FROM x0 WHERE (e + i) % 13 <> 0 AND (e + i) % 19 <> 0)"
    )


def each_child(where: str = OK) -> str:
    """Two parents with results: the event's own target, and one without a name."""
    return (
        f"x0 AS (SELECT r.*, 0 AS parent, unnest(range(0, e % 4)) AS i FROM r WHERE {where} "
        f"UNION ALL SELECT r.*, 2, unnest(range(0, (e + 1) % 3)) FROM r WHERE {where}), "
        "x AS (SELECT *, e + i AS v, CASE parent WHEN 0 THEN i ELSE e % 4 + i END AS pos FROM x0 WHERE (e + i) % 13 <> 0 AND (e + i) % 19 <> 0)"
    )


def finding(tool: str, meta: str = "CAST(v AS VARCHAR)", **fields: str) -> str:
    t = TOOL_BY_NAME[tool]
    values = {
        "scan_id": "scan_id",
        "seq": f"CAST({t.rank << 58} AS BIGINT) + e * {1 << 28} + pos",
        "tool": f"'{t.finding_tool}'",
        "severity": "NULL",
        "rule_id": "NULL",
        "title": "NULL",
        "description": "NULL",
        "file_path": "CAST(NULL AS VARCHAR)",
        "line_number": "CAST(NULL AS INTEGER)",
        "resource": "CAST(NULL AS VARCHAR)",
        "remediation": "CAST(NULL AS VARCHAR)",
        "meta": meta,
        **fields,
    }
    return "y AS (SELECT " + ", ".join(f"{sql} AS {name}" for name, sql in values.items()) + " FROM x)"


def norm(name: str, rows: str, found: str, *, paths: bool = False, rules: bool = True, extra: str = "", where: str = "TRUE") -> None:
    conditions = [where]
    if paths:
        conditions.append(f"NOT {excluded("nullif(file_path, '')")}")
    if rules:
        listed = [r for t, r in excluded_rules() if t == TOOL_BY_NAME[name].finding_tool]
        if listed:
            quoted = ", ".join(f"'{r}'" for r in listed)
            conditions.append(f"rule_id NOT IN ({quoted})")
    key = "norm_build_failure" if name == "container-build" else "norm_" + name.replace("-", "_")
    add(key, f"{NUMBERS}, {extra}{rows}, {found}", f"SELECT * FROM y WHERE {' AND '.join(conditions)}")


def c(value: str, default: str) -> str:
    return f"coalesce({value}, '{default}')"


def p(values: list) -> str:
    return pick(values, V)


LINE = f"CAST({p(LINES)} AS INTEGER)"
RANGE_FILE = some(6, p(PATHS))
RANGE_LINE = f"CASE WHEN v % 6 = 0 OR v % 4 = 0 THEN NULL ELSE {LINE} END"
FIRST_LINE = "CASE WHEN v % 5 = 0 OR v % 4 = 0 THEN NULL ELSE CAST(v % 9 AS INTEGER) END"
BLANK = "' ' || chr(9) || chr(10) || chr(13)"

norm(
    "terraform-fmt",
    f"""x0 AS (SELECT *, string_split(trim(array_to_string(list_transform(range(0, e % 4), lambda i: CASE WHEN (e + i) % 6 = 0 THEN '  ' ELSE '' END
      || coalesce({pick(PATHS, "e + i")}, ' ') || CASE WHEN (e + i) % 4 = 0 THEN ' ' ELSE '' END), chr(10)) || chr(10), {BLANK}), chr(10)) AS ls FROM r WHERE e % 4 <> 0),
    x AS (SELECT * FROM (SELECT scan_id, e, unnest(range(0, len(ls))) AS pos, unnest(ls) AS line FROM x0) WHERE trim(line, {BLANK}) <> '')""",
    finding(
        "terraform-fmt",
        meta="CAST(NULL AS VARCHAR)",
        severity="'LOW'",
        rule_id="'FMT001'",
        title="'Terraform file needs formatting'",
        description="'File ' || line || ' is not properly formatted'",
        file_path=f"trim(line, {BLANK})",
        remediation="'Run: terraform fmt'",
    ),
    paths=True,
)
norm(
    "terraform-validate",
    each_result(f"{OK} AND e % 3 <> 0 AND e % 5 <> 0"),
    finding(
        "terraform-validate",
        severity=f"CASE WHEN {p(['error', 'warning', None])} = 'error' THEN 'HIGH' ELSE 'MEDIUM' END",
        rule_id="'VAL001'",
        title="'Terraform validation error'",
        description=c(p(TEXTS), "Validation failed"),
        file_path=RANGE_FILE,
        line_number=RANGE_LINE,
    ),
)
norm(
    "tflint",
    each_result(),
    finding(
        "tflint",
        severity=severity(c(some(7, p(SEVERITY_WORDS)), "warning")),
        rule_id=c(some(7, p(RULES["tflint"])), "UNKNOWN"),
        title=c(p(TEXTS), "Linting issue"),
        description=c(p(TEXTS), ""),
        file_path=RANGE_FILE,
        line_number=RANGE_LINE,
    ),
    paths=True,
)
norm(
    "tfsec",
    each_result(),
    finding(
        "tfsec",
        severity=severity(c(p(SEVERITY_WORDS), "MEDIUM")),
        rule_id=c(p(RULES["tfsec"]), "UNKNOWN"),
        title=c(p(TEXTS), "Security issue detected"),
        description=c(p(TEXTS), ""),
        file_path=RANGE_FILE,
        line_number=f"CASE WHEN v % 6 = 0 THEN NULL ELSE {LINE} END",
        resource=c(p(RESOURCES), ""),
        remediation="CASE WHEN v % 5 = 0 OR v % 3 = 0 THEN NULL ELSE 'https://x/' || v END",
    ),
)


def checkov_finding(tool: str, paths: list, terraform: bool) -> str:
    return finding(
        tool,
        severity=checkov(some(2, p(["high", "", "bogus"])), p(CHECK_NAMES), terraform),
        rule_id=c(p(RULES["checkov"]), "UNKNOWN"),
        title=c(p(CHECK_NAMES), "Policy violation"),
        description=c(some(7, p(TEXTS)), ""),
        file_path=p(paths),
        line_number=FIRST_LINE,
        resource=c(p(RESOURCES), ""),
        remediation=p(TEXTS),
    )


norm("checkov", each_result(), checkov_finding("checkov", PATHS, True))
norm(
    "trivy",
    each_child(),
    finding(
        "trivy",
        severity=severity(c(p(SEVERITY_WORDS), "MEDIUM")),
        rule_id=c(p(RULES["trivy"]), "UNKNOWN"),
        title=c(p(TEXTS), "Misconfiguration detected"),
        description=c(p(TEXTS), ""),
        file_path=f"CASE parent WHEN 0 THEN {c(pick(PATHS, 'e'), 'none')} END",
        resource=some(7, p(RESOURCES)),
        remediation=p(TEXTS),
    ),
)
norm(
    "cfn-lint",
    each_result(),
    finding(
        "cfn-lint",
        severity=severity(c(p(["Error", "Warning", "Informational", None]), "Warning")),
        rule_id=c(some(7, p(RULES["cfn-lint"])), "UNKNOWN"),
        title=c(some(7, p(TEXTS)), "Validation issue"),
        description=c(p(TEXTS), ""),
        file_path=p(PATHS),
        line_number=RANGE_LINE,
    ),
)
norm(
    "cfn-nag",
    each_result(),
    finding(
        "cfn-nag",
        severity=f"CASE WHEN {p(['FAIL', 'WARN', None])} = 'FAIL' THEN 'HIGH' ELSE 'MEDIUM' END",
        rule_id=c(p(RULES["cfn-nag"]), "UNKNOWN"),
        title=c(p(TEXTS), "Security violation"),
        description=c(p(TEXTS), ""),
        file_path=c(pick(PATHS, "e"), "none"),
        line_number=FIRST_LINE,
        resource="CASE WHEN v % 5 = 0 THEN '' WHEN v % 3 = 0 THEN 'A' ELSE 'A, B' || e END",
    ),
)
norm(
    "checkov-cfn",
    each_result(),
    checkov_finding("checkov-cfn", inputs.CFN_PATHS, False),
    extra=f"{TEMPLATES}, ",
    where="(scan_id, string_split(file_path, '/')[-1]) IN (SELECT (scan_id, name) FROM templates)",
)
norm(
    "bandit",
    each_result(),
    finding(
        "bandit",
        meta=c(p(["HIGH", None]), "UNKNOWN"),
        severity=lookup(f"lower({p(['HIGH', 'medium', 'Low', 'UNDEFINED', None])})", BANDIT_WORDS, "MEDIUM"),
        rule_id=c(p(RULES["bandit"]), "UNKNOWN"),
        title=c(p(TEXTS), "Security issue detected"),
        description=c(p(TEXTS), "") + " || ' - ' || " + c(p(["name", None]), ""),
        file_path=relative(c(p(PATHS), "")),
        line_number=LINE,
        remediation=f"coalesce((SELECT words FROM advice WHERE id = {c(p(RULES['bandit']), 'UNKNOWN')}), {literal(BANDIT_DEFAULT, 'duck')})",
    ),
    extra=f"{ADVICE}, ",
)
_package = f"coalesce({p(['django', None])}, {p(['flask', None, 'jinja2'])}, 'unknown')"
_installed = f"coalesce({p(['1.0', None])}, {p(['2.0', '3.0', None])}, 'unknown')"
_affected = f"coalesce({p(['<2', None])}, {p(['<3', '<4', None])}, 'unknown')"
norm(
    "safety",
    f"{SAFETY_CUT}, " + each_result(f"{OK} AND (SELECT cut IS NULL OR r.e < cut FROM cuts WHERE cuts.scan_id = r.scan_id)"),
    finding(
        "safety",
        meta=_affected,
        severity="'HIGH'",
        rule_id=f"coalesce(nullif({p(['CVE-2021-44228', '', None])}, ''), {p(['44715', None])}, 'UNKNOWN')",
        title=f"'Vulnerable dependency: ' || {_package} || ' ' || {_installed}",
        description=f"coalesce({p([None, 'bad', 'worse'])}, {p(['desc', None])}, 'Known vulnerability in dependency')",
        file_path="'requirements' || CASE WHEN e % 2 = 0 THEN '' ELSE '-dev' END || '.txt'",
        remediation=f"'Update ' || {_package} || ' to a secure version. Vulnerable: ' || {_affected}",
    ),
)
_symbol = c(pick(["line-too-long", "R0914", None], "v // 2"), "")
norm(
    "pylint",
    each_result(),
    finding(
        "pylint",
        meta=_symbol,
        severity=lookup(f"lower({c(p(['fatal', 'error', 'Warning', 'refactor', 'convention', 'info', None]), 'convention')})", PYLINT_WORDS, "INFO"),
        rule_id=c(p(RULES["pylint"]), ""),
        title=f"{_symbol} || ': ' || " + c(p(TEXTS), "Code quality issue"),
        description=c(p(TEXTS), ""),
        file_path=relative(c(p(PATHS), "")),
        line_number=LINE,
    ),
    where=f"meta NOT IN ({PYLINT_RULES})",
)
norm(
    "npm-audit",
    f"x AS (SELECT *, e + i AS v, i AS pos FROM (SELECT r.*, unnest(range(0, e % 4)) AS i FROM r WHERE {OK}))",
    finding(
        "npm-audit",
        severity=severity(p(SEVERITY_WORDS[:-1])),
        rule_id="'npm-pkg' || i",
        title="'Vulnerable dependency: pkg' || i",
        description=p(["ReDoS", *["Dependency vulnerability"] * 3, "lodash", ""]),
        file_path=pick(inputs.PACKAGE_FILES, "e"),
        remediation=p(["Update to version latest", "Review and update dependency", "Update to version 2.0.1", "Update to version latest", "Review and update dependency"]),
    ),
    paths=True,
)


def snyk_finding(tool: str, targets: list) -> str:
    impact = p(["", "data loss", None])
    return finding(
        tool,
        meta=p(RULES["snyk"]),
        severity=lookup(f"lower({c(p(SEVERITY_WORDS), 'medium')})", SNYK_WORDS, "MEDIUM"),
        rule_id=c(p(RULES["snyk"]), "UNKNOWN"),
        title=c(p(TEXTS), "IaC security issue"),
        description=c(p(TEXTS), "") + f" || CASE WHEN coalesce({impact}, '') <> '' THEN ' Impact: ' || {impact} ELSE '' END",
        file_path=c(pick(targets, "e"), "unknown"),
        line_number=f"nullif({LINE}, 0)",
        resource=c(p(RESOURCES), ""),
        remediation=c(p(TEXTS), ""),
    )


SNYK_ROWS = each_result(f"{OK} AND NOT (e % 3 = 2 AND e % 5 = 0)")
norm("snyk-iac", SNYK_ROWS, snyk_finding("snyk-iac", PATHS))
norm(
    "snyk-iac-template",
    SNYK_ROWS,
    snyk_finding("snyk-iac-template", inputs.TEMPLATE_TARGETS).replace("y AS (", "y0 AS (")
    + ", y AS (SELECT * REPLACE (coalesce(original, file_path) AS file_path) FROM (SELECT y0.*, original FROM y0 LEFT JOIN renames n ON n.scan_id = y0.scan_id AND renamed = file_path))",
    extra=f"{RENAMES}, ",
    paths=True,
)
ORACLES["norm_snyk_iac_template"] = ORACLES["norm_snyk_iac_template"].replace("SELECT * FROM y WHERE", "SELECT * EXCLUDE (original) FROM y WHERE")
_dockerfile = pick(inputs.BUILD_DOCKERFILES, "e")
_image = image(DIRNAME.replace("path", _dockerfile))
_version = p(["1.1", "", None])
_fixed = p(["1.2", "", None])
_pkg = c(p(["openssl", "zlib", None]), "")
_cve = c(p(RULES["cve"]), "UNKNOWN")
norm(
    "trivy-container",
    each_child(),
    finding(
        "trivy-container",
        meta=_image,
        severity=severity(c(p(SEVERITY_WORDS), "MEDIUM")),
        rule_id=_cve,
        title=f"{_cve} || ': ' || {_pkg} || CASE WHEN coalesce({_version}, '') <> '' THEN ' (' || {_version} || ')' ELSE '' END",
        description=c(p(TEXTS), ""),
        file_path=_dockerfile,
        resource=f"CASE WHEN parent = 2 THEN {_image} WHEN e % 2 = 0 THEN 'alpine (os)' ELSE 'alpine' END",
        remediation=f"CASE WHEN coalesce({_fixed}, '') <> '' THEN 'Upgrade ' || {_pkg} || ' to version ' || {_fixed} ELSE 'No fix available yet' END",
    ),
)
norm(
    "container-build",
    "x AS (SELECT *, 0 AS pos FROM r WHERE e % 3 <> 0)",
    finding(
        "container-build",
        meta="CAST(NULL AS VARCHAR)",
        severity="'HIGH'",
        rule_id="'BUILD_FAILURE'",
        title="'Docker image build failed'",
        description=f"'Failed to build Docker image from ' || {_dockerfile} || ': ' || substring(repeat('step ' || e || ' failed; ', 60), 1, 500)",
        file_path=_dockerfile,
    ),
)

# Reports that are no JSON of the tool's form: cut off, of another type, or with text after.
_text_tools = [t for t in inputs.STDOUT if t not in inputs.TEXT_TOOLS]
add(
    "report_parse_errors",
    NUMBERS,
    " UNION ALL ".join(
        f"SELECT scan_id, '{t}' AS tool, e AS seq FROM r WHERE e % 23 <> 0 AND (e % 29 = 0 OR e % 31 = 0 OR e % 37 = 0)" for t in _text_tools
    ),
)

# Results that are a text instead of an object: where they stand, by the shape of the report.
_children = (
    "(SELECT r.*, '0.' AS parent, unnest(range(0, e % 4)) AS i FROM r UNION ALL SELECT r.*, '2.', unnest(range(0, (e + 1) % 3)) FROM r)"
)
_flat, _nested = "(SELECT r.*, '' AS parent, unnest(range(0, e % 4)) AS i FROM r)", "(SELECT r.*, '0.' AS parent, unnest(range(0, e % 4)) AS i FROM r)"
_shapes = {
    **{t: _flat for t in ("terraform-validate", "tflint", "tfsec", "checkov", "cfn-lint", "checkov-cfn", "bandit", "safety", "pylint")},
    **{t: _children for t in ("trivy", "trivy-container")},
    "cfn-nag": _nested,
    **{t: f"(SELECT * FROM {_nested} WHERE NOT (e % 3 = 2 AND e % 5 = 0))" for t in ("snyk-iac", "snyk-iac-template")},
}
add(
    "result_errors",
    NUMBERS,
    " UNION ALL ".join(
        f"SELECT scan_id, '{t}' AS tool, e AS seq, 'entry' AS reason, parent || i AS position, 'odd' AS text FROM {rows} "
        "WHERE e % 23 <> 0 AND e % 29 <> 0 AND e % 31 <> 0 AND e % 37 <> 0 AND (e + i) % 13 <> 0 AND (e + i) % 19 = 0"
        for t, rows in _shapes.items()
    ),
)

# --- secrets ---------------------------------------------------------------------------------


def hex_rule(rule: str) -> str:
    """The rule with its case flag, and the match shown by its head and length."""
    return SECRET_PATTERNS[rule].replace("'", "''")


ORACLES["file_inventory"] = """SELECT 'scan=s' || (doc_id // 8) AS scan_id, CAST(1 AS BIGINT) AS files, CAST(sum(length(text) + 1) AS BIGINT) AS chars,
  CAST(sum(strlen(text) + 1) AS BIGINT) AS bytes FROM documents GROUP BY doc_id // 8"""
SECRET_LINES = f"{FILES}, l AS (SELECT scan_id, path, unnest(string_split(content, chr(10))) AS line, unnest(range(1, len(string_split(content, chr(10))) + 1)) AS line_number FROM files WHERE read_ok)"
SECRETS = " UNION ALL ".join(
    f"SELECT scan_id, path, CAST(line_number AS INTEGER) AS line_number, '{rule}' AS rule_id, unnest(regexp_extract_all(line, '{hex_rule(rule)}')) AS m FROM l"
    for rule in SECRET_PATTERNS
    if rule != "generic-api-key"  # excluded by the configuration
)
add(
    "secrets_scan",
    f"{SECRET_LINES}, h AS ({SECRETS})",
    "SELECT scan_id, path, line_number, rule_id, substring(m, 1, 4) || '***(' || length(m) || ')' AS match FROM h",
)

# --- everything together ---------------------------------------------------------------------

NORMS = [
    "norm_build_failure" if t.name == "container-build" else "norm_" + t.name.replace("-", "_")
    for t in TOOLS
    if t.name != "secrets"
]
SECRET_FINDINGS = f"""WITH {SECRET_LINES}, h AS ({SECRETS}) SELECT scan_id, CAST({16 << 58} AS BIGINT) + row_number() OVER () AS seq, 'secrets' AS tool,
  'CRITICAL' AS severity, rule_id, 'Secret detected: ' || rule_id AS title, path AS file_path, line_number, '' AS resource FROM h"""
UNION_COLUMNS = "scan_id, tool, severity, rule_id, title, file_path, line_number, resource"
ALL_FINDINGS = "a AS (" + " UNION ALL ".join(
    [f"SELECT scan_id, seq, {UNION_COLUMNS[9:]} FROM ({ORACLES[n]})" for n in NORMS] + [f"SELECT scan_id, seq, {UNION_COLUMNS[9:]} FROM ({SECRET_FINDINGS})"]
) + ")"
add(
    "flow_switches",
    ALL_FINDINGS,
    "SELECT scan_id, tool, count(*) AS findings FROM a WHERE severity <> 'INFO' "
    "AND tool NOT IN ('npm-audit', 'snyk-iac', 'trivy-container', 'container-build', 'docker-build') GROUP BY ALL",
)
add("union_findings", ALL_FINDINGS, f"SELECT {UNION_COLUMNS} FROM a")
KEY = "md5(coalesce(file_path, 'None') || ':' || coalesce(CAST(line_number AS VARCHAR), 'None') || ':' || rule_id || ':' || title)"
_gate = GATE_RANK.replace("fail_on", "coalesce(fail_on, 'HIGH')")
add(
    "scan_flow",
    f"""{ALL_FINDINGS}, d AS (SELECT * FROM a QUALIFY row_number() OVER (PARTITION BY scan_id, {KEY} ORDER BY seq) = 1), {SCANS},
    c AS (SELECT scan_id, count(*) AS total_findings, count(*) FILTER (severity = 'CRITICAL') AS critical, count(*) FILTER (severity = 'HIGH') AS high,
      count(DISTINCT nullif(file_path, '')) AS unique_files, max({rank('severity')}) AS w FROM d GROUP BY scan_id),
    n AS (SELECT scan_id, count(*) AS total_raw_findings FROM a GROUP BY scan_id),
    g AS (SELECT *, coalesce(w >= {_gate}, FALSE) AS failed FROM scans LEFT JOIN c USING (scan_id) LEFT JOIN n USING (scan_id))""",
    "SELECT scan_id, coalesce(fail_on, 'HIGH') AS fail_on, failed, CASE WHEN errored THEN 1 WHEN failed THEN 2 ELSE 0 END AS exit_code, "
    "CASE WHEN errored THEN 'error' WHEN failed THEN 'failed' ELSE 'passed' END AS status, coalesce(total_findings, 0) AS total_findings, "
    "coalesce(total_raw_findings, 0) AS total_raw_findings, coalesce(critical, 0) AS critical, coalesce(high, 0) AS high, coalesce(unique_files, 0) AS unique_files FROM g",
)

# --- configuration ---------------------------------------------------------------------------

ORACLES["config_lookup"] = """SELECT 'scan-' || c_custkey AS scan_id, CASE WHEN c_custkey % 3 = 2 THEN 'LOW' ELSE 'HIGH' END AS fail_on,
  CASE WHEN c_custkey % 5 <> 0 AND c_custkey % 2 = 0 THEN 'true' ELSE 'default' END AS terraform_enabled,
  CASE WHEN c_custkey % 5 <> 0 THEN 'n' || c_mktsegment END AS name FROM customer"""
ORACLES["config_check_keys"] = """SELECT 'scan-' || c_custkey AS scan_id, 'tools' AS missing_key FROM customer WHERE c_custkey % 5 = 0
  UNION ALL SELECT 'scan-' || c_custkey, 'severity' FROM customer WHERE c_custkey % 3 = 0
  UNION ALL SELECT 'scan-' || c_custkey, 'output' FROM customer WHERE c_custkey % 7 = 0"""



def quoted(values: list[str]) -> str:
    return "[" + ", ".join(literal(v, "duck") for v in values) + "]::VARCHAR[]"


def nth(lists: list[list[str]], number: str) -> str:
    return f"([{', '.join(quoted(x) for x in lists)}])[CAST(({number}) % {len(lists)} AS BIGINT) + 1]"


# Scans (scan_id, c) with a configuration of their own, an empty one for a broken text, or the shipped one.
CONFIGURED = """own AS (SELECT 'scan-' || c_custkey AS scan_id, c_custkey AS c FROM customer WHERE c_custkey % 7 <> 4 AND c_custkey % 13 <> 5),
  shipped AS (SELECT scan_id FROM known WHERE scan_id NOT IN (SELECT 'scan-' || c_custkey FROM customer WHERE c_custkey % 7 <> 4))"""
_ruled = [(t.name, i) for i, name in enumerate(inputs.RULED_TOOLS) for t in TOOLS
          if (t.scanner, t.exclude_key) == (TOOL_BY_NAME[name].scanner, TOOL_BY_NAME[name].exclude_key)]
_shipped = [(t.name, r) for t in TOOLS for r in EXCLUDED_RULES.get(t.scanner, {}).get(t.exclude_key) or []]
_switches = [(t.name, 3 + i) for i, (scanner, tools) in enumerate(
    [("npm", ["npm-audit", "snyk-iac-template", "snyk-iac"]), ("terraform", ["tfsec"]), ("container", ["container-build"])])
    for t in TOOLS if t.name in tools]
POLICY_TABLES = f"""{CONFIGURED},
  rule_rows AS ({" UNION ".join(f"SELECT scan_id, '{t}' AS tool, unnest({nth(inputs.CONFIG_RULES, f'c + {i}')}) AS rule_id FROM own" for t, i in _ruled)}
    UNION SELECT scan_id, tool, rule_id FROM shipped, (VALUES {", ".join(f"('{t}', '{r}')" for t, r in _shipped)}) v(tool, rule_id)),
  path_rows AS (SELECT DISTINCT scan_id, unnest({nth(inputs.CONFIG_PATHS, "c")}) AS pattern FROM own
    UNION SELECT scan_id, unnest({quoted(EXCLUDED_PATHS)}) FROM shipped),
  off_rows AS ({" UNION ".join(f"SELECT scan_id, '{t}' AS tool FROM own WHERE c % {n} = 0" for t, n in _switches)})"""
_filtered = ", ".join(f"'{t.name}'" for t in TOOLS if t.path_filtered)
_level = f"coalesce({pick(['LOW', 'HIGH', 'MEDIUM', 'BOGUS', None], 'o.c')}, 'LOW')"
add(
    "scan_policies",
    f"{FINDINGS}, known AS (SELECT DISTINCT scan_id FROM f), {POLICY_TABLES}",
    f"""SELECT f.scan_id, f.seq, f.tool, f.rule_id, f.file_path FROM f LEFT JOIN own o USING (scan_id)
  WHERE (f.scan_id, f.tool) NOT IN (SELECT scan_id, tool FROM off_rows) AND (f.scan_id, f.tool, f.rule_id) NOT IN (SELECT * FROM rule_rows)
    AND (f.tool <> 'snyk-iac' OR {rank("f.severity")} >= {rank(_level)})
    AND NOT (f.tool IN ({_filtered}) AND coalesce(f.file_path, '') <> '' AND EXISTS (
      SELECT 1 FROM path_rows p WHERE p.scan_id = f.scan_id AND (contains({normal("f.file_path")}, trim(p.pattern))
        OR (contains(p.pattern, '**') AND contains({normal("f.file_path")}, replace(replace(trim(p.pattern), '**/', ''), '**', ''))))))""",
)
add(
    "scan_policy_tables",
    f"known AS (SELECT 'scan-' || c_custkey AS scan_id FROM customer), {POLICY_TABLES}",
    "SELECT scan_id, 'rule' AS kind, tool || ' ' || rule_id AS value FROM rule_rows UNION ALL SELECT scan_id, 'path', pattern FROM path_rows "
    "UNION ALL SELECT scan_id, 'off', tool FROM off_rows",
)
ORACLES["path_index"] = f"""WITH p AS (SELECT doc_id AS seq, 'a/' || translate(substr(text, 1, 90), ' .', '//') AS path FROM documents),
  n AS (SELECT *, {normal("path")} AS normal FROM p),
  w AS (SELECT DISTINCT trim(translate(substr(text, 70 + doc_id % 40, 7 + doc_id % 12), ' .', '//'), chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS pattern
    FROM documents WHERE trim(translate(substr(text, 70 + doc_id % 40, 7 + doc_id % 12), ' .', '//')) <> ''),
  b AS (SELECT DISTINCT unnest(CASE WHEN contains(pattern, '**') THEN [pattern, replace(replace(pattern, '**/', ''), '**', '')] ELSE [pattern] END) AS pattern FROM w)
SELECT seq, path FROM n WHERE EXISTS (SELECT 1 FROM b WHERE contains(normal, pattern))"""

# --- reports ---------------------------------------------------------------------------------


def rows(text: str, source: str, part: str | int, item: str = "0", major: str = "0") -> str:
    return (
        f"SELECT scan_id, CAST({major} AS BIGINT) AS major, CAST({part} AS INTEGER) AS part, "
        f"CAST({item} AS BIGINT) AS item, {text} AS text FROM {source}"
    )


def union(*parts: str) -> str:
    return " UNION ALL ".join(parts)


def joined(*parts: str) -> str:
    """Lines joined by newlines without the NULL ones."""
    return f"concat_ws(chr(10), {', '.join(parts)})"


def js(value: str) -> str:
    return f"coalesce(CAST(to_json({value}) AS VARCHAR), 'null')"


def if_set(value: str, text: str) -> str:
    return f"CASE WHEN coalesce({value}, '') <> '' THEN {text} END"


FULL = f"{DEDUP}, {SUMMARY}"
JSON_SEVERITIES = "concat_ws(',', " + ", ".join(f"""CASE WHEN {s.lower()} > 0 THEN '"{s}":' || {s.lower()} END""" for s in SEVERITIES_DESC) + ")"
JSON_TOOLS = """array_to_string(list_transform(CASE by_tool WHEN '' THEN [] ELSE string_split(by_tool, ',') END, lambda x: '"' || replace(x, '=', '":')), ',')"""
JSON_RAN = """array_to_string(list_transform(CASE scanners_run WHEN '' THEN [] ELSE string_split(scanners_run, ',') END, lambda x: '"' || x || '"'), ',')"""
JSON_FIELDS = ["tool", "severity", "rule_id", "title", "description", "file_path", "line_number", "resource", "remediation"]
JSON_FINDING = "'{' || " + " || ',' || ".join(f"""'"{n}":' || {js(n)}""" for n in JSON_FIELDS) + """ || ',"metadata":{"event":' || e || '}}'"""
COMMA = "CASE WHEN seq = min(seq) OVER (PARTITION BY scan_id) THEN '' ELSE ',' END"
add(
    "report_json",
    FULL,
    union(
        rows(
            f"""'{{"scan_timestamp":' || {js("scan_timestamp")} || ',"repository":' || {js("repository")} || ',"branch":' || {js("branch")} || ',"summary":{{"total_findings":' || total_findings
            || ',"by_severity":{{' || {JSON_SEVERITIES} || '}},"by_tool":{{' || {JSON_TOOLS} || '}},"unique_files":' || unique_files || '}},"findings":['""",
            "s", 0,
        ),
        rows(f"{COMMA} || {JSON_FINDING}", "d", 1, "seq"),
        rows(
            f"""'],"metadata":{{"scanners_run":[' || {JSON_RAN} || '],"total_raw_findings":' || total_raw_findings || ',"deduplication_enabled":true}}}}'""",
            "s", 2,
        ),
    ),
)
add(
    "report_readback",
    FULL,
    "SELECT scan_id, total_findings AS total, critical, high, medium, low FROM s",
)

SARIF_HELP = if_set(
    "remediation",
    f"""',"help":{{"text":' || {js("substring(remediation, 1, 4096)")} || ',"markdown":' || {js("substring(remediation, 1, 4096)")} || '}}'""",
)
TAG_LIST = f"""'["' || replace({TAGS}, ',', '","') || '"]'"""
SARIF_RULE = f"""'{{"id":' || {js("rule_id")} || ',"name":' || {js(RULE_NAME)} || ',"shortDescription":{{"text":' || {js("substring(title, 1, 512)")}
  || '}},"fullDescription":{{"text":' || {js("CASE WHEN description <> '' THEN substring(description, 1, 4096) ELSE title END")}
  || '}},"defaultConfiguration":{{"level":"' || {lookup("severity", SARIF_LEVELS, "note")} || '"}},"properties":{{"security-severity":"'
  || {lookup("severity", SARIF_SCORES, "1.0")} || '","tags":' || {TAG_LIST} || '}}' || coalesce({SARIF_HELP}, '') || '}}'"""
SARIF_REGION = """CASE WHEN coalesce(line_number, 0) <> 0 THEN ',"region":{"startLine":' || line_number || '}' ELSE '' END"""
SARIF_PLACE = if_set(
    "file_path",
    f"""',"locations":[{{"physicalLocation":{{"artifactLocation":{{"uri":' || {js(sarif_uri("file_path"))} || ',"uriBaseId":"%SRCROOT%"}}' || {SARIF_REGION} || '}}}}]'""",
)
SARIF_RESULT = f"""'{{"ruleId":' || {js("rule_id")} || ',"level":"' || {lookup("severity", SARIF_LEVELS, "note")} || '","message":{{"text":' || {js(MESSAGE)} || '}}'
  || coalesce({SARIF_PLACE}, '') || ',"fingerprints":{{"primaryLocationLineHash":"' || key || '"}}}}'"""
RUN_COMMA = "CASE WHEN seq = run THEN '' ELSE ',' END"
add(
    "sarif_doc",
    f"""{FULL}, q AS (SELECT *, min(seq) OVER (PARTITION BY scan_id, tool) AS run FROM d),
    runs AS (SELECT scan_id, tool, run, min(run) OVER (PARTITION BY scan_id) AS first, scan_timestamp FROM (SELECT DISTINCT scan_id, tool, run FROM q) JOIN s USING (scan_id)),
    firsts AS (SELECT * FROM q QUALIFY row_number() OVER (PARTITION BY scan_id, tool, rule_id ORDER BY seq) = 1)""",
    union(
        rows(f"""'{{"$schema":"{SARIF_SCHEMA}","version":"2.1.0","runs":['""", "s", 0, major="-1"),
        rows("""CASE WHEN run = first THEN '' ELSE ',' END || '{"tool":{"driver":{"name":"findlake (' || tool || ')","version":"1.0.0","rules":['""", "runs", 0, major="run"),
        rows(f"{RUN_COMMA} || {SARIF_RULE}", "firsts", 1, "seq", "run"),
        rows("""']}},"results":['""", "runs", 2, major="run"),
        rows(f"{RUN_COMMA} || {SARIF_RESULT}", "q", 3, "seq", "run"),
        rows("""'],"invocations":[{"executionSuccessful":true,"endTimeUtc":"' || scan_timestamp || 'Z"}]}'""", "runs", 4, major="run"),
        rows("']}'", "s", 5, major=str((1 << 63) - 1)),
    ),
)
NL = "chr(10)"
SIZES = "z AS (SELECT scan_id, severity, count(*) AS size FROM d GROUP BY ALL)"
TOOL_LINES = "tl AS (SELECT scan_id, string_agg('- **' || tool || ':** ' || n, chr(10) ORDER BY n DESC, first_seq) AS tool_lines FROM t GROUP BY scan_id)"
add(
    "report_markdown",
    f"{FULL}, {SIZES}, {TOOL_LINES}, m AS (SELECT s.*, tool_lines FROM s LEFT JOIN tl USING (scan_id)), q AS (SELECT *, {SECTION_N} AS n FROM d)",
    union(
        rows(
            joined(
                f"'# {TITLE}' || {NL}",
                f"'**Repository:** ' || repository || {NL}",
                if_set("branch", f"'**Branch:** ' || branch || {NL}"),
                f"'**Scan Date:** ' || scan_timestamp || {NL}",
                f"'---' || {NL}",
                f"'## Summary' || {NL}",
                "'- **Total Findings:** ' || total_findings",
                "'- **Files Scanned:** ' || unique_files",
                f"'- **Scanners Run:** ' || replace(scanners_run, ',', ', ') || {NL}",
                f"'### Findings by Severity' || {NL}",
                *[f"CASE WHEN {s.lower()} > 0 THEN '- **{s}:** ' || {s.lower()} END" for s in SEVERITIES_DESC],
                "''",
                f"'### Findings by Tool' || {NL}",
                "tool_lines",
                f"{NL} || '---' || {NL}",
                f"'## Findings Details' || {NL}",
                f"CASE WHEN total_findings = 0 THEN 'No findings detected.' || {NL} END",
            ),
            "m",
            0,
        ),
        rows(f"'### ' || severity || ' Severity (' || size || ' findings)' || {NL}", "z", f"1 + 2 * ({PLACE})"),
        rows(
            joined(
                "'#### ' || n || '. ' || title",
                "'- **Severity:** ' || severity",
                "'- **Tool:** ' || tool",
                "'- **Rule:** ' || rule_id",
                if_set("file_path", f"'- **Location:** `' || {location('file_path')} || '`'"),
                if_set("resource", "'- **Resource:** ' || resource"),
                if_set("description", "'- **Description:** ' || description"),
                if_set("remediation", "'- **Remediation:** ' || remediation"),
                "''",
            ),
            "q",
            f"2 + 2 * ({PLACE})",
            "seq",
        ),
    ),
)


def card(name: str, value: str) -> str:
    return f"""'<div class="card"><h3>{name}</h3><p>' || {value} || '</p></div>'"""


add(
    "report_html",
    f"{FULL}, {SIZES}",
    union(
        rows(
            joined(
                f"""'<!DOCTYPE html>' || {NL} || '<html lang="en">' || {NL} || '<head>' || {NL} || '<meta charset="UTF-8">'""",
                f"'<title>{TITLE}</title>' || {NL} || '<style>{STYLE}</style>' || {NL} || '</head>' || {NL} || '<body>' || {NL} || '<h1>{TITLE}</h1>'",
                f"'<p>Repository: ' || {escape('repository')} || '</p>'",
                if_set("branch", f"'<p>Branch: ' || {escape('branch')} || '</p>'"),
                f"'<p>Scan Date: ' || {escape('scan_timestamp')} || '</p>'",
                """'<div class="cards">'""",
                card("Total Findings", "total_findings"),
                card("Files Analyzed", "unique_files"),
                card("Critical Findings", "critical"),
                card("High Findings", "high"),
                f"'</div>' || {NL} || '<h2>Findings Details</h2>'",
                "CASE WHEN total_findings = 0 THEN '<p>No findings detected.</p>' END",
            ),
            "s",
            0,
        ),
        rows("'<h3>' || severity || ' Severity (' || size || ' findings)</h3>'", "z", f"1 + 2 * ({PLACE})"),
        rows(
            joined(
                f"""'<div class="finding"><p><span class="badge severity-' || severity || '">' || severity || '</span>' || {escape("title")} || '</p>'""",
                f"'<p>Severity: ' || severity || ' | Tool: ' || tool || ' | Rule: ' || {escape('rule_id')} || coalesce({if_set('file_path', "' | Location: <code>' || " + location(escape('file_path')) + " || '</code>'")}, '') || '</p>'",
                f"'<p>' || {escape('description')} || '</p>'",
                if_set("remediation", f"'<p>Remediation: ' || {escape('remediation')} || '</p>'"),
                "'</div>'",
            ),
            "d",
            f"2 + 2 * ({PLACE})",
            "seq",
        ),
        rows(f"'</body>' || {NL} || '</html>'", "s", 100),
    ),
)
STATUS_D = STATUS.replace(f"{SCANS}, ", "").replace("FROM f GROUP BY scan_id), gate", "FROM d GROUP BY scan_id), gate")
CI = f"{FULL}, {STATUS_D}, ci AS (SELECT s.*, status.fail_on, status.exit_code, status.status FROM s JOIN status USING (scan_id))"
CI_OUTPUTS = {
    "findings-count": "CAST(total_findings AS VARCHAR)",
    "critical-count": "CAST(critical AS VARCHAR)",
    "high-count": "CAST(high AS VARCHAR)",
    "medium-count": "CAST(medium AS VARCHAR)",
    "low-count": "CAST(low AS VARCHAR)",
    "report-path": "'reports'",
    "sarif-path": "'reports/sarif/scan_id=' || scan_id",
    "scan-status": "status",
}
add("ci_outputs", CI, union(*[f"SELECT scan_id, '{n}' AS name, {v} AS value FROM ci" for n, v in CI_OUTPUTS.items()]))
LEVEL = "coalesce(fail_on, 'HIGH')"
add(
    "ci_summary",
    f"{CI}, top AS (SELECT *, {TOP} AS place FROM d QUALIFY place <= 10)",
    union(
        rows(
            joined(
                f"'# Security Scan Results' || {NL} || {NL} || '## Summary' || {NL} || {NL} || '| Severity | Count |' || {NL} || '|----------|-------|'",
                *[f"'| {s.title()} | ' || {s.lower()} || ' |'" for s in ("CRITICAL", "HIGH", "MEDIUM", "LOW")],
                f"'| **Total** | **' || total_findings || '** |' || {NL}",
                f"""'> **Status:** ' || CASE exit_code WHEN 0 THEN ':white_check_mark: Passed - No findings at or above ' || {LEVEL} || ' severity'
                WHEN 2 THEN ':x: Failed - Findings detected at or above ' || {LEVEL} || ' severity' ELSE ':warning: Error - Scan encountered an error' END""",
                f"{NL} || '## Scan Configuration' || {NL}",
                "'- **Scan Path:** `.`'",
                "'- **Output Formats:** json,sarif'",
                f"'- **Fail Threshold:** ' || {LEVEL} || {NL}",
                f"CASE WHEN total_findings > 0 THEN '## Top Findings' || {NL} END",
            ),
            "ci",
            0,
        ),
        rows(
            f"place || '. ' || {lookup('severity', EMOJI, ':white_circle:')} || ' **' || severity || '** - ' || title || {NL} || '   - Location: `' || {location("coalesce(file_path, 'None')")} || '`' || {NL}",
            "top",
            1,
            "place",
        ),
        rows("'*... and ' || (total_findings - 10) || ' more findings. See full report for details.*'", "s WHERE total_findings > 10", 2),
    ),
)
BAR = "repeat('=', 46)"
add(
    "ci_log",
    f"{FULL}, q AS (SELECT *, {HEADER} AS header FROM d)",
    union(
        rows(f"{NL} || {BAR} || {NL} || 'SECURITY FINDINGS DETAILS' || {NL} || {BAR} || {NL}", "s WHERE total_findings > 0", 0),
        rows(
            joined(
                f"CASE WHEN header THEN {NL} || '--- ' || severity || ' ---' || {NL} END",
                "'[' || tool || '] ' || rule_id || ': ' || title",
                "'  Location: ' || " + location("coalesce(file_path, 'None')", zero=True),
                if_set("resource", "'  Resource: ' || resource"),
                f"CASE WHEN description NOT IN ('', 'FAILED') THEN '  Description: ' || {dots('description', 200)} END",
                if_set("remediation", f"'  Remediation: ' || {dots('remediation', 150)}"),
                "''",
            ),
            "q",
            f"1 + {PLACE}",
            "seq",
        ),
        rows(f"{BAR} || {NL} || 'END OF FINDINGS DETAILS' || {NL} || {BAR}", "s WHERE total_findings > 0", 9),
        rows("'No findings to display.'", "s WHERE total_findings = 0", 0),
    ),
)

# --- history ---------------------------------------------------------------------------------

add("report_floor", DEDUP, "SELECT scan_id, seq, severity FROM d WHERE severity <> 'INFO'")
add(
    "by_file",
    FINDINGS,
    f"SELECT scan_id, file_path, count(*) AS findings, max({rank('severity')}) AS worst_rank, "
    f"['INFO', 'LOW', 'MEDIUM', 'HIGH', 'CRITICAL'][max({rank('severity')}) + 1] AS worst_severity FROM f WHERE file_path <> '' GROUP BY scan_id, file_path",
)
BEFORE = f"b AS (SELECT scan_id, rule_id, {KEY} AS key FROM (SELECT * REPLACE (CASE WHEN seq % 3 = 0 THEN line_number + 1 ELSE line_number END AS line_number) FROM f))"
add(
    "baseline_diff",
    f"{FINDINGS}, {BEFORE}, n1 AS (SELECT DISTINCT scan_id, key FROM f), b1 AS (SELECT DISTINCT scan_id, key FROM b)",
    "SELECT scan_id, key, CASE WHEN b1.key IS NULL THEN 'new' ELSE 'same' END AS state FROM n1 LEFT JOIN b1 USING (scan_id, key) "
    "UNION ALL SELECT scan_id, key, 'fixed' FROM b1 ANTI JOIN n1 USING (scan_id, key)",
)
add(
    "run_changes",
    f"""{FINDINGS}, keys AS (SELECT DISTINCT scan_id, key FROM f),
  times AS (SELECT user_id % 10 AS repository, 'scan-' || user_id AS scan_id, min(ts) AS scan_ts FROM events GROUP BY user_id),
  runs AS (SELECT scan_id, lag(scan_id) OVER (PARTITION BY repository ORDER BY scan_ts, scan_id) AS previous FROM times),
  later AS (SELECT scan_id, previous, key FROM keys JOIN runs USING (scan_id)),
  earlier AS (SELECT runs.scan_id, runs.previous, keys.key FROM runs JOIN keys ON keys.scan_id = runs.previous)""",
    "SELECT scan_id, l.previous, key, CASE WHEN e.key IS NULL THEN 'new' ELSE 'same' END AS state "
    "FROM later l LEFT JOIN earlier e USING (scan_id, key) "
    "UNION ALL SELECT scan_id, previous, key, 'fixed' FROM earlier ANTI JOIN later USING (scan_id, key)",
)
add(
    "suppression",
    f"{DEDUP}, {BEFORE}",
    "SELECT scan_id, seq, rule_id FROM d ANTI JOIN (SELECT * FROM b WHERE rule_id LIKE 'R%') b USING (scan_id, key)",
)
ORACLES["trend"] = """WITH c AS (SELECT user_id, min(ts) AS scan_ts, count(*) AS findings FROM events GROUP BY user_id),
  o AS (SELECT 'repo-' || (user_id % 10) AS repository, 'scan-' || user_id AS scan_id, scan_ts, findings FROM c)
  SELECT repository, row_number() OVER w AS run, scan_id, findings, lag(findings) OVER w AS previous, findings - lag(findings) OVER w AS change
  FROM o WINDOW w AS (PARTITION BY repository ORDER BY scan_ts, scan_id)"""
LAYERS = "layers(tool, layer) AS (VALUES " + ", ".join(f"('{t}', '{layer}')" for t, layer in sorted({(t.finding_tool, t.layer) for t in TOOLS})) + ")"
add(
    "by_layer",
    f"{FINDINGS}, {LAYERS}",
    "SELECT scan_id, layer, count(*) AS findings FROM f JOIN layers USING (tool) GROUP BY ALL",
)
add(
    "normalized_dedup",
    f"{FINDINGS}, g AS (SELECT *, CASE WHEN file_path IS NOT NULL THEN {normal('file_path')} END AS np FROM f)",
    f"SELECT scan_id, seq, file_path FROM g QUALIFY row_number() OVER (PARTITION BY scan_id, {KEY.replace('file_path', 'np')} ORDER BY seq) = 1",
)

# --- streams ---------------------------------------------------------------------------------

ORACLES["stream_normalize"] = f"WITH {NUMBERS}, {each_result()}, " + finding(
    "tflint",
    severity=severity(c(some(7, p(SEVERITY_WORDS)), "warning")),
    rule_id=c(some(7, p(RULES["tflint"])), "UNKNOWN"),
    title=c(p(TEXTS), "Linting issue"),
    description=c(p(TEXTS), ""),
    file_path=RANGE_FILE,
    line_number=RANGE_LINE,
) + " SELECT * EXCLUDE (meta) FROM y"
add("stream_dedup_keys", FINDINGS, "SELECT DISTINCT scan_id, key FROM f")
add(
    "stream_windowed_counts",
    FINDINGS,
    "SELECT strftime(date_trunc('day', ts), '%Y-%m-%d') AS day, severity, count(*) AS findings FROM f GROUP BY ALL",
)
ORACLES["stream_dedup_rows"] = ORACLES["dedup_keep_first"]
ORACLES["stream_errors"] = (
    f"SELECT scan_id, tool, seq, 'report' AS reason, CAST(NULL AS VARCHAR) AS position FROM ({ORACLES['report_parse_errors']}) WHERE tool = 'tflint' "
    f"UNION ALL SELECT scan_id, tool, seq, reason, position FROM ({ORACLES['result_errors']}) WHERE tool = 'tflint'"
)
