"""What cannot be read is listed by one parse of a report, with the same rows as by one parse for each question."""

from __future__ import annotations

import json

from pyspark.sql import functions as F

from findlake.model import RAW_REPORTS
from findlake.operators import errors
from findlake.operators.normalize import readable

NUMBERS = [1, -2, 2.5, 1e30, "7", "x", "", None, True, [3], {"line": "y"}]
ENTRIES = [{}, None, "text", 5, [1], [], {"line": "z"}]


def _put(names, value):
    """An object with ``value`` at the place ``names``; ``x[0]`` stands for the first of a list."""
    for name in reversed(names):
        value = {name.removesuffix("[0]"): [value]} if name.endswith("[0]") else {name: value}
    return value


def _lists(listing):
    entries = [*ENTRIES, *[_put(path.removeprefix("$.").split("."), n) for path in listing.numbers for n in NUMBERS]]
    if not listing.child:
        return [entries, [], None, "none", {"a": 1}]
    child = listing.child.removeprefix("$.").split(".")
    return [[_put(child, kids), None, "odd", _put(child, None), {}] for kids in (entries, [], "none", {"a": 1}, 3)]


def _reports(tool):
    if tool in errors.MAPS:
        bodies = [{"vulnerabilities": v} for v in ({f"p{i}": e for i, e in enumerate(ENTRIES)}, {}, None, [], "x")]
    else:
        listing = errors.LISTINGS[tool]
        names = listing.path.removeprefix("$").removeprefix(".").split(".") if listing.path != "$" else []
        bodies = [_put(names, listed) for listed in _lists(listing)]
        if tool == "safety":
            bodies += [_put(path.removeprefix("$.").split("."), listed) for path in errors.SAFETY_PATHS for listed in _lists(listing)]
            bodies.append({"vulnerabilities": "x", "scanned_packages": {"vulnerabilities": [5]}})
        if tool.startswith("snyk"):
            bodies += [b for listed in _lists(listing) for b in listed if isinstance(b, dict)]
    texts = [json.dumps(b, indent=i % 3) for i, b in enumerate(bodies)]
    return [*texts, *[f" \n{t}\t" for t in texts], texts[0] + " x", texts[0][:-1], f"[{texts[0]}]", f"{texts[0]},{texts[0]}", "", " ", "null", "5", None]


def test_same_rows_as_a_parse_for_each_question(spark):
    tools = [*errors.LISTINGS, *errors.MAPS]
    rows = [("s", tool, ".", i, 0, text, "") for tool in tools for i, text in enumerate(_reports(tool))]
    reports = spark.createDataFrame(rows, RAW_REPORTS).coalesce(1)
    slow = F
    for tool in tools:
        each = errors._in_report(tool, errors.LISTINGS[tool]) if tool in errors.LISTINGS else errors._in_map(F.get_json_object("stdout", errors.MAPS[tool]))
        slow = slow.when(F.col("tool") == tool, each)
    listed = reports.where(readable(reports)).select("scan_id", "tool", "target", "seq", F.inline(slow)).select(errors.COLUMNS)
    expected = sorted(map(str, listed.collect()))
    whole = sorted([*expected, *map(str, errors.report_errors(reports).collect())])
    got = errors.unread(reports).collect()
    assert sorted(map(str, got)) == whole
    assert sorted(str(r) for r in got if r.reason != "report") == expected
    assert {r.tool for r in got if r.reason != "report"} == set(tools)


def test_reports_are_read_once(raw):
    reports = raw("tflint", "{}")
    plan = errors.result_errors(reports)._jdf.queryExecution().optimizedPlan().toString()
    assert not any("from_json" in line for line in plan.splitlines() if "Filter" in line), plan
    plan = errors.unread(reports)._jdf.queryExecution().optimizedPlan().toString()
    assert "Union" not in plan and plan.count("Generate") == 1, plan
