"""A report is read once, and only if it is one JSON value."""

from __future__ import annotations

import json

import pytest

from findlake.operators import normalize as n

from .test_normalize import FULL, rows

NESTED = {"trivy", "cfn-nag", "snyk-iac", "snyk-iac-template", "trivy-container"}
EXTRA = {"npm-audit": 4}  # texts of causes and fixes, per result


@pytest.mark.parametrize("tool", sorted(FULL))
def test_text_around_a_report_makes_it_unreadable(raw, tool):
    whole = json.dumps(FULL[tool][0])
    broken = [f"{whole} x", f"{whole}] x", f"{whole}}} x", f"{whole},{whole}", f"{whole},", whole[:-1], f"[{whole}", f"{whole}],[1",
              f'{whole},"x":1', f'{whole}],"x":[[1', "null", "5", '"x"', "'x'", whole.replace('"', "'")]
    code = 1
    assert rows(n.NORMALIZERS[tool](raw(tool, *broken, code=code), {})) == []
    assert len(rows(n.NORMALIZERS[tool](raw(tool, *broken, f" \n{whole}\t", code=code), {}))) == 1
    listed = {r.stdout for r in n.parse_errors(raw(tool, *broken, whole)).collect()}
    assert listed == set(broken)


@pytest.mark.parametrize("tool", sorted(FULL))
def test_one_parse_of_a_report_and_one_of_a_result(raw, tool):
    plan = n.NORMALIZERS[tool](raw(tool, json.dumps(FULL[tool][0]), code=1), {})._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_json") == 2 + (tool in NESTED) + EXTRA.get(tool, 0), plan


def test_safety_lists_and_objects(raw):
    item = {"cve": "CVE-1", "package": "p"}
    outputs = [json.dumps([item]), json.dumps({"vulnerabilities": [item]}), json.dumps({"scanned_packages": {"vulnerabilities": [item]}}),
               '{"listed":[[{"cve":"x"}],["findlake_whole"]]}', '[{}]],"vulnerabilities":[{}],"x":[[1]', "[]", "{}"]
    assert [r["seq"] >> n.POSITION_BITS & 7 for r in rows(n.safety(raw("safety", *outputs)))] == [0, 1, 2]


ODD = ["null", "5", "true", '"x"', "[1]", "{}", '{"a":1}', '["s"]']
KIDS = '[{"ID":"A","id":"A","VulnerabilityID":"A"}]'
PARENTS = {
    "trivy": ("Target", "Misconfigurations", '{"Results":[%s]}'),
    "trivy-container": ("Target", "Vulnerabilities", '{"Results":[%s]}'),
    "cfn-nag": ("filename", "file_results", "[%s]"),
    "snyk-iac": ("targetFile", "infrastructureAsCodeIssues", "[%s]"),
}


@pytest.mark.parametrize("tool", sorted(PARENTS))
def test_parents_are_read_at_once_and_an_odd_one_hides_no_other(raw, tool):
    name, child, report = PARENTS[tool]
    kids = '{"violations":%s}' % KIDS if tool == "cfn-nag" else KIDS
    good = '{"%s":"good","%s":%s}' % (name, child, kids)
    odd = [*ODD, *['{"%s":%s,"%s":%s}' % (name, o, child, kids) for o in ODD], *['{"%s":"f","%s":%s}' % (name, child, o) for o in ODD]]
    found = n.NORMALIZERS[tool](raw(tool, *[report % f"{good},{o},{good}" for o in odd], report % ",".join([good, *odd])), {})
    per_report = {i: 0 for i in range(len(odd) + 1)}
    for r in rows(found):
        per_report[r["seq"] >> n.POSITION_BITS & 63] += 1
    named = range(len(ODD), 2 * len(ODD))  # an odd name leaves the children there
    assert per_report == {**{i: 3 if i in named else 2 for i in range(len(odd))}, len(odd): 1 + len(ODD)}
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "THEN from_json(" not in plan, plan  # one parse for all parents, not one for each


@pytest.mark.parametrize("text", [r"{", r"{oops", r"{},{", r"{},{}", r"{\"a\":1} x", r"\u007b\"a\":", r"\u007B"])
@pytest.mark.parametrize("tool", sorted(PARENTS))
def test_a_text_that_begins_like_a_parent_hides_no_other(raw, tool, text):
    name, child, report = PARENTS[tool]
    kids = '{"violations":%s}' % KIDS if tool == "cfn-nag" else KIDS
    good = '{"%s":"good","%s":%s}' % (name, child, kids)
    found = rows(n.NORMALIZERS[tool](raw(tool, report % f'"{text}",{good}', report % f'{good},"{text}",{good}'), {}))
    assert sorted(r["seq"] >> n.POSITION_BITS & 1 for r in found) == [0, 1, 1]
