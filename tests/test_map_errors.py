"""Results that are kept as a map, where some cannot be read."""

from __future__ import annotations

from findlake.operators.errors import unread
from findlake.plans.scan_flow import normalize_all


def test_odd_npm_entries_are_listed(raw):
    reports = raw(
        "npm-audit",
        '{"vulnerabilities":{"good":{"severity":"high"},"odd":"text","five":5,"many":[1,2],"nothing":null}}',
        '{"vulnerabilities":["no map"]}',
        '{"vulnerabilities":{}}',
        '{"vulnerabilities":null}',
        "{}",
        code=1,
    )
    got = sorted((r.reason, r.position, r.text) for r in unread(reports).collect())
    assert got == [("entry", "five", "5"), ("entry", "many", "[1,2]"), ("entry", "odd", "text"), ("map", "", '["no map"]')]
    assert [r.rule_id for r in normalize_all(reports, None, {}).collect()] == ["npm-good"]
