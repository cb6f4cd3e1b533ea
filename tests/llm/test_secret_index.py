from __future__ import annotations

import hashlib
import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from findlake.llm import secret_index as s

RULES = s.BASE_RULES + s.MORE_RULES


def plain_spans(text):
    out = []
    for order, rule in enumerate(RULES):
        for m in re.finditer(rule.pattern, text or ""):
            if len(m[rule.group]) >= rule.least:
                out.append((m.start(), order, m.end()))
    return ",".join(f"{RULES[o].kind}:{a}:{b}" for a, o, b in sorted(out))


TEXTS = [
    None, "", "no secret", "PassWord = 'abcdefgh1'", "token=secret: longvalue1", "api_key: short", "apikey=12345678 api-key=12345678",
    "AKIA" + "A" * 11, "AKIA" + "Z9" * 6, "x" + "0123456789abcdef" * 2 + "y", "é" * 5 + "token:\x20\x20abcdefghij " + "f" * 40,
    "-----BEGIN RSA PRIVATE KEY-----", "ghp_" + "a1" * 18, "xoxb-1234567890", "AIza" + "b" * 35, "eyJhbGciOiJI.eyJzdWIiOiIx.abcdefgh_-1",
    "secret=" + "a" * 8 + " " + "secret=" + "b" * 9 + "\npasswd:12345678", "deadbeef" * 2000,
]


def test_spans_equal_plain_regex(spark, documents):
    rows = [(i, t) for i, t in enumerate(TEXTS)] + [(None, TEXTS[3]), (3, TEXTS[3]), (3, TEXTS[4])]
    got = s.digest(s.scan(documents(rows), RULES), RULES, 3).collect()
    assert sorted((str(r["doc_id"]), r["spans"]) for r in got) == sorted((str(i), plain_spans(t)) for i, t in rows)
    for r in got:
        base = [x for x in r["spans"].split(",") if x.split(":")[0] in ("assign", "access", "hex")]
        assert r["base_sha256"] == hashlib.sha256(",".join(base).encode()).hexdigest()
        assert [r["n_assign"], r["n_access"], r["n_hex"]] == [sum(x.startswith(k) for x in base) for k in ("assign", "access", "hex")]


def test_very_long_text_with_many_matches(spark, documents):
    text = "\n".join(hashlib.md5(str(i).encode()).hexdigest() + (" é token=abcdefgh" if i % 3 == 0 else "") for i in range(20_000))
    row = s.digest(s.scan(documents([(1, text)]), RULES), RULES, 3).first()
    assert row["spans"] == plain_spans(text)
    assert row["n_hex"] == 20_000 and row["n_assign"] == 6_667


def test_empty_table(spark, documents):
    assert s.scan(documents([]), RULES).count() == 0


def test_queries():
    assert s.trigram_query("[0-9a-f]+") is None
    assert s.trigram_query("abc|x") is None
    assert s.trigram_query("AKIA[A-Z0-9]+") == [frozenset({"aki", "kia"})]
    assert s.trigram_query("ab?cd") == [frozenset({"abc", "bcd"}), frozenset({"acd"})]
    assert s.trigram_query("(foo|bar)+baz") is not None


@settings(max_examples=200, deadline=None)
@given(st.from_regex(s.BASE_RULES[0].pattern), st.sampled_from(RULES[3:]), st.data())
def test_every_match_satisfies_its_query(text, rule, data):
    for r, t in ((s.BASE_RULES[0], text), (rule, data.draw(st.from_regex(rule.pattern)))):
        low = t.lower()
        assert any(all(x in low for x in need) for need in s.trigram_query(r.pattern))


@pytest.mark.parametrize("limit", [0, 1 << 30])
def test_shuffled_candidates_give_the_same(spark, documents, monkeypatch, limit):
    monkeypatch.setattr(s, "BROADCAST_BYTES", limit)
    got = s.digest(s.scan(documents([(i, t) for i, t in enumerate(TEXTS)]), RULES), RULES, 3).collect()
    assert {r["doc_id"]: r["spans"] for r in got} == {i: plain_spans(t) for i, t in enumerate(TEXTS)}
