from __future__ import annotations

import hashlib
import random
import re
import zlib
from collections import defaultdict

import pytest

from findlake.llm import prefix_trie
from findlake.llm.queries import QUERIES



WORD = re.compile("[^ \t-\r]+")


def plain_nodes(conversations):
    """Every node by a dictionary of prefixes; ``conversations`` maps an id to its (role, text) turns."""
    members, ends = defaultdict(list), defaultdict(list)
    for c, turns in conversations.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
        ends[tuple(turns)].append(c)
    below = defaultdict(list)
    for node in members:
        if node:
            below[node[:-1]].append(node)

    def least(node):
        return min((c for c in members[node] if c is not None), default=None)

    out, totals = [], {}
    for node in sorted(members, key=len, reverse=True):
        own = (len(members[node]) - 1) * len(WORD.findall(node[-1][1])) if node else 0
        leaves = sum(totals[b][0] for b in below[node]) or 1
        saved = own + sum(totals[b][1] for b in below[node])
        totals[node] = (leaves, saved)
        ids = sorted(ends[node], key=lambda c: (c is not None, c))
        text = ",".join("null" if c is None else str(c) for c in ids)
        parent = least(node[:-1]) if node else None
        out.append((least(node), len(node), parent, len(members[node]), len(below[node]), leaves, saved, hashlib.sha256(text.encode()).hexdigest()))
    return sorted(out, key=str)


def rebuilt(own):
    """Starts borrowed by the rule of the query."""
    out = {}
    for c, turns in own.items():
        h = 0 if c is None else zlib.crc32(str(c).encode()) % 4
        out[c] = (own.get(c - c % 20, [])[:h] if c is not None else []) + turns[h:]
    return out


def by_number(rows):
    own = defaultdict(list)
    for c, _, role, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or 0)):
        own[c].append((role or "", text or ""))
    return dict(own)


def check(spark, rows, ranges, fan=256, borrow=True):
    table = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string")
    for clash in ("key", "path", "words", "part", "n"):
        table = table.selectExpr("*", f"'x' AS {clash}")
    turns = prefix_trie.ordered_turns(table)
    turns = prefix_trie.with_borrowed_starts(turns) if borrow else turns
    got = prefix_trie.nodes(prefix_trie.paths(turns), ranges, fan).collect()
    want = plain_nodes(rebuilt(by_number(rows)) if borrow else by_number(rows))
    assert sorted(map(tuple, got), key=str) == want


def crowd(seed, size, texts=3, most=5):
    chance = random.Random(seed)
    return [(c, t, chance.choice(["user", "assistant"]), chance.choice(["a", "b c", "", None, "d e f"][:texts])) for c in range(size) for t in range(chance.randrange(most + 1))]


@pytest.mark.parametrize("ranges,fan", [(1, 256), (7, 256), (23, 3), (40, 2)])
def test_equals_brute_force_however_it_is_cut(spark, ranges, fan):
    check(spark, crowd(ranges, 150), ranges, fan)


@pytest.mark.parametrize("seed", range(4))
def test_few_texts_and_deep_paths(spark, seed):
    check(spark, crowd(seed, 60, 2, 12), 9, 2, borrow=False)


def test_one_group_of_copies_spans_ranges(spark, monkeypatch):
    monkeypatch.setattr(prefix_trie, "PIECE", 7)
    rows = [(c, t, "user", f"same {t}") for c in range(120) for t in range(3)] + [(c, 0, "user", f"other {c % 3}") for c in range(200, 230)]
    check(spark, rows, 16, 4, borrow=False)


def test_nulls_ties_and_none(spark):
    rows = [(1, None, "user", "first"), (1, 0, None, None), (2, 5, "user", "first"), (None, 0, "user", "first"), (20, 1, "a", "x"), (20, 2, "b", "y"), (20, 3, "c", "z"), (27, 1, "only", "one")]
    check(spark, rows, 3)
    check(spark, rows + [(9, 0, "user", "t" * 100_000)], 2)
    twice = [(1, 0, "user", "b"), (1, 0, "user", "a"), (1, 0, "user", "a"), (2, 0, "user", "a"), (2, 0, "user", "b"), (2, 0, "user", "a")]
    table = spark.createDataFrame(twice, "conv_id bigint, turn bigint, role string, text string")
    got = prefix_trie.nodes(prefix_trie.paths(prefix_trie.ordered_turns(table))).collect()
    assert [r["n_convs"] for r in got] == [2, 2, 2, 2]  # the same three turns, in one order
    assert prefix_trie.nodes(prefix_trie.paths(prefix_trie.ordered_turns(table.where("false")))).count() == 0


def test_a_long_conversation(spark):
    rows = [(1, t, "user", str(t)) for t in range(3000)] + [(2, t, "user", str(t)) for t in range(2990)] + [(3, 0, "user", "x")]
    check(spark, rows, 2, borrow=False)


def test_query_equals_brute_force(spark):
    import duckdb

    sf = "/root/testdata/sf0.001"
    rows = duckdb.connect().execute(f"SELECT conv_id, turn, role, text FROM '{sf}/conversations.parquet'").fetchall()
    got = sorted(map(tuple, QUERIES["op12_prefix_trie"](spark, sf).collect()), key=str)
    assert got == plain_nodes(rebuilt(by_number(rows)))
