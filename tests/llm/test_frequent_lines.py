"""Lines that too many documents of a host share, in hosts where the count is easily led astray."""

from __future__ import annotations

import random

import pytest

from findlake.llm import quality_rules

from . import plain

FOOTER = "all rights reserved by the owner of this site"


def words(name, n):
    return " ".join(f"{name}x{i}" for i in range(n))


def judged(documents, rows):
    return {r["doc_id"]: r for r in quality_rules.judged(documents(rows)).collect()}


def test_copies_neither_add_to_a_count_nor_veto_it(spark, documents):
    rows = [(i, f"{FOOTER}\n{words(f'a{i}', 40)}", "site") for i in range(30)]
    rows += [(100 + i, f"{FOOTER}\n{words('copied', 40)}", "site") for i in range(90)]
    rows += [(300 + i, f"{FOOTER}\n{words(f'b{i // 40}', 40)}", "few texts") for i in range(120)]
    got = judged(documents, rows)
    assert all(r["n_removed_words"] == (9 if d < 300 else 0) and r["kept"] for d, r in got.items())


def test_lines_of_hosts_with_ten_shared_lines(spark, documents):
    shared = [words(f"s{j}", 8) for j in range(10)]
    rows = [(i, "\n".join([*shared, words(f"a{i}", 20)]), "depleted") for i in range(60)]
    rows += [(100 + i, "\n".join([*shared, words(f"b{i}", 200)]), None) for i in range(60)]
    got = judged(documents, rows)
    assert all(r["n_removed_words"] == 80 for r in got.values())
    assert all(r["kept"] == (d >= 100) for d, r in got.items())


def test_near_copies_are_no_evidence_and_no_veto(spark, documents):
    base = [words(f"n{j}", 60).split(" ") for j in range(8)]

    def near(i):
        changed = [list(x) for x in base]
        changed[i % 8][i // 8 % 60] = f"new{i}"
        return "\n".join([FOOTER, *map(" ".join, changed)])

    rows = [(i, near(i), "near") for i in range(400)]
    rows += [(1000 + i, near(i), "both") for i in range(400)]
    rows += [(2000 + i, f"{FOOTER}\n{words(f'a{i}', 40)}", "both") for i in range(30)]
    got = judged(documents, rows)
    assert all(r["kept"] and r["n_removed_words"] == (0 if d < 1000 else 9) for d, r in got.items())


@pytest.mark.parametrize("own", [5, 10, 12, 13, 40])
def test_hosts_with_hardly_anything_of_their_own(spark, documents, own):
    shared = [words(f"s{j}", 12) for j in range(10)]
    rows = [(i, "\n".join([*shared, words(f"a{i}", own)]), "thin") for i in range(200)]
    got = judged(documents, rows)
    assert all(r["n_removed_words"] == 120 and r["kept"] == (own == 40) or own == 40 and r["n_removed_words"] == 120 for r in got.values())
    assert not any(r["kept"] for r in got.values()) or 100 * own >= 30 * (own + 120)


def test_own_lines_that_begin_alike_are_own(spark, documents):
    rows = [(i, f"{FOOTER}\n{words('s', 9)}\n{words('intro', 9)} {words(f'a{i}', 40)}", "site") for i in range(200)]
    got = judged(documents, rows)
    assert all(r["n_removed_words"] == 18 and r["kept"] for r in got.values())


@pytest.mark.parametrize("length", [6, 12, 30])
def test_near_copies_of_short_lines_stay(spark, documents, length):
    """Three words in a hundred are changed; a page number differs."""
    chance = random.Random(length)
    base = [words(f"n{j}", length).split(" ") for j in range(300 // length)]
    rows = []
    for i in range(150):
        lines = [[f"new{i}x{j}x{k}" if chance.random() < 0.03 else w for k, w in enumerate(line)] for j, line in enumerate(base)]
        rows.append((i, "\n".join([*map(" ".join, lines), f"page {i}"]), "near"))
    got = judged(documents, rows)
    assert all(r["kept"] and r["n_removed_words"] == 0 for r in got.values())


def test_equals_the_plain_rule(spark, documents):
    chance = random.Random(1)
    pool = [words(f"p{j}", chance.choice([2, 5, 9, 14])) for j in range(8)]
    rows = []
    for i in range(400):
        lines = [chance.choice(pool) for _ in range(chance.randrange(6))]
        lines += [" ".join(chance.choice([*"ab", *(f"u{i}v{k}" for k in range(9))]) for _ in range(chance.randrange(1, 14))) for _ in range(chance.randrange(3))]
        rows.append((i, "\n".join(lines), chance.choice(["x", "y", None])))
    want = plain.quality(rows)
    got = judged(documents, rows)
    assert {d: (r["n_removed_words"], r["kept"]) for d, r in got.items()} == {d: want[d, t, s][1:3] for d, t, s in rows}
    assert sum(w[1] > 0 for w in want.values()) > 100
