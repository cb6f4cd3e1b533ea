from __future__ import annotations

import random
import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from findlake.llm import license_scan
from findlake.llm.license_texts import BASE_PHRASES, TEMPLATES

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def plain_words(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return WORD.findall(low)


def plain_places(text):
    """(label, start) of every base phrase, by comparing words at every place."""
    words = plain_words(text)
    found = []
    for phrase, label in BASE_PHRASES:
        want = phrase.split()
        found += [(label, i) for i in range(len(words)) if words[i : i + len(want)] == want]
    return sorted(found)


def longest_ending(words, i, sequence, place):
    n = 0
    while n <= min(i, place) and words[i - n] == sequence[place - n]:
        n += 1
    return n


def plain_matches(words, sequence, least):
    """Runs that neither side can continue, of ``least`` words or more: (start, place, words)."""
    found = set()
    for i in range(len(words)):
        for j in range(len(sequence)):
            n = longest_ending(words, i, sequence, j)
            further = i + 1 < len(words) and j + 1 < len(sequence) and words[i + 1] == sequence[j + 1]
            if n >= least and not further:
                found.add((i + 1 - n, j + 1 - n, n))
    return found


def best_chain(matches, gap):
    """Words covered by the best chain, by trying every predecessor."""
    best = {}
    for m in sorted(matches, key=lambda m: (m[0] + m[2], m[0], m[1])):
        start, place, n = m
        best[m] = n
        for (s, p, k), b in list(best.items()):
            shared = max(0, s + k - start, p + k - place)
            if (s, p, k) != m and shared < n and s < start and p < place and start - s - k <= gap and place - p - k <= gap:
                best[m] = max(best[m], b + n - shared)
    return max(best.values(), default=0)


few = st.lists(st.sampled_from("abcd"), max_size=30)


@settings(max_examples=300, deadline=None)
@given(st.lists(few.filter(bool), min_size=1, max_size=4), few)
def test_matching_statistics(sequences, words):
    automaton = license_scan.Automaton(sequences)
    state = run = 0
    for i, w in enumerate(words):
        while state and w not in automaton.next[state]:
            state = automaton.link[state]
            run = automaton.length[state]
        if w in automaton.next[state]:
            state, run = automaton.next[state][w], run + 1
        want = {(s, j): longest_ending(words, i, seq, j) for s, seq in enumerate(sequences) for j in range(len(seq))}
        assert run == max(want.values())
        assert {p: min(n, run) for p, n in automaton.runs(state, 1).items()} == {p: n for p, n in want.items() if n}


@settings(max_examples=300, deadline=None)
@given(st.lists(few.filter(lambda s: len(s) > 3), min_size=1, max_size=3), few)
def test_matches_and_chains(sequences, words):
    scanner = license_scan.Scanner([], [(str(i), " ".join(s)) for i, s in enumerate(sequences)])
    n, places, spans = scanner.scan(" ".join(words).encode())
    assert n == len(words) and places == []
    for i, s in enumerate(sequences):
        covered = best_chain(plain_matches(words, s, license_scan.LEAST), license_scan.GAP)
        mine = [c for label, *_, c, _ in spans if label == str(i)]
        if covered >= license_scan.COVERED * len(s):
            assert max(mine) == covered
        else:
            assert mine == []


@settings(max_examples=200, deadline=None)
@given(st.text(st.sampled_from("aB9 é\n.-▁日"), max_size=60), st.integers(1, 9))
def test_blocks_cut_no_word(text, size):
    assert [w.decode() for block in license_scan.blocks(text.encode(), size) for w in block] == plain_words(text)


def notices():
    chance = random.Random(3)
    words = "the license mit apache gnu general public cc by of Licensed under é 4".split()
    rows = [(i, " ".join(chance.choice(words) for _ in range(chance.randrange(120)))) for i in range(60)]
    rows += [(100 + i, f"Some words.\n{text}\nMore words.") for i, (_, text) in enumerate(TEMPLATES)]
    rows += [(200, None), (201, ""), (202, "GNU-General\nPUBLIC License"), (202, "GNU-General\nPUBLIC License"), (None, "the MIT license")]
    return rows + [(203, "x " * 300_000 + "CC BY"), (204, "mit licenses"), (205, "cc by cc by")]


def test_documents(spark, documents):
    rows = notices()
    got = license_scan.digest(license_scan.scan(documents(rows))).collect()
    assert len(got) == len(rows)
    text = dict(rows)
    for r in got:
        places = plain_places(text[r["doc_id"]])
        assert r["n_words"] == len(plain_words(text[r["doc_id"]])) and r["n_base"] == len(places)
        assert (r["first_word"], r["last_word"]) == ((min(p for _, p in places), max(p for _, p in places)) if places else (None, None))
        assert r["base_labels"] == ",".join(sorted({label for label, _ in places}))
        assert set(r["base_labels"].split(",")) - {""} <= set(r["labels"].split(",")) and 0 <= r["score"] <= 1
        if r["doc_id"] is not None and 100 <= r["doc_id"] < 200:
            assert TEMPLATES[r["doc_id"] - 100][0] in r["labels"].split(",") and r["score"] == 1
    assert license_scan.digest(license_scan.scan(documents([]))).count() == 0


def test_a_changed_notice_is_still_found_and_another_is_not(spark, documents):
    mit = dict(TEMPLATES)["mit-text"]
    words = mit.split()
    changed = " ".join(w for i, w in enumerate(words) if i % 17)  # every seventeenth word is gone
    turned = " ".join(reversed(words))
    found = license_scan.scan(documents([(1, changed), (2, turned), (3, " ".join(words[:20]))])).collect()
    spans = {r["doc_id"]: [(s["label"], s["start"], s["end"]) for s in r["spans"]] for r in found}
    assert [label for label, *_ in spans[1]] == ["mit-text"] and spans[2] == [] and spans[3] == []


@pytest.mark.parametrize("sf", ["/root/testdata/sf0.001"])
def test_query_equals_brute_force(spark, sf):
    import duckdb

    from findlake.llm.queries import QUERIES

    text = dict(duckdb.connect().execute(f"SELECT doc_id, text FROM '{sf}/documents.parquet'").fetchall())
    got = {r["doc_id"]: r for r in QUERIES["op13_license_automaton"](spark, sf).collect()}
    assert got.keys() == text.keys()
    scanner = license_scan.Scanner(BASE_PHRASES, TEMPLATES)
    for d, t in text.items():
        words, places = plain_words(t), plain_places(t)
        assert (got[d]["n_words"], got[d]["n_base"], got[d]["base_labels"]) == (len(words), len(places), ",".join(sorted({x for x, _ in places})))
        labels = {x for x, _ in places}
        for label, sequence in scanner.templates:
            sequence = [w.decode() for w in sequence]
            if set(sequence) & set(words) and best_chain(plain_matches(words, sequence, license_scan.LEAST), license_scan.GAP) >= license_scan.COVERED * len(sequence):
                labels.add(label)
        assert got[d]["labels"] == ",".join(sorted(labels))
