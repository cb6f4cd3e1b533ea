from __future__ import annotations

from findlake.llm import line_dedup, quality_rules

from . import plain

LONG = " ".join(f"w{i}" for i in range(50))
FOOTER = "All rights reserved by the owner of this site"


def corpus():
    rows = [(i, f"title {i}\n{FOOTER}\n" + " ".join(f"a{i}b{j}" for j in range(30)), "busy") for i in range(30)]
    rows += [(100 + i, "only\n" + FOOTER + " " + "x y z " * 20 + f"\n{FOOTER}", "busy") for i in range(3)]
    rows += [(200 + i, LONG + "\n" + FOOTER, "copies") for i in range(30)]  # copies are no evidence
    rows += [(300, None, "busy"), (301, "", None), (302, " \t\n", "busy"), (303, "ab " * 60, "busy"), (304, "é# $\n" * 3 + LONG, None), (None, LONG, "busy")]
    # near copies in which any line may differ: two lines, one of them changed
    rows += [(400 + i, " ".join(f"a{j}" for j in range(60)) + "\n" + " ".join(f"b{j}" if j != i else "other" for j in range(60)), "near") for i in range(40)]
    rows += [(305, "\n".join([FOOTER] * 5) + "\nshort rest of only a few words", "busy"), (305, "another text under the same id " + LONG, "busy")]
    return rows + rows[:2] + [(306, LONG + " " + "v " * 20000, "busy")]


def test_quality_rules_equal_plain(spark, documents):
    rows = corpus()
    expected = plain.quality(rows)
    got = quality_rules.judged(documents(rows)).collect()
    assert len(got) == len(rows)
    key = lambda r: (str(r["doc_id"]), *[r[c] for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")], r["n_removed_words"], r["kept"])
    want = [(str(d), *expected[d, t, s][0].values(), expected[d, t, s][1], expected[d, t, s][2]) for d, t, s in rows]
    assert sorted(map(key, got)) == sorted(want)
    assert any(w[7] for w in want) and all(w[8] for w in want if len(w[0]) == 3 and w[0][0] == "2")
    assert all(w[8] and not w[7] for w in want if len(w[0]) == 3 and w[0][0] == "4")
    assert not next(w for w in want if w[0] == "305" and w[1] < 60)[8]


def test_line_dedup_equals_plain(spark, documents):
    a = [f"line {i}" for i in range(8)]
    rows = [
        (1, "\n".join(a)), (2, "\n".join(["new", *a[2:6], "tail", *a[2:6]])), (3, "\n".join(["LINE  3", "", " line 4 ", "line 5\t", "x"])),
        (4, "a\nb"), (5, None), (6, ""), (7, "s\n" * 9), (None, "\n".join(a[:4])), (1, "\n".join(a)), (1, "other\n" + "\n".join(a)),
        (8, "\n\n".join(a * 300)),
    ]
    got = line_dedup.dedup_lines(documents(rows)).collect()
    assert len(got) == len(rows)
    unique_ids = [r for r in rows if r[0] != 1]
    by_id = {r["doc_id"]: r for r in got if r["doc_id"] != 1}
    expected = plain.line_dedup(unique_ids + [rows[0]])
    for doc_id, text in unique_ids:
        assert by_id[doc_id]["text"] == expected[doc_id, text], doc_id
    ones = sorted(r["text"] for r in got if r["doc_id"] == 1)
    assert ones[0] == ones[1] or ones[1] == ones[2]  # repeated rows lose the same


def test_empty_tables(spark, documents):
    assert quality_rules.judged(documents([])).count() == 0
    assert line_dedup.dedup_lines(documents([])).count() == 0
