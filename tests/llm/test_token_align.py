from __future__ import annotations

import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

import public_tokenizers
from findlake.llm import token_align, token_ids
from findlake.llm.queries import QUERIES

from .test_packing import odd_texts

FIRST, SECOND = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def plain():
    """A text's ids and token bytes by the two libraries alone."""
    import sentencepiece
    from tokenizers import Tokenizer

    one, two = Tokenizer.from_file(FIRST), sentencepiece.SentencePieceProcessor(model_file=SECOND)
    one.encode_special_tokens = True
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    byte = {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in printable)}

    def tokens(text):
        if not text:
            return [], []
        a = [(i, bytes(byte[c] for c in one.id_to_token(i))) for i in one.encode(" " + text, add_special_tokens=False).ids]
        b = [(i, bytes([int(two.id_to_piece(i)[3:5], 16)]) if two.is_byte(i) else two.id_to_piece(i).replace("▁", " ").encode()) for i in two.encode(text)]
        want = (" " + text).encode()
        return (a, b) if b"".join(t for _, t in a) == want == b"".join(t for _, t in b) else ([], [])

    return tokens


def cut(a, b):
    """Groups by walking both sides to the next common end."""
    groups, i, j = [], 0, 0
    while i < len(a):
        x, y, at_a, at_b = [a[i][0]], [b[j][0]], len(a[i][1]), len(b[j][1])
        i, j = i + 1, j + 1
        while at_a != at_b:
            if at_a < at_b:
                x.append(a[i][0])
                at_a += len(a[i][1])
                i += 1
            else:
                y.append(b[j][0])
                at_b += len(b[j][1])
                j += 1
        groups.append((x, y))
    return groups


def expected(texts, tokens):
    all_groups = [cut(*tokens(t)) for t in texts]
    counts = Counter()
    for groups in all_groups:
        counts.update({(x, y) for a, b in groups for x in a for y in b})
    best = defaultdict(int)
    for (x, _), n in counts.items():
        best[x] = max(best[x], n)
    out = []
    for groups in all_groups:
        links = [counts[x, y] == best[x] and (1, counts[x, y]) or (0, counts[x, y]) for a, b in groups for x in a for y in b]
        text = ";".join(",".join(map(str, a)) + "|" + ",".join(map(str, b)) for a, b in groups)
        out.append(
            (sum(len(a) for a, _ in groups), sum(len(b) for _, b in groups), len(groups), len(links), sum(n for n, _ in links),
             sum(c for _, c in links), hashlib.sha256(text.encode()).hexdigest() if groups else "")
        )
    return out


COLUMNS = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


def odd():
    return odd_texts() + ["▁", "a▁b", "<s> </s> <unk> <0x41>", "<|endoftext|>", "x <|endoftext|>\ny", "日本語のテキスト", "🦊🦊 ünï\u0000ø", "ﬁ Ａ"]


def test_piece_ids_are_the_tokenizers(plain):
    coder = token_ids.PieceEncoder(SECOND)
    assert coder.by_word and coder.newline == 1
    texts = odd()
    for _ in range(2):
        got = coder.encode([" " + t for t in texts])
        for text, ids in zip(texts, got):
            want = [i for i, _ in plain(text)[1]]
            if want:
                assert ids.tolist() == want, repr(text)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.integers(1, 5), min_size=1, max_size=40), st.randoms())
def test_pointers_reach_the_end_of_each_group(sizes, chance):
    total = sum(sizes)
    a = np.cumsum(sizes)
    b = np.array(sorted({total, *(chance.randrange(1, total + 1) for _ in range(chance.randrange(40)))}))
    label = token_align.labels(a, b)
    both = np.array([total if (c := [e for e in a if e in set(b.tolist()) and e >= x]) == [] else min(c) for x in [*a, *b]])
    assert (np.concatenate([a, b])[label] == both).all()


@pytest.mark.parametrize("frequent,links", [(None, None), (40, None), (0, 5), (1000, 3)])
def test_documents(spark, documents, plain, monkeypatch, frequent, links):
    if links:
        monkeypatch.setattr(token_align, "LINKS", links)
    chance = random.Random(5)
    texts = [None, "", *odd()[:: 1 if links is None else 40], *(" ".join(chance.choice(["the", "Haus", "naïve", "12½", "l'eau", "\n"]) for _ in range(chance.randrange(60))) for _ in range(30)), "same", "same"]
    rows = list(enumerate(texts)) + [(None, "no id")]
    got = {}
    for r in token_align.aligned(documents(rows), FIRST, SECOND, frequent).collect():
        got[r["doc_id"]] = tuple(r[c] for c in COLUMNS)
    want = expected([t for _, t in rows], plain)
    assert len(got) == len(rows)
    for (d, text), w in zip(rows, want):
        assert got[d] == w, (d, text)
    assert token_align.aligned(documents([]), FIRST, SECOND).count() == 0


def test_repeated_rows_count_twice(spark, documents):
    got = token_align.aligned(documents([(1, "a b"), (1, "a b"), (2, "a")]), FIRST, SECOND).collect()
    assert sorted(r["count_sum"] for r in got) == [3, 5, 5]


def test_one_group_of_very_many_tokens(plain, monkeypatch):
    """All links of a text whose tokens never end together, in slices."""
    found = token_align.Portion(["a b c d e f"], token_ids.encoder(FIRST, True), token_ids.piece_encoder(SECOND))
    found.p, found.q, found.groups = np.array([found.n_a[0]]), np.array([found.n_b[0]]), np.array([0, 1])
    whole = list(found.pairs(0, 32000))
    monkeypatch.setattr(token_align, "LINKS", 4)
    parts = list(found.pairs(0, 32000))
    assert len(whole) == 1 and len(parts) > 1
    for i in (0, 1):
        assert np.concatenate([p[i] for p in parts]).tolist() == whole[0][i].tolist()


def test_alignment(spark, documents, plain):
    text = "Über l'eau, naïve 日本"
    row = token_align.align(documents([(1, text), (2, None)]), FIRST, SECOND).orderBy("doc_id").collect()
    groups = cut(*plain(text))
    assert row[0]["a_ids"] == [i for a, _ in groups for i in a] and row[0]["b_ids"] == [i for _, b in groups for i in b]
    assert row[0]["a_sizes"] == [len(a) for a, _ in groups] and row[0]["b_sizes"] == [len(b) for _, b in groups]
    assert row[1]["a_ids"] == [] and row[1]["b_sizes"] == []


def test_query_equals_brute_force(spark, plain):
    import duckdb

    docs = duckdb.connect().execute("SELECT doc_id, text FROM '/root/testdata/sf0.001/documents.parquet'").fetchall()
    got = {r["doc_id"]: tuple(r[c] for c in COLUMNS) for r in QUERIES["op11_token_align"](spark, "/root/testdata/sf0.001").collect()}
    assert got == dict(zip((d for d, _ in docs), expected([t for _, t in docs], plain)))
