from __future__ import annotations

import math
import random
from collections import Counter

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from findlake.llm import packing, token_ids
from findlake.llm.queries import tokenizer_path

from . import plain


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(tokenizer_path())


def odd_texts():
    chance = random.Random(1)
    out = ["", " ", "\n", "a", "a\n", "a ", "\na", " a", "a  <|endoftext|> b", "x\n\n y\t\tz  ", " a  b\x1c\x1dc \x85d\xa0 e", "don't  we'll\r\n\r\nI've 12½ 一二", "w" * 90_000]
    out += ["".join(chance.choice(" \n\t\x1c\x85\xa0ab'sé1½,.!<|　 ­") for _ in range(40)) for _ in range(300)]
    return out + ["".join(chance.choice(["ab", " c", "\nd", " 'll", "!!", " é", "½", "'s", " 日本"]) for _ in range(20)) for _ in range(300)]


@pytest.mark.parametrize("by_rank", [True, False])
def test_ids_are_the_tokenizers(tokenizer, by_rank):
    encoder = token_ids.Encoder(tokenizer_path())
    assert encoder.ranks is not None
    if not by_rank:
        encoder.ranks = None
    texts = odd_texts()
    want = [e.ids for e in tokenizer.encode_batch(texts, add_special_tokens=False)]
    for _ in range(2):  # the second time from what is kept
        assert [ids.tolist() for ids in encoder.encode(texts)] == want
    assert encoder.encode([]) == []


@settings(max_examples=300, deadline=None)
@given(st.dictionaries(st.integers(1, 64), st.integers(1, 500), max_size=40))
def test_plan_places_every_piece_once(counts):
    kinds = packing.plan(counts, 64)
    placed = Counter()
    for many, recipe in kinds:
        assert many > 0 and sum(n * c for n, c in recipe) <= 64
        assert sum(c for n, c in recipe if 3 * n > 64) <= 2
        for n, c in recipe:
            placed[n] += many * c
    assert placed == Counter(counts)
    assert len(kinds) <= 6 * 64
    used, total = sum(m for m, _ in kinds), sum(n * c for n, c in counts.items())
    over_half = sum(c for n, c in counts.items() if 2 * n > 64)  # no two of these fit together
    assert used <= 1.5 * max(math.ceil(total / 64), over_half) + 1


def test_cut():
    assert packing.cut(1, 2048) == [(0, 1)] and packing.cut(2048, 2048) == [(0, 2048)]
    assert packing.cut(5000, 2048) == [(0, 904), (904, 2048), (2952, 2048)]


def test_every_document_is_packed(spark, documents, tokenizer, monkeypatch):
    monkeypatch.setattr(packing, "BUCKET_ROWS", 7)
    chance = random.Random(4)
    rows = [(i, " ".join(f"w{chance.randrange(999)}" for _ in range(chance.choice([1, 5, 40, 300, 900, 5000])))) for i in range(60)]
    rows += [(100, None), (101, ""), (102, "same"), (103, "same")]
    ids = {d: tokenizer.encode(t or "", add_special_tokens=False).ids + [0] for d, t in rows}
    got = [r.asDict() for r in packing.pack(documents(rows), tokenizer_path()).collect()]
    assert plain.check_packing(got, ids) <= math.ceil(sum(map(len, ids.values())) / 2048) + 2


def test_repeated_rows_null_ids_and_none(spark, documents):
    got = packing.pack(documents([(1, "a b"), (1, "a b"), (None, "c"), (None, None)]), tokenizer_path()).collect()
    assert len(got) == 4 and len({(r["sequence_id"], r["offset"]) for r in got}) == 4
    assert packing.pack(documents([]), tokenizer_path()).count() == 0


def test_query_packs_the_table(spark, tokenizer):
    import duckdb

    from findlake.llm.queries import QUERIES

    sf = "/root/testdata/sf0.001"
    docs = duckdb.connect().execute(f"SELECT doc_id, text FROM '{sf}/documents.parquet'").fetchall()
    ids = {d: tokenizer.encode(t, add_special_tokens=False).ids + [0] for d, t in docs}
    rows = [r.asDict() for r in QUERIES["op8_packing"](spark, sf).collect()]
    assert plain.check_packing(rows, ids) <= math.ceil(sum(map(len, ids.values())) / 2048) + 2
