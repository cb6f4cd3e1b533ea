from __future__ import annotations

import random

import numpy as np
import pytest

from findlake.llm import simhash_anchors as s
from findlake.llm.components import components

from . import plain


def near_texts():
    chance = random.Random(3)
    rows = []
    for group in range(6):
        words = [f"g{group}w{chance.randrange(400)}" for _ in range(300)]
        for copy in range(12):
            changed = list(words)
            for _ in range(copy // 2):
                changed[chance.randrange(300)] = f"c{copy}"
            rows.append((1000 - len(rows), " ".join(changed)))
    return rows


def test_groups_equal_plain(spark, documents):
    rows = near_texts() + [(5, None), (3, ""), (9, " \n"), (20, "a"), (21, "A"), (22, "b c"), (None, "a"), (20, "a"), (20, "other words here now again"), (30, "É é x y z " * 4000)]
    got = s.near_duplicates(documents(rows)).collect()
    want = [(str(d), f"{f:016x}", str(c)) for d, f, c in plain.near_groups(rows)]
    assert sorted((str(r[0]), r[1], str(r[2])) for r in got) == sorted(want)


@pytest.mark.parametrize("parts, slice_size", [(3, s.SLICE), (2, s.SLICE), (3, 7)])
def test_no_link_is_lost(spark, parts, slice_size):
    chance = np.random.default_rng(5)
    base = chance.integers(0, 1 << 63, 60, dtype=np.uint64)
    values = [base]
    for bits in range(1, 7):
        more = base.copy()
        for i in range(len(more)):
            for b in chance.choice(64, bits, replace=False):
                more[i] ^= np.uint64(1) << np.uint64(b)
        values.append(more)
    hot = base[0] ^ (np.uint64(1) << np.arange(20, dtype=np.uint64))  # a crowd around one value
    values = np.unique(np.concatenate([*values, hot, np.zeros(1, np.uint64)]))
    signed = [int(v) for v in values.view(np.int64)]
    df = spark.createDataFrame([(v,) for v in signed], "fp bigint")
    root = {r["node"]: r["root"] for r in components(s.links(df, parts, slice_size)).collect()}
    up = {v: v for v in signed}

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    near = np.bitwise_count(values[:, None] ^ values[None, :]) <= 4
    for i, j in zip(*np.nonzero(near)):
        up[find(signed[i])] = find(signed[j])
    same = {}
    for v in signed:
        same.setdefault(find(v), set()).add(root.get(v, v))
    assert all(len(roots) == 1 for roots in same.values())
    assert len({next(iter(r)) for r in same.values()}) == len(same)


def test_components_of_a_path_a_star_and_nothing(spark):
    path = [(i, i + 1) for i in range(60)]
    star = [(1000, 1000 + i) for i in range(1, 200)] + [(1005, 1005), (1006, 1000)]
    roots = {r["node"]: r["root"] for r in components(spark.createDataFrame(path + star, "a bigint, b bigint")).collect()}
    assert {roots[i] for i in range(61)} == {0} and {roots[1000 + i] for i in range(200)} == {1000}
    assert components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0


def test_empty_table(spark, documents):
    assert s.near_duplicates(documents([])).count() == 0
