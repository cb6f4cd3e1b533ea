"""The pipeline against the same steps over plain lists."""

from __future__ import annotations

import math
import os
from collections import Counter

import duckdb
import pytest

from . import plain

SF = "/root/testdata/sf0.001"


def expected_documents(docs, items):
    """(doc_id, text) that reach the packing."""
    verdicts = plain.quality(docs)
    kept = [(d, verdicts[d, t, s][3]) for d, t, s in docs if verdicts[d, t, s][2]]
    left = plain.line_dedup(kept)
    kept = [(d, left[d, t]) for d, t in kept]
    groups = plain.near_groups(kept)
    kept = [row for row, (d, _, smallest) in zip(kept, groups) if d == smallest]
    bad = {d for d, _ in plain.contaminated(kept, items)}
    return [row for row in kept if row[0] not in bad]


def test_whole_pipeline(spark):
    import corpus_pipeline
    from findlake.llm.queries import tokenizer_path
    from tokenizers import Tokenizer

    db = duckdb.connect()
    docs = db.execute(f"SELECT doc_id, text, source FROM '{SF}/documents.parquet' ORDER BY doc_id").fetchall()
    items = db.execute(f"SELECT item_id, text FROM '{SF}/benchmark.parquet'").fetchall()
    expected = expected_documents(docs, items)
    assert 0 < len(expected) < len(docs)
    tokenizer = Tokenizer.from_file(tokenizer_path())
    ids = {d: tokenizer.encode(t, add_special_tokens=False).ids + [0] for d, t in expected}
    rows = [r.asDict() for r in corpus_pipeline.run(spark, SF).collect()]
    sequences = plain.check_packing(rows, ids)
    assert sequences <= 1.02 * math.ceil(sum(map(len, ids.values())) / 2048) + 1


def test_stages_keep_columns_and_handle_odd_rows(spark, documents, tmp_path):
    import corpus_pipeline

    spark.createDataFrame([(1, "one two three four five six seven")], "item_id bigint, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    good = " ".join(f"word{i}" for i in range(40))
    other = "\n".join(" ".join(f"n{i}x{j}" for i in range(30)) for j in range(5))
    rows = [(1, good), (1, good), (2, good), (None, other), (None, None), (3, ""), (4, other + "\n" + good), (5, other)]
    for docs in (documents(rows), documents([])):
        columns = docs.columns
        for _, stage in corpus_pipeline.STAGES[:-1]:
            path = str(tmp_path / os.urandom(4).hex())
            stage(spark, docs, str(tmp_path)).write.parquet(path)
            docs = spark.read.parquet(path)
            assert docs.columns == columns
        packed = corpus_pipeline.STAGES[-1][1](spark, docs, str(tmp_path)).collect()
        assert Counter(r["doc_id"] for r in docs.collect()) == Counter(r["doc_id"] for r in packed if r["piece"] == 0)


@pytest.mark.parametrize("rows, left", [([(7, "a b c d e f"), (3, "a b c d e f"), (5, "q w e r t y")], {3, 5}), ([(None, "a b"), (2, "a b")], {2}), ([(None, "a b"), (None, "a b")], {None})])
def test_one_of_each_group_stays(spark, documents, rows, left):
    import corpus_pipeline

    kept = corpus_pipeline.near_duplicates(spark, documents(rows), "").collect()
    assert {r["doc_id"] for r in kept} == left and len(kept) == len(left)
