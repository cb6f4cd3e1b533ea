from __future__ import annotations

import pytest

DOCUMENT = "doc_id bigint, text string, lang string, source string, n_chars bigint"


@pytest.fixture(scope="session")
def documents(spark):
    """Documents from (doc_id, text) or (doc_id, text, source), with columns that clash with ours."""

    def make(rows, clash=True):
        full = [(r[0], r[1], "en", r[2] if len(r) > 2 else "s", len(r[1] or "")) for r in rows]
        df = spark.createDataFrame(full, DOCUMENT)
        if clash:
            from pyspark.sql import functions as F

            for name in ("k", "kept", "whole", "fp", "line", "length", "label", "ranges", "host", "removed"):
                df = df.withColumn(name, F.lit("x"))
        return df

    return make
