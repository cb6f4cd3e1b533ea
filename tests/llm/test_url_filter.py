from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from findlake.llm import url_filter
from findlake.llm.queries import URL_RULES


def pages(spark, urls):
    return spark.createDataFrame(list(enumerate(urls)), "page_id bigint, url string").withColumn("host", F.lit("x")).withColumn("rule", F.lit("x"))


def test_rules_and_parts(spark):
    urls = [
        "http://a.example.ORG/es/1#x", "https://example.org/en/12?q", "http://example.org/en/2", "http://org", "http://org/",
        "http://x.com/fr/1", "http://x.com/de/1", "http://x.com/en/1", "http://myorg/es/", "no scheme/x", "", None, "://h/p", "http://ÄB.org/", "http://u?x=http://org/",
    ]
    none = pages(spark, []).select("url")
    got = {r["page_id"]: r for r in url_filter.judge(pages(spark, urls), none, URL_RULES).collect()}
    assert len(got) == len(urls)
    found = [(got[i]["rule"], got[i]["verdict"]) for i in range(len(urls))]
    assert found[:8] == [
        ("example.org/es/", "block"), ("example.org/en/1", "block"), ("org/", "allow"), (None, "allow"), ("org/", "allow"),
        ("com/fr/", "allow"), ("com/de/", "block"), (None, "allow"),
    ]
    assert found[8:13] == [(None, "allow")] * 5
    assert [got[i]["host"] for i in (0, 9, 10, 11, 12, 13, 14)] == ["a.example.org", "", "", "", "h", "Äb.org", "u"]
    assert [got[i]["path"] for i in (0, 1, 3, 9, 12, 14)] == ["/es/1", "/en/12", "", "", "/p", ""]


def test_list_is_exact(spark):
    listed = [f"http://h{i}.net/p?b=2&a={i}&utm_source=x" for i in range(500)] * 2 + [None, "nothing"]
    asked = [f"https://H{i}.net:443/p/?a={i}&b=2#top" for i in range(1000)] * 2
    rows = url_filter.judge(pages(spark, asked), pages(spark, listed).select("url"), []).collect()
    assert sorted(r["page_id"] for r in rows) == list(range(2000))
    assert all((r["verdict"] == "block") == (r["page_id"] % 1000 < 500) == r["listed"] for r in rows)


def test_very_long_urls(spark):
    tail = "/" + "é/p" * 60_000 + "?" + "&".join(f"k{i}={i}" for i in range(5_000))
    asked = ["http://a.net" + tail, "http://a.net" + tail + "1", "http://" + "h." * 50_000 + "org/x"]
    rows = url_filter.judge(pages(spark, asked), pages(spark, ["https://A.net" + tail + "#f"]).select("url"), URL_RULES).collect()
    got = {r["page_id"]: (len(r["host"]), len(r["path"]), r["rule"], r["verdict"]) for r in rows}
    assert got == {0: (5, 180_001, None, "block"), 1: (5, 180_001, None, "allow"), 2: (100_003, 2, "org/", "allow")}


@pytest.mark.parametrize("limit", [0, 1 << 30])
def test_filter_loses_nothing_and_cuts(spark, limit):
    listed = spark.range(2000).select(F.concat(F.lit("u"), "id").alias("listed_as"))
    asked = spark.range(20000).select(F.concat(F.lit("u"), "id").alias("listed_as"))
    blocks = url_filter.bloom_blocks(2000, 16)
    hits = {r[0] for r in url_filter.possible(asked, url_filter.bloom_filter(listed, blocks), blocks, limit).collect()}
    assert {f"u{i}" for i in range(2000)} <= hits
    assert len(hits) < 2000 + 18000 * 0.02


def test_empty_tables(spark):
    assert url_filter.judge(pages(spark, []), pages(spark, ["http://a/b"]).select("url"), URL_RULES).count() == 0
