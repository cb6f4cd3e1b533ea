"""Numbering, first rows and joins against brute force, with one key holding most rows."""

from __future__ import annotations

import random
import re

import pytest
from pyspark.sql import functions as F

from findlake.operators.ordering import first_by, frequent, hot_join, numbered, top_by

random.seed(3)
# A third and more of all rows in one group; orders far apart and close together.
ROWS = [
    ("hot" if i % 3 else f"g{i % 40}", order)
    for i, order in enumerate(random.sample(range(2000), 700) + random.sample(range(1 << 40, 1 << 62), 300))
]


@pytest.fixture(scope="module")
def df(spark):
    return spark.createDataFrame(ROWS, "g string, seq bigint").repartition(5)


def places(rows):
    return {(g, s): sum(1 for h, t in rows if h == g and t <= s) for g, s in rows}


@pytest.fixture
def partitions(spark):
    """Sets how many ranges numbering makes."""
    keys = ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")
    before = {k: spark.conf.get(k) for k in keys}

    def set_to(n):
        spark.conf.set(keys[0], str(n))
        spark.conf.set(keys[1], "false")

    yield set_to
    for k, v in before.items():
        spark.conf.set(k, v)


@pytest.mark.parametrize("ranges", [1, 2, 7, 40, None])
def test_numbered(df, partitions, ranges):
    if ranges:
        partitions(ranges)
    out = numbered(df, ["g"], first="low").collect()
    assert {(r.g, r.seq): r.n for r in out} == places(ROWS) and len(out) == len(ROWS)
    assert {(r.g, r.low) for r in out} == {(g, min(s for h, s in ROWS if h == g)) for g, _ in ROWS}


def test_numbered_takes_null_groups_and_no_rows(spark, partitions):
    partitions(5)
    rows = [(None, i, "x") for i in range(60)] + [("a", i, "x") for i in range(30)]
    df = spark.createDataFrame(rows, "g string, seq bigint, n string")
    out = numbered(df.drop("n"), ["g"]).collect()
    assert sorted((str(r.g), r.seq, r.n) for r in out) == sorted((str(g), i, i + 1) for g, i, _ in rows)
    assert numbered(df.drop("n").where("false"), ["g"]).count() == 0


def test_numbered_shuffles_the_rows_once(spark, df, partitions):
    """They are shuffled to be written; reading them, only counts of ranges move."""
    partitions(8)
    plan = numbered(df.withColumn("wide", F.lit("text")), ["g"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and "Exchange rangepartitioning" not in plan and "SinglePartition" not in plan
    assert "SortMergeJoin" not in plan and plan.count("BroadcastHashJoin") == 1
    scans = [line for line in plan.splitlines() if "ReadSchema" in line]
    assert sum("wide" in line.split("ReadSchema")[1] for line in scans) == 1


def test_every_range_has_a_task_of_its_own(spark, df, partitions):
    partitions(13)
    out = numbered(df, ["g"])
    sizes = [r["count"] for r in out.groupBy(F.spark_partition_id()).count().collect()]
    assert len(sizes) >= 11 and max(sizes) <= 3 * len(ROWS) / 13


def test_numbered_with_ties(spark):
    df = spark.createDataFrame([("a", 5, "y"), ("a", 5, "x"), ("a", 1, "z")], "g string, seq bigint, t string")
    got = [(r.t, r.n) for r in numbered(df, ["g"], ties=["t"]).orderBy("n").collect()]
    assert got == [("z", 1), ("x", 2), ("y", 3)]


def test_first_and_top(df):
    first = {r.g: r.seq for r in first_by(df, ["g"]).collect()}
    assert first == {g: min(s for h, s in ROWS if h == g) for g, _ in ROWS}
    top = [(r.seq, r.n) for r in top_by(df, ["g"], [F.desc("seq")], 3).where("g = 'hot'").orderBy("n").collect()]
    assert top == [(s, i) for i, s in enumerate(sorted((s for g, s in ROWS if g == "hot"), reverse=True)[:3], 1)]


@pytest.mark.parametrize("how", ["left", "inner", "left_semi", "left_anti"])
@pytest.mark.parametrize("broadcast", ["10MB", "-1"])
def test_hot_join_equals_join(spark, df, how, broadcast):
    right = spark.createDataFrame([("hot", 1), ("g3", 2), ("none", 3)], "g string, v int")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", broadcast)
    try:
        got, expected = hot_join(df, right, ["g"], how), df.join(right, "g", how)
        assert sorted(got.columns) == sorted(expected.columns)
        order = expected.columns
        assert sorted(map(tuple, got.select(order).collect()), key=str) == sorted(map(tuple, expected.collect()), key=str)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_hot_join_spreads_the_hot_key(spark, df):
    right = spark.createDataFrame([("hot", 1)], "g string, v int")
    salted = hot_join(df, right, ["g"], "inner")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        sizes = salted.groupBy(F.spark_partition_id()).count().collect()
        assert len(sizes) > 4  # one task would hold all rows of the key without the salt
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def test_a_hot_join_repeats_nothing_on_the_driver(spark, df):
    right = spark.createDataFrame([("hot", 1), ("g1", 2)], "g string, v int")
    for how in ("left", "inner", "left_semi", "left_anti"):
        joined = hot_join(df, right, ["g"], how)
        joined.collect()
        assert "Broadcast" not in joined._jdf.queryExecution().executedPlan().toString()


def test_first_by_sorts_by_a_hash_before_the_keys(spark):
    rows = [("scan-1", "a", 3), ("scan-1", "a", 1), ("scan-1", None, 2), (None, "a", 5), (None, "a", 4), (None, None, 6), ("scan-1", None, 7)]
    first = first_by(spark.createDataFrame(rows, "scan_id string, key string, seq int"), ["scan_id", "key"])
    assert sorted(r.seq for r in first.collect()) == [1, 2, 4, 6]
    plan = first._jdf.queryExecution().optimizedPlan().toString()
    hashed = re.search(r"xxhash64\(scan_id#\d+, key#\d+, \d+\) AS (_w\d+#\d+L)", plan)
    assert hashed and f"WindowGroupLimit [{hashed[1]}, scan_id" in plan, plan


@pytest.mark.parametrize("how", ["left", "inner", "left_semi", "left_anti"])
def test_hot_join_repeats_only_the_keys_that_are_hot(spark, df, how):
    left = df.unionByName(spark.createDataFrame([(None, 5), ("g3", 6)], "g string, seq bigint"))
    right = spark.createDataFrame([("hot", 1), ("none", 3), (None, 4), *[(f"g{i}", i) for i in range(30)]], "g string, v int")
    hot = frequent(left, ["g"], 300)
    assert hot.count() == 1
    got, expected = hot_join(left, right, ["g"], how, hot=hot), left.join(right, "g", how)
    assert sorted(got.columns) == sorted(expected.columns)
    order = expected.columns
    assert sorted(map(tuple, got.select(order).collect()), key=str) == sorted(map(tuple, expected.collect()), key=str)
    repeated = re.search(r"Generate explode.*_spread", got._jdf.queryExecution().optimizedPlan().toString())
    assert repeated, "the right side is repeated without a look at what is hot"


def test_a_hot_key_is_spread_and_the_others_are_not_repeated(spark, df):
    right = spark.createDataFrame([(g, 1) for g in ("hot", "g1", "g2", "g3")], "g string, v int")
    kept = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        joined = hot_join(df, right, ["g"], "inner", hot=frequent(df, ["g"], 300))
        tasks = joined.groupBy("g", F.spark_partition_id().alias("task")).count().groupBy("g").count().collect()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", kept)
    spread = {r.g: r["count"] for r in tasks}
    assert spread["hot"] > 4 and spread["g1"] == 1
