"""Streams over several files, and restarts."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from findlake.model import FINDINGS
from findlake.operators import aggregate
from findlake.operators.errors import unread, usable
from findlake.operators.normalize import tflint
from findlake.plans.scan_flow import normalize_all
from findlake.streaming import arrivals
from findlake.streaming.runs import RunTable

START = dt.datetime(2026, 1, 1)


@pytest.fixture(scope="module")
def table(spark, findings):
    rows = [{"scan_id": f"s{i % 3}", "rule_id": f"R{i % 5 if i % 3 else 0}", "severity": ["LOW", "HIGH"][i % 2]} for i in range(300)]
    found = findings(*rows)
    return found.withColumn("ts", F.lit(START) + F.make_dt_interval(hours=F.col("seq").cast("int")))


@pytest.fixture(scope="module")
def folder(table, tmp_path_factory):
    """Six files, months apart and out of order: the last rows arrive first."""
    path = str(tmp_path_factory.mktemp("arrivals") / "in")
    for part in (5, 0, 3, 1, 4, 2):
        rows = table.where(F.col("seq") % 300 >= part * 50).where(F.col("seq") % 300 < part * 50 + 50)
        rows.withColumn("ts", F.col("ts") + F.make_dt_interval(days=F.lit(60 * part))).coalesce(1).write.mode("append").parquet(path)
    return path


@pytest.mark.parametrize("files_per_batch", [1, 2, 10_000])
def test_dedup_across_arrivals(spark, folder, table, tmp_path, files_per_batch):
    arriving = arrivals.read_arrivals(spark, folder, table.schema, files_per_batch=files_per_batch)
    expected = {(r.scan_id, r.key) for r in aggregate.with_key(table).collect()}
    for _ in range(2):  # the second run finds its progress and adds nothing
        got = arrivals.run_to_table(arrivals.dedup_stream(arriving), str(tmp_path))
        rows = [(r.scan_id, r.key) for r in got.collect()]
        assert len(rows) == len(set(rows))
        assert set(rows) == expected


@pytest.mark.parametrize("files_per_batch", [1, 10_000])
def test_windows_count_late_rows(spark, folder, table, tmp_path, files_per_batch):
    arriving = arrivals.read_arrivals(spark, folder, table.schema, files_per_batch=files_per_batch)
    whole = arrivals.window_counts(spark.read.schema(table.schema).parquet(folder))
    expected = {(r.window_start, r.severity): r.findings for r in whole.collect()}
    for _ in range(2):
        got = arrivals.count_to_table(arriving, str(tmp_path))
        assert {(r.window_start, r.severity): r.findings for r in got.collect()} == expected
    assert sum(expected.values()) == 300
    assert len(list((tmp_path / "counts").glob("level=0/number=*"))) == (6 if files_per_batch == 1 else 1)


def test_normalise_as_it_arrives(spark, raw, tmp_path):
    reports = raw("tflint", *['{"issues":[{"message":"m"},{}]}'] * 4, "broken")
    path = str(tmp_path / "in")
    reports.repartition(3).write.parquet(path)
    found = arrivals.normalize_stream(arrivals.read_arrivals(spark, path, reports.schema), tflint)
    assert found.schema.fieldNames() == FINDINGS.fieldNames()
    assert arrivals.run_to_table(found, str(tmp_path / "out")).count() == 8


def test_restart_adds_only_what_is_new(spark, raw, tmp_path):
    path, folder = str(tmp_path / "in"), str(tmp_path / "out")

    def run():
        return arrivals.run_to_table(tflint(arrivals.read_arrivals(spark, path, reports.schema)), folder).count()

    reports = raw("tflint", '{"issues":[{"message":"m"}]}')
    reports.write.parquet(path)
    assert run() == 1
    assert run() == 1
    reports.write.mode("append").parquet(path)
    assert run() == 2


@pytest.mark.parametrize("files_per_batch", [1, 10_000])
def test_dedup_keeps_the_first_finding(spark, folder, table, tmp_path, files_per_batch):
    arriving = arrivals.read_arrivals(spark, folder, table.schema, files_per_batch=files_per_batch)
    stored = spark.read.schema(table.schema).parquet(folder)
    expected = sorted(map(tuple, aggregate.deduplicate(stored).collect()), key=str)
    for _ in range(2):
        got = arrivals.dedup_to_table(arriving, str(tmp_path))
        assert sorted(map(tuple, got.collect()), key=str) == expected


def test_runs_are_merged_and_can_be_written_again(spark, tmp_path):
    sums = lambda df: df.groupBy("k").agg(F.sum("n").alias("n"))
    table = RunTable(spark, str(tmp_path / "t"), "k string, n bigint", sums, fan=3)
    assert table.read().count() == 0 and table.live() == []
    for batch in range(11):
        table.write(spark.createDataFrame([("a", 1), (f"b{batch}", 2)], table.schema), batch)
    table.write(spark.createDataFrame([("a", 1), ("b8", 2)], table.schema), 8)  # the batch is run again
    assert table.live() == [(0, 9), (0, 10), (2, 0)]
    assert {r.k: r.n for r in table.read().collect()} == {"a": 11, **{f"b{i}": 2 for i in range(11)}}
    assert table.vacuum() == 12 and table.vacuum() == 0
    assert {r.k: r.n for r in table.read().collect()} == {"a": 11, **{f"b{i}": 2 for i in range(11)}}


def test_a_run_that_is_not_whole_does_not_count(spark, tmp_path):
    table = RunTable(spark, str(tmp_path / "t"), "k string", lambda df: df, fan=2)
    for batch in range(2):
        table.write(spark.createDataFrame([(str(batch),)], "k string"), batch)
    assert table.live() == [(1, 0)]
    (tmp_path / "t" / "level=1" / "number=0" / "_SUCCESS").rename(tmp_path / "lost")
    assert table.live() == [(0, 0), (0, 1)]
    assert sorted(r.k for r in table.read().collect()) == ["0", "1"]


@pytest.mark.parametrize("files_per_batch", [1, 10_000])
def test_reports_arrive_in_three_tables(spark, raw, tmp_path, files_per_batch):
    reports = (
        raw("tflint", '{"issues":[{"message":"m"},{"message":"m"},"odd"]}', "broken", '{"issues":[{"message":"n","rule":{"severity":"error"}}]}')
        .unionByName(raw("bandit", '{"results":[{"test_id":"B404"},{"test_id":"B1"}]}'))
        .unionByName(raw("pylint", "[]", scan=None))
    )
    path = str(tmp_path / "in")
    reports.repartition(4, "seq").write.parquet(path)
    arriving = arrivals.read_arrivals(spark, path, reports.schema, files_per_batch=files_per_batch)
    config = {"tools": {"python": {"exclude_rules": {"bandit": ["B404"]}}}}
    whole = normalize_all(usable(reports), None, config)
    for _ in range(2):
        got = arrivals.ingest(arriving, str(tmp_path / "out"), config)
        assert sorted(map(tuple, got.findings.collect()), key=str) == sorted(map(tuple, aggregate.deduplicate(whole).collect()), key=str)
        assert {(r.tool, r.severity): r.findings for r in got.counts.collect()} == {("tflint", "MEDIUM"): 2, ("tflint", "HIGH"): 1, ("bandit", "MEDIUM"): 1}
        assert sorted((r.tool, r.reason) for r in got.errors.collect()) == sorted((r.tool, r.reason) for r in unread(reports).collect())
    assert not (tmp_path / "out" / "work").exists() or not list((tmp_path / "out" / "work").iterdir())


def test_nothing_has_arrived(spark, raw, table, tmp_path):
    (tmp_path / "in").mkdir()
    arriving = arrivals.read_arrivals(spark, str(tmp_path / "in"), table.schema)
    assert arrivals.count_to_table(arriving, str(tmp_path / "a")).count() == 0
    assert arrivals.dedup_to_table(arriving, str(tmp_path / "b")).count() == 0
    assert arrivals.run_to_table(arrivals.dedup_stream(arriving), str(tmp_path / "c")).count() == 0
    reports = raw("tflint", "{}")
    got = arrivals.ingest(arrivals.read_arrivals(spark, str(tmp_path / "in"), reports.schema), str(tmp_path / "d"), {})
    assert [t.count() for t in got] == [0, 0, 0]


def test_a_long_file_is_dealt_out_before_it_is_sorted(spark, table):
    rows = table.drop("ts").coalesce(1)
    found = arrivals._first_findings(rows)
    assert {r.seq for r in found.collect()} == {r.seq for r in aggregate.deduplicate(rows).collect()}
    plan = found._jdf.queryExecution().executedPlan().toString().splitlines()
    first_sort = max(i for i, line in enumerate(plan) if " Sort " in line and "Final Plan" not in line)
    assert any("REPARTITION_BY_NUM" in line for line in plan[first_sort:])
