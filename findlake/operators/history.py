"""Comparisons between runs: baseline, trend, and grouping by layer."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from findlake.model import TOOLS
from findlake.operators.aggregate import deduplicate, with_key
from findlake.operators.ordering import hot_join, numbered
from findlake.session import materialize, shuffle_partitions
from findlake.sources.dims import dimension

# Runs, a narrow row each, that are sent to every executor at most.
MOST_RUNS = 100_000


def baseline_diff(current: DataFrame, baseline: DataFrame) -> DataFrame:
    """(scan_id, key, state): new, same or fixed against the baseline run.

    Both sides are reduced to distinct keys first, so the join is one row to one row.
    """
    now = with_key(current).select("scan_id", "key").distinct().withColumn("_now", F.lit(True))
    before = with_key(baseline).select("scan_id", "key").distinct().withColumn("_before", F.lit(True))
    state = F.when(F.col("_before").isNull(), "new").when(F.col("_now").isNull(), "fixed").otherwise("same")
    return now.join(before, ["scan_id", "key"], "full").select("scan_id", "key", state.alias("state"))


def suppress(findings: DataFrame, suppressed: DataFrame) -> DataFrame:
    """Drop findings listed, by scan and key, in a suppression table.

    The findings are deduplicated first: at most one row per key meets the list.
    """
    kept = with_key(deduplicate(findings))
    listed = suppressed.select("scan_id", "key").distinct()
    return kept.join(listed, ["scan_id", "key"], "left_anti").select(findings.columns)


def trend(scan_counts: DataFrame) -> DataFrame:
    """Change of the findings count against the previous scan of the repository.

    ``scan_counts`` has (repository, scan_ts, scan_id, findings), one row per scan. Scans are
    numbered in time order by ranges, and each hands its count to the next number, so a
    repository with very many scans is not one task, as it would be with ``lag``.
    """
    timed = scan_counts.withColumn("_micros", F.unix_micros("scan_ts"))
    ordered = numbered(timed, ["repository"], "_micros", "run", ties=["scan_id"])
    none = F.lit(None)
    own = F.struct("run", "scan_id", "findings", none.cast("bigint").alias("previous"))
    handed = F.struct(
        (F.col("run") + 1).alias("run"),
        none.cast("string").alias("scan_id"),
        none.cast("bigint").alias("findings"),
        F.col("findings").alias("previous"),
    )
    met = (
        ordered.select("repository", F.inline(F.array(own, handed)))
        .groupBy("repository", "run")
        .agg(*[F.max(c).alias(c) for c in ("scan_id", "findings", "previous")])
    )
    return met.where("scan_id is not null").withColumn("change", F.col("findings") - F.col("previous"))


def append_runs(findings: DataFrame, runs: DataFrame, name: str, folder: str | None = None) -> None:
    """Keep the finding keys of finished scans for later comparisons.

    ``runs`` has (scan_id, repository, scan_ts), one row per scan; a scan without findings is a run
    too. ``<name>_keys`` holds each key of a scan once, bucketed by (scan_id, key), so no scan, however
    large, is one bucket; ``<name>_runs`` holds one row per run with its number of keys. Runs are
    written last, and what is written twice counts once: an append that failed is simply repeated.
    Findings without a scan belong to no run, nor do those of a scan that ``runs`` does not list.
    ``folder`` is where the tables lie, if not in the warehouse.
    """
    spark = findings.sparkSession
    keys = materialize(with_key(findings).select("scan_id", "key").distinct(), "run-keys")
    buckets = _buckets(spark, f"{name}_keys")
    counts = keys.groupBy("scan_id").agg(F.count(F.lit(1)).alias("findings"))
    counted = runs.select("scan_id", "repository", "scan_ts").join(counts, "scan_id", "left").fillna(0, ["findings"])
    # One file a bucket: the rows are dealt as the buckets are.
    placed = keys.repartition(buckets, "scan_id", "key").write.bucketBy(buckets, "scan_id", "key").sortBy("scan_id", "key")
    for writer, table in ((placed, f"{name}_keys"), (counted.write, f"{name}_runs")):
        if folder:
            writer = writer.option("path", f"{folder}/{table}")
        writer.format("parquet").mode("append").saveAsTable(table)


def _buckets(spark: SparkSession, table: str) -> int:
    """Buckets of a table, or those a new one should have: as many as a shuffle has partitions."""
    if not spark.catalog.tableExists(table):
        return shuffle_partitions(spark)
    described = spark.sql(f"DESCRIBE EXTENDED {table}").where("col_name = 'Num Buckets'")
    return int(described.first()["data_type"])


def stored_runs(spark: SparkSession, name: str) -> DataFrame:
    """(scan_id, repository, scan_ts, findings): the runs kept, which is what ``trend`` takes. No
    finding is read for it. Of a run that was appended twice the later time counts."""
    last = F.max(F.struct("scan_ts", "repository", "findings")).alias("_last")
    return spark.table(f"{name}_runs").groupBy("scan_id").agg(last).select("scan_id", "_last.repository", "_last.scan_ts", "_last.findings")


def run_changes(spark: SparkSession, name: str, wanted: DataFrame | None = None) -> DataFrame:
    """(scan_id, previous, key, state): the keys of runs that are new, same or fixed against the run
    before it of the same repository; all runs kept, or those whose scan_id is in ``wanted``.

    A repository's first run, and a run without a repository, have only new keys. A run is the
    predecessor of one run at most, so its stored keys are compared once and stay in their buckets;
    only the later run's keys are shuffled, to where the earlier ones lie. Runs meet their keys where these
    lie as long as there are ``MOST_RUNS`` at most, which are sent to every executor; beyond that by a salted join.
    """
    timed = stored_runs(spark, name).withColumn("_micros", F.unix_micros("scan_ts"))
    ordered = numbered(timed, ["repository"], "_micros", "_run", ties=["scan_id"])
    earlier = ordered.select("repository", (F.col("_run") + 1).alias("_run"), F.col("scan_id").alias("previous"))
    pairs = ordered.join(earlier, ["repository", "_run"], "left").select("scan_id", "previous")
    if wanted is not None:
        pairs = pairs.join(wanted.select("scan_id").distinct(), "scan_id", "left_semi")
    pairs = materialize(pairs, "run-pairs")
    few = pairs.count() <= MOST_RUNS
    keys = spark.table(f"{name}_keys").distinct()  # within buckets

    def of_runs(runs: DataFrame) -> DataFrame:
        return keys.join(F.broadcast(runs), "scan_id") if few else hot_join(keys, runs, ["scan_id"], "inner", spread_by=["key"])

    now = of_runs(pairs)
    followed = pairs.where("previous IS NOT NULL").select(F.col("previous").alias("scan_id"), F.col("scan_id").alias("_later"))
    before = of_runs(followed).select(
        F.col("scan_id").alias("_before"), F.col("key").alias("_key"), "_later"
    )
    same = (F.col("previous") == F.col("_before")) & (F.col("key") == F.col("_key"))
    state = F.when(F.col("_before").isNull(), "new").when(F.col("scan_id").isNull(), "fixed").otherwise("same")
    return now.join(before, same, "full").select(
        F.coalesce("scan_id", "_later").alias("scan_id"),
        F.coalesce("previous", "_before").alias("previous"),
        F.coalesce("key", "_key").alias("key"),
        state.alias("state"),
    )


def by_layer(findings: DataFrame) -> DataFrame:
    """Findings per scan and layer (lint, security, dependency, secrets)."""
    layers = sorted({(t.finding_tool, t.layer) for t in TOOLS})
    layer = dimension(findings.sparkSession, layers, "tool string, layer string")
    per_tool = findings.groupBy("scan_id", "tool").agg(F.count(F.lit(1)).alias("findings"))
    return per_tool.join(layer, "tool").groupBy("scan_id", "layer").agg(F.sum("findings").alias("findings"))
