"""Reports that keep arriving: stateless normalisation, dedup across arrivals, windowed counts.

Jobs run until the input is used up (``availableNow``). Each is given a folder of its own, in which
it keeps its progress and its output: run again with the same folder, it takes up only what is new,
and a lost executor or a restart repeats no row and loses none. No result depends on how many files
make a batch, nor on the order in which they arrive.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from typing import Any, NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from findlake.model import TOOLS
from findlake.operators.aggregate import deduplicate, with_key
from findlake.operators.errors import unread, usable
from findlake.operators.ordering import SALTS
from findlake.plans.scan_flow import normalize_all
from findlake.session import remove_folder, shuffle_partitions, unsorted_writes
from findlake.streaming.runs import RunTable, run_batches

COUNTS = "window_start timestamp, window_end timestamp, severity string, findings bigint"


def read_arrivals(
    spark: SparkSession, path: str, schema, file_glob: str = "*.parquet", files_per_batch: int = 10_000
) -> DataFrame:
    """Files as they arrive. A long backlog is taken in batches of ``files_per_batch``, so each
    batch's shuffle stays of bounded size."""
    reader = spark.readStream.schema(schema).option("pathGlobFilter", file_glob)
    return reader.option("maxFilesPerTrigger", files_per_batch).parquet(path)


def run_to_table(stream: DataFrame, folder: str) -> DataFrame:
    """Run a stream to the end of its input and read back the table written to ``folder``."""
    query = (
        stream.writeStream.format("parquet")
        .option("path", f"{folder}/table")
        .option("checkpointLocation", f"{folder}/progress")
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    if not query.recentProgress and not _exists(stream.sparkSession, f"{folder}/table"):
        return stream.sparkSession.createDataFrame([], stream.schema)  # nothing has arrived yet
    return stream.sparkSession.read.schema(stream.schema).parquet(f"{folder}/table")


def _exists(spark: SparkSession, path: str) -> bool:
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(place)


def normalize_stream(raw_stream: DataFrame, normalizer: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """Normalisers are stateless, so the batch function serves the stream as it is."""
    return normalizer(raw_stream)


def dedup_stream(findings_stream: DataFrame) -> DataFrame:
    """Each (scan_id, key) once, whenever it arrives.

    The keys seen are kept as state on the executors' disks, without a time limit, so no row is too
    late. The stream is first deduplicated per salt, then per key: copies of one hot key are spread
    over the salts, and only one row per salt goes on to the key's own task.
    """
    salt = F.pmod(F.xxhash64("seq"), F.lit(SALTS)).alias("_salt")
    keyed = with_key(findings_stream).select("scan_id", "key", salt)
    return keyed.dropDuplicates(["scan_id", "key", "_salt"]).select("scan_id", "key").dropDuplicates(["scan_id", "key"])


def window_counts(findings: DataFrame, ts: str | Column = "ts", size: str = "1 day") -> DataFrame:
    """Findings per event-time window and severity."""
    counted = findings.groupBy(F.window(ts, size).alias("w"), "severity").agg(F.count(F.lit(1)).alias("findings"))
    return counted.select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), "severity", "findings")


def count_to_table(findings_stream: DataFrame, folder: str, ts: str = "ts", size: str = "1 day") -> DataFrame:
    """Run the stream to the end of its input and return its windowed counts so far.

    Every batch writes the counts of its own rows; merges and reading add them up. A row counts in
    its window however late it comes.
    """
    counts = RunTable(findings_stream.sparkSession, f"{folder}/counts", COUNTS, _added)
    run_batches(findings_stream, folder, lambda batch, number: counts.write(window_counts(batch, ts, size), number))
    return counts.read()


def _added(counts: DataFrame) -> DataFrame:
    keys = [c for c in counts.columns if c != "findings"]
    return counts.groupBy(*keys).agg(F.sum("findings").alias("findings"))


def _first_findings(findings: DataFrame) -> DataFrame:
    """``deduplicate``, which sorts what a task reads before its shuffle: a file is read by one task,
    however long it is, so the rows are dealt out first."""
    parts = shuffle_partitions(findings.sparkSession)
    return deduplicate(findings.repartition(parts, "scan_id", "seq"))


def dedup_to_table(findings_stream: DataFrame, folder: str) -> DataFrame:
    """Run the stream to the end of its input and return the first finding, by ``seq``, of each key of
    each scan so far: what ``deduplicate`` gives for all that has arrived.

    No finding is held as state: a later copy with a lower ``seq`` simply wins where runs are merged or
    read, so nothing depends on the order of arrival and nothing has to be released.
    """
    table = RunTable(findings_stream.sparkSession, f"{folder}/findings", findings_stream.schema, _first_findings)
    run_batches(findings_stream, folder, table.write)
    return table.read()


class Arrived(NamedTuple):
    findings: DataFrame  # deduplicated
    counts: DataFrame  # of all findings, by scan, tool and severity
    errors: DataFrame  # what could not be read


TOOL_COUNTS = "scan_id string, tool string, severity string, findings bigint"


def ingest(raw_stream: DataFrame, folder: str, config: Mapping[str, Any]) -> Arrived:
    """Raw reports as they arrive, to three tables at once. Every batch is parsed once; each table
    has a run of its own for it, so a batch that is run again replaces all it wrote."""
    spark = raw_stream.sparkSession
    empty = normalize_all(spark.createDataFrame([], raw_stream.schema), None, config)
    findings = RunTable(spark, f"{folder}/findings", empty.schema, deduplicate)
    counts = RunTable(spark, f"{folder}/counts", TOOL_COUNTS, _added)
    errors = RunTable(spark, f"{folder}/errors", unread(spark.createDataFrame([], raw_stream.schema), []).schema, lambda rows: rows)

    def take(batch: DataFrame, number: int) -> None:
        work = f"{folder}/work/batch={number}"
        with unsorted_writes(batch.sparkSession):
            batch.write.mode("overwrite").partitionBy("tool").parquet(f"{work}/raw")
        raw = spark.read.schema(raw_stream.schema).parquet(f"{work}/raw")
        tools = [r["tool"] for r in raw.where(F.col("tool").isin([t.name for t in TOOLS])).select("tool").distinct().collect()]
        errors.write(unread(raw, tools), number)
        normalize_all(usable(raw), None, config, tools).write.mode("overwrite").parquet(f"{work}/found")
        found = spark.read.schema(empty.schema).parquet(f"{work}/found")
        counts.write(found.groupBy("scan_id", "tool", "severity").agg(F.count(F.lit(1)).alias("findings")), number)
        findings.write(found, number)
        remove_folder(spark, work)

    run_batches(raw_stream, folder, take)
    return Arrived(findings.read(), counts.read(), errors.read())
