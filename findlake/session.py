"""Session settings and the shared folder that holds cut-off points and written tables."""

from __future__ import annotations

import contextlib
import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Rows go to Python by bytes, not only by number: one text may be as long as a thousand others.
    "spark.sql.execution.arrow.maxBytesPerBatch": "8m",
    # An odd field of one of several objects that are read at once costs that field only.
    "spark.sql.json.enablePartialResults": "true",
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
}


# What one shuffle partition should hold; smaller ones are merged at run time.
PARTITION_BYTES = 256 << 20


def build_session(
    app_name: str = "findlake", master: str | None = None, shuffled_bytes: int | None = None, **conf: str
) -> SparkSession:
    """Session with our settings, then ``conf``.

    ``shuffled_bytes`` is the size of the largest shuffle to expect (for dedup: the findings, not
    the reports). Adaptive execution merges partitions but never adds any, so a large job has to
    start with enough of them to fit in executor memory.
    """
    settings = dict(CONF)
    if shuffled_bytes:
        partitions = max(200, -(-shuffled_bytes // PARTITION_BYTES))
        settings["spark.sql.adaptive.coalescePartitions.initialPartitionNum"] = str(partitions)
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**settings, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


_own_folders: dict[str, str] = {}


def shared_dir(spark: SparkSession, purpose: str) -> str:
    """A fresh path for ``purpose`` in the folder named by ``spark.checkpoint.dir``.

    Only where the session names none and its master is local (a test) is a temporary folder made;
    on a cluster executors would each write to a disk of their own, so that is an error.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        master = spark.sparkContext.master
        if master != "local" and not master.startswith("local["):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        application = spark.sparkContext.applicationId
        if application not in _own_folders:
            _own_folders[application] = tempfile.mkdtemp(prefix="findlake-")
        base = _own_folders[application]
    return os.path.join(base, "findlake", purpose, uuid.uuid4().hex)


def remove_folder(spark: SparkSession, path: str) -> None:
    """Remove a folder of our own, on whatever file system it is."""
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(place, True)


_written: dict[str, list[str]] = {}
_tables: dict[str, list[str]] = {}
_labels: dict[int, list[int]] = {}


def remove_written(spark: SparkSession) -> int:
    """Remove the tables that this application has written with ``materialize`` and
    ``materialize_ranges``, once nothing reads them any more; returns how many there were."""
    paths = _written.pop(spark.sparkContext.applicationId, [])
    for path in paths:
        remove_folder(spark, path)
    for name in _tables.pop(spark.sparkContext.applicationId, []):
        spark.sql(f"DROP TABLE IF EXISTS {name}")
    return len(paths)


# Files that a task keeps open at most while it writes a table laid out by a column.
OPEN_FILES = 32


@contextlib.contextmanager
def unsorted_writes(spark: SparkSession):
    """Tables laid out by a column are written without a sort by it: a task keeps a file open for each value,
    and only one that meets more than ``OPEN_FILES`` of them sorts the rest."""
    key = "spark.sql.maxConcurrentOutputFileWriters"
    before = spark.conf.get(key, None)
    spark.conf.set(key, str(OPEN_FILES))
    try:
        yield
    finally:
        spark.conf.unset(key) if before is None else spark.conf.set(key, before)


def materialize(df: DataFrame, purpose: str, partition_by: list[str] | None = None) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: several readers, one computation.

    The lineage ends at the written files, so a lost executor never costs more than a read. They
    stay until ``remove_written`` or the folder's retention removes them.
    """
    spark = df.sparkSession
    path = shared_dir(spark, purpose)
    _written.setdefault(spark.sparkContext.applicationId, []).append(path)
    writer = df.write
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    with unsorted_writes(spark):
        writer.parquet(path)
    return spark.read.schema(df.schema).parquet(path).select(df.columns)


def shuffle_partitions(spark: SparkSession) -> int:
    """How many partitions a shuffle starts with."""
    initial = spark.conf.get("spark.sql.adaptive.coalescePartitions.initialPartitionNum", None)
    return int(initial or spark.conf.get("spark.sql.shuffle.partitions"))


def _bucket_labels(spark: SparkSession, buckets: int) -> list[int]:
    """For every bucket a number that Spark's bucket hash puts into it."""
    if buckets not in _labels:
        numbers = spark.range(max(1000, 20 * buckets)).select(F.col("id").cast("int").alias("label"))
        found = numbers.groupBy(F.pmod(F.hash("label"), F.lit(buckets)).alias("bucket")).agg(F.min("label").alias("label"))
        _labels[buckets] = [r["label"] for r in sorted(found.collect(), key=lambda r: r["bucket"])]  # a row a bucket
    return _labels[buckets]


def materialize_ranges(df: DataFrame, purpose: str, by: list[str], label: str = "_part") -> DataFrame:
    """Write ``df`` in ranges of ``by``, one bucket for each, and read it back with ``label``: a number
    of the range, growing with it.

    This is the one shuffle. Since the table is bucketed by ``label``, Spark knows that a range lies in
    one partition, and windows and aggregates by ``label`` and other columns need no further one.
    """
    spark = df.sparkSession
    buckets = shuffle_partitions(spark)
    labels = sorted(_bucket_labels(spark, buckets))
    path, name = shared_dir(spark, purpose), f"findlake_{uuid.uuid4().hex}"
    _written.setdefault(spark.sparkContext.applicationId, []).append(path)
    _tables.setdefault(spark.sparkContext.applicationId, []).append(name)
    number = F.get(F.array(*map(F.lit, labels)), F.spark_partition_id())
    placed = df.repartitionByRange(*by).withColumn(label, number)
    placed.write.format("parquet").bucketBy(buckets, label).option("path", path).saveAsTable(name)
    return spark.table(name)
