"""Tables that a stream writes batch by batch, and that stay few files to read.

Every batch writes a run under its own number, so a batch that is run again replaces what it wrote. Each
``FAN`` runs of a level are merged into one of the next level, so a row is rewritten once a level and a
reader meets at most ``FAN`` runs of each. A run counts once it is written whole; the runs it was
made from stay, for readers that have begun and for a merge that has to be done again, until ``vacuum``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from findlake.session import remove_folder

FAN = 8


class RunTable:
    """A table in ``folder``. ``merge`` makes one table of the rows of several runs."""

    def __init__(self, spark: SparkSession, folder: str, schema, merge: Callable[[DataFrame], DataFrame], fan: int = FAN):
        self.spark, self.folder, self.merge, self.fan = spark, folder, merge, fan
        self.schema = schema

    def _path(self, level: int, number: int) -> str:
        return f"{self.folder}/level={level}/number={number}"

    def _whole(self) -> dict[int, list[int]]:
        """Numbers of the whole runs of every level; a run is a folder, so this is a short listing."""
        jvm = self.spark.sparkContext._jvm
        root = jvm.org.apache.hadoop.fs.Path(self.folder)
        system = root.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())
        found: dict[int, list[int]] = {}
        for status in system.globStatus(jvm.org.apache.hadoop.fs.Path(f"{self.folder}/level=*/number=*/_SUCCESS")) or []:
            number, level = (part.getName().split("=")[1] for part in (status.getPath().getParent(), status.getPath().getParent().getParent()))
            found.setdefault(int(level), []).append(int(number))
        return found

    def live(self) -> list[tuple[int, int]]:
        """(level, number) of the runs that hold the whole table: those that no whole run covers."""
        whole = self._whole()

        def covered(level: int, number: int) -> bool:
            return any(number // self.fan ** (up - level) in numbers for up, numbers in whole.items() if up > level)

        return sorted((level, n) for level, numbers in whole.items() for n in numbers if not covered(level, n))

    def _rows(self, runs: list[tuple[int, int]]) -> DataFrame:
        if not runs:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(*[self._path(*r) for r in runs])

    def write(self, rows: DataFrame, batch: int) -> None:
        """The rows of a batch, and the merges that it completes."""
        self.merge(rows).write.mode("overwrite").parquet(self._path(0, batch))
        level, number = 0, batch
        while (number + 1) % self.fan == 0:
            first = number + 1 - self.fan
            level, number = level + 1, number // self.fan
            parts = [(level - 1, n) for n in range(first, first + self.fan)]
            self.merge(self._rows(parts)).write.mode("overwrite").parquet(self._path(level, number))

    def read(self) -> DataFrame:
        """The table so far; empty before the first batch."""
        return self.merge(self._rows(self.live()))

    def vacuum(self) -> int:
        """Remove the runs that others cover, once no reader uses them; returns how many there were."""
        live = set(self.live())
        gone = [(level, n) for level, numbers in self._whole().items() for n in numbers if (level, n) not in live]
        for run in gone:
            remove_folder(self.spark, self._path(*run))
        return len(gone)


def run_batches(stream: DataFrame, folder: str, take: Callable[[DataFrame, int], None]) -> None:
    """Run a stream to the end of its input; progress is kept in ``folder``."""
    writer = stream.writeStream.foreachBatch(take).option("checkpointLocation", f"{folder}/progress")
    writer.trigger(availableNow=True).start().awaitTermination()
