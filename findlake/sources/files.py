"""File inventory: a folder with one directory per scan becomes the ``files`` table.

Spark's own file sources pass over empty files and over names that start with a dot or an
underscore, so ``__init__.py``, ``.env`` or ``.github/`` would be missing from the inventory.
The folder is therefore walked by tasks: each round lists the directories found by the round
before, and the files are then read in parallel, spread by path. The driver sees no names. Names are
short and what they stand for is not, so the number of tasks never goes by the bytes of the names.
"""

from __future__ import annotations

import fnmatch
import os
from collections.abc import Iterator
from itertools import islice

import pandas as pd
from pyarrow import fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from findlake.session import materialize, shuffle_partitions

# Texts are handed back to Spark in batches of about this many characters.
BATCH_CHARS = 16 << 20
# Names are handed back in batches of this many.
LISTED_AT_ONCE = 10_000


def open_folder(root: str) -> tuple[pafs.FileSystem, str]:
    """File system and path of a folder, local or shared, from a path or URI."""
    filesystem, path = pafs.FileSystem.from_uri(root.replace("s3a://", "s3://", 1))
    return filesystem, path.rstrip("/")


def _entries(filesystem: pafs.FileSystem, folder: str) -> Iterator[tuple[str, bool]]:
    local = isinstance(filesystem, pafs.LocalFileSystem)
    for info in filesystem.get_file_info(pafs.FileSelector(folder, allow_not_found=True)):
        is_folder = info.type == pafs.FileType.Directory
        if not (is_folder and local and os.path.islink(info.path)):  # links to folders are not followed
            yield info.path, is_folder


def walk_files(spark: SparkSession, root: str, glob: str = "*") -> DataFrame:
    """(full_path): every file below ``root`` whose name matches, hidden and empty ones included."""

    def list_folders(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        filesystem, _ = open_folder(root)
        for batch in batches:
            for folder in batch["full_path"]:
                entries = _entries(filesystem, folder)
                wanted = ((p, d) for p, d in entries if d or fnmatch.fnmatchcase(p.rsplit("/", 1)[-1], glob))
                while rows := list(islice(wanted, LISTED_AT_ONCE)):
                    yield pd.DataFrame(rows, columns=["full_path", "is_folder"])

    found = None
    folders = spark.range(1).select(F.lit(open_folder(root)[1]).alias("full_path"))
    while not folders.isEmpty():
        listing = folders.repartition(shuffle_partitions(spark), "full_path").mapInPandas(list_folders, "full_path string, is_folder boolean")
        entries = materialize(listing, "listing")
        files = entries.where("not is_folder").select("full_path")
        found = files if found is None else found.unionByName(files)
        folders = entries.where("is_folder").select("full_path")
    return found


def read_files(spark: SparkSession, root: str, glob: str = "*") -> DataFrame:
    """``root/<scan_id>/<path>`` as (scan_id, repo, path, content, read_ok).

    Whole contents; bytes that are not UTF-8 become U+FFFD, the rest of the file stays. Files that
    cannot be read are kept with ``read_ok`` false (see ``unreadable``). ``glob`` limits the files
    by name. A checkout's directory names its scan; the repository is not known here.
    """
    base = open_folder(root)[1]

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        filesystem, _ = open_folder(root)
        rows, chars = [], 0
        for batch in batches:
            for full_path in batch["full_path"]:
                try:
                    with filesystem.open_input_file(full_path) as handle:
                        text = handle.read().decode("utf-8", errors="replace")
                except OSError:
                    text = None
                scan, _, path = full_path[len(base) + 1 :].partition("/")
                rows.append((scan, None, path, text, text is not None))
                chars += len(text or "")
                if chars > BATCH_CHARS or len(rows) >= 1000:
                    yield pd.DataFrame(rows, columns=["scan_id", "repo", "path", "content", "read_ok"])
                    rows, chars = [], 0
        if rows:
            yield pd.DataFrame(rows, columns=["scan_id", "repo", "path", "content", "read_ok"])

    schema = "scan_id string, repo string, path string, content string, read_ok boolean"
    inside = F.contains(F.substr("full_path", F.lit(len(base) + 2)), F.lit("/"))  # files beside the scans are none
    found = walk_files(spark, root, glob).where(inside)
    return found.repartition(shuffle_partitions(spark), "full_path").mapInPandas(read, schema)


def unreadable(files: DataFrame) -> DataFrame:
    """(scan_id, path): files that no scan could look into."""
    return files.where(~F.col("read_ok")).select("scan_id", "path")
