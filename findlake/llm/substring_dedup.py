"""Removal of long repeated byte strings by prefix doubling over chosen positions.

Prefix doubling gives every position a rank for its first bytes, and makes the rank of twice the
length from pairs of ranks, until a position's rank is unique or the length reaches the threshold.
Two things differ here from sorting all positions at every length:

* Ranks are names (hashes of bytes), which a task computes for any length from the text alone; only
  the question whether a name is unique needs the cluster. A shared core, by a rolling name, only
  keeps a cell in; repeated are cells whose spans agree in 128 bits of XXH3.
* Of all positions only one per cell takes part. A cell is a range of window starts that share an
  anchor chosen by content. Its core, common to all its windows, has the short length; its span,
  which covers them all, is past the threshold. A cell whose core is unique drops out. One whose
  span occurs elsewhere is decided: all its windows are repeated. What is left is cut into smaller
  cells, so cores grow (201 bytes, then 376) until core and span are one window of 400 bytes.

Cells that share a span are represented by one of them in the next round, as a witness.

Defined results: a null or empty text has no bytes. Texts shorter than the length keep everything.
A very long text is named in blocks of 1 MB that overlap, so repeats across their edges are found.
Repeated rows are texts of their own: each is repeated in the other, so both lose what is long
enough. A null ``doc_id`` is an id like any other. No rows give no rows. Columns other than id and
text are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import texts, written, written_for_now
from .substring_names import BLOCK, SHORT, Names, anchored_runs, cell_names, cells

LENGTH = 400
# Lists of cells up to this size are sent to every executor; larger ones meet the texts in a shuffle.
BROADCAST_BYTES = 32 << 20
CELL_BYTES = 32
_CELLS = "k bigint, core bigint, a bigint, b bigint, place bigint, open boolean"
_NAMES = ["k", "core", "a", "b", "place", "open"]
# A cell's place is its first window start, and how far the last one and the anchor lie behind it.
_BITS = 12
_REST = (1 << _BITS) - 1


def _place(first: np.ndarray, last: np.ndarray, anchor: np.ndarray) -> np.ndarray:
    return (first << (2 * _BITS)) | ((last - first) << _BITS) | (anchor - first)


def _placed(place: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(anchor, first, last)"""
    first = place >> (2 * _BITS)
    return first + (place & _REST), first, first + ((place >> _BITS) & _REST)


def _whole(batch: pa.RecordBatch) -> Iterator[bytes]:
    """The bytes of each text, whether it came as it is or compressed."""
    if "packed" in batch.schema.names:
        unpack = zstandard.ZstdDecompressor().decompress
        for value in batch.column("packed"):
            yield unpack(value.as_py())
    else:
        for value in batch.column("text"):
            yield (value.as_py() or "").encode("utf-8", "surrogatepass")


def packed(documents: DataFrame) -> DataFrame:
    """``documents`` with compressed texts, for a shuffle that moves all of them."""
    others = [c for c in documents.columns if c != "text"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pack = zstandard.ZstdCompressor(level=3).compress
        for batch in batches:
            values = pa.array([pack(data) for data in _whole(batch)], pa.binary())
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in others), values], [*others, "packed"])

    kinds = dict(documents.dtypes)
    return documents.mapInArrow(run, ", ".join(f"{c} {kinds[c]}" for c in others) + ", packed binary")


def _rows(key: int, offset: int, names: Names, size: int, run, first, last, low, high, anchor, opened, length: int) -> list[np.ndarray]:
    core, a, b = cell_names(names, size - offset, low, high, length)
    place = _place(first + offset, last + offset, anchor[run] + offset)
    return [np.full(len(run), key, np.int64), core.view(np.int64), a.view(np.int64), b.view(np.int64), place, opened]


def _batch(parts: list[list[np.ndarray]]) -> pa.RecordBatch:
    kinds = [pa.int64()] * 5 + [pa.bool_()]
    columns = [np.concatenate(c) if parts else np.zeros(0) for c in (zip(*parts) if parts else [[]] * 6)]
    return pa.RecordBatch.from_arrays([pa.array(c.astype(k.to_pandas_dtype()), k) for c, k in zip(columns, kinds)], _NAMES)


def first_cells(documents: DataFrame, length: int, width: int) -> DataFrame:
    """The cells of every text, none of them decided."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts, rows = [], 0
            for key, whole in zip(batch.column("k").to_pylist(), _whole(batch)):
                data = np.frombuffer(whole, np.uint8)
                for offset, names, anchor, first, last in anchored_runs(data, length):
                    cut = cells(anchor, first, last, length, width)
                    parts.append(_rows(key, offset, names, len(data), *cut, anchor, np.ones(len(cut[0]), bool), length))
                    rows += len(cut[0])
                    if rows > 100_000:
                        yield _batch(parts)
                        parts, rows = [], 0
            yield _batch(parts)

    return documents.select("k", "text").mapInArrow(run, _CELLS)


def smaller_cells(documents: DataFrame, left: DataFrame, length: int, width: int) -> DataFrame:
    """The cells of ``left`` cut to ``width``."""
    lists = left.groupBy("k").agg(F.collect_list(F.struct("place", "open")).alias("cells"))
    if left.count() * CELL_BYTES <= BROADCAST_BYTES:
        both = documents.select("k", "text").join(F.broadcast(lists), "k")
    else:
        both = packed(documents.select("k", "text")).join(lists.hint("merge"), "k")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for key, whole, found in zip(batch.column("k").to_pylist(), _whole(batch), batch.column("cells")):
                data, found = np.frombuffer(whole, np.uint8), found.values
                anchor, first, last = _placed(found.field("place").to_numpy())
                opened = found.field("open").to_numpy(zero_copy_only=False)
                block = first // BLOCK
                parts = []
                for number in np.unique(block).tolist():
                    here = block == number
                    low = max(0, number * BLOCK - 2 * length)
                    names = Names(data[low : (number + 1) * BLOCK + 3 * length])
                    cut = cells(anchor[here] - low, first[here] - low, last[here] - low, length, width)
                    parts.append(_rows(key, low, names, len(data), *cut, anchor[here] - low, opened[here][cut[0]], length))
                yield _batch(parts)

    return both.mapInArrow(run, _CELLS)


def decided(found: DataFrame, last_round: bool) -> tuple[DataFrame, DataFrame | None]:
    """(decided cells, cells to cut further) of a round's cells."""
    spans = found.groupBy("core", "a", "b").agg(
        F.count("*").alias("n"), F.max("open").alias("open"), F.min("k").alias("k"), F.min_by("place", "k").alias("place")
    )
    if last_round:
        spans = spans.where("open and n > 1")
    spans = written(spans, "spans")
    repeated = spans.where("open and n > 1").select("core", "a", "b")
    done = found.where("open").join(repeated, ["core", "a", "b"], "left_semi").select("k", "place")
    if last_round:
        return done, None
    undecided = F.col("open") & (F.col("n") == 1)
    cores = spans.groupBy("core").agg(F.count("*").alias("spans"), F.max(undecided).alias("undecided")).where("spans > 1 and undecided")
    cores = written(cores.select("core"), "open-cores")  # one row a core: a core of many spans can be split by the join
    left = spans.join(cores, "core", "left_semi").select("k", "place", undecided.alias("open"))
    return done, written(left, "cells")


def repeats(documents: DataFrame, length: int = LENGTH) -> DataFrame:
    """``k`` and ``place`` of the cells whose windows of ``length`` bytes start elsewhere too."""
    if not SHORT < length <= _REST:
        raise ValueError(f"a repeat has more than {SHORT} and at most {_REST} bytes")
    part = max(1, length // 16)
    widths = [8 * part, part, 1]  # each divides the one before, so a smaller cell lies in one larger
    found, remove = written_for_now(first_cells(documents, length, widths[0]), "all-cells")
    shared = found.groupBy("core").agg(F.count("*").alias("n")).where("n > 1").select("core")
    found = written(found.join(written(shared, "shared-cores"), "core", "left_semi").select(_NAMES), "shared-cells")
    remove()
    ranges = None
    for width in widths[1:] + [None]:
        done, left = decided(found, width is None)
        ranges = done if ranges is None else ranges.unionByName(done)
        if width is not None:
            found = written(smaller_cells(documents, left, length, width), "smaller-cells")
    return ranges


RESULT = "n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string"


def _kept(data: bytes, ranges: pa.Scalar, length: int) -> tuple[int, int, bytes]:
    """(removed bytes, removed runs, what is kept)."""
    if not ranges.is_valid or not len(ranges.values):
        return 0, 0, data
    _, begin, last = _placed(np.sort(ranges.values.to_numpy()))
    end = np.maximum.accumulate(last + length)
    fresh = np.concatenate([[True], begin[1:] > end[:-1]])  # touching runs are one
    begin, end = begin[fresh], end[np.concatenate([np.flatnonzero(fresh)[1:] - 1, [len(end) - 1]])]
    edges = [0, *np.stack([begin, end], 1).ravel().tolist(), len(data)]
    kept = b"".join(data[a:b] for a, b in zip(edges[::2], edges[1::2]))
    return len(data) - len(kept), len(begin), kept


def without_repeats(documents: DataFrame, length: int = LENGTH, keep_text: bool = False) -> DataFrame:
    """``doc_id``, counts of bytes and removed runs, and the checksum of what is kept of every text;
    with ``keep_text`` the kept bytes too."""
    docs = texts(documents)
    ranges = repeats(docs, length).groupBy(F.col("k").alias("_k")).agg(F.collect_set("place").alias("ranges"))
    both = packed(docs).join(ranges.hint("merge"), F.col("k") == F.col("_k"), "left").select("doc_id", "packed", "ranges")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, removed, spans, digests, texts_kept = [], [], [], [], []
            for data, found in zip(_whole(batch), batch.column("ranges")):
                gone, n, kept = _kept(data, found, length)
                sizes.append(len(data))
                removed.append(gone)
                spans.append(n)
                digests.append(hashlib.sha256(kept).hexdigest())
                texts_kept.append(kept)
            columns = [pa.array(x, pa.int64()) for x in (sizes, removed, spans)] + [pa.array(digests, pa.string())]
            more = [pa.array(texts_kept, pa.binary())] if keep_text else []
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *columns, *more],
                ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", *["kept"] * keep_text],
            )

    kind = dict(docs.dtypes)["doc_id"]
    return both.mapInArrow(run, f"doc_id {kind}, {RESULT}" + ", kept binary" * keep_text)
