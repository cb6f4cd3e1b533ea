"""Benchmark decontamination by greedy string tiling.

A document and a benchmark item that share a run of five tokens are a candidate pair. For each pair
the longest run of tokens that both hold and no tile covers yet is marked as a tile, again and
again, until no run of five or more is left; Karp-Rabin hashes of the five-token windows find where
runs can begin. The share of the item's tokens under tiles is its coverage. Tiles may lie anywhere
in the document, so a passage whose sentences were put in another order is still covered.

A benchmark up to ``BROADCAST_BYTES`` (its texts are measured first) is sent to every executor, and
documents are tiled where they are read. For a larger one, windows of documents and items are joined
by a shuffle, and only the pairs found travel with their texts. Both ways give the same rows.

Defined results: tokens are runs of letters, digits and underscores, in lower case. A null or empty
text and an item of fewer than five tokens match nothing. A very long text is one value: its tokens are
held by the task that tiles it, 8 bytes each, and no part of it is left out. Rows with the same ``item_id`` are items of
their own; for each ``doc_id`` and ``item_id`` the best coverage is returned, so repeated rows change
nothing. A null id is an id. Empty tables give no rows. Other columns are not read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import texts, written

LEAST = 5
MIN_COVERAGE = 0.6
BROADCAST_BYTES = 32 << 20
_BASE = np.uint64(0x9E3779B97F4A7C15)
_TOKEN = re.compile(r"\w+")
TILED = "n_tokens bigint, n_covered bigint, n_tiles bigint, longest bigint"


def tokens(text: str | None) -> list[str]:
    return _TOKEN.findall((text or "").lower())


def _numbers(found: list[str]) -> np.ndarray:
    """A 64-bit number for each token."""
    return np.fromiter((xxhash.xxh64_intdigest(t.encode("utf-8", "surrogatepass")) | 1 for t in found), np.uint64, len(found))


def windows(values: np.ndarray, least: int = LEAST) -> np.ndarray:
    """Karp-Rabin hash of each window of ``least`` tokens."""
    n = max(0, len(values) - least + 1)
    hashes = np.zeros(n, np.uint64)
    for i in range(least):
        hashes = hashes * _BASE + values[i : i + n]
    return hashes


def _runs(doc: np.ndarray, item: np.ndarray, starts: np.ndarray, at: dict[int, list[int]], hashes: np.ndarray, free_doc, free_item, least: int):
    """(length, start in item, start in document) of the longest runs of free tokens."""
    best: list[tuple[int, int, int]] = []
    longest = least
    for p in starts.tolist():
        if not free_doc[p : p + least].all():
            continue
        for q in at[int(hashes[p])]:
            if not free_item[q : q + least].all():
                continue
            if p and q and free_doc[p - 1] and free_item[q - 1] and doc[p - 1] == item[q - 1]:
                continue  # the run began earlier
            n, most = 0, min(len(doc) - p, len(item) - q)
            while n < most and doc[p + n] == item[q + n] and free_doc[p + n] and free_item[q + n]:
                n += 1
            if n > longest:
                best, longest = [], n
            if n == longest:
                best.append((n, q, p))
    return best


def tiles(doc: np.ndarray, item: np.ndarray, hashes: np.ndarray | None = None, least: int = LEAST) -> list[tuple[int, int, int]]:
    """Tiles (start in document, start in item, length), longest first; of equally long ones the
    earlier in the item, then in the document, is marked first."""
    hashes = windows(doc, least) if hashes is None else hashes
    at: dict[int, list[int]] = {}
    for q, h in enumerate(windows(item, least).tolist()):
        at.setdefault(h, []).append(q)
    starts = np.flatnonzero(np.isin(hashes, np.fromiter(at, np.uint64, len(at))))
    free_doc, free_item = np.ones(len(doc), bool), np.ones(len(item), bool)
    found: list[tuple[int, int, int]] = []
    while len(starts):
        marked = False
        for n, q, p in sorted(_runs(doc, item, starts, at, hashes, free_doc, free_item, least), key=lambda r: r[1:]):
            if free_doc[p : p + n].all() and free_item[q : q + n].all():
                free_doc[p : p + n] = free_item[q : q + n] = False
                found.append((p, q, n))
                marked = True
        if not marked:
            break
    return found


def _summary(item: np.ndarray, found: list[tuple[int, int, int]]) -> tuple[int, int, int, int]:
    return len(item), sum(n for _, _, n in found), len(found), max((n for _, _, n in found), default=0)



def _pairs_here(documents: DataFrame, items: list[tuple[object, str]], id_type: str) -> DataFrame:
    """Tiled pairs, for a benchmark that fits on every executor."""
    numbers = [_numbers(tokens(text)) for _, text in items]
    vocabulary: dict[str, int] = {}
    values_of = [0]  # place 0: a token of no item
    for (_, text), values in zip(items, numbers):
        for t, n in zip(tokens(text), values.tolist()):
            if vocabulary.setdefault(t, len(values_of)) == len(values_of):
                values_of.append(n)
    seeds: dict[int, list[int]] = {}
    for j, values in enumerate(numbers):
        for h in set(windows(values).tolist()):
            seeds.setdefault(h, []).append(j)
    shared = documents.sparkSession.sparkContext.broadcast(
        ([i for i, _ in items], numbers, vocabulary, np.array(values_of, np.uint64), np.sort(np.fromiter(seeds, np.uint64, len(seeds))), seeds)
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, items, vocabulary, values_of, known, seeds = shared.value
        number = vocabulary.get
        for batch in batches:
            rows, item_ids, results = [], [], []
            for i, text in enumerate(batch.column("text")):
                found = tokens(text.as_py())
                place = np.fromiter((number(t, 0) for t in found), np.int64, len(found))
                inside = np.cumsum(np.concatenate([[0], place != 0]))
                begin = np.flatnonzero(inside[LEAST:] - inside[:-LEAST] == LEAST) if len(place) >= LEAST else []
                if not len(begin) or not len(known):
                    continue
                doc = values_of[place]
                hashes = windows(doc)
                here = hashes[begin]
                hit = here[known[np.minimum(np.searchsorted(known, here), len(known) - 1)] == here]
                for j in sorted({j for h in np.unique(hit).tolist() for j in seeds[h]}):
                    rows.append(i)
                    item_ids.append(ids[j])
                    results.append(_summary(items[j], tiles(doc, items[j], hashes)))
            columns = [pa.array(c, pa.int64()) for c in zip(*results)] if results else [pa.array([], pa.int64())] * 4
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").take(pa.array(rows, pa.int64())), pa.array(item_ids, _arrow(id_type)), *columns],
                ["doc_id", "item_id", "n_tokens", "n_covered", "n_tiles", "longest"],
            )

    kind = dict(documents.dtypes)["doc_id"]
    return documents.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, item_id {id_type}, {TILED}")


def _arrow(kind: str) -> pa.DataType:
    return {"bigint": pa.int64(), "int": pa.int32(), "smallint": pa.int16(), "tinyint": pa.int8()}.get(kind, pa.string())


def _seeds(rows: DataFrame) -> DataFrame:
    """Row number and each different window hash of ``text``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, text in enumerate(batch.column("text")):
                hashes = np.unique(windows(_numbers(tokens(text.as_py())))).view(np.int64)
                yield pa.RecordBatch.from_arrays([batch.column("k").take(pa.array([i] * len(hashes), pa.int64())), pa.array(hashes)], ["k", "h"])

    return rows.select("k", "text").mapInArrow(run, "k bigint, h bigint")


def _pairs_joined(documents: DataFrame, benchmark: DataFrame, id_type: str) -> DataFrame:
    """Tiled pairs, for any size of benchmark: seeds meet in a shuffle."""
    items = benchmark.select(F.xxhash64("item_id", "text").alias("k"), "item_id", F.col("text").alias("item_text")).distinct()
    wanted = written(_seeds(items.select("k", F.col("item_text").alias("text"))).distinct(), "benchmark-seeds").withColumnRenamed("k", "item_k")
    docs = documents.distinct()
    pairs = written(_seeds(docs).join(wanted, "h").select("k", "item_k").distinct(), "benchmark-pairs")
    both = pairs.join(docs, "k").join(items.withColumnRenamed("k", "item_k"), "item_k").select("doc_id", "item_id", "text", "item_text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            results = []
            for text, item in zip(batch.column("text"), batch.column("item_text")):
                values = _numbers(tokens(item.as_py()))
                results.append(_summary(values, tiles(_numbers(tokens(text.as_py())), values)))
            columns = [pa.array(c, pa.int64()) for c in zip(*results)] if results else [pa.array([], pa.int64())] * 4
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("item_id"), *columns], ["doc_id", "item_id", "n_tokens", "n_covered", "n_tiles", "longest"]
            )

    kind = dict(documents.dtypes)["doc_id"]
    return both.mapInArrow(run, f"doc_id {kind}, item_id {id_type}, {TILED}")


def overlaps(documents: DataFrame, benchmark: DataFrame, broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """``doc_id``, ``item_id`` and the tiles of every pair that shares five tokens in a row."""
    docs = texts(documents)
    items = benchmark.select("item_id", F.coalesce("text", F.lit("")).alias("text"))
    id_type = dict(items.dtypes)["item_id"]
    size = items.agg(F.sum(F.octet_length("text")), F.count("*")).first()
    if (size[0] or 0) + 100 * size[1] <= broadcast_bytes and id_type in ("bigint", "int", "smallint", "tinyint", "string"):
        tiled = _pairs_here(docs, [tuple(row) for row in items.distinct().collect()], id_type)  # measured just before
    else:
        tiled = _pairs_joined(docs, items, id_type)
    best = Window.partitionBy("doc_id", "item_id").orderBy(F.desc("coverage"), F.desc("n_tokens"), F.desc("longest"), "n_tiles")
    tiled = tiled.withColumn("coverage", F.col("n_covered") / F.col("n_tokens"))
    return tiled.withColumn("_best", F.row_number().over(best)).where("_best = 1").drop("_best")


def contaminated(documents: DataFrame, benchmark: DataFrame, min_coverage: float = MIN_COVERAGE) -> DataFrame:
    """The pairs whose item is covered to ``min_coverage`` or more."""
    return overlaps(documents, benchmark).where(F.col("coverage") >= min_coverage)
