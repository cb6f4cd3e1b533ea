"""Packing documents into sequences: large ones paired, small ones best-fit into the gaps.

Only lengths matter to the plan, and there are at most ``CAPACITY`` of them: the plan is made from
the count of each length. It is a list of kinds of sequence, each with the number of sequences of
that kind. Documents above a third of the capacity go at most two to a sequence: the longest is
matched with the longest that still fits beside it. Shorter ones, longest first, go where the gap is
tightest, and into new sequences when no gap is left. Pieces are then numbered within their length
and take the places of that number; nothing but the counts leaves the executors.

Defined results: a null or empty text is the one id 0. Each repeated row is packed, so equal rows
take different places. A null ``doc_id`` is packed like any other. No rows give no rows. Columns
other than id and text are not read.
"""

from __future__ import annotations

import bisect
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import written
from .token_ids import encoder, portions

CAPACITY = 2048
END = 0
# Rows that are numbered in one window group, on average.
BUCKET_ROWS = 50_000


def cut(n_ids: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces: full ones, but for the first, which takes the rest."""
    first = n_ids % capacity or min(n_ids, capacity)
    return [(0, first), *((s, capacity) for s in range(first, n_ids, capacity))]


PIECES = "piece int, start bigint, length bigint, ids_crc32 bigint"


def pieces(documents: DataFrame, tokenizer: str, capacity: int = CAPACITY) -> DataFrame:
    """The pieces of every document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(tokenizer).encode
        end = np.array([END], "<u4")
        for whole in batches:
            for first, texts in portions(whole.column("text")):
                at, number, start, length, crc = [], [], [], [], []
                for row, found in enumerate(encode(texts), first):
                    ids = np.concatenate([found, end])
                    for j, (s, n) in enumerate(cut(len(ids), capacity)):
                        at.append(row)
                        number.append(j)
                        start.append(s)
                        length.append(n)
                        crc.append(zlib.crc32(ids[s : s + n].tobytes()))
                yield pa.RecordBatch.from_arrays(
                    [
                        whole.column("doc_id").take(pa.array(at, pa.int64())),
                        pa.array(number, pa.int32()),
                        *[pa.array(x, pa.int64()) for x in (start, length, crc)],
                    ],
                    ["doc_id", "piece", "start", "length", "ids_crc32"],
                )

    kind = dict(documents.select("doc_id").dtypes)["doc_id"]
    return documents.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, {PIECES}")


def plan(counts: dict[int, int], capacity: int = CAPACITY) -> list[tuple[int, list[tuple[int, int]]]]:
    """Kinds of sequence: (how many, [(length, pieces of that length)]), for the ``counts`` of each
    length. Every step uses up a length or a kind, so there are few kinds however many pieces."""
    left = {n: c for n, c in counts.items() if c}
    large = sorted(n for n in left if 3 * n > capacity)
    kinds: dict[int, list[tuple[int, list[tuple[int, int]]]]] = {}  # by gap
    while large:
        longest = large[-1]
        fits = bisect.bisect_right(large, capacity - longest)
        mate = large[fits - 1] if fits else None
        if mate == longest and left[longest] == 1:
            mate = large[fits - 2] if fits > 1 else None
        if mate is None:
            many, recipe = left[longest], [(longest, 1)]
        elif mate == longest:
            many, recipe = left[longest] // 2, [(longest, 2)]
        else:
            many, recipe = min(left[longest], left[mate]), [(longest, 1), (mate, 1)]
        for n, c in recipe:
            left[n] -= c * many
            if not left[n]:
                large.remove(n)
        kinds.setdefault(capacity - sum(n * c for n, c in recipe), []).append((many, recipe))
    gaps = sorted(kinds)

    def put(gap: int, many: int, recipe: list[tuple[int, int]]) -> None:
        if many:
            if gap not in kinds:
                kinds[gap] = []
                bisect.insort(gaps, gap)
            kinds[gap].append((many, recipe))

    for n in sorted((n for n in left if 3 * n <= capacity), reverse=True):
        rest = left[n]
        while rest:
            i = bisect.bisect_left(gaps, n)
            if i < len(gaps):
                gap = gaps[i]
                many, recipe = kinds[gap].pop()
                if not kinds[gap]:
                    del kinds[gap], gaps[i]
            else:
                gap, many, recipe = capacity, -(-rest // (capacity // n)), []
            each = gap // n
            filled = min(many, rest // each)
            put(gap - each * n, filled, [*recipe, (n, each)])
            rest -= filled * each
            many -= filled
            if many and rest:  # fewer than fill one more
                put(gap - rest * n, 1, [*recipe, (n, rest)])
                rest, many = 0, many - 1
            if recipe:
                put(gap, many, recipe)
    return [kind for gap in gaps for kind in kinds[gap]]


def places(kinds: list[tuple[int, list[tuple[int, int]]]]) -> dict[int, np.ndarray]:
    """For each length the blocks of numbers, one row each: first number, first sequence, pieces of
    that length in a sequence, offset of the first of them."""
    found: dict[int, list[tuple[int, int, int, int]]] = {}
    used: dict[int, int] = {}
    sequence = 0
    for many, recipe in kinds:
        offset = 0
        for n, each in recipe:
            found.setdefault(n, []).append((used.get(n, 0), sequence, each, offset))
            used[n] = used.get(n, 0) + many * each
            offset += n * each
        sequence += many
    return {n: np.array(rows, np.int64) for n, rows in found.items()}


def numbered(found: DataFrame) -> DataFrame:
    """``found`` with ``number``, counted from 0 within each length.

    One length may hold a third of all pieces, so rows are counted in buckets of bounded size and
    the sizes of the buckets before are added.
    """
    buckets = max(1, -(-found.count() // BUCKET_ROWS))
    bucketed = found.withColumn("bucket", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.lit(buckets)))
    sizes = bucketed.groupBy("length", "bucket").agg(F.count("*").alias("n"))
    before = Window.partitionBy("length").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    sizes = sizes.select("length", "bucket", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    within = Window.partitionBy("length", "bucket").orderBy("doc_id", "piece", "ids_crc32", "start")
    ranked = bucketed.withColumn("rank", F.row_number().over(within) - 1)
    return ranked.join(sizes, ["length", "bucket"]).withColumn("number", F.col("before") + F.col("rank")).drop("bucket", "rank", "before")


def pack(documents: DataFrame, tokenizer: str, capacity: int = CAPACITY) -> DataFrame:
    """``doc_id``, the piece and its ``sequence_id`` and ``offset``, for every piece."""
    found = written(pieces(documents, tokenizer, capacity), "pieces")
    counts = {row["length"]: row["n"] for row in found.groupBy("length").agg(F.count("*").alias("n")).collect()}  # a row per length
    blocks = places(plan(counts, capacity))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length = batch.column("length").to_numpy()
            number = batch.column("number").to_numpy()
            sequence, offset = np.zeros(len(length), np.int64), np.zeros(len(length), np.int64)
            for n in np.unique(length).tolist():
                here = np.flatnonzero(length == n)
                block = blocks[n][np.searchsorted(blocks[n][:, 0], number[here], "right") - 1]
                nth = number[here] - block[:, 0]
                sequence[here] = block[:, 1] + nth // block[:, 2]
                offset[here] = block[:, 3] + nth % block[:, 2] * n
            kept = [batch.column(c) for c in ("doc_id", "piece", "start", "length", "ids_crc32")]
            yield pa.RecordBatch.from_arrays(
                [*kept, pa.array(sequence), pa.array(offset)], ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]
            )

    kind = dict(found.dtypes)["doc_id"]
    return numbered(found).mapInArrow(run, f"doc_id {kind}, {PIECES}, sequence_id bigint, offset bigint")
