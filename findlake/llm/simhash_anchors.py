"""SimHash near-duplicates by covering codes.

A fingerprint's 64 bits are cut into parts. Two fingerprints at distance ``DISTANCE`` or less differ
in at most ``DISTANCE // parts`` bits of some part. In each part the words of a covering code are the
anchors: the first 15 bits run through the [15,11] Hamming code, the others are taken as they are,
so every value lies within 1 bit of exactly one anchor, its home. Each fingerprint goes to its home
and, as a replica, to every anchor within 1 + ``DISTANCE // parts`` bits: a linked pair meets at the
home of either. Per anchor the homes are compared with the replicas over all 64 bits.

No group is held whole: an anchor with very many homes is cut into slices, the replicas stream past
one slice at a time, and of the links found only a spanning forest is returned, never all pairs.

Defined results: a null or empty text, or one of white space, has fingerprint zero and links like any
other. Fewer than four words are one shingle. Repeated rows get equal results each. A null ``doc_id``
is never the smallest of a group; a group without any other has a null component. No rows give no
rows. Columns other than id and text are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import texts, written
from .components import components

SHINGLE = 4
SEED = 42
DISTANCE = 4
# From this many different fingerprints on, two long parts keep the anchors small; below, three.
LONG_PARTS_FROM = 1 << 25
# Homes of one anchor that are compared at a time.
SLICE = 20_000
PAIRS_AT_ONCE = 1 << 21
SHINGLES_AT_ONCE = 1 << 17


_LANES = np.uint64(0x0101010101010101)


def _ones(hashes: np.ndarray) -> np.ndarray:
    """How many hashes have each bit set, highest bit first. Eight counters share a word, so at
    most 255 hashes are added before they are spread out."""
    starts = np.arange(0, len(hashes), 255)
    ones = np.zeros((8, 8), np.int64)
    for bit in range(8):
        sums = np.add.reduceat((hashes >> np.uint64(bit)) & _LANES, starts)
        ones[:, 7 - bit] = sums.byteswap().view(np.uint8).reshape(-1, 8).sum(axis=0, dtype=np.int64)
    return ones.ravel()


def fingerprint(text: str) -> int:
    """64 bits, each set if it is set in over half of the shingles' hashes; as a signed integer."""
    found = text.encode("utf-8", "surrogatepass").lower().split()
    if not found:
        return 0
    if len(found) <= SHINGLE:
        hashes = [np.array([xxhash.xxh64_intdigest(b" ".join(found), SEED)], np.uint64)]
        count = 1
    else:
        joined = b" ".join(found)
        sizes = np.fromiter(map(len, found), np.int64, len(found))
        ends = np.cumsum(sizes + 1) - 1
        first = (ends - sizes)[: 1 - SHINGLE].tolist()
        last = ends[SHINGLE - 1 :].tolist()
        count = len(first)
        digest = xxhash.xxh64_intdigest
        hashes = (
            np.array([digest(joined[a:b], SEED) for a, b in zip(first[i : i + SHINGLES_AT_ONCE], last[i : i + SHINGLES_AT_ONCE])], np.uint64)
            for i in range(0, count, SHINGLES_AT_ONCE)
        )
    ones = np.zeros(64, np.int64)
    for part in hashes:
        ones += _ones(part)
    return int.from_bytes(np.packbits(2 * ones > count).tobytes(), "big", signed=True)


def _fingerprints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        values = [fingerprint(t) for t in batch.column("text").to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column("k"), batch.column("doc_id"), pa.array(values, pa.int64())], ["k", "doc_id", "fp"])


def fingerprints(documents: DataFrame) -> DataFrame:
    """``k``, ``doc_id`` and ``fp`` of every document."""
    docs = texts(documents)
    kind = dict(docs.dtypes)["doc_id"]
    return docs.mapInArrow(_fingerprints, f"k bigint, doc_id {kind}, fp bigint")


# Hamming [15,11]: the syndrome of a value is the xor of the places (1..15) of its ones, and is
# itself the place of the one bit that leads to the home.
_SYNDROME = np.zeros(1 << 15, np.uint64)
for _bit in range(15):
    _SYNDROME[1 << _bit : 2 << _bit] = _SYNDROME[: 1 << _bit] ^ np.uint64(_bit + 1)


def _part_widths(parts: int) -> list[int]:
    return [64 // parts + (1 if i < 64 % parts else 0) for i in range(parts)]


def _reach(width: int, radius: int) -> list[np.ndarray]:
    """For each syndrome, the bit patterns of weight ``radius`` or less that lead to an anchor."""
    from itertools import combinations

    patterns: list[list[int]] = [[] for _ in range(16)]
    for weight in range(radius + 1):
        for places in combinations(range(width), weight):
            pattern = sum(1 << p for p in places)
            patterns[int(_SYNDROME[pattern & 0x7FFF])].append(pattern)
    return [np.array(p, np.uint64) for p in patterns]


def anchors(values: np.ndarray, parts: int, homes_only: bool) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(anchor, fingerprint, is home) for blocks of the unsigned ``values``, part by part."""
    shift = 0
    for part, width in enumerate(_part_widths(parts)):
        word = (values >> np.uint64(shift)) & np.uint64((1 << width) - 1)
        shift += width
        syndrome = _SYNDROME[(word & np.uint64(0x7FFF)).astype(np.int64)]
        home = np.where(syndrome > 0, word ^ (np.uint64(1) << (np.maximum(syndrome, 1) - np.uint64(1))), word)
        tag = np.uint64(part << 60)
        yield home | tag, values, np.ones(len(values), bool)
        if homes_only:
            continue
        for s, patterns in enumerate(_reach(width, 1 + DISTANCE // parts)):
            here = syndrome == s
            if here.any():
                to = word[here][:, None] ^ patterns[None, :]
                yield to.ravel() | tag, np.repeat(values[here], len(patterns)), np.zeros(to.size, bool)


def _placed(parts: int, homes_only: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = batch.column("fp").to_numpy().astype(np.int64).view(np.uint64)
            for i in range(0, len(values), 2048):
                for anchor, fp, home in anchors(values[i : i + 2048], parts, homes_only):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(anchor.view(np.int64)), pa.array(fp.view(np.int64)), pa.array(home)], ["anchor", "fp", "home"]
                    )

    return run


class _Forest:
    """Union by smallest index."""

    def __init__(self, size: int):
        self.up = list(range(size))

    def find(self, x: int) -> int:
        while self.up[x] != x:
            self.up[x] = self.up[self.up[x]]
            x = self.up[x]
        return x

    def join(self, x: int, y: int) -> bool:
        x, y = self.find(x), self.find(y)
        if x == y:
            return False
        self.up[max(x, y)] = min(x, y)
        return True


def _close(homes: np.ndarray, others: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Indexes (home, other) of the linked pairs, each other than a fingerprint with itself."""
    near = np.bitwise_count(homes[:, None] ^ others[None, :])
    return np.nonzero((near <= DISTANCE) & (near > 0))


def _linked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links within each (anchor, slice); the rows come sorted, homes before replicas."""
    key, homes, forest = None, np.zeros(0, np.uint64), _Forest(0)
    for batch in batches:
        anchor = batch.column("anchor").to_numpy()
        piece = batch.column("slice").to_numpy()
        fp = batch.column("fp").to_numpy().view(np.uint64)
        home = batch.column("home").to_numpy(zero_copy_only=False)
        cuts = np.flatnonzero((anchor[1:] != anchor[:-1]) | (piece[1:] != piece[:-1])) + 1
        left: list[np.ndarray] = []
        right: list[np.ndarray] = []
        for a, b in zip([0, *cuts.tolist()], [*cuts.tolist(), len(fp)]):
            if a == b:
                continue
            if (anchor[a], piece[a]) != key:
                key, homes, forest = (anchor[a], piece[a]), np.zeros(0, np.uint64), None
            n = int(np.count_nonzero(home[a:b]))
            if n:
                homes = np.concatenate([homes, fp[a : a + n]])
            others = fp[a + n : b]
            if not len(homes) or not len(others):
                continue
            step = max(1, PAIRS_AT_ONCE // len(homes))
            for i in range(0, len(others), step):
                x, y = _close(homes, others[i : i + step])
                if not len(x):
                    continue
                # One link for each replica, then those that join homes nothing has joined yet.
                forest = forest or _Forest(len(homes))
                once, first = np.unique(y, return_inverse=True, return_index=True)[1:]
                of = x[once][first]
                roots = np.array(forest.up)
                more = np.flatnonzero(roots[of] != roots[x])
                more = more[np.unique(of[more] * len(homes) + x[more], return_index=True)[1]]
                joined = [j for j in more.tolist() if forest.join(int(of[j]), int(x[j]))]
                if joined:
                    forest.up = [forest.find(i) for i in range(len(homes))]
                chosen = np.concatenate([once, np.array(joined, np.int64)])
                left.append(homes[x[chosen]])
                right.append(others[i : i + step][y[chosen]])
        if left:
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate(left).view(np.int64)), pa.array(np.concatenate(right).view(np.int64))], ["a", "b"]
            )


def links(different: DataFrame, parts: int, slice_size: int = SLICE) -> DataFrame:
    """Links (a, b) that connect every two of the ``different`` fingerprints at a small distance."""
    schema = "anchor bigint, fp bigint, home boolean"
    homes = different.mapInArrow(_placed(parts, True), schema)
    large = homes.groupBy("anchor").agg(F.count("*").alias("n")).where(F.col("n") > slice_size)
    large = written(large.select(F.col("anchor").alias("_anchor"), F.ceil(F.col("n") / slice_size).cast("int").alias("slices")), "anchors")
    rows = different.mapInArrow(_placed(parts, False), schema)
    if not large.isEmpty():
        rows = rows.join(large, rows.anchor == F.col("_anchor"), "left")
        slices = F.coalesce("slices", F.lit(1))
        own = F.array(F.pmod(F.xxhash64("fp"), slices).cast("int"))
        rows = rows.select("anchor", "fp", "home", F.explode(F.when(F.col("home"), own).otherwise(F.sequence(F.lit(0), slices - 1))).alias("slice"))
    else:
        rows = rows.withColumn("slice", F.lit(0))
    dealt = rows.repartition("anchor", "slice").sortWithinPartitions("anchor", "slice", F.col("home").desc())
    return dealt.mapInArrow(_linked, "a bigint, b bigint")


def groups(documents: DataFrame) -> DataFrame:
    """``k``, ``doc_id``, ``fp``, ``component_id`` and ``root`` (any fingerprint of the group) of every
    document."""
    prints = written(fingerprints(documents), "fingerprints")
    different = written(prints.groupBy("fp").agg(F.min("doc_id").alias("first")), "different-fingerprints")
    parts = 3 if different.count() < LONG_PARTS_FROM else 2
    labels = components(written(links(different.select("fp"), parts), "close-fingerprints"))
    rooted = different.join(labels, F.col("fp") == F.col("node"), "left").select("fp", "first", F.coalesce("root", "fp").alias("root"))
    rooted = written(rooted, "rooted-fingerprints")
    smallest = rooted.groupBy("root").agg(F.min("first").alias("component_id"))
    named = written(rooted.join(smallest, "root").select(F.col("fp").alias("_fp"), "component_id", "root"), "named-fingerprints")
    return prints.join(named, prints.fp == named["_fp"]).select("k", "doc_id", "fp", "component_id", "root")


def representatives(found: DataFrame) -> DataFrame:
    """``k`` and ``doc_id`` of the row of each group that stays: the smallest id, nulls last."""
    first = F.min(F.struct(F.col("doc_id").isNull().alias("unknown"), "doc_id", "k")).alias("first")
    return found.groupBy("root").agg(first).select("first.k", "first.doc_id")


def near_duplicates(documents: DataFrame) -> DataFrame:
    """``doc_id``, ``fingerprint`` (16 hex digits) and ``component_id`` of every document."""
    found = groups(documents)
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
