"""Aligns the tokens of two tokenizers by pointer jumping, and counts which ids go together.

Both tokenizers cut the same bytes, so a token of one overlaps some of the other. Every token points to
the farthest-right token it overlaps; a token that ends where one of the other ends is as far as it
gets. Following all pointers at once and doubling them (``successor = successor[successor]``) until
nothing moves leaves each token pointing at the last token of its component: the component's label. All
tokens of a portion of texts are one vector.

Every token of a group is linked with every token of the other side there. A pair of ids counts once
for each document that holds it linked. Documents leave the tasks as sums and their different pairs;
pairs are counted in tasks before they are shuffled. The counts go back to the documents in two ways:
the ``FREQUENT`` most common pairs (a fixed bound, cut where counts reach a power of two) are sent to all
executors, the rarer ones, of which none is a hot key any more, are joined by a shuffle.

Defined results: the first tokenizer gets a space and the text, the second the text, before which it
puts the space itself. A null or empty text, or one whose tokens of either side do not spell it, has no
tokens: all numbers are 0 and the hash is ''. Special tokens' strings in a text are text. Repeated rows
are documents of their own. A null id stays null. No rows give no rows. Columns other than id and text
are not read. Of a document with very many links some at a time are held.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import written
from .token_ids import Encoder, PieceEncoder, encoder, piece_encoder, portions, slices

# Links that are written out one by one at a time.
LINKS = 1 << 20
# Pairs whose counts every executor gets: 17 bytes each.
FREQUENT = 1 << 20


def successors(a_ends: np.ndarray, b_ends: np.ndarray) -> np.ndarray:
    """For every token, first those of ``a`` and then those of ``b``, the farthest-right token that it
    overlaps; ends are byte offsets over the same bytes."""
    to_b = np.searchsorted(b_ends, a_ends, "left")
    to_a = np.searchsorted(a_ends, b_ends, "left")
    farther = a_ends[to_a] > b_ends
    own = len(a_ends) + np.arange(len(b_ends))
    return np.concatenate([len(a_ends) + to_b, np.where(farther, to_a, own)])


def labels(a_ends: np.ndarray, b_ends: np.ndarray) -> np.ndarray:
    """The last token of each token's component."""
    successor = successors(a_ends, b_ends)
    while True:
        doubled = successor[successor]
        if np.array_equal(doubled, successor):
            return successor
        successor = doubled


def _sizes(label: np.ndarray) -> np.ndarray:
    """Lengths of the runs of equal labels."""
    starts = np.flatnonzero(np.diff(label, prepend=-1))
    return np.diff(starts, append=len(label))


class Portion:
    """The tokens of some texts, one text after the other, and their groups."""

    def __init__(self, texts: list[str], first: Encoder, second: PieceEncoder):
        spaced = [" " + t for t in texts]
        a, b = first.encode(spaced), second.encode(spaced)
        for i, text in enumerate(spaced):
            size = len(text.encode())
            if size == 1 or first.width[a[i]].sum() != size or second.width[b[i]].sum() != size:
                a[i] = b[i] = np.zeros(0, "<u4")
        self.n_a = np.fromiter(map(len, a), np.int64, len(a))
        self.n_b = np.fromiter(map(len, b), np.int64, len(b))
        self.a = np.concatenate([*a, np.zeros(0, "<u4")]).astype(np.int64)
        self.b = np.concatenate([*b, np.zeros(0, "<u4")]).astype(np.int64)
        a_ends, b_ends = np.cumsum(first.width[self.a]), np.cumsum(second.width[self.b])
        label = labels(a_ends, b_ends)
        self.p, self.q = _sizes(label[: len(self.a)]), _sizes(label[len(self.a) :])  # tokens of each group
        # Groups never cross texts, since texts end both sides.
        a_before = np.concatenate([[0], np.cumsum(self.n_a)])
        self.groups = np.searchsorted(np.cumsum(self.p), a_before, "right") if len(self.p) else np.zeros(len(a_before), np.int64)
        self.a_at, self.b_at = a_before, np.concatenate([[0], np.cumsum(self.n_b)])

    def group_texts(self, names: list[bytes], a_ids: int, b_ids: int) -> Iterator[bytes]:
        """``a1,a2|b1;a3|b2`` of every text. ``names``: see ``id_names``."""
        a_group, b_group = np.repeat(np.arange(len(self.p)), self.p), np.repeat(np.arange(len(self.q)), self.q)
        a_last, b_last = np.cumsum(self.p) - 1, np.cumsum(self.q) - 1
        a_code, b_code = self.a.copy(), self.b + 2 * a_ids
        a_code[a_last] += a_ids
        b_code[b_last] += b_ids
        merged = np.empty(len(a_code) + len(b_code), np.int64)
        merged[np.arange(len(a_code)) + (np.cumsum(self.q) - self.q)[a_group]] = a_code
        merged[np.arange(len(b_code)) + np.cumsum(self.p)[b_group]] = b_code
        at = self.a_at + self.b_at
        for start, stop in zip(at[:-1].tolist(), at[1:].tolist()):
            yield b"".join(map(names.__getitem__, merged[start:stop].tolist()))[:-1]

    def pairs(self, i: int, b_ids: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """The different pairs of ids linked in text ``i`` and how often, some at a time."""
        a, b = self.a[self.a_at[i] : self.a_at[i + 1]], self.b[self.b_at[i] : self.b_at[i + 1]]
        p, q = (s[self.groups[i] : self.groups[i + 1]] for s in (self.p, self.q))
        mates = np.repeat(q, p)  # of each token of a
        from_b = np.repeat(np.cumsum(q) - q, p)
        if not len(a):
            return
        if int(mates.sum()) <= LINKS:
            yield np.unique(_linked(a, b, mates, from_b, b_ids), return_counts=True)
            return
        order = np.argsort(a, kind="stable")
        a, mates, from_b = a[order], mates[order], from_b[order]
        starts = np.flatnonzero(np.diff(a, prepend=-1))
        heaps = np.add.reduceat(mates, starts)
        number = (np.cumsum(heaps) - heaps) // LINKS  # ids of a that are taken together
        for n in np.unique(number):
            of = np.flatnonzero(number == n)
            start, stop = starts[of[0]], starts[of[-1] + 1] if of[-1] + 1 < len(starts) else len(a)
            keys, times = np.zeros(0, np.int64), np.zeros(0, np.int64)
            links = np.cumsum(mates[start:stop])
            while start < stop:
                end = start + max(1, int(np.searchsorted(links, LINKS, "right")))
                end = min(end, stop)
                found, n_times = np.unique(_linked(a[start:end], b, mates[start:end], from_b[start:end], b_ids), return_counts=True)
                keys, places = np.unique(np.concatenate([keys, found]), return_inverse=True)
                times = np.bincount(places, np.concatenate([times, n_times]), len(keys)).astype(np.int64)
                links = links[end - start :] - links[end - start - 1]
                start = end
            yield keys, times


def _linked(a: np.ndarray, b: np.ndarray, mates: np.ndarray, from_b: np.ndarray, b_ids: int) -> np.ndarray:
    """One number for each link: the ids of its two tokens."""
    ends = np.cumsum(mates)
    at = np.arange(ends[-1]) + np.repeat(from_b - ends + mates, mates)
    return np.repeat(a, mates) * b_ids + b[at]


def id_names(a_ids: int, b_ids: int) -> list[bytes]:
    """Decimal ids with what follows them: of ``a`` within and at the end of its side, then of ``b``."""
    return [b"%d%s" % (i, end) for size, ends in ((a_ids, (b",", b"|")), (b_ids, (b",", b";"))) for end in ends for i in range(size)]


_names: dict[tuple[int, int], list[bytes]] = {}


def align(documents: DataFrame, first: str, second: str) -> DataFrame:
    """Both tokenizers' ids of every document, and how many of them each group has: ``doc_id``, ``a_ids``,
    ``b_ids``, ``a_sizes``, ``b_sizes``."""
    columns = ("a_ids", "b_ids", "a_sizes", "b_sizes")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        one, two = encoder(first, True), piece_encoder(second)
        for batch in batches:
            for at, texts in portions(batch.column("text")):
                found = Portion(texts, one, two)
                bounds = (found.a_at, found.b_at, found.groups, found.groups)
                values = (found.a, found.b, found.p, found.q)
                lists = [pa.ListArray.from_arrays(pa.array(o, pa.int32()), pa.array(v, pa.int32())) for o, v in zip(bounds, values)]
                yield pa.RecordBatch.from_arrays([batch.column("doc_id").slice(at, len(texts)), *lists], ["doc_id", *columns])

    kind = dict(documents.select("doc_id").dtypes)["doc_id"]
    return documents.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, " + ", ".join(f"{c} array<int>" for c in columns))


_SUMS = ["n_a", "n_b", "n_groups", "n_links"]
_PAIRS = "row bigint, whole boolean, pairs binary, times binary"


def _summaries(documents: DataFrame, first: str, second: str) -> DataFrame:
    """A row for each document: its sums, the hash of its groups and its different pairs; and further rows
    for the pairs that were not taken at the same time (not ``whole``)."""
    kind = dict(documents.select("doc_id").dtypes)["doc_id"]
    schema = f"doc_id {kind}, " + ", ".join(f"{c} bigint" for c in _SUMS) + f", groups_sha256 string, {_PAIRS}"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        one, two = encoder(first, True), piece_encoder(second)
        sizes = len(one.width), len(two.width)
        if sizes not in _names:
            _names[sizes] = id_names(*sizes)
        row = TaskContext.get().partitionId() << 40
        for batch in batches:
            for at, texts in portions(batch.column("text")):
                found = Portion(texts, one, two)
                links = np.concatenate([[0], np.cumsum(found.p * found.q)])[found.groups]
                hashes = [hashlib.sha256(t).hexdigest() if t else "" for t in found.group_texts(_names[sizes], *sizes)]
                sums = np.stack([found.n_a, found.n_b, np.diff(found.groups), np.diff(links)])
                some: list[tuple] = []
                held = 0
                for i in range(len(texts)):
                    row += 1
                    blocks = list(found.pairs(i, sizes[1])) if sums[3, i] <= LINKS else found.pairs(i, sizes[1])
                    none = np.zeros(0, np.int64)
                    for n, (keys, times) in enumerate(blocks or [(none, none)]):
                        some.append((i, n == 0, row, keys.astype("<i8").tobytes(), times.astype("<u4").tobytes()))
                        held += len(keys)
                        if held > LINKS:
                            yield _rows(some, batch, at, sums, hashes)
                            some, held = [], 0
                if some:
                    yield _rows(some, batch, at, sums, hashes)

    return documents.select("doc_id", "text").mapInArrow(run, schema)


def _rows(some: list[tuple], batch: pa.RecordBatch, at: int, sums: np.ndarray, hashes: list[str]) -> pa.RecordBatch:
    text = np.array([i for i, *_ in some])
    return pa.RecordBatch.from_arrays(
        [
            batch.column("doc_id").take(pa.array(at + text)),
            *[pa.array(s) for s in sums[:, text]],
            pa.array([hashes[i] for i in text]),
            pa.array([r for _, _, r, _, _ in some], pa.int64()),
            pa.array([w for _, w, _, _, _ in some]),
            pa.array([k for *_, k, _ in some], pa.binary()),
            pa.array([t for *_, t in some], pa.binary()),
        ],
        ["doc_id", *_SUMS, "groups_sha256", "row", "whole", "pairs", "times"],
    )


def _flat(column: pa.Array, kind: str) -> np.ndarray:
    """The numbers of all binaries of a column."""
    return np.frombuffer(b"".join(column.to_pylist()), kind)


def _partial_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in _parts(batches):
        pairs, counts = np.unique(_flat(batch.column("pairs"), "<i8"), return_counts=True)
        yield pa.RecordBatch.from_pydict({"pair": pa.array(pairs), "documents": pa.array(counts)})


def _parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The same rows, with about ``LINKS`` pairs in a batch."""
    for batch in batches:
        for first, stop in slices(batch.column("pairs"), 8 * LINKS):
            yield batch.slice(first, stop - first)


def pair_counts(summaries: DataFrame, b_ids: int) -> DataFrame:
    """``pair``, the ``documents`` that hold it linked, and whether no pair of the same first id is in
    more (``best``). A first id has at most as many pairs as the second tokenizer has ids."""
    counts = summaries.select("pairs").mapInArrow(_partial_counts, "pair bigint, documents bigint")
    counts = counts.groupBy("pair").agg(F.sum("documents").alias("documents"))
    of_first = Window.partitionBy(F.floor(F.col("pair") / b_ids))
    return counts.withColumn("best", F.col("documents") == F.max("documents").over(of_first))


def frequent_from(counts: DataFrame, most: int) -> int:
    """The least power of two that at most ``most`` pairs' counts reach."""
    level = F.floor(F.log2("documents")).cast("int").alias("level")
    sizes = {r["level"]: r["n"] for r in counts.groupBy(level).agg(F.count("*").alias("n")).collect()}  # 64 rows at most
    total, least = 0, 64
    for at in sorted(sizes, reverse=True):
        total += sizes[at]
        if total > most:
            break
        least = at
    return 1 << min(least, 62)


def aligned(documents: DataFrame, first: str, second: str, frequent: int | None = None) -> DataFrame:
    """Sums over every document's tokens, groups and links, and the counts of its links."""
    spark = documents.sparkSession
    frequent = FREQUENT if frequent is None else frequent
    b_ids = len(piece_encoder(second).width)
    summaries = written(_summaries(documents, first, second), "aligned")
    counts = written(pair_counts(summaries, b_ids), "pair-counts")
    least = frequent_from(counts, frequent)
    # At most ``frequent`` rows.
    common = counts.where(F.col("documents") >= least).orderBy("pair").toArrow()
    known = spark.sparkContext.broadcast(tuple(common.column(c).to_numpy() for c in ("pair", "documents", "best")))
    kind = dict(summaries.dtypes)["doc_id"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair, documents_of, best = known.value
        for batch in _parts(batches):
            ends = np.cumsum([len(p) // 8 for p in batch.column("pairs").to_pylist()], dtype=np.int64)
            keys, times = _flat(batch.column("pairs"), "<i8"), _flat(batch.column("times"), "<u4").astype(np.int64)
            at = np.minimum(np.searchsorted(pair, keys), max(len(pair) - 1, 0))
            hit = pair[at] == keys if len(pair) else np.zeros(len(keys), bool)
            n_best, total = np.zeros(len(keys) + 1, np.int64), np.zeros(len(keys) + 1, np.int64)
            np.cumsum(np.where(hit, best[at] if len(pair) else False, False) * times, out=n_best[1:])
            np.cumsum(np.where(hit, documents_of[at] if len(pair) else 0, 0) * times, out=total[1:])
            starts = np.concatenate([[0], ends[:-1]]).astype(np.int64)
            rare = np.flatnonzero(~hit)
            bounds = pa.array(np.concatenate([[0], np.cumsum(np.diff(np.searchsorted(rare, np.concatenate([starts, ends[-1:]]))))]), pa.int32())
            yield pa.RecordBatch.from_arrays(
                [
                    *[batch.column(c) for c in ("doc_id", *_SUMS, "groups_sha256", "row", "whole")],
                    pa.array(n_best[ends] - n_best[starts]),
                    pa.array(total[ends] - total[starts]),
                    pa.ListArray.from_arrays(bounds, pa.array(keys[rare])),
                    pa.ListArray.from_arrays(bounds, pa.array(times[rare])),
                ],
                ["doc_id", *_SUMS, "groups_sha256", "row", "whole", "n_best", "count_sum", "pairs", "times"],
            )

    schema = f"doc_id {kind}, " + ", ".join(f"{c} bigint" for c in _SUMS) + ", groups_sha256 string, row bigint, whole boolean, "
    found = written(summaries.mapInArrow(run, schema + "n_best bigint, count_sum bigint, pairs array<bigint>, times array<bigint>"), "aligned-counts")
    rare = found.select("row", F.inline(F.arrays_zip("pairs", "times")).alias("pair", "times")).join(counts.where(F.col("documents") < least), "pair")
    rare = rare.select("row", (F.col("best").cast("bigint") * F.col("times")).alias("n_best"), (F.col("documents") * F.col("times")).alias("count_sum"))
    more = rare.unionByName(found.where("NOT whole").select("row", "n_best", "count_sum"))
    more = more.groupBy(F.col("row").alias("_row")).agg(F.sum("n_best").alias("_best"), F.sum("count_sum").alias("_sum"))
    joined = found.where("whole").join(more, F.col("row") == F.col("_row"), "left")
    return joined.select(
        "doc_id",
        *_SUMS,
        (F.col("n_best") + F.coalesce("_best", F.lit(0))).alias("n_best"),
        (F.col("count_sum") + F.coalesce("_sum", F.lit(0))).alias("count_sum"),
        "groups_sha256",
    )
