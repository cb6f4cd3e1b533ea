"""Trie of the prefixes that conversations share, by union-find over sorted neighbours.

A conversation is the path of its turns' hashes. Paths are sorted over the whole table and cut into
ranges. Within a range the longest common prefix of each pair of neighbours is an edge; edges are taken
deepest first, and every union that joins two subtrees makes a branching node (or hangs one below the
other, where that one's path ends there). What lies between two such nodes has the members of the lower
one, so all nodes follow from these. Nodes on the path of a range's first or last conversation may go on
in the neighbouring ranges: of them only partial sums leave the range, two paths for each (the contracted
forest). These are merged, ``FAN`` ranges at a time, along the same edges until one is left. Closed nodes
whose parent was still open get the parent's number by a join.

The turns' texts are hashed first and never shuffled. A conversation's hashes (16 bytes a turn) are one
value, as its text would be. A group of equal conversations may span ranges: the numbers that end
at one node are then hashed as a stream, in order, without being held.

Defined results: turns are ordered by number (null first), turns of the same number by hash; repeated rows
are repeated turns. Null role or text is an empty one. A null ``conv_id`` is one conversation: it borrows
no turns, is the smallest member only where there is no other, and stands as ``null`` before the numbers
that are hashed. No rows give no nodes, not even a root. Other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from findlake.operators.ordering import hot_join

from .common import words, written

# Bytes of a turn's hash.
WIDTH = 16
# Ranges whose contracted forests are merged at a time.
FAN = 256
# Numbers in one piece of the list that is hashed, and rows handed over at a time.
PIECE = 50_000
ROWS = 20_000
NONE = -1
# Conversations of one range, on average.
RANGE_ROWS = 50_000

TURNS = "array<struct<turn:bigint,id:string,words:int>>"
_ROW = "key binary, parent_key binary, conv_id bigint, depth bigint, parent_conv_id bigint, n_convs bigint, n_children bigint, n_leaves bigint, saved_tokens bigint, ends_sha256 string"
_SPINE = "part bigint, side int, path binary, n array<bigint>, low array<bigint>, children array<bigint>, leaves array<bigint>, saved array<bigint>, words array<bigint>"
_PIECE = "nth bigint, numbers binary"
RECORD = f"kind int, {_ROW}, {_SPINE}, {_PIECE}"
NODE, SPINE, ENDS = 0, 1, 2
_TYPES = {"string": pa.string(), "binary": pa.binary(), "bigint": pa.int64(), "int": pa.int32(), "array<bigint>": pa.list_(pa.int64())}
_FIELDS = [(name, _TYPES[kind]) for name, kind in (field.split(" ") for field in RECORD.split(", "))]
NODE_COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
_NO_ENDS = hashlib.sha256(b"").hexdigest()
_LARGEST = 1 << 63  # beyond every number: no member, or only the null one


# --- conversations as paths --------------------------------------------------------------------


def ordered_turns(conversations: DataFrame) -> DataFrame:
    """``conv_id`` and its ``turns`` in order: number, hash of role and text, words of the text."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    marked = F.concat(F.length(role).cast("string"), F.lit(":"), role, text)
    turn = F.struct(
        F.col("turn").cast("bigint").alias("turn"),
        F.substring(F.sha2(marked, 256), 1, 2 * WIDTH).alias("id"),
        F.size(words(text)).alias("words"),
    )
    return conversations.select("conv_id", turn.alias("t")).groupBy("conv_id").agg(F.array_sort(F.collect_list("t")).alias("turns"))


def with_borrowed_starts(ordered: DataFrame, block: int = 20, most: int = 4) -> DataFrame:
    """Every conversation with its first ``crc32(conv_id) % most`` turns replaced by those of the
    first conversation of its block of numbers, as far as that one has them."""
    donors = ordered.where(F.col("conv_id") % block == 0).select(F.col("conv_id").alias("_donor"), F.slice("turns", 1, most - 1).alias("_start"))
    h = F.coalesce(F.crc32(F.col("conv_id").cast("string").cast("binary")) % most, F.lit(0)).cast("int")
    joined = ordered.join(donors, F.col("conv_id") - F.col("conv_id") % block == F.col("_donor"), "left")
    start = F.slice(F.coalesce("_start", F.array().cast(TURNS)), F.lit(1), h)
    return joined.select("conv_id", F.concat(start, F.slice("turns", h + 1, F.greatest(F.size("turns"), F.lit(1)))).alias("turns"))


def paths(ordered: DataFrame) -> DataFrame:
    """``conv_id``, ``path`` (the turns' hashes, one after the other) and ``words`` of each turn."""
    path = F.unhex(F.array_join(F.transform("turns", lambda t: t["id"]), ""))
    return ordered.select(F.col("conv_id").cast("bigint").alias("conv_id"), path.alias("path"), F.transform("turns", lambda t: t["words"]).alias("words"))


# --- within a range ----------------------------------------------------------------------------


def shared(a: bytes, b: bytes) -> int:
    """Turns that two paths have in common at the start."""
    most = min(len(a), len(b))
    if a[:most] == b[:most]:
        return most // WIDTH
    low, high = 0, most // WIDTH  # the first differing turn lies in [low, high)
    while high - low > 1:
        middle = (low + high) // 2
        if a[low * WIDTH : middle * WIDTH] == b[low * WIDTH : middle * WIDTH]:
            low = middle
        else:
            high = middle
    return low


def keys(path: bytes) -> list[bytes]:
    """A name for every prefix of a path."""
    digest = hashlib.blake2b(digest_size=16)
    out = [digest.digest()]
    for i in range(0, len(path), WIDTH):
        digest.update(path[i : i + WIDTH])
        out.append(digest.copy().digest())
    return out


def _joined(ids: list[int | None]) -> bytes:
    return ",".join("null" if i is None else str(i) for i in ids).encode()


class Range:
    """The different paths of a range in order, with the conversations that end at each."""

    def __init__(self):
        self.paths: list[bytes] = []
        self.words: list[np.ndarray] = []  # before each depth, added up
        self.first: list[int] = []  # place of the first conversation in ``ids``
        self.ids: list[int | None] = []

    def add(self, batch: pa.RecordBatch) -> None:
        found = batch.column("words")
        flat, offsets = found.flatten().to_numpy(zero_copy_only=False), found.offsets.to_numpy()
        offsets = offsets - offsets[0]
        for i, (path, conversation) in enumerate(zip(batch.column("path").to_pylist(), batch.column("conv_id").to_pylist())):
            if not self.paths or path != self.paths[-1]:
                self.paths.append(path)
                self.words.append(np.concatenate([[0], np.cumsum(flat[offsets[i] : offsets[i + 1]], dtype=np.int64)]))
                self.first.append(len(self.ids))
            self.ids.append(conversation)

    def ends(self, i: int) -> list[int | None]:
        return self.ids[self.first[i] : self.first[i + 1] if i + 1 < len(self.first) else len(self.ids)]


class Forest:
    """Compressed nodes of a range. The first ones are where its paths end, the rest are made by unions."""

    def __init__(self, rows: Range):
        size = len(rows.paths)
        self.rows = rows
        self.depth = [len(p) // WIDTH for p in rows.paths]
        self.path = list(range(size))  # a path that the node lies on
        ends = [rows.ends(i) for i in range(size)]
        self.n = [len(e) for e in ends]
        self.low = [min((i for i in e if i is not None), default=_LARGEST) for e in ends]
        self.ends = list(range(size))  # the path that ends here, or none
        self.children = [0] * size  # closed ones, here and in the two below
        self.leaves = [0] * size
        self.saved = [0] * size  # by all nodes below
        self.parent = [NONE] * size
        self.left_child = [NONE] * size  # open ones
        self.right_child = [NONE] * size
        self.span = [(i, i) for i in range(size)]
        self.same = list(range(size))  # nodes that turned out to be one
        above = list(range(size))
        top = list(range(size))  # of a component, kept at its root

        def find(i: int) -> int:
            while above[i] != i:
                above[i] = above[above[i]]
                i = above[i]
            return i

        lcp = [shared(a, b) for a, b in zip(rows.paths, rows.paths[1:])]
        for i in sorted(range(size - 1), key=lambda i: (-lcp[i], i)):
            a, b = find(i), find(i + 1)
            node = self._merge(top[a], top[b], lcp[i])
            if self.n[top[a]] < self.n[top[b]]:
                a, b = b, a
            above[b] = a
            top[a] = node
        self.top = top[find(0)]

    def _merge(self, a: int, b: int, depth: int) -> int:
        if self.depth[a] == depth and self.depth[b] == depth:
            for child in ("n", "children", "leaves", "saved"):
                getattr(self, child)[a] += getattr(self, child)[b]
            self.low[a] = min(self.low[a], self.low[b])
            self.left_child[a] = max(self.left_child[a], self.left_child[b])
            self.right_child[a] = max(self.right_child[a], self.right_child[b])
            self.span[a] = (self.span[a][0], self.span[b][1])
            self.same[b] = a
            return a
        if self.depth[a] == depth:
            self._hang(b, a)
            return a
        if self.depth[b] == depth:
            self._hang(a, b)
            return b
        node = len(self.n)
        for column, value in (
            ("depth", depth), ("path", self.path[a]), ("n", 0), ("low", _LARGEST), ("ends", NONE), ("children", 0), ("leaves", 0),
            ("saved", 0), ("parent", NONE), ("left_child", NONE), ("right_child", NONE), ("span", self.span[a]), ("same", node),
        ):
            getattr(self, column).append(value)
        self._hang(a, node)
        self._hang(b, node)
        return node

    def open(self, node: int) -> bool:
        left, right = self.span[node]
        return left == 0 or right == len(self.rows.paths) - 1

    def _hang(self, child: int, node: int) -> None:
        self.n[node] += self.n[child]
        self.low[node] = min(self.low[node], self.low[child])
        self.parent[child] = node
        if self.open(child):
            if self.span[child][0] == 0:
                self.left_child[node] = child
            else:
                self.right_child[node] = child
        else:
            self.children[node] += 1
            self.leaves[node] += max(1, self.leaves[child])
            before = self.rows.words[self.path[child]]
            chain = int(before[self.depth[child]] - before[self.depth[node]])
            self.saved[node] += self.saved[child] + (self.n[child] - 1) * chain
        self.span[node] = (min(self.span[node][0], self.span[child][0]), max(self.span[node][1], self.span[child][1]))

    def closed_nodes(self) -> Iterator[dict]:
        rows = self.rows
        names: dict[int, list[bytes]] = {}
        for node in range(len(self.n)):
            if self.same[node] != node or self.open(node):
                continue
            parent = self.parent[node]
            while self.same[parent] != parent:
                parent = self.same[parent]
            top, bottom = self.depth[parent], self.depth[node]
            before, low, n = rows.words[self.path[node]], _number(self.low[node]), self.n[node]
            for depth in range(top + 1, bottom + 1):
                row = {
                    "kind": NODE, "conv_id": low, "depth": depth, "parent_conv_id": low, "n_convs": n, "n_children": 1,
                    "n_leaves": max(1, self.leaves[node]), "ends_sha256": _NO_ENDS,
                    "saved_tokens": self.saved[node] + (n - 1) * int(before[bottom] - before[depth - 1]),
                }
                if depth == top + 1:
                    row["parent_conv_id"] = _number(self.low[parent])
                    if self.open(parent):  # lies on the path of the first or the last conversation
                        side = 0 if self.span[parent][0] == 0 else len(rows.paths) - 1
                        if side not in names:
                            names[side] = keys(rows.paths[side])
                        row["parent_key"], row["parent_conv_id"] = names[side][top], None
                if depth == bottom:
                    row["n_children"] = self.children[node]
                    if self.ends[node] != NONE:
                        row["ends_sha256"] = hashlib.sha256(_joined(rows.ends(self.ends[node]))).hexdigest()
                yield row

    def spines(self, part: int) -> Iterator[dict]:
        """The paths of the first and of the last conversation, with what is known of their nodes."""
        rows, last = self.rows, len(self.rows.paths) - 1
        common = shared(rows.paths[0], rows.paths[last])
        for side, path in enumerate([0, last][: 1 + (last > 0)]):
            here: dict[str, list] = {c: [] for c in ("n", "low", "children", "leaves", "saved")}
            node, names = self.top, keys(rows.paths[path])
            while node != NONE:
                while self.same[node] != node:
                    node = self.same[node]
                for depth in range(len(here["n"]), self.depth[node] + 1):
                    told = side == 1 and depth <= common  # by the other path
                    here["n"].append(0 if told else self.n[node])
                    here["low"].append(None if told else _number(self.low[node]))
                    mine = depth == self.depth[node] and not told
                    for column in ("children", "leaves", "saved"):
                        here[column].append(getattr(self, column)[node] if mine else 0)
                    if mine and self.ends[node] != NONE:
                        ids = rows.ends(self.ends[node])
                        for i in range(0, len(ids), PIECE):
                            numbers = _joined(ids[i : i + PIECE])
                            yield {"kind": ENDS, "key": names[depth], "part": part, "nth": i, "numbers": numbers}
                below = self.left_child if path == 0 else self.right_child
                node = below[node] if self.depth[node] < self.depth[path] else NONE
            each = np.diff(rows.words[path], prepend=0).tolist()
            yield {"kind": SPINE, "part": part, "side": side, "path": rows.paths[path], "words": each, **here}


def _number(low: int) -> int | None:
    return None if low == _LARGEST else low


def _batches(records: Iterator[dict]) -> Iterator[pa.RecordBatch]:
    some: list[dict] = []

    def batch() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([r.get(name) for r in some], kind) for name, kind in _FIELDS], [name for name, _ in _FIELDS])

    for record in records:
        some.append(record)
        if len(some) == ROWS or record["kind"] == ENDS:
            yield batch()
            some = []
    if some:
        yield batch()


def _forest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    rows = Range()
    for batch in batches:
        rows.add(batch)
    if rows.paths:
        forest = Forest(rows)
        yield from _batches(forest.closed_nodes())
        yield from _batches(forest.spines(TaskContext.get().partitionId()))


# --- across ranges -----------------------------------------------------------------------------


def merged(spines: list[dict], part: int, last: bool) -> Iterator[dict]:
    """Nodes that are closed once the ranges of ``spines`` (in order) are one, and that range's own
    spines; with ``last`` there are no other ranges, and all nodes are closed.

    Along the edges between neighbouring spines, deepest first, the nodes of one depth that an edge
    covers are one node.
    """
    depth = [len(s["path"]) // WIDTH for s in spines]
    lcp = [shared(a["path"], b["path"]) for a, b in zip(spines, spines[1:])]
    end = len(spines) - 1
    names = [keys(s["path"]) for s in spines]
    columns = ("n", "low", "children", "leaves", "saved")
    common = shared(spines[0]["path"], spines[end]["path"])
    out = {side: {c: [0] * (depth[side] + 1) for c in columns} for side in {0, end}}
    below: list[tuple[int, int, int, int]] = []  # closed nodes one deeper: their spine, leaves, saved
    by_depth = sorted(range(len(spines)), key=lambda s: -depth[s])
    active: list[int] = []
    for level in range(max(depth), -1, -1):
        added = 0
        while by_depth and depth[by_depth[0]] >= level:
            active.append(by_depth.pop(0))
            added += 1
        if added:
            active.sort()
        found, at = [], 0
        while at < len(active):
            first = active[at]
            stop = at
            while stop + 1 < len(active) and active[stop + 1] == active[stop] + 1 and lcp[active[stop]] >= level:
                stop += 1
            members = active[at : stop + 1]
            at = stop + 1
            values = {c: sum(spines[s][c][level] for s in members) for c in columns if c != "low"}
            values["low"] = min((low for s in members if (low := spines[s]["low"][level]) is not None), default=_LARGEST)
            while below and below[0][0] <= members[-1]:
                _, leaves, saved, _ = below.pop(0)
                values["children"] += 1
                values["leaves"] += leaves
                values["saved"] += saved
            side = 0 if first == 0 else end if members[-1] == end else None
            if side is not None and not last:
                for c in columns:
                    out[side][c][level] = values[c] if c != "low" else _number(values[c])
                continue
            leaves = max(1, values["leaves"])
            saved = values["saved"] + (values["n"] - 1) * spines[first]["words"][level]
            yield {
                "kind": NODE, "key": names[first][level], "parent_key": names[first][level - 1] if level else None,
                "conv_id": _number(values["low"]), "depth": level, "n_convs": values["n"], "n_children": values["children"],
                "n_leaves": leaves, "saved_tokens": saved,
            }
            found.append((first, leaves, saved, level))
        below = found
    if not last:
        for side, path in enumerate([0, end][: 1 + (end > 0)]):
            if side == 1:
                for level in range(common + 1):  # told by the other path
                    for c in columns:
                        out[path][c][level] = None if c == "low" else 0
            yield {"kind": SPINE, "part": part, "side": side, "path": spines[path]["path"], "words": spines[path]["words"], **out[path]}


def _merge_ranges(records: DataFrame, fan: int) -> list[DataFrame]:
    """Written tables that hold the nodes of all spines in ``records``."""
    found = []
    while True:
        spines = records.where(F.col("kind") == SPINE)
        top = spines.agg(F.max("part").alias("part")).first()["part"]  # one number
        if top is None:
            return found
        last = top < fan

        def run(key: tuple, table: pa.Table) -> pa.Table:
            rows = sorted(table.to_pylist(), key=lambda r: (r["part"], r["side"]))
            return pa.Table.from_batches(list(_batches(merged(rows, key[0].as_py(), last))), pa.schema(_FIELDS))

        group = F.floor(F.col("part") / fan).cast("bigint").alias("group")
        records = written(spines.groupBy(group).applyInArrow(run, RECORD), "trie-merged")
        found.append(records)
        if last:
            return found


def _hashed_ends(records: DataFrame) -> DataFrame:
    """``key`` and the hash of the numbers that end there, in the order of ranges, as a stream."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, digest = None, None
        for batch in batches:
            out: list[tuple[bytes, str]] = []
            for name, numbers in zip(batch.column("_key").to_pylist(), batch.column("numbers").to_pylist()):
                if name != key:
                    if digest is not None:
                        out.append((key, digest.hexdigest()))
                    key, digest = name, hashlib.sha256()
                else:
                    digest.update(b",")
                digest.update(numbers)
            yield pa.RecordBatch.from_pydict({"_key": pa.array([k for k, _ in out], pa.binary()), "_ends": pa.array([d for _, d in out], pa.string())})
        if digest is not None:
            yield pa.RecordBatch.from_pydict({"_key": pa.array([key], pa.binary()), "_ends": pa.array([digest.hexdigest()], pa.string())})

    pieces = records.where(F.col("kind") == ENDS).select(F.col("key").alias("_key"), "part", "nth", "numbers")
    in_order = pieces.repartition("_key").sortWithinPartitions("_key", "part", "nth")
    return in_order.mapInArrow(run, "_key binary, _ends string")


def nodes(sequences: DataFrame, ranges: int | None = None, fan: int = FAN) -> DataFrame:
    """All nodes of the trie of ``sequences`` (``conv_id``, ``path``, ``words``; see ``paths``).

    ``ranges`` is by default one for ``RANGE_ROWS`` conversations, and at least as many as the
    session's shuffles have partitions.
    """
    sequences = written(sequences, "trie-paths")
    if ranges is None:
        ranges = max(int(sequences.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-sequences.count() // RANGE_ROWS))
    in_order = sequences.repartitionByRange(ranges, "path", "conv_id").sortWithinPartitions("path", "conv_id")
    records = written(in_order.mapInArrow(_forest, RECORD), "trie-forest")
    closed = records.where(F.col("kind") == NODE)
    shared_nodes = closed.where("false")
    for table in _merge_ranges(records, fan):
        shared_nodes = shared_nodes.unionByName(table.where(F.col("kind") == NODE))
    ends = _hashed_ends(records)
    shared_nodes = shared_nodes.join(ends, F.col("key") == F.col("_key"), "left").withColumn("ends_sha256", F.coalesce("_ends", F.lit(_NO_ENDS)))
    shared_nodes = written(shared_nodes.select(closed.columns), "trie-shared")
    parents = shared_nodes.select(F.col("key").alias("parent_key"), F.col("conv_id").alias("_of_parent"))
    whole = closed.unionByName(shared_nodes)
    # A root may be the parent of a third of all nodes.
    below = hot_join(whole.where("parent_key IS NOT NULL"), parents, ["parent_key"], "inner", ["conv_id", "depth"])
    below = below.withColumn("parent_conv_id", F.col("_of_parent"))
    return whole.where("parent_key IS NULL").select(NODE_COLUMNS).unionByName(below.select(NODE_COLUMNS))
