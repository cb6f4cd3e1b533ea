"""Names of substrings: equal substrings have equal names.

There are two kinds. Rolling names, of any length in one step, are polynomials in random byte values,
taken from running sums over the text. Different substrings may share one (regular texts of two
bytes can be made so), hence they only choose places and put cells aside that cannot be repeated.
What counts as repeated is decided by 128-bit XXH3 of the bytes themselves.

Each window of a given length has an anchor: the place of its smallest short name, the first
if there are several. It is chosen by content alone, so equal windows of any two texts have it in
the same place. Windows in a row with the same anchor are cut into cells by their distance from it.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import xxhash

# Length of the short names that choose positions.
SHORT = 16
BLOCK = 1 << 20
_BASE = 0x9E3779B97F4A7C15
_MASK = (1 << 64) - 1


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


_TABLE = _mixed(_mixed(np.arange(1, 257, dtype=np.uint64) * np.uint64(_BASE)))
_POWERS: list[np.ndarray] = []


def _powers(size: int) -> list[np.ndarray]:
    """Powers of the base and of its inverse."""
    if not _POWERS or len(_POWERS[0]) < size:
        _POWERS.clear()
        for b in (_BASE, pow(_BASE, -1, 1 << 64)):
            steps = np.full(max(size, 1 << 16), b, np.uint64)
            steps[0] = 1
            _POWERS.append(np.multiply.accumulate(steps))
    return _POWERS


class Names:
    """Names of the substrings of ``data`` (bytes)."""

    def __init__(self, data: np.ndarray):
        self.data = data
        self.powers = _powers(len(data) + 1)
        self.sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(_TABLE[data] * self.powers[0][: len(data)], out=self.sums[1:])

    def rolling(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return _mixed((self.sums[end] - self.sums[start]) * self.powers[1][start])

    def short(self) -> np.ndarray:
        n = len(self.sums) - SHORT
        return _mixed((self.sums[SHORT:] - self.sums[:n]) * self.powers[1][:n])

    def exact(self, start: np.ndarray, end: np.ndarray, seed: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Both halves of XXH3 of the bytes, with a seed for each substring."""
        view, digest = memoryview(self.data), xxhash.xxh3_128_digest
        each = zip(start.tolist(), end.tolist(), seed.tolist())
        halves = np.frombuffer(b"".join([digest(view[s:e], r) for s, e, r in each]), np.uint64)
        return halves[::2], halves[1::2]


def _sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every ``width`` values in a row."""
    n = len(values) - width + 1
    padded = np.full(-(-len(values) // width) * width, np.uint64(_MASK))
    padded[: len(values)] = values
    blocks = padded.reshape(-1, width)
    before = np.minimum.accumulate(blocks, axis=1).ravel()
    after = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(after[:n], before[width - 1 : width - 1 + n])


def anchored_runs(data: np.ndarray, length: int) -> Iterator[tuple[int, Names, np.ndarray, np.ndarray, np.ndarray]]:
    """(offset, names, anchor, first, last): runs of window starts with the same anchor, block by
    block; positions count from ``offset``, like the names'."""
    total = len(data) - length + 1
    margin = 2 * length
    for begin in range(0, max(0, total), BLOCK):
        low, high = max(0, begin - margin), min(len(data), begin + BLOCK + margin + length)
        names = Names(data[low:high])
        short = names.short()
        order = (short >> np.uint64(32) << np.uint64(32)) | np.arange(len(short), dtype=np.uint64)
        chosen = (_sliding_min(order, length - SHORT + 1) & np.uint64(0xFFFFFFFF)).astype(np.int64)
        first = np.flatnonzero(np.concatenate([[True], chosen[1:] != chosen[:-1]]))
        last = np.concatenate([first[1:] - 1, [len(chosen) - 1]])
        here = (first + low >= begin) & (first + low < begin + BLOCK)
        yield low, names, chosen[first[here]], first[here], last[here]


def cells(anchor: np.ndarray, first: np.ndarray, last: np.ndarray, length: int, width: int) -> tuple[np.ndarray, ...]:
    """(run, first, last, low, high): the runs cut into cells of ``width`` places, counted from the
    farthest place a window with that anchor can start; ``low`` and ``high`` bound the whole cell."""
    origin = anchor - (length - SHORT)
    begin = (first - origin) // width
    count = (last - origin) // width - begin + 1
    run = np.repeat(np.arange(len(anchor)), count)
    cell = np.arange(len(run)) - np.repeat(np.cumsum(count) - count, count) + begin[run]
    low = origin[run] + cell * width
    high = np.minimum(low + width - 1, anchor[run])
    return run, np.maximum(first[run], low), np.minimum(last[run], high), low, high


def cell_names(names: Names, size: int, low: np.ndarray, high: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(core, two halves of the span): the core is common to all windows of the cell, the span covers
    them all as far as the text goes; how far it goes is part of its name."""
    start, end = np.maximum(low, 0), np.minimum(high + length, size)
    core = names.rolling(high, low + length)
    return core, *names.exact(start, end, (start - low) * 4096 + (high + length - end))
