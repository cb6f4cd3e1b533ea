"""Licence scan: matching statistics against a generalised suffix automaton, chained into spans.

All templates and base phrases form one automaton over words. A text is streamed through it, block
by block; after each word the automaton knows the longest run of words, ending there, that stands
anywhere in a template. Base phrases that end there are found among the suffixes of that run. Runs of
``LEAST`` words or more that a template cannot continue are matches; matches in the order of the
template, with gaps of ``GAP`` words at most, are chained, and a chain that covers ``COVERED`` of the
template's words is a span with the template's label.

Words are maximal runs of digits, letters a-z (A-Z in lower case) and characters beyond ASCII.
Positions count words from 0, ends are exclusive.

Defined results: a null or empty text has no words, no places, no spans and a score of 0. Texts are
read to the end in blocks, so a very long one holds one block of words at a time. Overlapping places
and spans of several templates all count; of chains of one template that share matches the one that
covers more wins, then the earlier. Repeated rows get equal results each; a null id stays null. No
rows give no rows. Columns other than id and text are not read.
"""

from __future__ import annotations

from collections import deque
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .license_texts import BASE_PHRASES, TEMPLATES

LEAST = 4
GAP = 20
COVERED = 0.75
# Text that is cut into words at a time.
BLOCK_BYTES = 1 << 20

_WORD = {*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)}
_CLEAN = bytes(b if b in _WORD else b + 32 if 0x41 <= b <= 0x5A else 32 for b in range(256))


def blocks(text: bytes, size: int = BLOCK_BYTES) -> Iterator[list[bytes]]:
    """The words of a UTF-8 text, a list for every ``size`` bytes or so; no word is cut."""
    at = 0
    while at < len(text):
        part = text[at : at + size].translate(_CLEAN)
        end = at + len(part)
        while end < len(text) and part[-1:] != b" ":  # up to the end of the word
            more = text[end : end + 4096].translate(_CLEAN)
            stop = more.find(b" ")
            more = more if stop < 0 else more[: stop + 1]
            part += more
            end += len(more)
        yield part.split()
        at = end


class Automaton:
    """Generalised suffix automaton of word sequences: state 0 is the empty run."""

    def __init__(self, sequences: Sequence[Sequence[bytes]]):
        self.sequences = [list(s) for s in sequences]
        self.next: list[dict[bytes, int]] = [{}]
        self.link = [-1]
        self.length = [0]
        self.marks: list[list[tuple[int, int]]] = [[]]  # (sequence, place) of the prefix that a state is
        for number, words in enumerate(self.sequences):
            last = 0
            for place, word in enumerate(words):
                last = self._extend(last, word)
                self.marks[last].append((number, place))
        children: list[list[int]] = [[] for _ in self.next]
        for state in range(1, len(self.next)):
            children[self.link[state]].append(state)
        # All places where a state's runs end: its marks and those of the states below it.
        self.places: list[list[tuple[int, int]]] = [list(m) for m in self.marks]
        for state in sorted(range(1, len(self.next)), key=self.length.__getitem__, reverse=True):
            self.places[self.link[state]].extend(self.places[state])
        self._runs: dict[int, dict[tuple[int, int], int]] = {}

    def _state(self, length: int, link: int, moves: dict[bytes, int]) -> int:
        self.next.append(moves)
        self.link.append(link)
        self.length.append(length)
        self.marks.append([])
        return len(self.next) - 1

    def _split(self, state: int, word: bytes, to: int) -> int:
        """The state for the runs of ``to`` that are no longer than ``state`` and ``word``."""
        if self.length[to] == self.length[state] + 1:
            return to
        clone = self._state(self.length[state] + 1, self.link[to], dict(self.next[to]))
        self.link[to] = clone
        while state >= 0 and self.next[state].get(word) == to:
            self.next[state][word] = clone
            state = self.link[state]
        return clone

    def _extend(self, last: int, word: bytes) -> int:
        if word in self.next[last]:  # an earlier sequence holds this prefix
            return self._split(last, word, self.next[last][word])
        new = self._state(self.length[last] + 1, 0, {})
        state = last
        while state >= 0 and word not in self.next[state]:
            self.next[state][word] = new
            state = self.link[state]
        if state >= 0:
            self.link[new] = self._split(state, word, self.next[state][word])
        return new

    def runs(self, state: int, least: int) -> dict[tuple[int, int], int]:
        """(sequence, place) of every run of at least ``least`` words that ends with ``state``, and
        how many words it can have (the longest state's runs have as many as were read)."""
        found = self._runs.get(state)
        if found is None:
            found = {}
            at = state
            while at > 0 and self.length[at] >= least:
                for place in self.places[at]:
                    found.setdefault(place, self.length[at])
                at = self.link[at]
            self._runs[state] = found
        return found


class Scanner:
    """Finds base phrases and templates in texts; made once per Python worker."""

    def __init__(self, phrases: Sequence[tuple[str, str]], templates: Sequence[tuple[str, str]]):
        self.phrases = [(label, sum(blocks(text.encode()), [])) for text, label in phrases]
        self.templates = [(label, sum(blocks(text.encode()), [])) for label, text in templates]
        sequences = [words for _, words in self.phrases + self.templates]
        self.first_template = len(self.phrases)
        self.automaton = Automaton(sequences)
        self.ending = [self._phrases_of(state) for state in range(len(self.automaton.next))]

    def _phrases_of(self, state: int) -> list[tuple[str, int]]:
        """Base phrases that the runs of ``state`` can end with."""
        found = []
        while state > 0:
            for number, place in self.automaton.marks[state]:
                if number < self.first_template and place + 1 == len(self.phrases[number][1]):
                    found.append((self.phrases[number][0], place + 1))
            state = self.automaton.link[state]
        return found

    def scan(self, text: bytes) -> tuple[int, list[tuple[str, int, int]], list[tuple[str, int, int, int, float]]]:
        """Number of words, base places (label, start, words) and spans (label, start, end, words of
        the template that are covered, their share)."""
        automaton, ending = self.automaton, self.ending
        moves, link, length = automaton.next, automaton.link, automaton.length
        state = run = at = 0
        places: list[tuple[str, int, int]] = []
        matches: dict[int, list[tuple[int, int, int]]] = {}
        open_runs: dict[tuple[int, int], int] = {}  # (sequence, place): words of the run that ends there

        def close(still: dict[tuple[int, int], int]) -> None:
            for (number, place), words in open_runs.items():
                if (number, place + 1) not in still:
                    matches.setdefault(number, []).append((at - words, place + 1 - words, words))

        for words in blocks(text):
            for word in words:
                if word in moves[state]:
                    state = moves[state][word]
                    run += 1
                elif state:
                    while state and word not in moves[state]:
                        state = link[state]
                    run = length[state]
                    if word in moves[state]:
                        state = moves[state][word]
                        run += 1
                if state:
                    for label, size in ending[state]:
                        if size <= run:
                            places.append((label, at + 1 - size, size))
                    if run >= LEAST or open_runs:
                        now = automaton.runs(state, LEAST) if run >= LEAST else {}
                        now = {p: min(n, run) for p, n in now.items() if p[0] >= self.first_template}
                        close(now)
                        open_runs = now
                elif open_runs:
                    close({})
                    open_runs = {}
                at += 1
        close({})
        spans = []
        for number, found in matches.items():
            label, words = self.templates[number - self.first_template]
            for start, end, covered in chains(found):
                if covered >= COVERED * len(words):
                    spans.append((label, start, end, covered, covered / len(words)))
        return at, places, sorted(spans)


def chains(matches: list[tuple[int, int, int]], gap: int = GAP) -> list[tuple[int, int, int]]:
    """(start, end, words covered) of the chains that matches (place in the text, place in the
    template, words) of one template form: later in both, and close in both."""
    ordered = sorted(matches, key=lambda m: (m[0] + m[2], m[0], m[1]))
    best: list[int] = []  # words covered by the best chain that ends with a match
    before: list[int] = []
    near: deque[int] = deque()
    longest = max((n for _, _, n in ordered), default=0)
    for i, (start, place, words) in enumerate(ordered):
        while near and ordered[near[0]][0] + ordered[near[0]][2] < start - gap - longest:
            near.popleft()
        top, source = words, -1
        for j in near:
            s, p, n = ordered[j]
            shared = max(0, s + n - start, p + n - place)
            if shared < words and s < start and p < place and start - s - n <= gap and place - p - n <= gap:
                if best[j] + words - shared > top:
                    top, source = best[j] + words - shared, j
        best.append(top)
        before.append(source)
        near.append(i)
    used = [False] * len(ordered)
    found = []
    for i in sorted(range(len(ordered)), key=lambda i: (-best[i], i)):
        if used[i]:
            continue
        at, first = i, i
        while at >= 0 and not used[at]:
            used[at] = True
            first, at = at, before[at]
        covered = best[i] - (best[at] if at >= 0 else 0)
        found.append((ordered[first][0], ordered[i][0] + ordered[i][2], covered))
    return sorted(found)


_PLACE = pa.struct([("label", pa.string()), ("start", pa.int64()), ("words", pa.int64())])
_SPAN = pa.struct([("label", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("covered", pa.int64()), ("share", pa.float64())])
FOUND = (
    "n_words bigint, places array<struct<label string, start bigint, words bigint>>, "
    "spans array<struct<label string, start bigint, end bigint, covered bigint, share double>>"
)

_scanners: dict[tuple, Scanner] = {}


def scan(
    documents: DataFrame,
    phrases: Sequence[tuple[str, str]] = BASE_PHRASES,
    templates: Sequence[tuple[str, str]] = TEMPLATES,
) -> DataFrame:
    """``doc_id``, ``n_words``, ``places`` of the base phrases (text, label) and ``spans`` of the
    ``templates`` (label, text), for every document. Nothing is shuffled."""
    key = (tuple(phrases), tuple(templates))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if key not in _scanners:
            _scanners[key] = Scanner(*key)
        scanner = _scanners[key]
        for batch in batches:
            found = [scanner.scan(t or b"") for t in batch.column("text").cast(pa.binary()).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array([n for n, _, _ in found], pa.int64()),
                    pa.array([[dict(zip(("label", "start", "words"), p)) for p in places] for _, places, _ in found], pa.list_(_PLACE)),
                    pa.array([[dict(zip(("label", "start", "end", "covered", "share"), s)) for s in spans] for _, _, spans in found], pa.list_(_SPAN)),
                ],
                ["doc_id", "n_words", "places", "spans"],
            )

    kind = dict(documents.select("doc_id").dtypes)["doc_id"]
    return documents.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, {FOUND}")


def digest(found: DataFrame) -> DataFrame:
    """Counts, labels and score of what ``scan`` found. The score is the largest share of a template
    that one span covers; a base phrase is always covered whole."""

    def labels(*columns: str) -> Column:
        every = F.concat(*[F.transform(F.col(c), lambda x: x["label"]) for c in columns])
        return F.array_join(F.array_sort(F.array_distinct(every)), ",")

    starts = F.transform("places", lambda p: p["start"])
    share = F.coalesce(F.array_max(F.transform("spans", lambda s: s["share"])), F.lit(0.0))
    return found.select(
        "doc_id",
        "n_words",
        F.size("places").cast("bigint").alias("n_base"),
        F.array_min(starts).alias("first_word"),
        F.array_max(starts).alias("last_word"),
        labels("places").alias("base_labels"),
        labels("places", "spans").alias("labels"),
        F.when(F.size("places") > 0, F.lit(1.0)).otherwise(share).alias("score"),
        F.size("spans").cast("bigint").alias("n_spans"),
    )
