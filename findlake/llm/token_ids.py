"""Token ids of many texts at once.

The byte-level pattern always splits before a single space or newline that follows a visible
character, so a word's ids do not depend on its neighbours. Arrow cuts a batch of texts into words
and numbers the different ones; only words not met before are encoded, joined to one text. Where the
tokenizer's merges are in the order of their ids, a rank encoder made from its own vocabulary does
that, which is several times faster and gives the same ids; otherwise the tokenizer does. Texts that
hold other white space, runs of it, or a special token's string are given to the tokenizer as they
are.

A piece tokenizer (``PieceEncoder``) works alike: no piece goes on over a space or holds a newline, so
a word's pieces do not depend on its neighbours either.

What is kept of the words met before is bounded by ``CACHE_BYTES``, and texts are cut into words in
portions of ``BATCH_BYTES``, so a process's memory does not grow with the corpus.
"""

from __future__ import annotations

import json
import os
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

# Memory for words met before: their text, ids and place in the table.
CACHE_BYTES = 32 << 20
ENTRY_BYTES = 250
CACHED_CHARS = 40
# Text that is cut into words at a time.
BATCH_BYTES = 1 << 20
# Fixed value: how byte-level tokenizers cut a text before merging.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
# How pieces write a space.
_MARK = "\u2581"
# Runs of white space, and white space other than space and newline.
_RUNS = ("  ", " \n", "\n ", "\n\n")
_OTHER = tuple(map(chr, [9, 11, 12, 13, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]))


class WordEncoder:
    """Encodes texts word by word; how a text and how new words are encoded, subclasses say."""

    special: tuple[str, ...] = ()
    newline = 0  # ids of a newline before a text

    def __init__(self):
        self.known: dict[str, bytes] = {}
        self.known_bytes = 0

    def _keep(self, found: dict[str, bytes]) -> None:
        """Remember new words, but never more than fit; what is new replaces what was there."""
        for word, ids in found.items():
            if len(word) > CACHED_CHARS:
                continue
            size = ENTRY_BYTES + len(word) + len(ids)
            if self.known_bytes + size > CACHE_BYTES:
                self.known.clear()
                self.known_bytes = 0
            self.known[word] = ids
            self.known_bytes += size

    def plain(self, text: str) -> bool:
        return not any(s in text for s in _RUNS + self.special) and not any(c in text for c in _OTHER)

    def _plain_batch(self, texts: list[str]) -> list[np.ndarray]:
        # Every word carries the space or newline before it; a newline is put before the first.
        column = pc.replace_substring(pa.array(["\n" + t for t in texts], pa.large_string()), "\n", " \n")
        parts = pc.split_pattern(column, " ")
        coded = parts.flatten().dictionary_encode()
        words = [w if w[:1] == "\n" else " " + w for w in coded.dictionary.to_pylist()]
        ids = list(map(self.known.get, words))
        new = [w for w, b in zip(words, ids) if b is None]
        if new:
            fresh = self._learn(new)
            ids = [fresh[w] if b is None else b for w, b in zip(words, ids)]
        sizes = np.fromiter(map(len, ids), np.int64, len(ids)) // 4
        starts = np.cumsum(sizes) - sizes
        pool = np.frombuffer(b"".join(ids), "<u4")
        word = coded.indices.to_numpy()
        offsets = parts.offsets.to_numpy()
        # Each text's parts begin with an empty one: what stands before the added newline.
        lengths = sizes[word]
        lengths[offsets[:-1]] = 0
        ends = np.cumsum(lengths)
        at = np.repeat(starts[word] - ends + lengths, lengths) + np.arange(ends[-1] if len(ends) else 0)
        flat = pool[at]
        bounds = np.concatenate([[0], ends])[offsets]
        return [flat[a + self.newline : b] for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist())]

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """The ids of each text."""
        out: list[np.ndarray | None] = [None] * len(texts)
        todo: list[int] = []
        size = 0
        for i, text in enumerate([*texts, None]):
            if text is not None and not self.plain(text):
                out[i] = self._whole(text)
                continue
            if todo and (text is None or size + len(text) > BATCH_BYTES):
                for j, ids in zip(todo, self._plain_batch([texts[j] for j in todo])):
                    out[j] = ids
                todo, size = [], 0
            if text is not None:
                todo.append(i)
                size += len(text)
        return out


class Encoder(WordEncoder):
    """A byte-level tokenizer. With ``plain_specials`` the strings of its special tokens are text."""

    def __init__(self, path: str, plain_specials: bool = False):
        super().__init__()
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = plain_specials
        added = self.tokenizer.get_added_tokens_decoder()
        self.added = {t.content for t in added.values()}
        self.special = () if plain_specials else tuple(self.added)
        vocabulary = self.tokenizer.get_vocab()
        # In a byte-level vocabulary one character stands for one byte.
        self.width = np.zeros(max(vocabulary.values()) + 1, np.int64)
        for token, i in vocabulary.items():
            self.width[i] = len(token)
        self.newline = len(self._whole("\n"))
        self.ranks = self._rank_encoder(path)

    def _whole(self, text: str) -> np.ndarray:
        return np.array(self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, "<u4")

    def _rank_encoder(self, path: str):
        """An encoder by ranks of the same vocabulary; None if its ids are not ranks."""
        import tiktoken

        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model, steps = spec["model"], spec["pre_tokenizer"]
        merges = [m.split(" ") if isinstance(m, str) else m for m in model.get("merges", [])]
        made = [model["vocab"].get(a + b, -1) for a, b in merges]
        usual = steps.get("type") == "ByteLevel" and steps.get("use_regex", True) and not steps.get("add_prefix_space")
        if not usual or spec.get("normalizer") or made != sorted(set(made)) or model.get("ignore_merges"):
            return None
        # One character of the vocabulary for each byte: the printable ones as they are, then from 256.
        printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
        others = [b for b in range(256) if b not in printable]
        byte = {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(others)}
        ranks = {bytes(byte[c] for c in t): i for t, i in model["vocab"].items() if t not in self.added}
        return tiktoken.Encoding("ranks", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})

    def _joined(self, text: str) -> np.ndarray:
        return self._whole(text) if self.ranks is None else np.array(self.ranks.encode_ordinary(text), "<u4")

    def _learn(self, words: list[str]) -> dict[str, bytes]:
        ids = self._joined("".join(words))
        ends = np.cumsum(np.fromiter((len(w.encode()) for w in words), np.int64, len(words)))
        at = np.searchsorted(np.cumsum(self.width[ids]), ends) + 1
        data = ids.tobytes()
        found = dict(zip(words, (data[4 * a : 4 * b] for a, b in zip([0, *at[:-1].tolist()], at.tolist()))))
        self._keep(found)
        return found


class PieceEncoder(WordEncoder):
    """A sentencepiece tokenizer, for texts that begin with the space which it puts there itself.

    Texts and words whose pieces do not spell them have no ids.
    """

    def __init__(self, path: str):
        super().__init__()
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.bytes: list[bytes] = []
        for i in range(self.model.get_piece_size()):
            piece = self.model.id_to_piece(i)
            self.bytes.append(bytes([int(piece[3:5], 16)]) if self.model.is_byte(i) else piece.replace(_MARK, " ").encode())
        self.width = np.fromiter(map(len, self.bytes), np.int64, len(self.bytes))
        # Words are only independent if no piece goes on after a word or over a newline.
        self.by_word = not any("\n" in p or " " in p.lstrip(" ") for p in (b.decode(errors="replace") for i, b in enumerate(self.bytes) if not self.model.is_byte(i)))
        self.newline = len(self._spelled("\n", self._after_space(["\n"])[0]))

    def plain(self, text: str) -> bool:
        return self.by_word and _MARK not in text and super().plain(text)

    def _after_space(self, words: list[str]) -> list[list[int]]:
        """The pieces of each word behind those of the space that is put before it."""
        space = self.model.encode("\n")[0]
        return [ids[1:] if ids[:1] == [space] else [] for ids in self.model.encode(words, num_threads=1)]

    def _spelled(self, text: str, ids: list[int]) -> list[int]:
        return ids if b"".join(map(self.bytes.__getitem__, ids)) == text.encode() else []

    def _whole(self, text: str) -> np.ndarray:
        return np.array(self._spelled(text, self.model.encode(text[1:])) if text[:1] == " " else [], "<u4")

    def _learn(self, words: list[str]) -> dict[str, bytes]:
        # A word begins with its space or newline; a space alone is what stands before a newline.
        of_space, of_newline = [w[1:] + "\n" if w == " " else w[1:] for w in words if w[0] == " "], [w for w in words if w[0] != " "]
        ids = iter(self.model.encode(of_space, num_threads=1)), iter(self._after_space(of_newline))
        found = {}
        for word in words:
            its = next(ids[word[0] != " "])
            found[word] = array("I", self._spelled(word, its[:1] if word == " " else its)).tobytes()
        self._keep(found)
        return found


_encoders: dict[tuple, WordEncoder] = {}


def encoder(path: str, plain_specials: bool = False) -> Encoder:
    """The process's encoder of a tokenizer file, which keeps what it has met."""
    key = (path, plain_specials)
    if key not in _encoders:
        _encoders[key] = Encoder(*key)
    return _encoders[key]


def piece_encoder(path: str) -> PieceEncoder:
    if (path,) not in _encoders:
        _encoders[(path,)] = PieceEncoder(path)
    return _encoders[(path,)]


def slices(column: pa.Array, size: int) -> Iterator[tuple[int, int]]:
    """(first, stop) of the rows of a text or binary column, about ``size`` bytes at a time."""
    lengths = pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False)
    number = (np.cumsum(lengths, dtype=np.int64) - lengths) // size
    bounds = [0, *(np.flatnonzero(np.diff(number)) + 1).tolist(), len(lengths)]
    return ((first, stop) for first, stop in zip(bounds, bounds[1:]) if stop > first)


def portions(texts: pa.Array, size: int = BATCH_BYTES) -> Iterator[tuple[int, list[str]]]:
    """(first row, texts) of the texts of a batch, about ``size`` bytes at a time; null ones empty."""
    for first, stop in slices(texts, size):
        yield first, [t or "" for t in texts.slice(first, stop - first).to_pylist()]
