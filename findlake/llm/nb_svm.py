"""Quality classifier: Naive Bayes support vectors.

Features of a text are indicators of its word unigrams and bigrams and of the unigrams and bigrams
of word shapes (letters, capitals, digits and signs, and whether the word before was the same), each
hashed to a bucket. Class counts of all training texts give every bucket a log-count ratio; each
indicator is scaled by it, the text's vector is brought to length one, and a linear model with hinge
loss is fitted by dual coordinate descent. Margins become scores by a logistic curve fitted to
training rows that the model has not seen.

The class counts cover every training row; the linear model and the curve are fitted to
``fit_rows`` rows of each class, those with the smallest hash of their id. What reaches the driver
are the counts (a row per bucket) and the features of those rows; the model sent to the tasks has a
number per bucket.

Defined results: a null or empty text has no features and gets the score of the model's bias. A
training id labelled twice takes the lower label; null labels and labels of unknown ids are ignored.
With fewer than two classes every score is 0.5. Repeated rows get equal results each, a null id is
scored too (and is not held out). No rows give no rows. Columns other than those named are not read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WORD_BUCKETS = 1 << 18
SHAPE_BUCKETS = 1 << 14
BUCKETS = WORD_BUCKETS + 2 * SHAPE_BUCKETS
SMOOTH = 1.0
COST = 1.0
ROUNDS = 20
FIT_ROWS = 4_000
# Every so manieth fitting row is kept for the curve.
CURVE_EVERY = 4
TEXT_AT_ONCE = 4 << 20
# Labels up to this many rows are sent to every executor; more meet the texts in a shuffle.
BROADCAST_ROWS = 1 << 20
_A, _B = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = x * _A
    x = (x ^ (x >> np.uint64(29))) * _B
    return x ^ (x >> np.uint64(32))


def shapes(words: pa.Array) -> pa.Array:
    """Capitals as X, other letters as x, digits as 9; runs of one kind as one."""
    for pattern, to in ((r"\p{Lu}+", "X"), (r"[\p{Ll}\p{Lo}\p{Lm}\p{Lt}\p{M}]+", "x"), (r"\p{N}+", "9"), (r"[^\p{L}\p{N}]{2,}", "~")):
        words = pc.replace_substring_regex(words, pattern, to)
    return words


def features(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(number of the text, bucket) of every feature, sorted, each once."""
    parts = pc.utf8_split_whitespace(pa.array(texts, pa.large_string()))
    coded = parts.flatten().dictionary_encode()
    words = coded.dictionary
    filled = np.asarray(pc.greater(pc.utf8_length(words), 0)) if len(words) else np.zeros(0, bool)
    crc = lambda values: np.fromiter((zlib.crc32(w.encode()) for w in values.to_pylist()), np.uint64, len(values))
    of_word, of_shape = crc(words), crc(shapes(words))
    index = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    text = np.repeat(np.arange(len(texts)), np.diff(parts.offsets.to_numpy()))
    keep = filled[index] if len(index) else np.zeros(0, bool)
    index, text = index[keep], text[keep]
    word, shape = of_word[index], of_shape[index]
    near = np.zeros(len(text), bool)
    near[1:] = text[1:] == text[:-1]  # a word before it in the same text
    same = near.copy()
    same[1:] &= index[1:] == index[:-1]
    shape = shape * np.uint64(2) + same
    at = np.flatnonzero(near)
    found = [
        (text, _mixed(word) % np.uint64(WORD_BUCKETS)),
        (text[at], _mixed(word[at - 1] * _B + word[at] + np.uint64(1)) % np.uint64(WORD_BUCKETS)),
        (text, np.uint64(WORD_BUCKETS) + _mixed(shape) % np.uint64(SHAPE_BUCKETS)),
        (text[at], np.uint64(WORD_BUCKETS + SHAPE_BUCKETS) + _mixed(shape[at - 1] * _B + shape[at]) % np.uint64(SHAPE_BUCKETS)),
    ]
    keys = np.concatenate([t.astype(np.uint64) * np.uint64(BUCKETS) + b for t, b in found])
    keys = np.unique(keys)
    return (keys // np.uint64(BUCKETS)).astype(np.int64), (keys % np.uint64(BUCKETS)).astype(np.int64)


def _portions(batch: pa.RecordBatch) -> Iterator[tuple[int, list[str]]]:
    """(first row, texts) of portions of bounded size."""
    begin, portion, size = 0, [], 0
    for i, value in enumerate(batch.column("text")):
        text = value.as_py() or ""
        if portion and size + len(text) > TEXT_AT_ONCE:
            yield begin, portion
            begin, portion, size = i, [], 0
        portion.append(text)
        size += len(text)
    if portion:
        yield begin, portion


def class_counts(training: DataFrame) -> DataFrame:
    """``bucket``, ``n0`` and ``n1``: texts of each class with a feature in the bucket."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros((2, BUCKETS + 1), np.int64)  # the last one counts texts
        for batch in batches:
            labels = batch.column("label").to_numpy()
            for begin, portion in _portions(batch):
                label = labels[begin : begin + len(portion)]
                text, bucket = features(portion)
                for c in (0, 1):
                    counts[c, :BUCKETS] += np.bincount(bucket[label[text] == c], minlength=BUCKETS)
                    counts[c, BUCKETS] += int((label == c).sum())
        some = np.flatnonzero(counts.any(axis=0))
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(counts[0, some]), pa.array(counts[1, some])], ["bucket", "n0", "n1"])

    parts = training.select("label", "text").mapInArrow(run, "bucket bigint, n0 bigint, n1 bigint")
    return parts.groupBy("bucket").agg(F.sum("n0").alias("n0"), F.sum("n1").alias("n1"))


def fitting_rows(training: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for begin, portion in _portions(batch):
                text, bucket = features(portion)
                ends = np.searchsorted(text, np.arange(len(portion) + 1)).astype(np.int32)
                lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(bucket.astype(np.int32)))
                part = batch.slice(begin, len(portion))
                yield pa.RecordBatch.from_arrays([part.column("label"), part.column("place"), lists], ["label", "place", "buckets"])

    return training.select("label", "place", "text").mapInArrow(run, "label int, place bigint, buckets array<int>")


@dataclass(frozen=True)
class Model:
    ratio: np.ndarray
    weight: np.ndarray
    bias: float
    slope: float
    shift: float

    def margins(self, text: np.ndarray, bucket: np.ndarray, count: int) -> np.ndarray:
        ratio = self.ratio[bucket]
        length = np.sqrt(np.bincount(text, ratio * ratio, count))
        total = np.bincount(text, ratio * self.weight[bucket], count)
        return total / np.maximum(length, 1e-12) + self.bias

    def scores(self, margins: np.ndarray) -> np.ndarray:
        return 1.0 / (1.0 + np.exp(-np.clip(self.slope * margins + self.shift, -500, 500)))


def dual_coordinate_descent(rows: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray, costs: np.ndarray, size: int, rounds: int = ROUNDS) -> np.ndarray:
    """Weights of the hinge-loss model; rows are (places, values), the last place is the bias."""
    weight = np.zeros(size)
    alpha = np.zeros(len(rows))
    norm = np.array([float(v @ v) for _, v in rows])
    order, chance = np.arange(len(rows)), np.random.default_rng(7)
    for _ in range(rounds):
        chance.shuffle(order)
        most = 0.0
        for i in order:
            at, value = rows[i]
            slope = labels[i] * float(weight[at] @ value) - 1.0
            new = min(max(alpha[i] - slope / norm[i], 0.0), costs[i])
            step = new - alpha[i]
            if step:
                weight[at] += step * labels[i] * value
                alpha[i] = new
                most = max(most, abs(step))
        if most < 1e-3:
            break
    return weight


def logistic_curve(margins: np.ndarray, labels: np.ndarray, weights: np.ndarray) -> tuple[float, float]:
    """Slope and shift, by Newton's method; targets are drawn in a little, so they stay finite."""
    n1, n0 = weights[labels > 0].sum(), weights[labels <= 0].sum()
    target = np.where(labels > 0, (n1 + 1) / (n1 + 2), 1 / (n0 + 2))
    a, b = 1.0, 0.0
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(a * margins + b, -500, 500)))
        error, spread = weights * (p - target), weights * p * (1 - p)
        gradient = np.array([(error * margins).sum(), error.sum()])
        curve = np.array([[(spread * margins * margins).sum(), (spread * margins).sum()], [(spread * margins).sum(), spread.sum()]]) + 1e-6 * np.eye(2)
        step = np.linalg.solve(curve, gradient)
        step *= min(1.0, 5.0 / max(np.abs(step).max(), 1e-12))
        a, b = a - step[0], b - step[1]
        if np.abs(step).max() < 1e-6:
            break
    return float(max(a, 1e-3)), float(b)


def fitting_sample(training: DataFrame, fit_rows: int) -> DataFrame:
    """``label``, ``place`` and ``text`` of the ``fit_rows`` different rows of each class that come first
    by a hash. They are chosen by their hashes; only the texts of the chosen ones leave their tasks."""
    place, key = F.xxhash64(F.col("doc_id").cast("string")), F.xxhash64("doc_id", "text")
    keyed = training.select(F.col("label").cast("int").alias("label"), place.alias("place"), key.alias("key"), "text")
    rows = keyed.select("label", "place", "key").distinct()
    first = [rows.where(F.col("label") == c).orderBy("place", "key").limit(fit_rows) for c in (0, 1)]
    # Two rows of numbers for each of ``fit_rows``: a proven bound.
    chosen = F.broadcast(first[0].unionByName(first[1]).select("label", "key"))
    return keyed.join(chosen, ["label", "key"]).dropDuplicates(["label", "key"]).select("label", "place", "text")


def fit(training: DataFrame, fit_rows: int = FIT_ROWS) -> Model:
    """The model of ``training`` rows (``doc_id``, ``text``, ``label`` 0 or 1)."""
    none = Model(np.zeros(BUCKETS), np.zeros(BUCKETS), 0.0, 1.0, 0.0)
    counted = class_counts(training).toArrow()  # at most a row per bucket
    counts = np.zeros((2, BUCKETS + 1))
    for c in (0, 1):
        counts[c, counted.column("bucket").to_numpy()] = counted.column(f"n{c}").to_numpy()
    texts = counts[:, BUCKETS]
    if not texts.all():
        return none
    share = (counts[:, :BUCKETS] + SMOOTH) / (texts[:, None] + 2 * SMOOTH)
    ratio = np.log(share[1] / share[0])
    rows = fitting_rows(fitting_sample(training, fit_rows)).toArrow().sort_by([("place", "ascending"), ("label", "ascending")])
    label = rows.column("label").to_numpy()
    bucket = rows.column("buckets").combine_chunks()
    ends, flat = bucket.offsets.to_numpy(), bucket.values.to_numpy()
    vectors = []
    for a, b in zip(ends[:-1], ends[1:]):
        value = ratio[flat[a:b]]
        length = float(np.sqrt(value @ value))
        vectors.append((np.append(flat[a:b], BUCKETS), np.append(value / max(length, 1e-12), 1.0)))
    sign = np.where(label > 0, 1.0, -1.0)
    of_class = [np.flatnonzero(label == c) for c in (0, 1)]
    if any(len(rows_of) < 2 for rows_of in of_class):
        return none
    curve = np.zeros(len(label), bool)
    for rows_of in of_class:
        curve[rows_of[:: min(CURVE_EVERY, len(rows_of))]] = True
    learn = np.flatnonzero(~curve)
    weight = dual_coordinate_descent([vectors[i] for i in learn], sign[learn], np.full(len(learn), COST), BUCKETS + 1)
    margins = np.array([weight[at] @ value for at, value in (vectors[i] for i in np.flatnonzero(curve))])
    of_curve = label[curve]
    # Both classes weigh the same, so that a score of 0.5 lies midway between them.
    balance = np.where(of_curve > 0, 1 / max(1, (of_curve > 0).sum()), 1 / max(1, (of_curve == 0).sum()))
    slope, shift = logistic_curve(margins, np.where(of_curve > 0, 1.0, -1.0), balance * len(of_curve) / 2)
    return Model(ratio, weight[:BUCKETS], float(weight[BUCKETS]), slope, shift)


def score(documents: DataFrame, model: Model) -> DataFrame:
    """``documents``' id, ``held_out`` and ``score`` of every row."""
    shared = documents.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in batches:
            scores = [model.scores(model.margins(*features(portion), len(portion))) for _, portion in _portions(batch)]
            values = np.concatenate(scores) if scores else np.zeros(0)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("held_out"), pa.array(values, pa.float64())], ["doc_id", "held_out", "score"])

    kind = dict(documents.dtypes)["doc_id"]
    scored = documents.select("doc_id", "held_out", "text").mapInArrow(run, f"doc_id {kind}, held_out boolean, score double")
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def held_out(doc_id: Column) -> Column:
    """Rows kept from training."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 3 == 1, F.lit(False))


def classify(documents: DataFrame, labels: DataFrame, label: str = "quality", fit_rows: int = FIT_ROWS) -> DataFrame:
    """``doc_id``, ``held_out``, ``score`` and ``predicted`` of every document, by a model of the
    labelled ones that are not held out."""
    docs = documents.select("doc_id", "text", held_out(F.col("doc_id")).alias("held_out"))
    known = labels.where(F.col(label).isin(0, 1)).where(~held_out(F.col("doc_id")))
    known = known.groupBy("doc_id").agg(F.min(label).cast("int").alias("label"))
    if known.count() <= BROADCAST_ROWS:
        known = F.broadcast(known)
    training = docs.where(~F.col("held_out")).join(known, "doc_id").select("doc_id", "text", "label")
    return score(docs, fit(training, fit_rows))
