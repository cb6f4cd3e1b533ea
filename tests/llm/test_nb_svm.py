from __future__ import annotations

import zlib

import duckdb
import numpy as np

from findlake.llm import nb_svm
from findlake.llm.queries import QUERIES

SF = "/root/testdata/sf0.01"


def test_held_out_accuracy(spark):
    rows = QUERIES["op1_nb_svm"](spark, SF).collect()
    db = duckdb.connect()
    assert sorted(r["doc_id"] for r in rows) == sorted(d for (d,) in db.execute(f"SELECT doc_id FROM '{SF}/documents.parquet'").fetchall())
    label = dict(db.execute(f"SELECT doc_id, quality FROM '{SF}/labels.parquet'").fetchall())
    for r in rows:
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1)
        assert 0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.5)
    held = [(r["score"], r["predicted"], label[r["doc_id"]]) for r in rows if r["held_out"] and r["doc_id"] in label]
    assert np.mean([p == q for _, p, q in held]) > 0.95
    good, bad = [s for s, _, q in held if q], [s for s, _, q in held if not q]
    assert np.mean([[g > b for b in bad] for g in good]) > 0.97


def test_held_out_labels_are_not_used(spark, documents):
    rows = [(i, ("fine words here" if i % 2 else "!! $$ !!") + f" t{i}") for i in range(60)]
    known = [(i, i % 2) for i in range(60)]
    flipped = [(i, 1 - q if zlib.crc32(str(i).encode()) % 3 == 1 else q) for i, q in known]
    scores = []
    for labels in (known, flipped):
        table = spark.createDataFrame(labels, "doc_id bigint, quality int")
        scores.append({r["doc_id"]: r["score"] for r in nb_svm.classify(documents(rows), table).collect()})
    assert scores[0] == scores[1]
    assert all((s >= 0.5) == bool(i % 2) for i, s in scores[0].items())


def test_features_are_indicators():
    text, bucket = nb_svm.features(["a a a", "", "a b", " \n"])
    assert set(text.tolist()) == {0, 2}
    assert len(set(zip(text.tolist(), bucket.tolist()))) == len(text)
    first, second = set(bucket[text == 0].tolist()), set(bucket[text == 2].tolist())
    assert first & second and first != second
    assert nb_svm.features([])[0].size == 0


def test_dual_solution_separates_and_stays_in_its_box():
    chance = np.random.default_rng(0)
    values = chance.normal(size=(80, 5))
    labels = np.where(values[:, 0] + 0.5 * values[:, 1] > 0, 1.0, -1.0)
    at = np.arange(5)
    weight = nb_svm.dual_coordinate_descent([(at, v) for v in values], labels, np.full(80, 10.0), 5, 200)
    assert np.mean(np.sign(values @ weight) == labels) > 0.97


def test_odd_tables(spark, documents):
    labels = spark.createDataFrame([(1, 1), (1, 0), (2, None), (9, 1)], "doc_id bigint, quality int")
    rows = [(1, "a b"), (1, "a b"), (2, None), (None, "x"), (3, "w " * 50000)]
    got = nb_svm.classify(documents(rows), labels).collect()
    assert len(got) == 5 and all(r["score"] == 0.5 for r in got)  # one class only
    assert nb_svm.classify(documents([]), labels).count() == 0


def test_ratios_and_dual_steps_by_brute_force(spark):
    """Log-count ratios from sets of n-grams, and the optimum of the hinge loss by plain sub-gradients."""
    rows = [(i, f"good words {'fine' if i % 2 else 'nice'} w{i}", 1) for i in range(8)] + [(10 + i, f"bad junk {'spam' if i % 2 else 'buy'} w{i}", 0) for i in range(6)]
    training = spark.createDataFrame(rows, "doc_id bigint, text string, label int")
    counted = {r["bucket"]: (r["n0"], r["n1"]) for r in nb_svm.class_counts(training).collect()}
    plain = {}
    for _, text, label in rows:
        at, bucket = nb_svm.features([text])
        for b in set(bucket.tolist()):
            plain.setdefault(b, [0, 0])[label] += 1
    assert {b: tuple(n) for b, n in plain.items()} == {b: n for b, n in counted.items() if b != nb_svm.BUCKETS}
    vectors = [(np.array([0, 2]), np.array([1.0, 1.0])), (np.array([1, 2]), np.array([0.5, 1.0])), (np.array([0, 1, 2]), np.array([0.2, 0.9, 1.0])), (np.array([0, 2]), np.array([0.4, 1.0]))]
    sign, cost = np.array([1.0, -1.0, -1.0, 1.0]), np.full(4, 1.0)
    weight = nb_svm.dual_coordinate_descent(vectors, sign, cost, 3)
    dense = np.zeros((4, 3))
    for i, (at, value) in enumerate(vectors):
        dense[i, at] = value

    def loss(w):
        return 0.5 * w @ w + (cost * np.maximum(0, 1 - sign * (dense @ w))).sum()

    best = np.zeros(3)
    for step in range(1, 60_001):
        margin = sign * (dense @ best)
        slope = (margin < 1).astype(float)
        best = best - 0.3 / (step**0.6) * (best - (cost * sign * slope) @ dense)
    assert loss(weight) <= loss(best) + 1e-2


def test_the_sample_is_chosen_by_numbers(spark):
    rows = [(i % 50, f"text {i % 50}", i % 2) for i in range(400)] + [(None, None, 1)]
    training = spark.createDataFrame(rows, "doc_id bigint, text string, label int")
    got = [(r["label"], r["text"]) for r in nb_svm.fitting_sample(training, 10).collect()]
    assert len(got) == len(set(got)) == 20
    everything = nb_svm.fitting_sample(training, 1000).collect()
    assert len(everything) == 51
    plan = nb_svm.fitting_sample(training, 10)._jdf.queryExecution().executedPlan().toString()
    ordered = [line for line in plan.splitlines() if "TakeOrderedAndProject" in line]
    assert ordered and not any("text" in line for line in ordered)
