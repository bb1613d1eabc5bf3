"""Toxicity: parts against plain versions, and held-out accuracy."""

import math
import zlib

import numpy as np
import pytest

from tapewright.llm import queries, toxicity
from tapewright.llm.text import Hashes

SF = "/root/testdata/sf0.1"


def auc(scores, labels):
    ranks = np.argsort(np.argsort(scores)) + 1
    ones = labels.sum()
    return (ranks[labels == 1].sum() - ones * (ones + 1) / 2) / (ones * (len(labels) - ones))


def test_held_out_accuracy(spark):
    found = {r.doc_id: r for r in queries.op4_toxicity(spark, SF).collect()}
    assert len(found) == spark.read.parquet(f"{SF}/documents.parquet").count()
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in found.values())
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in found.values())
    held = [(found[r.doc_id], r.toxic) for r in spark.read.parquet(f"{SF}/labels.parquet").collect() if found[r.doc_id].held_out]
    labels = np.array([t for _, t in held])
    predicted = np.array([f.predicted for f, _ in held])
    assert auc(np.array([f.score for f, _ in held]), labels) > 0.94
    assert labels[predicted == 1].mean() > 0.95 and predicted[labels == 1].mean() > 0.85


def test_held_out_labels_are_not_learned(spark):
    """Other labels in the held-out fold change no score."""
    from pyspark.sql import functions as F

    small = "/root/testdata/sf0.001"
    docs, labels = (spark.read.parquet(f"{small}/{t}.parquet") for t in ("documents", "labels"))
    turned = labels.withColumn("toxic", F.when(toxicity.fold("doc_id", 5) == 0, 1 - F.col("toxic")).otherwise(F.col("toxic")))
    a, b = (toxicity.train(docs, toxicity.learned_rows(x)) for x in (labels, turned))
    assert np.array_equal(a.ratios, b.ratios) and np.array_equal(a.weights, b.weights)


def test_continuation_counts_are_distinct_contexts(spark):
    rows = [(1, 0, 0, "a b a b c"), (2, 0, 1, "a b"), (3, 1, 1, "B; b"), (4, 1, 2, None)]
    sample = spark.createDataFrame(rows, "id long, label int, part int, text string")
    of = Hashes()
    got = {np.int64(r.word): r for r in toxicity.continuation_counts(sample).collect()}
    code = lambda w: of[w.encode()].__index__() - (1 << 64) * (of[w.encode()] >= 1 << 63)
    # before b: a (class 0, in parts 0 and 1); start and b (class 1, in part 1)
    b = got[code("b")]
    assert [b[f"n0_{k}"] for k in range(5)] == [1, 1, 1, 1, 1]
    assert [b[f"n1_{k}"] for k in range(5)] == [2, 0, 2, 2, 2]
    assert got[code("a")].n0_4 == 2 and got[code("c")].n0_0 == 0


def test_smoothed_shares_sum_to_one():
    counts = np.array([0, 1, 1, 1, 2, 2, 3, 9, 40])
    shares, mass = toxicity.smoothed(counts, np.full(len(counts), 1 / len(counts)))
    assert math.isclose(shares.sum(), 1) and 0 < mass < 1 and (shares > 0).all()
    assert (np.diff(shares) >= -1e-12).all()


def test_no_model_and_odd_texts(spark):
    docs = spark.createDataFrame([(1, None, 0.5), (None, "", 0.1), (2, "some words", 0.2), (2, "some words", 0.2)], "doc_id long, text string, score double")
    none = spark.createDataFrame([], "doc_id long, toxic int")
    scored = toxicity.score(docs, toxicity.train(docs, none))
    assert scored.columns == docs.columns
    assert [r.score for r in scored.collect()] == pytest.approx([0.5] * 4)
    marked = spark.createDataFrame([(2, 1), (2, None), (None, 1)], "doc_id long, toxic int")
    assert 0.5 < toxicity.score(docs, toxicity.train(docs, marked)).first().score < 1
    assert toxicity.score(docs.limit(0), toxicity.train(docs.limit(0), marked)).collect() == []


def test_a_long_text_is_no_safer(spark):
    calm = ["the weather is fine today and we walk", "a long road leads over the hill", "we read books in the evening at home"]
    rows = [(k, f"{calm[k % 3]} number {k} {'vile ' if k % 4 == 0 else 'mild '}{calm[(k + 1) % 3]} {'nasty' if k % 4 == 0 else 'good'} {k % 7}") for k in range(400)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(k, int(k % 4 == 0)) for k in range(400)], "doc_id long, toxic int")
    model = toxicity.train(docs, labels)
    long = " ".join(calm * 5000)
    tests = spark.createDataFrame([(0, long), (1, f"{long} vile {long} nasty {long}")], "doc_id long, text string")
    scores = {r.doc_id: r.score for r in toxicity.score(tests, model).collect()}
    assert scores[1] > 0.5 > scores[0]


def test_sample_is_bounded(spark):
    docs = spark.createDataFrame([(k, "x" * 100) for k in range(300)], "doc_id long, text string")
    labels = spark.createDataFrame([(k, k % 2) for k in range(300)], "doc_id long, toxic int")
    sample, rows = toxicity.training_sample(docs, labels, "doc_id", "text", "toxic", 20, 1000)
    assert sample.count() == 20 and rows == {0: 150, 1: 150}


def test_query_equals_a_plain_version(spark):
    """Counts, ratios, features and scores of the whole query from sets and loops."""
    small = "/root/testdata/sf0.001"
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{small}/documents.parquet").collect()}
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{small}/labels.parquet").collect() if zlib.crc32(str(r.doc_id).encode()) % 5}
    part_of = {r.id: r.part for r in spark.createDataFrame([(i,) for i in labels], "id long").selectExpr("id", "CAST(pmod(xxhash64(id, 'part'), 4) AS INT) AS part").collect()}

    def ratios(left_out):
        contexts = ({}, {})
        for i, label in labels.items():
            if part_of[i] != left_out:
                own = toxicity.words(docs[i])
                for before, word in zip([b"", *own], own):
                    contexts[label].setdefault(word, set()).add(before)
        names = sorted({w for i in labels for w in toxicity.words(docs[i])})
        counts = [np.array([len(c.get(w, ())) for w in names]) for c in contexts]
        found = toxicity.log_ratios(*counts)
        return dict(zip(names, found.tolist())), float(found[-1])

    def features(text, known):
        own = toxicity.words(text)
        if not own:
            return [0.0] * 4
        top = sorted((max(known[0][w], 0) for w in set(own) if w in known[0]), reverse=True)
        return [sum(known[0].get(w, known[1]) for w in own) / len(own), *(sum(top[:n]) / n for n in (1, 2, 4))]

    models = [ratios(k) for k in range(4)]
    ids = sorted(labels)
    trained = np.array([features(docs[i], models[part_of[i]]) for i in ids])
    curve = toxicity.fit_curve(trained, np.array([labels[i] for i in ids]), np.ones(len(ids)))
    assert (curve[:-1] >= 0).all()
    whole = ratios(None)
    want = {i: 1 / (1 + math.exp(-(np.dot(features(t, whole), curve[:-1]) + curve[-1]))) for i, t in docs.items()}
    got = {r.doc_id: r.score for r in queries.op4_toxicity(spark, small).collect()}
    assert got.keys() == want.keys()
    assert max(abs(got[i] - want[i]) for i in want) < 1e-4


def test_a_higher_ratio_never_lowers_a_score():
    rng = np.random.default_rng(1)
    for _ in range(20):
        x = rng.normal(size=(60, 4))
        y = (x @ rng.normal(size=4) + rng.normal(size=60) > 0).astype(int)
        w = toxicity.fit_curve(x, y, np.ones(60))
        assert (w[:-1] >= 0).all()
