"""Toxicity by class-conditional Kneser-Ney models.

Toxic and ordinary training texts each give a word distribution from continuation counts: in how many distinct places,
told by the word before, the class uses a word. So copies and repeated boilerplate count once. Counts are discounted by
how many words have one, two, three or four, and what is taken goes to the continuation distribution that both classes
share. An expression that is rare in both classes therefore has nearly the same probability in both, and a new one has
no say. A text is judged by the ratio of its log-likelihoods under the two models, normalised by length: over all its
words, and over its most telling one, two and four distinct words, so a long text is no safer than a short one. A logistic
curve with weights of zero or more, so that a higher ratio never lowers a score, turns these into a probability; it is
fitted on scores of training texts under models that have not seen them.
"""

import re

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Window
from pyspark.sql import functions as F

from tapewright.llm.text import Hashes, fold

MOST_TEXTS = 6000  # training texts of a class, those with the smallest hash of their id
MOST_CHARS = 30_000_000  # code points of a class's training texts together
PEAKS = (1, 2, 4)  # numbers of most telling words whose ratio is looked at
PARTS = 4  # of the training texts, for scores by models that have not seen a text

_WORD = re.compile(r"[^\W\d_]+")


def words(text):
    """Runs of letters in lower case."""
    return [w.encode("utf-8", "surrogatepass") for w in _WORD.findall((text or "").lower())]


# --- training ----------------------------------------------------------------------------------


def training_sample(docs, labels, id_col, text_col, label_col, most_texts, most_chars):
    """(id, label, part, text) of at most ``most_texts`` texts and about ``most_chars`` code points a class; also rows
    by class.
    """
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    sizes = docs.select(F.col(id_col).alias("id"), F.length(text).alias("size"))
    marked = labels.select(F.col(id_col).alias("id"), F.col(label_col).cast("int").alias("label"))
    marked = marked.where("label in (0, 1)").distinct()
    known = sizes.join(marked, "id")
    rows = {r.label: r.n for r in known.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    order = [F.xxhash64("id"), "id", "size"]
    chosen = None
    for label in (0, 1):
        first = known.where(F.col("label") == label).orderBy(*order).limit(most_texts)
        chosen = first if chosen is None else chosen.unionByName(first)
    before = Window.partitionBy("label").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    chosen = chosen.withColumn("before", F.coalesce(F.sum("size").over(before), F.lit(0))).where(F.col("before") < most_chars)
    ids = F.broadcast(chosen.select("id", "label").distinct())  # at most 2 * most_texts rows
    sample = docs.select(F.col(id_col).alias("id"), text.alias("text")).join(ids, "id")
    part = F.pmod(F.xxhash64("id", F.lit("part")), F.lit(PARTS)).cast("int")
    return sample.select("id", "label", part.alias("part"), "text"), rows


def continuation_counts(sample):
    """(word, for each class and part left out, the number of distinct words before it); part ``PARTS`` leaves none out.
    """

    def run(batches):
        codes_of = Hashes()
        for batch in batches:
            for row in range(batch.num_rows):
                codes = codes_of.of(words(batch.column("text")[row].as_py()))
                if not len(codes):
                    continue
                pairs = np.unique(np.stack([np.concatenate([[0], codes[:-1]]).astype(np.uint64), codes]), axis=1).view(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.full(pairs.shape[1], batch.column(c)[row].as_py(), np.int32))
                        for c in ("label", "part")
                    ]
                    + [pa.array(pairs[0]), pa.array(pairs[1])],
                    ["label", "part", "before", "word"],
                )

    pairs = sample.select("label", "part", "text").mapInArrow(run, "label int, part int, before long, word long")
    seen = pairs.groupBy("label", "before", "word").agg(F.bit_or(F.expr("shiftleft(1, part)")).alias("parts"))
    whole = (1 << PARTS) - 1
    kept = [whole - (1 << p) for p in range(PARTS)] + [whole]
    sums = [
        F.sum(F.when((F.col("label") == c) & (F.col("parts").bitwiseAND(mask) != 0), 1).otherwise(0)).alias(f"n{c}_{k}")
        for c in (0, 1)
        for k, mask in enumerate(kept)
    ]
    return seen.groupBy("word").agg(*sums)


def discounts(counts):
    """What is taken from counts of 1, 2, and 3 or more, from the number of words with each count."""
    n = [max(1, int((counts == k).sum())) for k in range(1, 5)]
    base = n[0] / (n[0] + 2 * n[1])
    found = [1 - 2 * base * n[1] / n[0], 2 - 3 * base * n[2] / n[1], 3 - 4 * base * n[3] / n[2]]
    low = 0.0
    for k in range(3):  # never less for a higher count, never more than the count
        low = found[k] = float(np.clip(found[k], max(low, 0.1), k + 1 - 0.05))
    return np.array([0.0, *found])


def smoothed(counts, below):
    """Discounted shares of the counts, with what was taken dealt by the lower distribution ``below``; and that mass."""
    taken = discounts(counts)[np.minimum(counts, 3)]
    total = max(counts.sum(), 1)
    mass = max(taken.sum() / total, 1e-6)
    return (counts - taken) / total + mass * below, mass


def log_ratios(ordinary, toxic):
    """For each word log P(word | toxic) / P(word | ordinary); last, for an unknown word."""
    shared = np.append(ordinary + toxic, 0)
    below, _ = smoothed(shared, np.full(len(shared), 1 / len(shared)))
    there, _ = smoothed(np.append(toxic, 0), below)
    here, _ = smoothed(np.append(ordinary, 0), below)
    ratios = np.log(there / here)
    ratios -= ratios[-1]  # a word that neither class has seen tells nothing
    return ratios.astype(np.float32)


class Model:
    """Word codes in order, their log ratios (a row for each part left out, the last with all) and the curve's weights.
    """

    def __init__(self, codes, ratios, weights):
        self.codes, self.ratios, self.weights = codes, ratios, weights

    def features(self, codes, row=-1):
        """Mean log ratio over all words, then over the most telling distinct words."""
        out = np.zeros(1 + len(PEAKS))
        if len(codes) and len(self.codes):
            at = np.minimum(np.searchsorted(self.codes, codes), len(self.codes) - 1)
            known = self.codes[at] == codes
            ratios = self.ratios[row]
            out[0] = np.where(known, ratios[at], ratios[-1]).mean(dtype=np.float64)
            top = np.maximum(np.sort(ratios[np.unique(at[known])])[::-1][: PEAKS[-1]], 0).cumsum(dtype=np.float64)
            if len(top):
                out[1:] = [top[min(n, len(top)) - 1] / n for n in PEAKS]
        return out

    def score(self, codes):
        return float(_curve(np.append(self.features(codes), 1.0) @ self.weights))


def _curve(x):
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def fit_curve(features, labels, weights):
    """Weighted logistic regression with weights of zero or more; the last one is the constant, of any sign.

    Features whose weight would be below zero are left out, the worst first, until none is.
    """
    used = list(range(features.shape[1]))
    while True:
        found = _newton(features[:, used], labels, weights)
        if not used or found[:-1].min() >= 0:
            break
        del used[int(found[:-1].argmin())]
    out = np.zeros(features.shape[1] + 1)
    out[[*used, -1]] = found
    return out


def _newton(features, labels, weights, ridge=1e-2, rounds=50):
    x = np.column_stack([features, np.ones(len(features))])
    w = np.zeros(x.shape[1])
    keep = ridge * np.eye(x.shape[1])
    keep[-1, -1] = 1e-9
    for _ in range(rounds):
        p = _curve(x @ w)
        step = np.linalg.solve((x.T * (weights * p * (1 - p))) @ x + keep, x.T @ (weights * (labels - p)) - keep @ w)
        w = w + step
        if np.abs(step).max() < 1e-8:
            break
    return w


def train(docs, labels, id_col="doc_id", text_col="text", label_col="toxic", most_texts=MOST_TEXTS, most_chars=MOST_CHARS):
    """A ``Model`` from the labelled rows of ``docs``, sampled as documented; its size is bounded by the sample."""
    spark = docs.sparkSession
    sample, rows = training_sample(docs, labels, id_col, text_col, label_col, most_texts, most_chars)
    table = continuation_counts(sample).toArrow()
    order = np.argsort(np.asarray(table.column("word")).view(np.uint64))
    codes = np.asarray(table.column("word")).view(np.uint64)[order]
    counts = {n: np.asarray(table.column(n)).astype(np.int64)[order] for n in table.column_names[1:]}
    prior = np.log((rows.get(1, 0) + 0.5) / (rows.get(0, 0) + 0.5))
    weights = np.append(np.zeros(1 + len(PEAKS)), prior)
    if not len(codes) or not rows.get(0) or not rows.get(1):
        return Model(codes[:0], np.zeros((PARTS + 1, 1), np.float32), weights)
    ratios = np.stack([log_ratios(counts[f"n0_{k}"], counts[f"n1_{k}"]) for k in range(PARTS + 1)])
    held = spark.sparkContext.broadcast((codes, ratios, weights))

    def run(batches):
        codes_of, model = Hashes(), Model(*held.value)
        for batch in batches:
            found = [
                model.features(codes_of.of(words(text)), part).tolist()
                for text, part in zip(batch.column("text").to_pylist(), batch.column("part").to_pylist())
            ]
            columns = [batch.column("id"), batch.column("label"), pa.array(found, pa.list_(pa.float64()))]
            yield pa.RecordBatch.from_arrays(columns, ["id", "label", "features"])

    kind = sample.schema["id"].dataType.simpleString()
    scored = sample.mapInArrow(run, f"id {kind}, label int, features array<double>").orderBy("id", "label").toArrow()
    labels_of = np.asarray(scored.column("label"))
    shares = np.array([rows[c] / max(1, (labels_of == c).sum()) for c in (0, 1)])
    features = np.array(scored.column("features").to_pylist()).reshape(-1, 1 + len(PEAKS))
    return Model(codes, ratios, fit_curve(features, labels_of, shares[labels_of]))


# --- scoring -----------------------------------------------------------------------------------


def score(docs, model, text_col="text", score_col="score"):
    """``docs`` with a toxicity between 0 and 1 in ``score_col``, which replaces a column of that name.

    Null texts and texts without letters get the score of a text without evidence. Whole texts of any length are scored.
    Without training rows of both classes, the score is the share of toxic rows.
    """
    held = docs.sparkSession.sparkContext.broadcast((model.codes, model.ratios[-1:], model.weights))

    @F.pandas_udf("double")
    def run(texts):
        codes_of, own = Hashes(), Model(*held.value)
        return pd.Series([own.score(codes_of.of(words(t))) for t in texts], dtype=float)

    return docs.withColumn(score_col, run(F.coalesce(F.col(text_col).cast("string"), F.lit(""))))


def learned_rows(labels, id_col="doc_id", folds=5, held_fold=0):
    """The labels that may be learned from: those outside the held-out fold."""
    return labels.where(fold(id_col, folds) != held_fold)
