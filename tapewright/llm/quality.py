"""Quality rules by distribution divergence.

A text's histograms of character classes and of common words are compared with those of each language's texts by
Jensen-Shannon distance. The nearest language counts, so a wrong language label of a text does no harm. Short texts have
rough histograms: below a guard length a histogram is not judged, and above it the limit falls with the length.
"""

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from tapewright.llm.stopwords import STOP_WORDS
from tapewright.llm.tables import stored
from tapewright.llm.text import Hashes

SYMBOLS = "#*$%&|<>"
MIN_WORDS = 50  # of a text that passes the base rules
MAX_REPEATED = 50  # per cent of the words of a text that passes the base rules
MOST_LANGUAGES = 5000  # references that workers hold, about 3 KB each
GUARD_CHARS = 200  # characters of a text whose character classes are judged
GUARD_WORDS = 80  # words of a text whose common words are judged
CHAR_LIMIT, WORD_LIMIT = 0.10, 0.12  # distances of a very long text that are still accepted
CHAR_SLACK, WORD_SLACK = 2.0, 2.2  # added to the limits, divided by the square root of the length

COMMON = sorted({w for words in STOP_WORDS.values() for w in words.split()})
CLASSES = ("lower", "upper", "digit", "space", "sentence", "symbol", "other")
SPACES = " \t\n\v\f\r\u00a0"
SENTENCE_MARKS = ".,;:!?'\"()-’“”„«»¿¡–—"
OTHER_MARKS = "#*$%&|<>=+^~@\\/_{}[]`"

_WORD = re.compile(r"[^ \t-\r]+")
_LETTERS = re.compile(r"[^\W\d_]+")


# --- one text ----------------------------------------------------------------------------------


def base_counts(text, codes_of):
    """(words, their code points, symbols, repeated lines, words in repeated windows of three) of a text."""
    words = _WORD.findall(text)
    seen, repeated_lines = set(), 0
    for line in text.split("\n"):
        if line in seen:
            repeated_lines += 1
        elif _WORD.search(line):
            seen.add(line)
    covered = np.zeros(len(words) + 3, np.int64)
    if len(words) >= 3:
        codes = codes_of.of([w.encode("utf-8", "surrogatepass") for w in words])
        windows = (codes[:-2] * np.uint64(0x9E3779B97F4A7C15) ^ codes[1:-1]) * np.uint64(0xC2B2AE3D27D4EB4F) ^ codes[2:]
        _, at, counts = np.unique(windows, return_inverse=True, return_counts=True)
        twice = np.flatnonzero(counts[at] > 1)
        np.add.at(covered, twice, 1)
        np.add.at(covered, twice + 3, -1)
    return len(words), sum(map(len, words)), sum(map(text.count, SYMBOLS)), repeated_lines, int((np.cumsum(covered) > 0).sum())


def class_table():
    """The class of each code point below 65536; all above count as the last class."""
    table = np.full(1 << 16, CLASSES.index("other"), np.uint8)
    for code in range(1 << 16):
        char = chr(code)
        if char.isalpha():
            table[code] = CLASSES.index("upper" if char.isupper() else "lower")
        elif char.isdigit():
            table[code] = CLASSES.index("digit")
        elif char in SPACES:
            table[code] = CLASSES.index("space")
        elif char in SENTENCE_MARKS:
            table[code] = CLASSES.index("sentence")
        elif char in OTHER_MARKS:
            table[code] = CLASSES.index("symbol")
    return table


def char_classes(text, table):
    """Counts of the character classes, in the order of ``CLASSES``."""
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")
    counts = np.bincount(table[np.minimum(codes, len(table) - 1)], minlength=len(CLASSES))
    counts[-1] += (above := int((codes >= len(table)).sum()))
    counts[table[-1]] -= above
    return counts


def common_words(text, place_of):
    """Counts of the listed words, in the order of ``COMMON``, and of all other words."""
    counts = np.zeros(len(COMMON) + 1, np.int64)
    for word in _LETTERS.findall(text.lower()):
        counts[place_of.get(word, -1)] += 1
    return counts


# --- distances ---------------------------------------------------------------------------------


def js_distance(rows, reference):
    """Jensen-Shannon distance (base 2, from 0 to 1) of each row of counts to one row of counts; 0 where either is
    empty.
    """
    rows, reference = np.asarray(rows, float), np.asarray(reference, float)
    sums = rows.sum(axis=1, keepdims=True)
    p = rows / np.maximum(sums, 1e-300)
    q = reference / max(reference.sum(), 1e-300)
    middle = (p + q) / 2
    with np.errstate(divide="ignore", invalid="ignore"):
        left = np.where(p > 0, p * np.log2(p / middle), 0).sum(axis=1)
        right = np.where(q > 0, q * np.log2(q / middle), 0).sum(axis=1)
    found = np.sqrt(np.clip((left + right) / 2, 0, 1))
    return np.where((sums[:, 0] > 0) & (reference.sum() > 0), found, 0.0)


def word_bins(counts, reference, most=20):
    """Histograms over a language's ``most`` commonest listed words, its other listed words, and all else."""
    order = np.argsort(-reference[:-1], kind="stable")
    top, rest = order[:most], order[most:]
    own = rest[reference[rest] > 0]
    counts = np.atleast_2d(counts)
    first, listed = counts[:, top], counts[:, own].sum(axis=1)
    return np.column_stack([first, listed, counts.sum(axis=1) - first.sum(axis=1) - listed])


# --- whole tables ------------------------------------------------------------------------------

_COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def measure(docs, id_col="doc_id", text_col="text", lang_col="lang"):
    """(id, lang, base counts, class and word histograms) of each row; one pass over the texts."""

    def run(batches):
        codes_of, place_of, table = Hashes(), {w: k for k, w in enumerate(COMMON)}, class_table()
        for batch in batches:
            for k in range(0, batch.num_rows, 512):
                some = batch.slice(k, 512)
                texts = some.column("text").to_pylist()
                base = np.array([base_counts(t, codes_of) for t in texts], np.int64).reshape(-1, 5)
                yield pa.RecordBatch.from_arrays(
                    [some.column("id"), some.column("lang")]
                    + [pa.array(base[:, c]) for c in range(5)]
                    + [pa.array([char_classes(t, table) for t in texts], pa.list_(pa.int64()))]
                    + [pa.array([common_words(t, place_of) for t in texts], pa.list_(pa.int64()))],
                    ["id", "lang", *_COUNTS, "classes", "common"],
                )

    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    inputs = docs.select(F.col(id_col).alias("id"), F.col(lang_col).cast("string").alias("lang"), text.alias("text"))
    counts = ", ".join(f"{n} long" for n in _COUNTS)
    kind = docs.schema[id_col].dataType.simpleString()
    measured = inputs.mapInArrow(run, f"id {kind}, lang string, {counts}, classes array<long>, common array<long>")
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEATED * F.col("n_words"))
    return measured.withColumn("base_failed", failed)


def references(measured):
    """[(language, class counts, word counts)]: sums over all texts of ``measured``, added up in tasks first.

    A task sends one row for each of its languages and places. More than ``MOST_LANGUAGES`` languages raise an error.
    """

    def run(batches):
        sums = {}
        for batch in batches:
            lang = batch.column("lang").to_pylist()
            parts = [np.array(batch.column(c).to_pylist(), np.int64) for c in ("classes", "common")]
            rows = np.column_stack(parts) if batch.num_rows else []
            for name, row in zip(lang, rows):
                sums[name] = sums.get(name, 0) + row
        for name, row in sums.items():
            yield pa.RecordBatch.from_pydict({"lang": [name] * len(row), "place": np.arange(len(row), dtype=np.int32), "n": row})

    good = measured.where("lang is not null").select("lang", "classes", "common")
    sums = good.mapInArrow(run, "lang string, place int, n long").groupBy("lang", "place").agg(F.sum("n").alias("n"))
    rows = sums.groupBy("lang").agg(F.transform(F.sort_array(F.collect_list(F.struct("place", "n"))), lambda s: s["n"]).alias("row"))
    found = rows.orderBy("lang").limit(MOST_LANGUAGES + 1).collect()
    if len(found) > MOST_LANGUAGES:
        raise ValueError(f"more than {MOST_LANGUAGES} languages")
    parts = len(CLASSES)
    return [(r.lang, np.array(r.row[:parts]), np.array(r.row[parts:])) for r in found]


def judge(measured, known, carry=False):
    """``measured`` with the nearest language, both distances to it and the verdict ``kept``; with its histograms to
    ``carry`` on.
    """
    held = measured.sparkSession.sparkContext.broadcast(known)
    names = [c for c in measured.columns if carry or c not in ("classes", "common", "lang")]

    def run(batches):
        for batch in batches:
            for k in range(0, batch.num_rows, 4096):
                some = batch.slice(k, 4096)
                classes = np.array(some.column("classes").to_pylist(), float).reshape(-1, len(CLASSES))
                common = np.array(some.column("common").to_pylist(), float).reshape(-1, len(COMMON) + 1)
                kept, nearest, by_class, by_word = verdicts(classes, common, held.value)
                failed = np.array(some.column("base_failed").to_pylist(), bool)
                yield pa.RecordBatch.from_arrays(
                    [some.column(n) for n in names]
                    + [pa.array(nearest, pa.string()), pa.array(by_class), pa.array(by_word), pa.array(kept & ~failed)],
                    [*names, "nearest", "class_distance", "word_distance", "kept"],
                )

    schema = ", ".join(f"{n} {measured.schema[n].dataType.simpleString()}" for n in names)
    return measured.mapInArrow(run, f"{schema}, nearest string, class_distance double, word_distance double, kept boolean")


def verdicts(classes, common, known):
    """(kept, nearest language, class distance, word distance) of each row, by the distances above the guards."""
    rows = len(classes)
    if not known:
        return np.ones(rows, bool), [None] * rows, np.zeros(rows), np.zeros(rows)
    by_class = np.stack([js_distance(classes, c) for _, c, _ in known])
    by_word = np.stack([js_distance(word_bins(common, w), word_bins(w, w)[0]) for _, _, w in known])
    chars, words = classes.sum(axis=1), common.sum(axis=1)
    # How far above its limit a text is; histograms below their guard don't count.
    over_class = np.where(chars >= GUARD_CHARS, by_class / (CHAR_LIMIT + CHAR_SLACK / np.sqrt(np.maximum(chars, 1))), 0)
    over_word = np.where(words >= GUARD_WORDS, by_word / (WORD_LIMIT + WORD_SLACK / np.sqrt(np.maximum(words, 1))), 0)
    best = (by_class + by_word).argmin(axis=0) if rows else np.zeros(0, int)
    at = np.arange(rows)
    return np.maximum(over_class, over_word)[best, at] <= 1, [known[b][0] for b in best], by_class[best, at], by_word[best, at]


def rules(docs, id_col="doc_id", text_col="text", lang_col="lang"):
    """(id, base counts, base_failed, nearest, class_distance, word_distance, kept) for each row of ``docs``.

    A null text counts as empty and fails the base rules. Rows without a language are judged but are no part of a
    reference; without any reference, the base rules alone decide. Whole texts of any length are read. Repeated rows
    each get a row, other columns are ignored.
    """
    measured = stored(measure(docs, id_col, text_col, lang_col), "histograms")
    first = references(measured.where("not base_failed"))
    # Texts far from all first references would blur the final ones.
    near = judge(measured, first, carry=True).where("kept")
    return judge(measured, references(near)).withColumnRenamed("id", id_col)
