"""Quality rules: counts and verdicts against plain versions."""

import math
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from hypothesis import given
from hypothesis import strategies as st

from tapewright.llm import quality, queries
from tapewright.llm.text import Hashes

SF = "/root/testdata/sf0.001"


def slow_counts(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [x for x in text.split("\n")]
    dup = sum(1 for k, x in enumerate(lines) if re.search(r"[^\x20\x09-\x0D]", x) and x in lines[:k])
    windows = Counter(tuple(words[k : k + 3]) for k in range(len(words) - 2))
    covered = {k + i for k in range(len(words) - 2) if windows[tuple(words[k : k + 3])] > 1 for i in range(3)}
    return len(words), sum(len(w) for w in words), len(re.findall(r"[#*$%&|<>]", text)), dup, len(covered)


@given(st.text(alphabet="ab \n\t#|é\x0b ", max_size=80))
def test_base_counts(text):
    assert quality.base_counts(text, Hashes()) == slow_counts(text)


def slow_distance(p, q):
    p, q = [x / sum(p) for x in p], [x / sum(q) for x in q]
    half = lambda a: sum(x * math.log2(2 * x / (x + y)) for x, y in zip(a, q if a is p else p) if x)
    return math.sqrt(max(0, (half(p) + half(q)) / 2))


@given(st.lists(st.tuples(st.integers(0, 9), st.integers(0, 9)), min_size=2, max_size=8))
def test_distance(pairs):
    p, q = [a for a, _ in pairs], [b for _, b in pairs]
    want = slow_distance(p, q) if sum(p) and sum(q) else 0
    assert quality.js_distance([p], q)[0] == pytest.approx(want, abs=1e-7)


def slow_rules(docs):
    """All verdicts in one place, from whole tables of texts."""
    table, of, places = quality.class_table(), Hashes(), {w: k for k, w in enumerate(quality.COMMON)}
    rows = []
    for r in docs:
        n = slow_counts(r.text or "")
        failed = n[0] < 50 or 100 * n[4] > 50 * n[0]
        rows.append((r.doc_id, r.lang, n, failed, quality.char_classes(r.text or "", table), quality.common_words(r.text or "", places)))

    def judged(good):
        sums = defaultdict(lambda: [0, 0])
        for _, lang, _, _, a, b in good:
            if lang is not None:
                sums[lang][0] += a
                sums[lang][1] += b
        known = [(k, *v) for k, v in sorted(sums.items())]
        return quality.verdicts(np.array([r[4] for r in rows], float), np.array([r[5] for r in rows], float), known)[0]

    first = judged([r for r in rows if not r[3]])
    final = judged([r for r, near in zip(rows, first) if near and not r[3]])
    return {r[0]: (*r[2], r[3], bool(k) and not r[3]) for r, k in zip(rows, final)}


def test_query_equals_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").collect()
    found = queries.op7_quality(spark, SF).collect()
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"]
    assert {r.doc_id: tuple(r[n] for n in names) for r in found} == slow_rules(docs)


def test_good_texts_stay_and_bad_ones_go(spark):
    sf = "/root/testdata/sf0.1"
    marks = {r.doc_id: r.quality for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    found = [(r, marks[r.doc_id]) for r in queries.op7_quality(spark, sf).collect() if r.doc_id in marks and not r.base_failed]
    good, bad = ([r.kept for r, m in found if m == k] for k in (1, 0))
    assert np.mean(good) > 0.99 and np.mean(bad) < 0.05


def test_odd_rows(spark):
    prose = "the house and the garden of the people that we have seen " * 3 + " ".join(f"word{chr(97 + k % 26)}{k}" for k in range(60))
    rows = [(1, None, "en"), (2, "", None), (3, prose, "en"), (3, prose, "en"), (None, "# " * 90, None), (4, prose, None)]
    docs = spark.createDataFrame([(*r, 1, True) for r in rows], "doc_id long, text string, lang string, n_words int, kept boolean")
    found = quality.rules(docs).collect()
    assert len(found) == 6
    assert {r.doc_id for r in found if r.base_failed} == {1, 2, None}
    assert {r.doc_id for r in found if r.kept} == {3, 4}
    assert quality.rules(docs.limit(0)).collect() == []
    # Without a language anywhere, the base rules decide.
    assert [r.kept for r in quality.rules(docs.where("lang is null")).collect()].count(True) == 1


def test_very_long_text(spark):
    text = " ".join(f"w{k}" for k in range(300_000))
    [row] = quality.rules(spark.createDataFrame([(1, text, "en")], "doc_id long, text string, lang string")).collect()
    assert (row.n_words, row.n_repeat_words) == (300_000, 0)
