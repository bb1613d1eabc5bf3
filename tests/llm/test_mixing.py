"""Mixing: targets against a plain version, the cube method's properties, and whole mixes."""

import random
import re
from collections import defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tapewright.llm import mixing, queries

SF = "/root/testdata/sf0.01"


def slow_targets(sizes):
    """Targets by dealing the excess again until no source is above its limit; sizes by source, in order."""
    weights = [(5, 2, 1)[k % 3] for k in range(len(sizes))]
    total, full = 1.5 * sum(sizes), set()
    while True:
        rest = total - sum(2 * sizes[k] for k in full)
        free = sum(w for k, w in enumerate(weights) if k not in full)
        targets = [2.0 * s if k in full else rest * weights[k] / free for k, s in enumerate(sizes)]
        over = {k for k, t in enumerate(targets) if t > 2 * sizes[k]} - full
        if not over:
            return targets
        full |= over


def test_query_reaches_its_targets(spark):
    docs = {r.doc_id: r for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    rows = queries.op6_mixing(spark, SF).collect()
    assert sorted(r.doc_id for r in rows) == sorted(docs)
    by_source, sizes = defaultdict(list), defaultdict(int)
    for r in rows:
        assert r.size == len(re.findall(r"[^\x20\x09-\x0D]+", docs[r.doc_id].text or ""))
        assert r.taken in (0, r.size, 2 * r.size)
        by_source[docs[r.doc_id].source].append(r)
        sizes[docs[r.doc_id].source] += r.size
    names = sorted(sizes)
    for name, target in zip(names, slow_targets([sizes[n] for n in names])):
        own = by_source[name]
        assert {r.source_size for r in own} == {sizes[name]}
        assert all(r.target == pytest.approx(target) for r in own)
        # What the landing leaves is less than a short document.
        assert abs(sum(r.taken for r in own) - target) <= max(20, 0.01 * target)


def test_reruns_agree(spark):
    again = spark.newSession()
    again.conf.set("spark.sql.shuffle.partitions", "3")
    a, b = (sorted(tuple(r) for r in queries.op6_mixing(s, SF).collect()) for s in (spark, again))
    assert a == b


@settings(max_examples=100, deadline=None)
@given(st.lists(st.tuples(st.floats(0, 1), st.integers(1, 3), st.integers(0, 50)), max_size=40), st.integers(0, 5))
def test_the_flight_keeps_both_totals(units, seed):
    chances = [u[0] for u in units]
    rows = [(float(c), float(w)) for _, c, w in units]
    flown = mixing.fly(chances, rows, random.Random(seed))
    assert all(0 <= f <= 1 for f in flown)
    assert sum(0 < f < 1 for f in flown) <= 2
    for k in (0, 1):
        assert sum(f * r[k] for f, r in zip(flown, rows)) == pytest.approx(sum(c * r[k] for c, r in zip(chances, rows)), abs=1e-5)


def test_the_flight_keeps_inclusion_probabilities():
    rows = [(1.0, float(w)) for w in (3, 5, 8, 13, 2, 7, 1, 4)]
    sums = np.zeros(8)
    for seed in range(4000):
        sums += mixing.fly([0.3] * 8, rows, random.Random(seed))
    assert np.abs(sums / 4000 - 0.3).max() < 0.03


def test_landing_takes_the_nearest_outcome():
    done = mixing.land([0.5, 1.0, 0.4], [(1, 10), (1, 99), (1, 4)])
    off = lambda d: abs((d[0] - 0.5) * 10 + (d[2] - 0.4) * 4)
    assert done[1] == 1.0 and off(done) == min(off([a, 1, b]) for a in (0, 1) for b in (0, 1))


def test_many_rounds_of_blocks(spark):
    rows = [(k, "w " * (k % 37 + 1), "hot" if k % 3 else f"s{k % 5}") for k in range(3000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    mixed = mixing.mix(docs, block=50).collect()
    sums, targets = defaultdict(int), {}
    for r in mixed:
        sums[r.source] += r.taken
        targets[r.source] = r.target
        assert r.taken <= 2 * r.size
    assert all(abs(sums[s] - t) <= 3 for s, t in targets.items())


def test_equal_rows_are_taken_to_their_share(spark):
    """Ten equal rows of 100 words and a target of 1500: five are taken once more than the others."""
    docs = spark.createDataFrame([(1, "w " * 100, "a")] * 10, "doc_id long, text string, source string")
    found = mixing.mix(docs).collect()
    assert sorted(r.times for r in found) == [1] * 5 + [2] * 5 and {r.target for r in found} == {1500.0}
    assert [(r.copy, r.copies) for r in sorted(found, key=lambda r: r.copy)] == [(k, 10) for k in range(1, 11)]
    odd = spark.createDataFrame([(1, "w " * 10, "a")] * 7 + [(2, "v " * 3, "a")] * 2, "doc_id long, text string, source string")
    assert abs(sum(r.taken for r in mixing.mix(odd).collect()) - 114) <= 5


def test_odd_rows(spark):
    rows = [(1, None, "a"), (2, "", None), (None, "x y", None), (None, "x y", None), (3, "x", "b"), (3, "x y z", "b"), (4, "u v w", "")]
    docs = spark.createDataFrame([(*r, 5, "z") for r in rows], "doc_id long, text string, source string, size int, rank string")
    found = mixing.mix(docs).collect()
    assert sorted(((r.doc_id, r.size) for r in found), key=str) == sorted([(1, 0), (2, 0), (3, 1), (3, 3), (4, 3), (None, 2), (None, 2)], key=str)
    assert len({r.taken for r in found if r.doc_id is None}) == 1
    # Sizes: "" 3, a 0, b 4, null 4; the target of "" stops at 6, and b and null share the rest 1 to 5.
    assert {r.source: r.target for r in found} == pytest.approx({"": 6.0, "a": 0.0, "b": 2.5, None: 8.0})
    assert mixing.mix(docs.limit(0)).collect() == []
    assert {r.target for r in mixing.mix(docs.where("size(split(text, ' ')) = 0 or text is null")).collect()} == {0.0}
