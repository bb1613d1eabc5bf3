"""Near-duplicates against a brute-force version."""

import random
import re

import numpy as np
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st

from tapewright.llm import queries, simhash
from tapewright.llm.components import components

SF = "/root/testdata/sf0.001"


def slow_print(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    shingles = [" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))] if words else []
    hashes = [xxhash.xxh64(s.encode(), seed=42).intdigest() for s in shingles]
    return sum(1 << b for b in range(64) if sum(h >> b & 1 for h in hashes) * 2 > len(hashes))


def slow_classes(prints, tau):
    """Class number of each print by comparing all pairs."""
    label = list(range(len(prints)))

    def find(i):
        while label[i] != i:
            i = label[i]
        return i

    for i in range(len(prints)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= tau:
                a, b = find(i), find(j)
                label[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(prints))]


def test_query_equals_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").orderBy("doc_id").collect()
    prints = [slow_print(d.text) for d in docs]
    classes = slow_classes(prints, 4)
    want = sorted((d.doc_id, f"{p:016x}", docs[c].doc_id) for d, p, c in zip(docs, prints, classes))
    assert sorted(tuple(r) for r in queries.op3_simhash(spark, SF).collect()) == want


def test_odd_rows(spark):
    rows = [(5, None), (3, ""), (9, " \t"), (None, "a b c d e"), (7, "a b c d e"), (7, "a b c d e"), (8, "A B\nC d e"), (None, "one two")]
    docs = spark.createDataFrame([(i, t, "x", 1, 2) for i, t in rows], "doc_id long, text string, id string, fp int, key int")
    found = sorted(simhash.near_duplicates(docs).select("doc_id", "component").collect(), key=str)
    got = {(r.doc_id, r.component) for r in found}
    assert len(found) == len(rows)
    assert got == {(5, 3), (3, 3), (9, 3), (None, 7), (7, 7), (8, 7), (None, None)}


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert simhash.near_duplicates(docs).collect() == []


def test_very_long_text():
    text = "alpha beta gamma delta " * 30_000 + "end"
    assert simhash.fingerprint(text) == slow_print(text)


def test_large_group_of_near_copies(spark, monkeypatch):
    """Buckets above the cell size are divided, and chains over several links stay whole."""
    monkeypatch.setattr(simhash, "CELL", 64)
    monkeypatch.setattr(simhash, "SMALL", 8)
    rng = random.Random(3)
    centre = [rng.getrandbits(64) for _ in range(3)]
    prints = {c ^ sum(1 << b for b in rng.sample(range(64), rng.choice([1, 2, 3, 5, 7]))) for c in centre for _ in range(250)}
    prints |= {rng.getrandbits(64) for _ in range(300)}
    prints = sorted(prints)
    signed = np.array(prints, np.uint64).view(np.int64).tolist()
    frame = spark.createDataFrame([(p,) for p in signed], "fp long")
    parts = simhash.plan_parts(frame, 4)
    assert sum(t + 1 for _, t in parts) == 5
    roots = {r.node: r.root for r in components(simhash.links(frame, parts, 4)).collect()}
    got = [roots.get(s, s) for s in signed]
    want = slow_classes(prints, 4)
    assert len(set(zip(got, want))) == len(set(got)) == len(set(want))


@settings(max_examples=30, deadline=None)
@given(st.lists(st.lists(st.floats(0, 1e6), min_size=5, max_size=5).map(sorted), min_size=2, max_size=4))
def test_thresholds_are_the_cheapest(costs):
    """Against trying all: index 0 is an unused part, the thresholds sum to tau - m + 1."""
    import itertools

    tau = 3
    want = min(
        sum(c[t + 1] for c, t in zip(costs, ts))
        for ts in itertools.product(range(-1, 4), repeat=len(costs))
        if sum(ts) == tau - len(costs) + 1
    )
    cost, chosen = simhash.allocate(costs, tau)
    assert sum(chosen) == tau - len(costs) + 1
    assert abs(cost - want) < 1e-6


def test_every_close_pair_meets_in_a_bucket():
    rng = random.Random(5)
    for thresholds in ([2, 1], [1, 1, 0], [0, 0, 0, 0, 0], [2, 0, 0], [-1, 3, 0]):
        size = 64 // len(thresholds) + 1
        parts = [(list(range(64))[k * size : (k + 1) * size], t) for k, t in enumerate(thresholds)]
        parts = [p for p in parts if p[1] >= 0]
        assert sum(thresholds) == 4 - len(thresholds) + 1
        for _ in range(200):
            a = rng.getrandbits(64)
            b = a ^ sum(1 << k for k in rng.sample(range(64), 4))
            import pyarrow as pa

            both = pa.RecordBatch.from_pydict({"fp": np.array([a, b], np.uint64).view(np.int64)})
            keys = {0: set(), 1: set()}
            for rows in simhash._filer(parts)([both]):
                for key, fp in zip(rows.column("key").to_pylist(), rows.column("fp").to_pylist()):
                    keys[int(fp != both.column("fp")[0].as_py())].add(key)
            assert keys[0] & keys[1]
