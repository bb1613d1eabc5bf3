"""Ranked search against SQL, a brute-force version and hand-made texts."""

import math
import re
from collections import Counter

import numpy as np
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from oracle import compare, connect
from tapewright.llm import lexical_search, queries

SF = "/root/testdata/sf0.001"
TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def test_query_matches_sql(spark):
    assert compare(spark, connect(SF), "op11", queries.op11_lexical_search, lexical_search.SQL, SF) is None


def words(text):
    return TERM.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def brute(docs, items, k):
    counts = [(d, Counter(words(t))) for d, t in docs]
    n_docs, total = sum(bool(c) for _, c in counts), sum(sum(c.values()) for _, c in counts)
    df = Counter(t for _, c in counts for t in c)
    wanted = {}
    for item, text in items:
        wanted.setdefault(item, set()).update(words(text))
    out = []
    for item, own in wanted.items():
        found = []
        for d, c in counts:
            m = 50 + (50 * sum(c.values()) * n_docs) // total if total else 0
            score = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((10**9 * c[t]) // (1000 * c[t] + 20 * m)) for t in own if c[t])
            if score > 0:
                found.append((-score, d is not None, d or 0, d))
        out += [(item, r, f[3], -f[0]) for r, f in enumerate(sorted(found)[:k], 1)]
    return sorted(out, key=str)


def run(spark, docs, items, k=3, **options):
    frames = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    return sorted(map(tuple, lexical_search.search(*frames, k=k, **options).collect()), key=str)


ODD = [
    (1, None), (2, ""), (3, "..."), (None, "alpha beta"), (None, "alpha"), (4, "Alpha, BETA; gamma"), (5, "alpha beta gamma"), (5, "alpha beta gamma"),
    (6, "alpha " * 50_000 + "omega"), (7, "élan Été été ÉTÉ"), (8, "x_y x-y a b 12"), (9, "alpha beta gamma"), (10, "delta"), (11, "delta"),
]
ITEMS = [(1, "alpha beta"), (2, "été élan"), (3, None), (4, ""), (None, "omega 12"), (5, "gamma"), (5, "delta gamma"), (6, "nowhere"), (7, "X y"), (1, "alpha beta")]


def test_odd_rows(spark):
    assert run(spark, ODD, ITEMS) == brute(ODD, ITEMS, 3)
    assert run(spark, ODD, ITEMS, k=1) == brute(ODD, ITEMS, 1)


def test_blocks_of_items(spark):
    assert run(spark, ODD, ITEMS, block_bytes=150) == brute(ODD, ITEMS, 3)


def test_empty_tables_and_other_columns(spark):
    assert run(spark, [], ITEMS) == [] and run(spark, ODD, []) == [] and run(spark, [(1, "...")], ITEMS) == []
    docs = spark.createDataFrame([("a", "one two", 1, 2, 3)], "name string, body string, item int, rank int, score int")
    items = spark.createDataFrame([("i", "two", 1)], "q string, words string, id int")
    found = lexical_search.search(docs, items, id_col="name", text_col="body", item_col="q", item_text_col="words")
    assert [tuple(r)[:3] for r in found.collect()] == [("i", 1, "a")] and found.columns == ["item_id", "rank", "doc_id", "score"]


_TEXT = st.lists(st.sampled_from("a b c d e f g h".split()), max_size=6).map(" ".join)


@settings(max_examples=4, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(_TEXT, min_size=1, max_size=40), st.lists(_TEXT, min_size=1, max_size=9))
def test_like_brute_force(spark, texts, wanted):
    docs, items = list(enumerate(texts)), list(enumerate(wanted))
    assert run(spark, docs, items, k=2) == brute(docs, items, 2)


@given(st.data())
@settings(max_examples=60, deadline=None)
def test_descent_finds_just_the_items_whose_bound_is_enough(data):
    n_terms, n_items = data.draw(st.integers(1, 9)), data.draw(st.integers(1, 20))
    names = [f"t{k}".encode() for k in range(n_terms)]
    own = {i: set(data.draw(st.lists(st.sampled_from(names), min_size=1))) for i in range(n_items)}
    tree = lexical_search.ItemTree(own, {t: data.draw(st.integers(0, 5)) for t in names}, fanout=2)
    dense = np.array(data.draw(st.lists(st.integers(0, 9), min_size=n_terms, max_size=n_terms)), np.int64) * tree.weights
    least = np.array(data.draw(st.lists(st.integers(0, 30), min_size=n_items, max_size=n_items)), np.int64)
    bounds = [sum(int(dense[tree.number[t]]) for t in own[i]) for i in tree.items]
    among = np.array(data.draw(st.lists(st.booleans(), min_size=n_items, max_size=n_items)))
    found, sums = tree.alive(dense, tree.weakest(least), among)
    assert found.tolist() == [k for k, b in enumerate(bounds) if b >= least[k] and b > 0 and among[k]]
    assert sums.tolist() == [bounds[k] for k in found]


def test_search_leaves_nodes_out(spark):
    """Documents of another subject fill nodes of their own, which no item needs once it has its k-th score."""
    docs = [(i, f"common subject{i % 40} word{i % 7}") for i in range(4000)]
    counted = spark.createDataFrame(docs, "doc_id long, text string").repartition(8)
    vocabulary = {t: n for n, t in enumerate(sorted(set().union(*(lexical_search.term_counts(t) for _, t in docs))))}
    rows = lexical_search._counted(counted, "doc_id", "text", spark.sparkContext.broadcast(vocabulary))
    found = {1: {b"subject3", b"word1"}, 2: {b"subject5"}}
    tree = lexical_search.ItemTree(found, {t: 1000 - 990 * (t == b"common") for t in vocabulary})
    leaves = lexical_search.index(lexical_search._scored(rows, tree.weights, 4000, 12000), node_leaves=2).cache()
    nodes = leaves.where("node_ids IS NOT NULL").count()
    zero = np.zeros(2, np.int64)
    reachable = lexical_search._node_pairs(leaves, tree, zero).count()
    assert reachable < nodes  # no term in common
    best = lexical_search._best(lexical_search._leaf_hits(leaves.join(lexical_search._node_pairs(leaves, tree, zero), "node"), tree, zero, 5), 5)
    scores = {r["item"]: r["score"] for r in best.where("rank = 5").collect()}
    least = np.array([scores[i] for i in range(2)], np.int64)
    assert lexical_search._node_pairs(leaves, tree, least).count() < reachable
    leaves.unpersist()
