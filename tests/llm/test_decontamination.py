"""Decontamination against plain greedy string tiling."""

import random

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from tapewright.llm import decontamination as d
from tapewright.llm import queries
from tapewright.llm.text import Hashes

SF = "/root/testdata/sf0.001"


def slow_tiles(item, text, least):
    """Tiling straight from its definition: the longest free match again and again."""
    free_a, free_b, tiles = [True] * len(item), [True] * len(text), []
    while True:
        best = (0, 0, 0)
        for i in range(len(item)):
            for j in range(len(text)):
                k = 0
                while i + k < len(item) and j + k < len(text) and item[i + k] == text[j + k] and free_a[i + k] and free_b[j + k]:
                    k += 1
                if k > best[2]:
                    best = (i, j, k)
        if best[2] < least:
            return tiles
        i, j, k = best
        tiles.append(best)
        free_a[i : i + k] = [False] * k
        free_b[j : j + k] = [False] * k


def codes(values):
    return np.array(values, np.uint64) * np.uint64(0x9E3779B97F4A7C15)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(1, 4), max_size=18), st.lists(st.integers(1, 4), max_size=24), st.integers(2, 4))
def test_tiles_cover_what_plain_tiling_covers(item, text, least):
    found = d.tile(codes(item), codes(text), least)
    used_a, used_b = [], []
    for i, j, k in found:
        assert k >= least and item[i : i + k] == text[j : j + k]
        used_a += range(i, i + k)
        used_b += range(j, j + k)
    assert len(set(used_a)) == len(used_a) and len(set(used_b)) == len(used_b)
    want = slow_tiles(item, text, least)
    assert max((t[2] for t in found), default=0) == max((t[2] for t in want), default=0)
    # Nothing is left that could still be marked.
    free_a = [x if i not in used_a else -1 for i, x in enumerate(item)]
    free_b = [x if j not in used_b else -2 for j, x in enumerate(text)]
    assert slow_tiles(free_a, free_b, least) == []


def test_window_hashes_depend_on_the_window_only():
    tokens = codes([random.Random(1).randrange(9) for _ in range(400)])
    hashes = d.window_hashes(tokens, 3)
    by_window = {}
    for k, value in enumerate(hashes.tolist()):
        by_window.setdefault(tuple(tokens[k : k + 3].tolist()), set()).add(value)
    assert all(len(v) == 1 for v in by_window.values()) and len({*hashes.tolist()}) == len(by_window)
    assert len(d.window_hashes(tokens[:2], 3)) == 0


def test_query_equals_brute_force(spark):
    """All documents against all items, without seeds, filters or joins."""
    of = Hashes()
    docs = [(r.doc_id, of.of(d.tokens(r.text))) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    items = [(r.item_id, of.of(d.tokens(r.text))) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    want = {}
    for doc_id, text in docs:
        for item_id, item in items:
            coverage = sum(t[2] for t in d.tile(item, text)) / len(item)
            if coverage >= d.THRESHOLD:
                want[doc_id, item_id] = coverage
    found = {(r.doc_id, r.item_id): r.coverage for r in queries.op2_decontamination(spark, SF).collect()}
    assert found == want and want


def frames(spark, docs, items):
    return (
        spark.createDataFrame([(i, t, "c", "c") for i, t in docs], "doc_id long, text string, item string, seed string"),
        spark.createDataFrame([(i, t, "c") for i, t in items], "item_id long, text string, doc_id string"),
    )


WORDS = [f"w{k}" for k in range(40)]


def test_reordered_edited_and_odd_rows(spark):
    item = " ".join(WORDS)
    moved = " ".join(["x", *WORDS[30:], "y", *WORDS[10:30], "z z", *WORDS[:10]]).upper().replace(" ", ",\n ")
    third = " ".join(WORDS[:13])
    docs = [(1, moved), (2, third), (3, None), (4, ""), (None, item), (5, item), (5, item), (5, "other text"), (6, "a b c d e f")]
    left, right = frames(spark, docs, [(7, item), (7, item), (8, None), (9, "w2 w1"), (None, item)])
    found = d.contamination(left, right).collect()
    assert sorted(((r.id, r.item) for r in found), key=str) == [(1, 7), (1, None), (5, 7), (5, None), (None, 7), (None, None)]
    assert all(r.coverage == 1 for r in found)
    kept = d.remove_contaminated(left, right)
    assert kept.columns == left.columns
    assert sorted((r.doc_id, r.text) for r in kept.where("doc_id is not null").select("doc_id", "text").na.fill("-").collect()) == [
        (2, third), (3, "-"), (4, ""), (5, "other text"), (6, "a b c d e f"),
    ]


def test_items_shorter_than_a_tile_match_in_full(spark):
    docs = [(1, "What is two plus"), (2, "so, what is TWO plus three?"), (3, "what is two minus"), (4, "plus"), (5, "two plus what is"), (6, ""), (7, "is two")]
    left, right = frames(spark, docs, [(1, "what is two plus"), (2, "is two"), (3, "..."), (4, "plus"), (5, None)])
    found = sorted((r.id, r.item, r.coverage, [t[2] for t in r.tiles]) for r in d.contamination(left, right).collect())
    assert found == [
        (1, 1, 1.0, [4]), (1, 2, 1.0, [2]), (1, 4, 1.0, [1]), (2, 1, 1.0, [4]), (2, 2, 1.0, [2]), (2, 4, 1.0, [1]), (3, 2, 1.0, [2]),
        (4, 4, 1.0, [1]), (5, 4, 1.0, [1]), (7, 2, 1.0, [2]),
    ]


def test_clashing_names_of_the_rows(spark):
    docs = spark.createDataFrame([(1, "a b c d e f", 1, 2, 3), (2, "x", 1, 2, 3)], "doc_id long, text string, id int, text_hash int, __id int")
    items = spark.createDataFrame([(9, "a b c d e f")], "item_id long, text string")
    kept = d.remove_contaminated(docs, items)
    assert kept.columns == docs.columns and [r.doc_id for r in kept.collect()] == [2]


def test_empty_tables(spark):
    left, right = frames(spark, [(1, " ".join(WORDS))], [(1, " ".join(WORDS))])
    assert d.contamination(left.limit(0), right).collect() == []
    assert d.remove_contaminated(left, right.limit(0)).count() == 1


def test_very_long_text_and_hot_item(spark):
    item = " ".join(WORDS)
    filler = " ".join(f"v{k}" for k in range(200_000))
    docs = [(0, f"{filler} {item} {filler}")] + [(k, f"n{k} {item}") for k in range(1, 1500)]
    left, right = frames(spark, docs, [(1, item)])
    assert d.contamination(left, right).count() == 1500


def test_scripts_without_spaces(spark):
    assert d.tokens("Abc d_e 12、東京タワーab。ไทย") == [t.encode() for t in ["abc", "d", "e", "12", *"東京タワー", "ab", *"ไทย"]]
    chinese, thai = "水在标准大气压下的沸点是多少摄氏度？", "เมืองหลวงของประเทศไทยคือเมืองอะไร"
    docs = [(1, f"前面的文字{chinese}后面的文字。"), (2, f"ก่อน{thai}หลัง"), (3, "水在别的地方，沸点不一样。"), (4, "plain words only in this text")]
    left, right = frames(spark, docs, [(7, chinese), (8, thai)])
    assert sorted((r.id, r.item, r.coverage) for r in d.contamination(left, right).collect()) == [(1, 7, 1.0), (2, 8, 1.0)]
