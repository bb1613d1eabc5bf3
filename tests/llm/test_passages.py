"""Repeated passages against SQL and hand-made texts."""

import pytest
from hypothesis import given
from hypothesis import strategies as st

from oracle import compare, connect
from tapewright.llm import passages, queries

SF = "/root/testdata/sf0.001"
A = "Here is a sentence of some words that many texts share with others. And a short one. "
B = "The second sentence of that passage has as many words as the first one had."


def test_query_matches_sql(spark):
    assert compare(spark, connect(SF), "op10", queries.op10_passages, passages.SQL, SF) is None


@given(st.text(alphabet="ab .!?\n\t,ß", max_size=60))
def test_units_put_together_are_the_text(text):
    assert "".join(passages.units(text)) == text


def run(spark, rows, **options):
    docs = spark.createDataFrame([(*r, "x", 7) for r in rows], "doc_id long, text string, id string, pos int")
    return passages.remove_repeats(docs, **options)


def test_later_passages_go_with_their_offsets(spark):
    rows = [(2, f"Own start. {A}{B}\nOwn end."), (1, f"Before it all.\n{A.upper()}{B}"), (3, A), (4, "Own start.")]
    found = {r.doc_id: r for r in run(spark, rows).collect()}
    assert found[1].text == rows[1][1] and found[1].removed == []
    # A run of equal units goes; units before and behind it stay.
    assert found[2].text == "Own start. Own end."
    start, end = found[2].removed[0]
    assert rows[0][1][start:end] == f"{A}{B}\n"
    assert found[3].text == A and found[4].text == "Own start."  # too few words
    assert run(spark, rows).columns == ["doc_id", "text", "id", "pos", "removed", "n_units", "n_removed"]


def test_repeats_inside_a_text(spark):
    [row] = run(spark, [(1, f"{A}{B}\n{A}{B}\nEnd here.")]).collect()
    assert row.text == f"{A}{B}\nEnd here."


def test_odd_rows(spark):
    text = f"{A}{B}"
    rows = [(1, None), (2, ""), (2, ""), (None, text), (None, text), (5, text), (5, text), (6, " \n ")]
    found = run(spark, rows).collect()
    assert len(found) == len(rows)
    assert [r.text for r in found if r.doc_id == 1] == [None]
    assert [r.text for r in found if r.doc_id is None] == [text, text]  # first in rank, and one text
    assert [r.text for r in found if r.doc_id == 5] == ["", ""]
    assert [r.text for r in found if r.doc_id == 6] == [" \n "]
    assert run(spark, rows).limit(0).collect() == []


def test_empty_table_and_hot_lines(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert passages.remove_repeats(docs).collect() == []
    line = " ".join(f"w{k}" for k in range(30))
    found = run(spark, [(k, f"{line}\nown {k}.") for k in range(2000)]).collect()
    assert sum(r.n_removed for r in found) == 1999
    assert all(r.text == f"own {r.doc_id}." for r in found if r.doc_id)


def test_very_long_text(spark):
    text = "".join(f"sentence number {k} of a very long text. " for k in range(100_000))
    [row] = run(spark, [(1, text)]).collect()
    assert row.text == text and row.n_units == 100_000


@pytest.mark.parametrize("words, gone", [(24, False), (25, True)])
def test_shortest_passage(spark, words, gone):
    line = " ".join(f"w{k}" for k in range(words))
    found = {r.doc_id: r.text for r in run(spark, [(1, line), (2, line)]).collect()}
    assert found == {1: line, 2: "" if gone else line}


def test_clashing_names(spark):
    names = ["__id", "__text_hash", "__positions", "__own_hash", "__cut", "id", "h1", "first"]
    docs = spark.createDataFrame([(k, A + B, *range(8)) for k in range(3)], "doc_id long, text string" + "".join(f", `{n}` int" for n in names))
    found = passages.remove_repeats(docs)
    assert found.columns == [*docs.columns, "removed", "n_units", "n_removed"]
    assert sorted((r.doc_id, r.n_removed, r["__cut"], r["__own_hash"]) for r in found.collect()) == [(0, 0, 4, 3), (1, 3, 4, 3), (2, 3, 4, 3)]
