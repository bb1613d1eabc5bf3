"""Shared lines against SQL, a brute-force version and hand-made texts."""

import hashlib
from collections import defaultdict

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from oracle import compare, connect
from pyspark.sql import functions as F
from tapewright.llm import line_runs, queries

SF = "/root/testdata/sf0.001"
LONG = "a line of twenty points or more"


def test_query_matches_sql(spark):
    assert compare(spark, connect(SF), "op12", queries.op12_line_dedup, line_runs.SQL, SF) is None


def test_query_runs_no_python(spark):
    plan = queries.op12_line_dedup(spark, SF)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


def brute(rows, min_chars=20, min_docs=3):
    key = lambda line: "".join(c.lower() if "A" <= c <= "Z" else c for c in line.strip(line_runs.SPACES))
    rank = lambda i: (i is not None, i or 0)
    holders = defaultdict(set)
    for i, text in rows:
        for line in (text or "").split("\n"):
            holders[key(line)].add(i)
    shared = {k: max(v, key=rank) for k, v in holders.items() if len(k) >= min_chars and len(v) >= min_docs}
    out = []
    for i, text in rows:
        lines = (text or "").split("\n")
        kept = [x for x in lines if key(x) not in shared or shared[key(x)] == i]
        out.append((i, None if text is None else "\n".join(kept), len(lines), len(lines) - len(kept)))
    return sorted(out, key=str)


def run(spark, rows, **options):
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    return sorted(map(tuple, line_runs.drop_shared_lines(docs, **options).collect()), key=str)


def test_odd_rows(spark):
    rows = [
        (1, None), (2, ""), (2, ""), (None, LONG), (None, f"{LONG}\nown"), (3, f"\t{LONG.upper()}\x0b\n{LONG}\n\n"),
        (4, f"first\n{LONG} \r\nlast"), (5, f"x\n{LONG[:19]}"), (6, LONG[:19]), (7, LONG[:19]), (4, "another row of the id 4\n" + LONG),
        (8, " " + LONG), (9, "Ä" + LONG), (10, "ä" + LONG), (11, "ä" + LONG), (12, "\n".join([LONG + "!"] * 30_000)),
        (13, LONG + "!"), (14, LONG + "!"),
    ]
    assert run(spark, rows) == brute(rows)
    assert run(spark, rows, batches=1) == run(spark, rows, batches=7) == brute(rows)
    assert run(spark, rows, min_chars=1, min_docs=1) == brute(rows, 1, 1)


def test_empty_table_and_clashing_names(spark):
    assert run(spark, []) == []
    names = ["id", "text_hash", "pos", "h1", "h2", "n", "last", "places", "batch", "line", "gone", "n_lines"]
    docs = spark.createDataFrame([(i, LONG, *range(12)) for i in range(3)], "doc_id long, text string, " + ", ".join(f"{c} int" for c in names))
    found = line_runs.drop_shared_lines(docs)
    assert found.columns == ["doc_id", "text", *names, "n_dropped"]
    assert sorted((r.doc_id, r.text, r.id, r.n_lines, r.n_dropped, r.gone) for r in found.collect()) == [(0, "", 0, 1, 1, 10), (1, "", 0, 1, 1, 10), (2, LONG, 0, 1, 0, 10)]


def test_ids_of_text(spark):
    docs = spark.createDataFrame([(c, LONG) for c in "abc"], "name string, body string")
    found = line_runs.drop_shared_lines(docs, "name", "body").collect()
    assert {r.name: r.body for r in found} == {"a": "", "b": "", "c": LONG}


_LINE = st.text(alphabet="aAé \t", max_size=4)


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.integers(0, 6), st.lists(_LINE, max_size=5).map("\n".join)), max_size=12))
def test_like_brute_force(spark, rows):
    assert run(spark, rows, min_chars=2, min_docs=2, batches=2) == brute(rows, 2, 2)


def test_runs_are_levelled_and_settled_keys_add_nothing(spark):
    store = line_runs.LineRuns(spark)
    docs = spark.createDataFrame([(i, f"{LONG}\n{LONG} {i % 5}") for i in range(25, 0, -1)], "doc_id long, text string")
    lines = line_runs.keyed_lines(docs, "doc_id", "text", 20)
    seen = []
    for low in (21, 16, 11, 6, 1):
        store.add(lines.where(F.col("id").between(low, low + 4)))
        seen.append(store.runs())
    assert seen == [[(0, 0)], [(0, 1)], [(0, 1), (2, 2)], [(0, 3)], [(0, 3), (4, 4)]]
    # The common line is settled by the first batch, the others by the first four.
    assert sorted((r.n, r["last"]) for r in store.table((0, 3)).collect()) == [(4, i) for i in range(21, 26)] + [(5, 25)]
    assert store.table((4, 4)).count() == 0
    # An interrupted compaction left its inputs; they are covered and count no more.
    again = line_runs.LineRuns(spark, store.name)
    assert again.runs() == [(0, 3), (4, 4)] and again.settled().count() == 6 and again.runs() == [(0, 4)]
    store.drop()
    assert store.runs() == []


def test_runs_are_not_shuffled(spark):
    other = spark.newSession()
    other.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    store = line_runs.LineRuns(other)
    lines = other.range(9).selectExpr("id", "id AS h1", "id AS h2")
    store.add(lines)
    store.add(lines)
    a, b = store.table((0, 1)).alias("a"), store.table((0, 1)).alias("b")
    for kind in ("full", "left_anti"):
        plan = a.join(b, (F.col("a.h1") == F.col("b.h1")) & (F.col("a.h2") == F.col("b.h2")), kind)._jdf.queryExecution().toString()
        assert "SortMergeJoin" in plan and "Exchange" not in plan
    assert {r.n for r in store.table((0, 1)).collect()} == {2}
    store.drop()


def test_digest_of_kept_text(spark):
    found = queries.op12_line_dedup(spark, SF).limit(1).collect()[0]
    assert len(found.kept_sha256) == 64
    assert hashlib.sha256(b"").hexdigest() == "e3b0c44298fc1c149afbf4c8996fb92427ae41e4649b934ca495991b7852b855"


@pytest.mark.parametrize("positions,n,mask", [([0], 1, "1"), ([1, 3], 5, "01010"), ([4], 5, "00001"), ([0, 1], 2, "11")])
def test_mask(spark, positions, n, mask):
    frame = spark.createDataFrame([(positions,)], "p array<int>")
    assert frame.select(line_runs._mask(F.col("p"), F.lit(n))).first()[0] == mask
