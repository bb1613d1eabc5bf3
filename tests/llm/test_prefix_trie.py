"""The prefix trie against SQL, a brute-force version and hand-made conversations."""

import hashlib
import re
import zlib
from collections import defaultdict

import pyarrow as pa
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from oracle import compare, connect
from tapewright.llm import prefix_trie, queries

SF = "/root/testdata/sf0.001"
ROWS = "conv_id long, turn long, role string, text string"


def test_query_matches_sql(spark):
    assert compare(spark, connect(SF), "op13", queries.op13_prefix_trie, prefix_trie.SQL, SF) is None


def rebuilt(rows):
    own = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            own[c].append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [t[2:] for t in sorted(ts)] for c, ts in own.items()}
    out = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 4
        base = c - (c % 20 if c >= 0 else -(-c % 20))
        out[c] = tuple(own.get(base, [])[:h] + turns[h:])
    return out


def brute(rows):
    convs = rebuilt(rows)
    members = defaultdict(list)
    for c, turns in convs.items():
        for d in range(len(turns) + 1):
            members[turns[:d]].append(c)
    children = defaultdict(list)
    for p in members:
        if p:
            children[p[:-1]].append(p)

    def below(p):
        leaves, saved = (0, 0) if children[p] else (1, 0)
        for c in children[p]:
            more = below(c)
            leaves, saved = leaves + more[0], saved + more[1]
        words = len(re.findall(r"[^\x20\x09-\x0D]+", p[-1][1])) if p else 0
        return leaves, saved + (len(members[p]) - 1) * words

    out = []
    for p, inside in members.items():
        ends = ",".join(map(str, sorted(c for c in inside if len(convs[c]) == len(p))))
        parent = min(members[p[:-1]]) if p else None
        out.append((min(inside), len(p), parent, len(inside), len(children[p]), *below(p), hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=str)


def run(spark, rows, **options):
    own = prefix_trie.turns_of(spark.createDataFrame(rows, ROWS))
    return sorted(map(tuple, prefix_trie.trie(prefix_trie.graft(own), **options).collect()), key=str)


def brute_nodes(rows):
    return {turns[:d] for turns in rebuilt(rows).values() for d in range(len(turns) + 1)}


def test_odd_rows(spark):
    long_text = "word " * 200_000
    rows = [
        (0, 0, "user", "Hello there"), (0, 1, "assistant", "Hi"), (0, None, None, None), (0, None, "system", None),
        (1, 0, "user", "Hello there"), (1, 0, "user", "Hello there"), (1, 0, "assistant", "a tie"),  # repeated row and a tie
        (2, 0, "user", ""), (2, 1, "", "user"), (2, 2, "us", "er"), (None, 0, "user", "no conversation"),
        (45, 0, "user", "turnless or not"), (46, 0, "x", "y"), (47, 0, "x", "y"), (48, 0, "x", "y"),  # of an absent base
        (-3, 0, "user", "below zero"), (-20, 0, "user", "Hello there"), (60, 7, "user", long_text), (61, 1, "a", "b"), (61, 9, "user", long_text),
        (62, 1, "a", "b"), (2**62, 0, "x", "y"),
    ]
    assert any(not turns for turns in rebuilt(rows).values())
    assert run(spark, rows) == brute(rows)


def test_large_group_of_copies(spark):
    rows = [(c, t, "user", f"turn {t}") for c in range(3000) for t in range(4)]
    rows += [(c, 0, "user", f"first {c}") for c in range(3000, 3100)]
    assert run(spark, rows) == brute(rows)


def test_deep_conversations_in_tasks_and_in_rounds(spark):
    rows = [(c, t, "user", f"w {t % 3}" if t < 30 + c // 20 else f"own {c}") for c in (20, 40, 60, 61, 80) for t in range(33 + c // 20)]
    rows += [(100, t, "user", f"w {t % 3}") for t in range(3)] + [(120, t, "user", f"w {t % 3}") for t in range(4)]
    want = brute(rows)
    assert run(spark, rows) == want
    assert run(spark, rows, task_turns=0) == want
    assert run(spark, rows, near=1) == want and run(spark, rows, near=33, task_turns=10_000) == want


def test_a_conversation_of_many_turns(spark):
    rows = [(20, t, "user", f"turn {t}") for t in range(600)] + [(21, 0, "user", "turn 0"), (40, 0, "user", "turn 0"), (40, 1, "user", "turn 1")]
    found = run(spark, rows)
    assert len(found) == len(brute_nodes(rows)) and {r[1] for r in found} == set(range(601))
    assert sum(r[2] is None for r in found) == 1


def test_empty_table_one_turnless_conversation_and_extra_columns(spark):
    assert run(spark, []) == []
    turnless = next(c for c in range(21, 40) if zlib.crc32(str(c).encode()) % 4)
    empty = hashlib.sha256(str(turnless).encode()).hexdigest()
    assert run(spark, [(turnless, 0, "user", "gone")]) == [(turnless, 0, None, 1, 0, 1, 0, empty)]
    names = ["path", "depth", "turns", "h", "base", "place", "words", "p1"]
    rows = spark.createDataFrame([(20, 0, "user", "a b", *range(8))], ROWS + "".join(f", {n} int" for n in names))
    found = prefix_trie.trie(prefix_trie.graft(prefix_trie.turns_of(rows)))
    assert sorted(r.depth for r in found.collect()) == [0, 1]


_TURN = st.tuples(st.integers(0, 45), st.sampled_from([None, 0, 1, 2]), st.sampled_from(["u", "a", None]), st.sampled_from(["x", "x y", "", None]))


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(_TURN, max_size=40))
def test_like_brute_force(spark, rows):
    assert run(spark, rows) == brute(rows)


def _batch(**columns):
    return pa.RecordBatch.from_arrays([pa.array(c) for c in columns.values()], list(columns))


def test_pieces_and_digests_over_batches():
    ids = list(range(5000))
    parts = [_batch(p1=[1] * n, p2=[2] * n, id=ids[a : a + n]) for a, n in ((0, 1500), (1500, 3000), (4500, 500))]
    pieces = list(prefix_trie._pieces([*parts, _batch(p1=[1, 3], p2=[3, 3], id=[7, 7])]))
    assert sum(p.num_rows for p in pieces) == 2 + 3 + 1 + 2
    found = {r["p2"]: r["ends_sha256"] for b in prefix_trie._digests(pieces) for r in b.to_pylist() if r["p1"] == 1}
    assert found == {2: hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), 3: hashlib.sha256(b"7").hexdigest()}
