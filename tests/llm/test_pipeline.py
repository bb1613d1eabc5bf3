"""The pipeline's stages, each against its operator's brute-force version or its own rule."""

import re

import corpus_pipeline as pipeline
import pytest
from tapewright.llm import decontamination, passages
from tapewright.llm.tables import stored
from tapewright.llm.text import Hashes
from test_simhash import slow_classes, slow_print

import __spark_entry__ as entry

SF = "/root/testdata/sf0.001"
STAGES = dict(pipeline.STAGES)
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def outputs(spark):
    """What each stage reads and returns."""
    docs, out = spark.read.parquet(f"{SF}/documents.parquet"), {}
    for name, stage in pipeline.STAGES:
        done = stored(stage(spark, docs, SF), f"test-{name}")
        out[name] = (docs, done)
        docs = done
    return {k: (a.collect(), b.collect(), b.columns) for k, (a, b) in out.items()}


def test_order_and_columns(outputs):
    assert list(outputs) == ["toxicity", "near_duplicates", "repeated_passages", "decontamination", "mixing"]
    assert [c for _, _, c in outputs.values()] == [COLUMNS] * 4 + [[*COLUMNS, "copy"]]


def test_toxicity(spark):
    larger = "/root/testdata/sf0.1"
    docs = spark.read.parquet(f"{larger}/documents.parquet")
    before, after = docs.collect(), pipeline.drop_toxic(spark, docs, larger).collect()
    kept = {r.doc_id for r in after}
    slurs = re.compile(r"\b(trash|pathetic|idiot|disgusting|worthless|stupid|clown|loser|scum|moron)\b", re.I)
    strong = {r.doc_id for r in before if len(slurs.findall(r.text)) >= 3}
    clean = {r.doc_id for r in before if r.lang == "en" and not slurs.search(r.text)}
    assert len(strong) > 100 and len(kept & strong) <= 0.02 * len(strong)
    assert len(kept & clean) >= 0.99 * len(clean)
    assert {tuple(r) for r in after} <= {tuple(r) for r in before}


def test_near_duplicates(outputs):
    before, after, _ = outputs["near_duplicates"]
    before = sorted(before, key=lambda r: r.doc_id)
    first = slow_classes([slow_print(r.text) for r in before], 4)
    assert sorted(r.doc_id for r in after) == sorted({before[c].doc_id for c in first})


def test_repeated_passages(outputs):
    before, after, _ = outputs["repeated_passages"]
    seen, want = set(), {}
    for r in sorted(before, key=lambda r: r.doc_id):
        own, later = passages.units(r.text), []
        for unit in own:
            key = tuple(passages.split_words(unit))
            later.append(key in seen)
            seen.add(key)
        kept, k = [], 0
        while k < len(own):
            end = k
            while end < len(own) and later[end] == later[k]:
                end += 1
            run = own[k:end]
            if not (later[k] and sum(len(passages.split_words(u)) for u in run) >= passages.MIN_WORDS):
                kept += run
            k = end
        want[r.doc_id] = "".join(kept)
    assert {r.doc_id: r.text for r in after} == want
    assert all(r.n_chars == len(r.text) for r in after)


def test_decontamination(spark, outputs):
    before, after, _ = outputs["decontamination"]
    of = Hashes()
    items = [of.of(decontamination.tokens(r.text)) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    want = []
    for r in before:
        text = of.of(decontamination.tokens(r.text))
        if all(sum(t[2] for t in decontamination.tile(i, text)) < decontamination.THRESHOLD * len(i) for i in items):
            want.append(r.doc_id)
    assert sorted(r.doc_id for r in after) == sorted(want)


def test_mixing(outputs):
    before, after, _ = outputs["mixing"]
    words = lambda rows: sum(len(re.findall(r"[^\x20\x09-\x0D]+", r.text)) for r in rows)
    assert {tuple(r)[:5] for r in after} <= {tuple(r) for r in before}
    assert all(r.copy in (1, 2) for r in after)
    assert words(after) == pytest.approx(1.5 * words(before), rel=0.01)


def test_odd_rows_pass_every_stage(spark, tmp_path):
    rows = [(1, None, None, None, None), (1, None, None, None, None), (2, "", "en", "a", 0), (None, "some words of a text", "en", "a", 20), (3, "some words of a text", "en", "b", 20), (3, "other words here", "en", "b", 16)]
    kinds = "doc_id long, text string, lang string, source string, n_chars long"
    spark.createDataFrame(rows, kinds).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(None, None), (3, 0)], "doc_id long, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([(None, None)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    for name in ("toxicity", "near_duplicates", "repeated_passages", "decontamination"):
        docs = stored(STAGES[name](spark, docs, str(tmp_path)), f"odd-{name}")
    assert sorted((r.doc_id, r.text) for r in docs.na.fill("-", ["text"]).collect()) == [(1, "-"), (3, "other words here"), (3, "some words of a text")]
    assert pipeline.run(spark, str(tmp_path)).columns == [*COLUMNS, "copy"]
    empty = spark.createDataFrame([], kinds)
    for name, stage in pipeline.STAGES:
        assert stage(spark, empty, str(tmp_path)).collect() == []


def test_clashing_names_pass_every_stage(spark, tmp_path):
    """Names that operators and stages use inside, a text of a million words, and equal rows."""
    names = ["copy", "id", "text_hash", "__text_hash", "__copy", "row", "first", "named", "score", "times", "size", "removed", "n_units", "component", "__id"]
    long = "several words that go on " * 200_000
    rows = [(k, t, "en", "a", len(t), *range(len(names))) for k, t in enumerate([long, "one two three", "four five six seven", "some other words here"])]
    rows += [(7, "equal rows of some words", "en", "a", 24, *range(len(names)))] * 3
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long" + "".join(f", `{n}` int" for n in names))
    spark.createDataFrame([(1, 0)], "doc_id long, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([(1, "seven eight nine")], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    docs = stored(docs, "clashing")
    for name, stage in pipeline.STAGES:
        found = stage(spark, docs, str(tmp_path))
        want = docs.columns if name != "mixing" else [*(c for c in docs.columns if c != "copy"), "copy"]
        assert found.columns == want
        out = found.collect()
        assert {r.doc_id for r in out} <= {0, 1, 2, 3, 7} and {r.removed for r in out} == {names.index("removed")}
    # Of the equal rows, 150 % are taken: four or five copies, none more than twice.
    mixed = [r for r in pipeline.mix_sources(spark, docs.where("doc_id > 0"), str(tmp_path)).collect() if r.doc_id == 7]
    assert 3 <= len(mixed) <= 6 and max(r.copy for r in mixed) <= 2


def test_registered():
    names = entry.queries()
    assert names["pipeline"] is pipeline.run
    assert [n for n in names if n.startswith("op")] == sorted((n for n in names if n.startswith("op")), key=lambda n: int(n[2:].split("_")[0]))
    assert {n.split("_")[0] for n in names if n.startswith("op")} == {f"op{k}" for k in range(1, 14)}
