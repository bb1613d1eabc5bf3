"""Language identification: vectors against their definition, and held-out accuracy."""

import zlib

import numpy as np

from tapewright.llm import language, queries

SF = "/root/testdata/sf0.01"


def test_held_out_accuracy(spark):
    docs = {r.doc_id: r for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    found = queries.op5_language(spark, SF).collect()
    assert len(found) == len(docs)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) and 0 <= r.score <= 1 for r in found)
    held = [r for r in found if r.held_out]
    assert sum(r.lang_pred == docs[r.doc_id].lang for r in held) / len(held) > 0.98


def slow_profile(text):
    """Products of rotated letter vectors, added up one by one."""
    codes = language.letters(text)
    total = np.zeros(language.DIMENSIONS)
    vector = lambda c, turn: np.roll(language.letter_vectors(np.array([c], np.uint64))[0].astype(int), turn)
    for a, b, c in zip(codes, codes[1:], codes[2:]):
        total += vector(a, 2) * vector(b, 1) * vector(c, 0)
    return total


def test_profiles_are_sums_of_bound_vectors(monkeypatch):
    texts = ["Über den Fluß!", "a", "", "one 2 two", "漢字 and 𝔘nicode", "zz " * 40]
    want = np.array([slow_profile(t) for t in texts])
    codes = [language.letters(t) for t in texts]
    assert np.array_equal(language.profiles(codes), want)
    assert np.array_equal(language.profiles(codes, np.array([0, 1, 0, 1, 2, 2]), 3), [want[[0, 2]].sum(0), want[[1, 3]].sum(0), want[4:].sum(0)])
    monkeypatch.setattr(language, "PIECE", 7)
    assert np.array_equal(language.profiles(codes), want)


def test_letter_vectors_are_nearly_orthogonal():
    vectors = language.letter_vectors(np.arange(97, 123, dtype=np.uint64)).astype(float)
    angles = vectors @ vectors.T / language.DIMENSIONS
    assert np.allclose(np.diag(angles), 1) and np.abs(angles - np.eye(26)).max() < 0.2


def test_odd_rows(spark):
    rows = [(1, "the house and the garden", "en"), (2, "das haus und der garten", "de"), (3, None, "en"), (4, "12 !", None), (5, "the garden", None), (5, "the garden", None), (None, "", "")]
    docs = spark.createDataFrame([(*r, 9) for r in rows], "doc_id long, text string, lang string, score int")
    names, vectors = language.prototypes(docs)
    assert names == ["", "de", "en"]
    found = language.identify(docs, names, vectors)
    assert found.columns == ["doc_id", "text", "lang", "score", "lang_pred"]
    assert [(r.lang_pred, r.score > 0) for r in found.collect()] == [
        ("en", True), ("de", True), ("und", False), ("und", False), ("en", True), ("en", True), ("und", False),
    ]
    none = language.prototypes(docs.limit(0))
    assert {r.lang_pred for r in language.identify(docs, *none).collect()} == {"und"}
    assert language.identify(docs.limit(0), names, vectors).collect() == []


def test_very_long_text(spark):
    docs = spark.createDataFrame([(1, "the house and the garden " * 40_000, "en"), (2, "das haus und der garten " * 3, "de")], "doc_id long, text string, lang string")
    names, vectors = language.prototypes(docs)
    assert [r.lang_pred for r in language.identify(docs, names, vectors).orderBy("doc_id").collect()] == ["en", "de"]


def test_numbers_of_any_kind_are_no_letters(spark):
    for text in ("½", "² ³", "Ⅷ", "12 ٣", "①", "_"):
        assert len(language.letters(text)) == 0
    assert len(language.letters("a½b")) == len(language.letters("a b"))
    docs = spark.createDataFrame([("½ Ⅷ", 1), ("abc", 2)], "text string, __found int")
    names, vectors = language.prototypes(spark.createDataFrame([("abc abd", "x")], "text string, lang string"))
    found = {r.text: r for r in language.identify(docs, names, vectors).collect()}
    assert found["½ Ⅷ"].lang_pred == "und" and found["abc"].lang_pred == "x" and found["abc"]["__found"] == 2
