"""License scans on notices put into texts."""

import random
import textwrap
import time

import pytest

from tapewright.llm import licenses, queries

SF = "/root/testdata/sf0.1"
PROSE = "The walk along the river was long. We saw the mill and the old bridge. Nobody was there."


@pytest.mark.parametrize("name", list(licenses.TEMPLATES))
def test_every_notice_is_found_in_prose(name):
    notice = licenses.TEMPLATES[name]
    text = f"{PROSE} {notice} {PROSE}\n{PROSE}"
    hits = licenses.scan_text(text, licenses.TEMPLATES, licenses.compressors(licenses.TEMPLATES))
    assert [h[2] for h in hits] == [name]
    start, end = hits[0][:2]
    assert text[start:end].strip() in notice and len(text[start:end]) >= 0.9 * len(notice) or notice in text[start:end]
    assert hits[0][4] == 1


def test_small_differences_are_named():
    tools = licenses.compressors(licenses.TEMPLATES)
    [hit] = licenses.scan_text("This work is licenced under the GNU General Public License, version 3.", licenses.TEMPLATES, tools)
    assert hit[2] == "GPL-3.0" and hit[5] == ["licensed -> licenced"]
    assert licenses.wording("a b c d", "x a b q d y")[1] == ["c -> q"]


def test_prose_with_cue_words_is_left_alone():
    tools = licenses.compressors(licenses.TEMPLATES)
    for text in ("She had permission to enter the garden.", "A driving license costs money.", "No warranty was given for the car.", PROSE):
        assert licenses.scan_text(text, licenses.TEMPLATES, tools) == []


def test_query_equals_a_search_for_the_wording(spark):
    """The documents hold short notices, each as a line of its own."""
    lines = {
        "Licensed under the Apache License, Version 2.0.": "Apache-2.0",
        "Released under the MIT License.": "MIT",
        "This work is licensed under the GNU General Public License, version 3.": "GPL-3.0",
        "Licensed under CC BY-NC 4.0.": "CC-BY-NC-4.0",
        "All rights reserved.": "All-rights-reserved",
    }
    want = set()
    for r in spark.read.parquet(f"{SF}/documents.parquet").collect():
        at = 0
        for line in r.text.split("\n"):
            if line in lines:
                want.add((r.doc_id, at, at + len(line), lines[line]))
            at += len(line) + 1
    found = {(r.doc_id, r.start, r.end, r.license) for r in queries.op8_licenses(spark, SF).collect()}
    assert want and want <= found
    assert len(found) <= 1.1 * len(want)


def test_odd_rows(spark):
    notice = "Released under the MIT License."
    long = "x " * 200_000 + notice
    rows = [(1, None), (2, ""), (3, notice), (3, notice), (None, notice), (4, long)]
    docs = spark.createDataFrame([(*r, 5, "q") for r in rows], "doc_id long, text string, start int, license string")
    found = licenses.scan(docs)
    assert found.columns == ["doc_id", "start", "end", "license", "reduction", "share", "differences"]
    rows = found.collect()
    assert sorted((str(r.doc_id), r.license) for r in rows) == [("3", "MIT"), ("3", "MIT"), ("4", "MIT"), ("None", "MIT")] or len(rows) == 4
    assert licenses.scan(docs.limit(0)).collect() == []


def test_random_text_gives_nothing():
    rng, tools = random.Random(2), licenses.compressors(licenses.TEMPLATES)
    for _ in range(50):
        text = " ".join("".join(rng.choices("abcdefgh", k=5)) for _ in range(40)) + " license. "
        assert licenses.scan_text(text, licenses.TEMPLATES, tools) == []


def names(text):
    return [h[2] for h in licenses.scan_text(text, licenses.TEMPLATES, licenses.compressors(licenses.TEMPLATES))]


@pytest.mark.parametrize("mark", ["", " * ", "# ", "// "])
@pytest.mark.parametrize("width", [70, 75, 80])
@pytest.mark.parametrize("name", list(licenses.TEMPLATES))
def test_every_notice_is_found_with_line_breaks(name, width, mark):
    lines = textwrap.wrap(licenses.TEMPLATES[name], width)
    assert names("\n".join([PROSE, *(mark + line for line in lines), PROSE])) == [name]


def test_numbered_clauses_and_usual_line_breaks():
    bsd = licenses.TEMPLATES["BSD-3-Clause"]
    for number, clause in enumerate(("Redistributions of source", "Redistributions in binary", "Neither the name"), 1):
        bsd = bsd.replace(clause, f"\n\n{number}. {clause}")
    assert names("\n".join(textwrap.fill(part, 75) for part in bsd.split("\n"))) == ["BSD-3-Clause"]
    mit = licenses.TEMPLATES["MIT-permission"].replace("permit persons to ", "permit persons to\n").replace("the Software is ", "the Software is\n")
    assert names(mit.replace("copies of the Software, and", "\ncopies of the Software, and")) == ["MIT-permission"]


def test_neighbouring_notices_are_rows_of_their_own():
    apache, mit, rights = (licenses.TEMPLATES[k] for k in ("Apache-2.0", "MIT", "All-rights-reserved"))
    assert names(f"{apache}\n{rights}\n{mit}") == ["Apache-2.0", "All-rights-reserved", "MIT"]
    assert names(f"{mit}\n{rights}\n{rights}\n{mit}") == ["MIT", "All-rights-reserved", "All-rights-reserved", "MIT"]
    long = "The distribution has no warranty and needs permission. Copyright is not licensed. " * 30
    assert names(f"{long}{mit} {long}") == ["MIT"]
    every = list(licenses.TEMPLATES)
    assert names("\n".join(licenses.TEMPLATES[k] for k in every)) == every
    assert names("\n".join(licenses.TEMPLATES[k] for k in every[::-1])) == every[::-1]


def test_many_notices_take_linear_time():
    started = time.monotonic()
    assert len(names("Released under the MIT License.\nAll rights reserved. Words between.\n" * 5000)) == 10_000
    assert time.monotonic() - started < 20


def test_notices_in_other_words():
    assert names("Licensed under the MIT License.") == ["MIT-licensed"]
    assert names("Licensed under the Apache License 2.0") == ["Apache-2.0-short"]
    assert names("Distributed under the GNU General Public License v3") == ["GPL-3.0-short"]


def test_the_ranking_by_compression_decides(monkeypatch):
    """Of templates that all have the wording of a block, the one that shrinks it most; without it, another comes."""
    text = "Licensed under CC BY-SA 4.0."
    assert {k for k in ("CC-BY-4.0", "CC-BY-SA-4.0") if licenses.wording(licenses.TEMPLATES[k], text)[0] == 1} == {"CC-BY-4.0", "CC-BY-SA-4.0"}
    assert names(text) == ["CC-BY-SA-4.0"]
    monkeypatch.setattr(licenses, "ranking", lambda raw, tools: (sorted((1, name) for name in tools[1]), 9))
    assert names(text) == ["CC-BY-4.0"]


def test_templates_without_the_usual_words(spark):
    templates = {"motto": "Take what you like and leave the rest to others who come.", "short": "Ça ira"}
    docs = spark.createDataFrame([(1, f"{PROSE} take what you LIKE, and leave the rest to others who come! {PROSE}"), (2, "ça ira"), (3, PROSE)], "doc_id long, text string")
    assert sorted((r.doc_id, r.license) for r in licenses.scan(docs, templates=templates).collect()) == [(1, "motto")]
    known = licenses.Templates(templates)
    for words in known.words.values():
        cues = known._cues(words)
        assert sum(words.count(c) for c in cues) > len(words) * (1 - licenses.MIN_SHARE)
    # A block may lack a tenth of the words, but never all cues.
    lacking = "take what you like and leave the rest to who come"
    assert [h[2] for h in licenses.scan_text(lacking, templates, licenses.compressors(templates))] == ["motto"]
