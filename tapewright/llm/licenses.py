"""License scans by conditional compression.

In a text with a cue word, stretches as long as a template that hold enough of its word pairs are candidate blocks,
whatever their lines and marks. Each block is compressed by itself and with every template as a raw zstandard dictionary.
Templates are ranked by how much they shrink it, and the first one whose wording the block has, word for word but for a
few named differences, is its license. Of blocks that share words, the one that its template saves most bytes of stays.
Cue words come from the templates: so many of each that no block can do without all of them.
"""

import difflib
import re

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import functions as F

# Wording of license notices in common use.
TEMPLATES = {
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "Apache-2.0-notice": 'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the '
    "License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law "
    'or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR '
    "CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and "
    "limitations under the License.",
    "Apache-2.0-short": "Licensed under the Apache License 2.0.",
    "MIT": "Released under the MIT License.",
    "MIT-licensed": "Licensed under the MIT License.",
    "MIT-permission": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
    'documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights '
    "to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to "
    "whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission "
    "notice shall be included in all copies or substantial portions of the Software.",
    "BSD-3-Clause": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
    "following conditions are met: Redistributions of source code must retain the above copyright notice, this list of conditions and "
    "the following disclaimer. Redistributions in binary form must reproduce the above copyright notice, this list of conditions "
    "and the following disclaimer in the documentation and/or other materials provided with the distribution. Neither the name of "
    "the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software "
    "without specific prior written permission.",
    "GPL-2.0": "This work is licensed under the GNU General Public License, version 2.",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "GPL-3.0-short": "Distributed under the GNU General Public License v3.",
    "GPL-3.0-notice": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public "
    "License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    "LGPL-3.0": "This work is licensed under the GNU Lesser General Public License, version 3.",
    "MPL-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not "
    "distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/.",
    "CC-BY-4.0": "Licensed under CC BY 4.0.",
    "CC-BY-SA-4.0": "Licensed under CC BY-SA 4.0.",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "CC-BY-4.0-notice": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "CC0-1.0": "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work.",
    "All-rights-reserved": "All rights reserved.",
}

MIN_REDUCTION = 0.2  # of a block's compressed size by a template that is confirmed at all
MIN_SHARE = 0.9  # of a template's words, in order, in a confirmed block
MIN_PAIRS = 0.5  # of a template's neighbouring words, in a block that is compared at all
EXTRA, SLACK = 0.25, 4  # words that a block may have beyond its template: a share of the template's, and a number

_WORDS = re.compile(r"[^\W_]+")
_MARKS = re.compile(r"[.!?;:,)\]}\"'”’]*")


def compressors(templates):
    """A plain compressor, and one for each template with its text as raw dictionary."""
    options = {"level": 9, "write_content_size": False, "write_checksum": False, "write_dict_id": False}
    raw = zstandard.DICT_TYPE_RAWCONTENT
    own = {
        name: zstandard.ZstdCompressor(dict_data=zstandard.ZstdCompressionDict(text.lower().encode(), dict_type=raw), **options)
        for name, text in templates.items()
    }
    return zstandard.ZstdCompressor(**options), own


def wording(template, block):
    """(share of the template's words found in order, differences): a difference is (template's words, block's words).
    """
    want, have = _WORDS.findall(template.lower()), _WORDS.findall(block.lower())
    matcher = difflib.SequenceMatcher(None, want, have, autojunk=False)
    same = sum(m.size for m in matcher.get_matching_blocks())
    steps = [s for s in matcher.get_opcodes() if s[0] != "equal"]
    # Words around the whole template are the block's own, not differences.
    inner = [s for s in steps if not (s[1] == s[2] and s[1] in (0, len(want)))]
    return same / max(1, len(want)), [f"{' '.join(want[a:b])} -> {' '.join(have[c:d])}" for _, a, b, c, d in inner]


class Templates:
    """Words of the templates, and which pairs of neighbouring words each one has."""

    def __init__(self, templates):
        self.words = {name: _WORDS.findall(text.lower()) for name, text in templates.items()}
        self.ids = {w: k for k, w in enumerate(sorted({w for words in self.words.values() for w in words}), 1)}
        self.pairs = {name: self._pairs([self.ids[w] for w in words]) for name, words in self.words.items()}
        cues = sorted({w for words in self.words.values() for w in self._cues(words)})
        #: Matches every text with a block; without a template, nothing.
        self.cue = "(?iu)" + ("|".join(cues) if cues else "(?!)")

    @staticmethod
    def _cues(words):
        """The longest words of a template that together are more of it than a block may lack."""
        found, covered = [], 0
        for word in sorted(set(words), key=lambda w: (-len(w), w)):
            if covered > len(words) * (1 - MIN_SHARE) + 1e-9:
                break
            found.append(word)
            covered += words.count(word)
        return found

    def _pairs(self, codes):
        codes = np.asarray(codes, np.int64)
        return np.where((codes[:-1] > 0) & (codes[1:] > 0), codes[:-1] * (len(self.ids) + 1) + codes[1:], -1)

    def hits(self, words):
        """By name: where a pair of neighbouring words begins that the template has."""
        pairs = self._pairs([self.ids.get(w, 0) for w in words])
        some = np.flatnonzero(pairs >= 0)
        return {name: some[np.isin(pairs[some], own)] for name, own in self.pairs.items()} if len(some) else {}


def _steps(want, have):
    """Matching blocks of the words, without a few at either end that lie far off the others."""
    matcher = difflib.SequenceMatcher(None, want, have, autojunk=False)
    found = [m for m in matcher.get_matching_blocks() if m.size]
    for end in (0, -1):
        while len(found) > 1:
            one, next_ = sorted((found[end], found[1 if end == 0 else -2]), key=lambda m: m.b)
            if next_.b - one.b - one.size <= found[end].size + max(1, next_.a - one.a - one.size):
                break
            del found[end]
    return found


def blocks(words, want, at):
    """[places of the matched words] of the stretches that have enough of the template's words in order; ``at`` is
    where the template's word pairs begin.
    """
    found, size = [], int(len(want) * (1 + EXTRA)) + SLACK
    least = max(1, int(np.ceil(MIN_PAIRS * (len(want) - 1))))
    inside = np.searchsorted(at, at + size) - np.arange(len(at))  # pairs from each one on, as far as a block reaches
    have, reach = list(words) if (inside >= least).any() else [], 0
    for start in at[inside >= least].tolist():
        while start >= reach:
            low, high = max(0, start - size // 2), start + size + size // 2
            places = [low + m.b + k for m in _steps(want, have[low:high]) for k in range(m.size)]
            if len(places) < MIN_SHARE * len(want):
                reach = start + size // 4 + 1  # blocks that begin so near were in sight
                break
            found.append(places)
            for k in places:
                have[k] = None
            if places[0] <= start:
                reach = places[-1] + 1
    return found


def ranking(raw, tools):
    """[(size, template)] of a block compressed with each template, smallest first, and its size by itself."""
    plain, own = tools
    return sorted((len(tool.compress(raw)), name) for name, tool in own.items()), len(plain.compress(raw))


def license_of(block, templates, tools):
    """(license, bytes saved, reduction, share, differences) of a block, or None: the best-ranked template that shrinks
    it enough and has its wording.
    """
    ranked, alone = ranking(block.lower().encode("utf-8", "surrogatepass"), tools)
    for size, name in ranked:
        if 1 - size / alone < MIN_REDUCTION:
            return None
        share, differences = wording(templates[name], block)
        if share >= MIN_SHARE:
            return name, alone - size, 1 - size / alone, share, differences
    return None


def scan_text(text, templates, tools, known=None):
    """[(start, end, license, reduction, share, differences)] of the confirmed blocks of a text, in order."""
    known = known or Templates(templates)
    if not re.search(known.cue, text or ""):
        return []
    spans = [m.span() for m in _WORDS.finditer(text)]
    words = [text[a:b].lower() for a, b in spans]
    confirmed = []
    for name, at in known.hits(words).items():
        for places in blocks(words, known.words[name], at):
            start, end = spans[places[0]][0], spans[places[-1]][1]
            end += len(_MARKS.match(text, end).group())
            best = license_of(text[start:end], templates, tools)
            # A block that another template fits better is found as a block of that template.
            if best and best[0] == name:
                confirmed.append(((-best[1], len(best[4]), start, name), places, (start, end, name, *best[2:])))
    found, taken = [], set()
    for _, places, hit in sorted(confirmed):
        if taken.isdisjoint(places):
            taken.update(places)
            found.append(hit)
    return sorted(found)


def scan(docs, id_col="doc_id", text_col="text", templates=None):
    """(id, start, end, license, reduction, share, differences) for each license notice in ``docs``.

    Starts and ends are code points. ``reduction`` is the part of the block's compressed size that the license's
    template saves, ``share`` the part of the template's words that the block has in order, ``differences`` what reads
    otherwise. A text gives a row for each confirmed stretch that shares no word with a better one: the one that its
    template saves more bytes of, then the one with fewer differences, then the first. Null and empty texts give no rows; texts of any length are read whole; repeated rows each give their
    rows; null ids are kept.
    """
    templates = dict(templates or TEMPLATES)
    cue = Templates(templates).cue

    def run(batches):
        tools, known = compressors(templates), Templates(templates)
        for batch in batches:
            for k in range(0, batch.num_rows, 512):
                some = batch.slice(k, 512)
                rows = [(at, *hit) for at, text in enumerate(some.column("text").to_pylist()) for hit in scan_text(text, templates, tools, known)]
                columns = list(zip(*rows)) or [()] * 7
                kinds = [pa.int32(), pa.int32(), pa.string(), pa.float64(), pa.float64(), pa.list_(pa.string())]
                yield pa.RecordBatch.from_arrays(
                    [some.column("id").take(pa.array(columns[0], pa.int64()))] + [pa.array(c, t) for c, t in zip(columns[1:], kinds)],
                    ["id", "start", "end", "license", "reduction", "share", "differences"],
                )

    inputs = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text")).where(F.col("text").rlike(cue))
    kind = docs.schema[id_col].dataType.simpleString()
    found = inputs.mapInArrow(run, f"id {kind}, start int, end int, license string, reduction double, share double, differences array<string>")
    return found.withColumnRenamed("id", id_col)
