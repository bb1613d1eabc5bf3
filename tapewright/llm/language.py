"""Language identification with hyperdimensional profiles.

Each letter has a random vector of +1 and -1. The vector of a letter sequence is the product of its letters' vectors,
each permuted (rotated) by the letter's distance from the end. A text's profile is the sum over all its sequences of
three, with word ends as a letter; a language's prototype is the sum of the profiles of its training texts. The
prototype with the highest cosine names the language.
"""

import re
import uuid

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import functions as F

DIMENSIONS = 1024
PIECE = 200_000  # code points that are counted at once
MOST_LANGUAGES = 5000  # prototypes that workers hold, 8 KB each; more labels than that raise an error

_GAPS = re.compile(r"[\W\d_]+")
# Numbers that count as word characters, such as fractions, superscripts and Roman numerals.
_NUMBERS = frozenset(c for c in map(chr, range(0x80, 0x110000)) if c.isnumeric() and not c.isalpha())


def letters(text):
    """Lower-case letters as code points with one space around each word; empty if the text has no letter."""
    plain = (text or "").lower()
    if not plain.isascii() and (found := _NUMBERS.intersection(plain)):
        plain = plain.translate(dict.fromkeys(map(ord, found), " "))
    plain = _GAPS.sub(" ", plain).strip()
    spaced = f" {plain} " if plain else ""
    return np.frombuffer(spaced.encode("utf-32-le", "surrogatepass"), "<u4").astype(np.uint64)


def sequences(codes):
    """All runs of three code points, each packed into one number."""
    return codes[:-2] << np.uint64(42) | codes[1:-1] << np.uint64(21) | codes[2:]


def letter_vectors(codes):
    """A row of +1 and -1 for each code point, drawn by mixing its number; the same on every machine."""
    lanes = np.arange(DIMENSIONS // 64, dtype=np.uint64)
    x = (codes[:, None] * np.uint64(0x9E3779B97F4A7C15)) + (lanes + np.uint64(1)) * np.uint64(0xD1B54A32D192ED03)
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB), (31, 0x9E3779B97F4A7C15)):
        x = (x ^ (x >> np.uint64(shift))) * np.uint64(factor)
    bits = np.unpackbits(x.astype("<u8").view(np.uint8), axis=1, bitorder="little")
    return bits.astype(np.int8) * np.int8(2) - np.int8(1)


def sequence_vectors(packed):
    """The bound vector of each packed sequence."""
    out = None
    for place in range(3):  # 0 is the last letter
        codes, at = np.unique(packed >> np.uint64(21 * place) & np.uint64((1 << 21) - 1), return_inverse=True)
        turned = np.roll(letter_vectors(codes), place, axis=1)[at]
        out = turned if out is None else out * turned
    return out


def profiles(texts, groups=None, most=None):
    """Sums of sequence vectors, a row for each text or, with ``groups``, for each of ``most`` groups."""
    owners = np.arange(len(texts)) if groups is None else groups
    sums = np.zeros((len(texts) if groups is None else most, DIMENSIONS))
    held, size = [], 0

    def bundle():
        nonlocal held, size
        if held:
            packed = np.concatenate([p for _, p in held])
            owner = np.repeat([o for o, _ in held], [len(p) for _, p in held])
            rows, owner = np.unique(owner, return_inverse=True)
            kinds, at = np.unique(packed, return_inverse=True)
            counts = np.bincount(owner * len(kinds) + at, minlength=len(rows) * len(kinds)).reshape(len(rows), len(kinds))
            sums[rows] += counts.astype(np.float32) @ sequence_vectors(kinds).astype(np.float32)
        held, size = [], 0

    for owner, codes in zip(owners, texts):
        for start in range(0, max(0, len(codes) - 2), PIECE):
            packed = sequences(codes[start : start + PIECE + 2])
            held.append((owner, packed))
            size += len(packed)
            if size >= PIECE or len(held) >= 64:
                bundle()
    bundle()
    return sums


# --- prototypes --------------------------------------------------------------------------------


def prototypes(docs, text_col="text", lang_col="lang"):
    """(languages in order, one unit vector each) from all rows of ``docs`` with a language.

    A task adds up whole numbers for its languages, and the sums over tasks are exact, so the order of rows doesn't
    matter.
    """

    def run(batches):
        sums = {}
        for batch in batches:
            names, at = np.unique(np.array(batch.column("lang").to_pylist(), object).astype(str), return_inverse=True)
            found = profiles([letters(t) for t in batch.column("text").to_pylist()], at, len(names))
            for name, row in zip(names, found):
                sums[str(name)] = sums.get(str(name), 0) + np.rint(row).astype(np.int64)
        for name, row in sums.items():
            places = np.arange(DIMENSIONS, dtype=np.int32)
            yield pa.RecordBatch.from_pydict({"lang": [name] * DIMENSIONS, "place": places, "value": row})

    rows = docs.select(F.col(lang_col).cast("string").alias("lang"), F.col(text_col).cast("string").alias("text"))
    rows = rows.where("lang is not null")
    total = rows.mapInArrow(run, "lang string, place int, value long").groupBy("lang", "place").agg(F.sum("value").alias("value"))
    in_order = F.sort_array(F.collect_list(F.struct("place", "value")))
    by_lang = total.groupBy("lang").agg(F.transform(in_order, lambda s: s["value"]).alias("sums"))
    found = by_lang.orderBy("lang").limit(MOST_LANGUAGES + 1).collect()
    if len(found) > MOST_LANGUAGES:
        raise ValueError(f"more than {MOST_LANGUAGES} languages")
    vectors = np.array([r.sums for r in found], float).reshape(-1, DIMENSIONS)
    return [r.lang for r in found], _unit(vectors)


def _unit(rows):
    return rows / np.maximum(np.sqrt((rows * rows).sum(axis=1, keepdims=True)), 1e-12)


# --- prediction --------------------------------------------------------------------------------


def identify(docs, names, vectors, text_col="text", lang_col="lang_pred", score_col="score"):
    """``docs`` with the language of the nearest prototype and its cosine (0 at least); columns of these names are
    replaced.

    A text that is null or has no letter is ``und`` with score 0, as is any text if nothing was learned. Of equal
    cosines, the language first in order wins. Whole texts of any length are read, in pieces of bounded size.
    """
    held = docs.sparkSession.sparkContext.broadcast((np.array([*names, "und"], object), vectors))

    @F.pandas_udf("lang string, score double")
    def run(texts):
        labels, known = held.value
        codes = [letters(t) for t in texts]
        own = _unit(profiles(codes))
        cosines = own @ known.T if len(known) else np.zeros((len(own), 1))
        best = cosines.argmax(axis=1)
        none = np.array([not len(c) for c in codes], bool) if len(known) else np.ones(len(codes), bool)
        best[none] = len(labels) - 1
        score = np.where(none, 0.0, np.clip(cosines.max(axis=1), 0, 1))
        return pd.DataFrame({"lang": labels[best], "score": score})

    found = f"found_{uuid.uuid4().hex}"
    done = docs.withColumn(found, run(F.coalesce(F.col(text_col).cast("string"), F.lit(""))))
    new = {lang_col: F.col(found)["lang"], score_col: F.col(found)["score"]}
    return done.withColumns(new).drop(found)
