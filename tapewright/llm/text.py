"""Words, ids and folds that several operators share."""

import numpy as np
import xxhash
from pyspark.sql import functions as F

#: A word is a run of characters other than the ASCII white space of this class.
WORD = r"[^\x20\x09-\x0D]+"
SEED = 42  # of Spark's own xxhash64, so hashes made in tasks equal hashes made in SQL


def plain(column):
    """The text with A-Z in lower case; null is the empty text."""
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return F.translate(F.coalesce(F.col(column), F.lit("")), upper, upper.lower())


def count_words(column):
    """Number of words, 0 for null."""
    return F.coalesce(F.regexp_count(F.col(column), F.lit(WORD)), F.lit(0)).cast("long")


def fold(id_column, folds):
    """crc32 of the id as text, modulo ``folds``; a null id counts as the empty text."""
    return F.pmod(F.crc32(F.coalesce(F.col(id_column).cast("string"), F.lit(""))), F.lit(folds))


def split_words(text):
    """The words of a text as bytes, A-Z in lower case. ``bytes.split`` knows exactly the white space of ``WORD``."""
    return (text or "").encode("utf-8", "surrogatepass").lower().split()


class Hashes(dict):
    """64-bit hashes of words, remembered; a lookup is cheaper than the hash. Forgets all when full."""

    def __init__(self, most=300_000):
        super().__init__()
        self.most = most

    def __missing__(self, word):
        if len(self) >= self.most:
            self.clear()
        value = self[word] = xxhash.xxh64_intdigest(word, SEED)
        return value

    def of(self, words):
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))
