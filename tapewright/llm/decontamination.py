"""Benchmark decontamination by greedy string tiling.

Texts and benchmark items that share a seed, a run of ``min_match`` tokens, are compared by tiling: the longest runs of
tokens that both have, not yet covered by a tile, are marked again and again, in any order of place, so reordered
passages count in full. A text is contaminated by an item if tiles cover enough of the item.
"""

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from tapewright.llm.tables import stored
from tapewright.llm.text import Hashes

MIN_MATCH = 5  # tokens of the shortest tile
THRESHOLD = 0.5  # share of an item's tokens under tiles
FILTER_BITS = 1 << 25  # of the filter of seeds that every worker holds, at any size of the benchmark

# Thai, Lao, Burmese, Khmer, Tai scripts, Javanese, Cham, kana, bopomofo and Han, with their marks and digits.
UNSPACED = (
    r"\u0e01-\u0e3a\u0e40-\u0e4e\u0e50-\u0e59\u0e81-\u0edf\u1000-\u1049\u1050-\u109d\u1780-\u17d3\u17dd-\u17e9\u1950-\u19da"
    r"\u1a20-\u1a99\ua980-\ua9c0\ua9d0-\ua9fe\uaa00-\uaa59\uaa60-\uaadd\u3005-\u3007\u3041-\u309a\u309d-\u309f\u30a1-\u30fa"
    r"\u30fc-\u312f\u31a0-\u31bf\u31f0-\u31ff\u3400-\u4dbf\u4e00-\u9fff\uf900-\ufaff\uff66-\uff9f\U00020000-\U0003ffff"
)

_TOKEN = re.compile(r"[^\W_]+")
_UNSPACED = re.compile(f"[{UNSPACED}]")
_MIXED = re.compile(rf"[{UNSPACED}]|[^\W_{UNSPACED}]+")
_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))


def tokens(text):
    """Runs of letters and digits in lower case, and each code point of scripts without spaces; punctuation does not
    count.
    """
    text = (text or "").lower()
    token = _TOKEN if text.isascii() or not _UNSPACED.search(text) else _MIXED
    return [t.encode("utf-8", "surrogatepass") for t in token.findall(text)]


def _powers(base, count):
    powers = np.full(count, base, np.uint64)
    if count:
        powers[0] = 1
    return np.multiply.accumulate(powers)


def window_hashes(codes, size):
    """Karp-Rabin hashes of all windows of ``size`` tokens, modulo 2^64; each comes from the one before by a sum and a
    shift.
    """
    if len(codes) < size:
        return np.zeros(0, np.uint64)
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(codes * _powers(_BASE, len(codes)), dtype=np.uint64)])
    mixed = (sums[size:] - sums[:-size]) * _powers(_INVERSE, len(codes) - size + 1)
    mixed ^= mixed >> np.uint64(29)
    mixed *= np.uint64(0xBF58476D1CE4E5B9)
    return mixed ^ (mixed >> np.uint64(32))


# --- tiling of one text and one item -----------------------------------------------------------


def tile(item, text, min_match=MIN_MATCH):
    """[(item place, text place, length)] of the tiles of two arrays of token codes, by running Karp-Rabin matching."""
    tiles, free_item, free_text = [], np.ones(len(item), bool), np.ones(len(text), bool)
    size = max(min_match, len(item))
    while size >= min_match:
        matches = _matches(item, text, free_item, free_text, size)
        longest = max((m[2] for m in matches), default=0)
        if longest > 2 * size:
            size = longest
            continue
        again = False
        for i, j, length in sorted(matches, key=lambda m: (-m[2], m[0], m[1])):
            if free_item[i : i + length].all() and free_text[j : j + length].all():
                tiles.append((i, j, length))
                free_item[i : i + length] = free_text[j : j + length] = False
            else:
                again = True  # a shorter rest of this match may still be long enough
        if not (again and matches):
            if size == min_match:
                break
            size = max(min_match, size // 2)
    return tiles


def _free_windows(codes, free, size):
    """Places and hashes of the windows without a marked token."""
    taken = np.concatenate([[0], np.cumsum(~free)])
    places = np.flatnonzero(taken[size:] == taken[:-size]) if len(codes) >= size else np.zeros(0, int)
    return places, window_hashes(codes, size)[places]


def _matches(item, text, free_item, free_text, size):
    """Maximal runs of equal free tokens, ``size`` or longer, each once."""
    item_places, item_hashes = _free_windows(item, free_item, size)
    text_places, text_hashes = _free_windows(text, free_text, size)
    shared = np.isin(text_hashes, item_hashes)
    by_hash = {}
    for place, value in zip(item_places.tolist(), item_hashes.tolist()):
        by_hash.setdefault(value, []).append(place)
    matches, reached = [], {}
    for j, value in zip(text_places[shared].tolist(), text_hashes[shared].tolist()):
        for i in by_hash[value]:
            if j < reached.get(i - j, -1):
                continue  # inside a run found from an earlier window of this diagonal
            most = min(len(item) - i, len(text) - j)
            same = (item[i : i + most] == text[j : j + most]) & free_item[i : i + most] & free_text[j : j + most]
            length = most if same.all() else int(np.argmin(same))
            if length >= size:
                matches.append((i, j, length))
                reached[i - j] = j + length - size + 1
    return matches


# --- whole tables ------------------------------------------------------------------------------


def _sized_seeds(codes, size, min_match):
    """Hashes of all windows of ``size`` tokens; those shorter than ``min_match`` are told apart from the usual seeds."""
    found = window_hashes(codes, size)
    return found if size == min_match else found ^ np.uint64((size * 0x9E3779B97F4A7C15) % (1 << 64))


def _seed_rows(min_match, seeds_filter=None, short=()):
    """A function for mapInArrow: a row for each window of an item, or for each distinct window of a text that passes
    the filter. An item of fewer than ``min_match`` tokens is one window; ``short`` are the lengths of such items.
    """

    def run(batches):
        codes_of = Hashes()
        bits = None if seeds_filter is None else np.asarray(seeds_filter.value)
        for batch in batches:
            for k in range(0, batch.num_rows, 256):
                some, seeds, places, sizes = batch.slice(k, 256), [], [], []
                for text in some.column("text").to_pylist():
                    codes = codes_of.of(tokens(text))
                    if bits is None:
                        found = _sized_seeds(codes, min(min_match, len(codes)), min_match) if len(codes) else np.zeros(0, np.uint64)
                        at = np.arange(len(found))
                    else:
                        found = np.concatenate([_sized_seeds(codes, size, min_match) for size in (min_match, *short)])
                        found = np.unique(found[_hits(bits, found)])
                        at = np.zeros(len(found), int)
                    seeds.append(found)
                    places.append(at)
                    sizes.append(len(codes))
                counts = [len(s) for s in seeds]
                at = pa.array(np.repeat(np.arange(some.num_rows), counts))
                yield pa.RecordBatch.from_arrays(
                    [
                        some.column("id").take(at),
                        some.column("text_hash").take(at),
                        pa.array(np.concatenate(seeds).view(np.int64), pa.int64()),
                        pa.array(np.concatenate(places), pa.int64()),
                        pa.array(np.repeat(sizes, counts), pa.int64()),
                    ],
                    ["id", "text_hash", "seed", "pos", "size"],
                )

    return run


def _places(seeds):
    return seeds & np.uint64(FILTER_BITS - 1), (seeds >> np.uint64(32)) & np.uint64(FILTER_BITS - 1)


def _hits(bits, seeds):
    a, b = _places(seeds)
    one = np.uint64(1)
    inside = lambda p: (bits[(p >> np.uint64(6)).astype(np.int64)] >> (p & np.uint64(63))) & one
    return (inside(a) & inside(b)).astype(bool)


def _seed_filter(seeds):
    """A Bloom filter of all seeds, two bits a seed, of fixed size; set words are merged before they reach the driver.
    """

    def run(batches):
        for batch in batches:
            found = np.asarray(batch.column("seed")).view(np.uint64)
            for places in _places(found):
                masks = (np.uint64(1) << (places & np.uint64(63))).view(np.int64)
                yield pa.RecordBatch.from_pydict({"word": (places >> np.uint64(6)).astype(np.int64), "mask": masks})

    words = seeds.select("seed").mapInArrow(run, "word long, mask long").groupBy("word").agg(F.bit_or("mask").alias("mask"))
    bits = np.zeros(FILTER_BITS // 64, np.int64)
    found = words.toArrow()
    bits[np.asarray(found.column("word"))] = np.asarray(found.column("mask"))
    return seeds.sparkSession.sparkContext.broadcast(bits.view(np.uint64))


def _keyed(frame, id_col, text_col):
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    return frame.select(F.col(id_col).alias("id"), F.xxhash64(text).alias("text_hash"), text.alias("text"))


def contamination(
    docs, items, id_col="doc_id", text_col="text", item_col="item_id", item_text_col="text",
    min_match=MIN_MATCH, threshold=THRESHOLD,
):
    """(id, text_hash, item, coverage, tiles) for each text and item with coverage of at least ``threshold``.

    ``text_hash`` is xxhash64 of the text, so texts that share an id are told apart; repeated rows count once. ``tiles``
    lists (item place, text place, length) in tokens. Null and empty texts match nothing, and neither does an item without
    a token; an item of fewer than ``min_match`` tokens matches as one tile of its full length. Null ids are kept. Whole texts are searched. Items may be any number: workers hold a filter
    of fixed size only, and what passes it is joined.
    """
    id_kind, item_kind = docs.schema[id_col].dataType.simpleString(), items.schema[item_col].dataType.simpleString()
    own = _keyed(items, item_col, item_text_col).distinct()
    seed_row = "text_hash long, seed long, pos long, size long"
    seeds = stored(own.mapInArrow(_seed_rows(min_match), f"id {item_kind}, {seed_row}"), "item-seeds")
    texts = _keyed(docs, id_col, text_col)
    short = [r["size"] for r in seeds.where(F.col("size") < min_match).select("size").distinct().collect()]  # fewer than min_match
    rows = texts.mapInArrow(_seed_rows(min_match, _seed_filter(seeds), short), f"id {id_kind}, {seed_row}")
    wanted = seeds.select(F.col("id").alias("item"), F.col("text_hash").alias("item_hash"), "seed", "pos", "size")
    shared = rows.select("id", "text_hash", "seed").join(wanted, "seed")
    # Tiles consist of shared seeds, so they can't cover more than this.
    pairs = (
        shared.groupBy("id", "text_hash", "item", "item_hash", "size").agg(F.countDistinct("pos").alias("n"))
        .where(F.col("n") * min_match >= F.col("size") * threshold).select("id", "text_hash", "item", "item_hash")
    )
    item_texts = own.select(F.col("id").alias("item"), F.col("text_hash").alias("item_hash"), F.col("text").alias("item_text"))
    listed = (
        stored(pairs, "candidate-pairs").alias("p")
        .join(item_texts.alias("i"), F.expr("p.item <=> i.item AND p.item_hash = i.item_hash"))
        .select("p.id", "p.text_hash", "i.item", "i.item_text")
        .groupBy("id", "text_hash").agg(F.collect_list(F.struct("item", "item_text")).alias("items"))
    )
    matched = (
        texts.alias("t").join(listed.alias("l"), F.expr("t.id <=> l.id AND t.text_hash = l.text_hash"))
        .select("t.id", "t.text_hash", "t.text", "l.items").dropDuplicates(["id", "text_hash"])
    )

    def run(batches):
        codes_of = Hashes()
        for batch in batches:
            for k in range(batch.num_rows):
                row = batch.slice(k, 1)
                text = codes_of.of(tokens(row.column("text")[0].as_py()))
                out = []
                for item in row.column("items")[0].as_py():
                    codes = codes_of.of(tokens(item["item_text"]))
                    tiles = tile(codes, text, min(min_match, len(codes)))
                    coverage = sum(t[2] for t in tiles) / len(codes)
                    if coverage >= threshold:
                        out.append((item["item"], coverage, [list(t) for t in tiles]))
                if out:
                    at = pa.array([0] * len(out))
                    item_type = batch.schema.field("items").type.value_type.field("item").type
                    yield pa.RecordBatch.from_arrays(
                        [
                            row.column("id").take(at),
                            row.column("text_hash").take(at),
                            pa.array([o[0] for o in out], item_type),
                            pa.array([o[1] for o in out], pa.float64()),
                            pa.array([o[2] for o in out], pa.list_(pa.list_(pa.int32()))),
                        ],
                        ["id", "text_hash", "item", "coverage", "tiles"],
                    )

    return matched.mapInArrow(run, f"id {id_kind}, text_hash long, item {item_kind}, coverage double, tiles array<array<int>>")


def remove_contaminated(docs, items, id_col="doc_id", text_col="text", **options):
    """The rows of ``docs`` whose text no item contaminates, with all their columns, whatever their names.

    Null and empty texts stay, and so do all rows if there is no item; a null id is an id like any other. Repeated rows
    stay or go together. Whole texts are searched, at any length.
    """
    found = contamination(docs, items, id_col, text_col, **options)
    found = stored(found.select("id", "text_hash").distinct(), "contaminated").alias("found")
    text = F.coalesce(F.col(f"rows.{text_col}").cast("string"), F.lit(""))
    same = F.col(f"rows.{id_col}").eqNullSafe(F.col("found.id")) & (F.xxhash64(text) == F.col("found.text_hash"))
    return docs.alias("rows").join(found, same, "left_anti")
