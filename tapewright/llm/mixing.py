"""Mixing sources to target weights by cube-method balanced sampling.

Each source gets a target number of words. A source's ratio of target to size is split into whole copies of every
document and a fraction, which is every document's inclusion probability. The flight phase of the cube method moves the
probabilities of a block of documents through the null space of two constraints, document and word totals, until at most
two per block lie between 0 and 1; those, and a few documents of all lengths that each block holds back, meet in further
rounds of blocks until one block a source is left. Its small rest is landed by trying all outcomes, so a source misses
its target by a few words at most.
"""

import random

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from tapewright.llm.tables import stored
from tapewright.llm.text import count_words

WEIGHTS = (5, 2, 1)  # of the sources in order, repeating
SHARE = 1.5  # of all words that the mix takes
REPEATS = 2  # times a document may be taken
BLOCK = 2000  # documents of a block
HELD_BACK = 12  # documents of a block, spread over its lengths, that are left to the landing
_NONE = 1e-9  # probabilities this close to 0 or 1 are decided


# --- targets -----------------------------------------------------------------------------------


def ranked(sources):
    """Sources numbered from 0 by code point, null last; numbered in parallel, as there may be many."""
    names = sources.select("source").orderBy(F.asc_nulls_last("source"))
    rows = names.rdd.zipWithIndex().map(lambda pair: (pair[0][0], pair[1]))
    return rows.toDF(f"source {sources.schema['source'].dataType.simpleString()}, rank long")


def with_targets(sources, weights=WEIGHTS, share=SHARE, repeats=REPEATS):
    """(source, size) -> (source, rank, size, target): words by weight, at most ``repeats`` times the size, the excess
    dealt again by weight.
    """
    ranks = ranked(sources).withColumnRenamed("source", "own")
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("rank") % len(weights) + 1).cast("int"))
    table = sources.join(ranks, F.col("source").eqNullSafe(F.col("own"))).drop("own")
    table = stored(table.withColumn("weight", weight).withColumn("most", F.col("size") * F.lit(float(repeats))), "sources")
    total, all_weights = table.agg(F.sum("size"), F.sum("weight")).first()
    total, level = float(total or 0) * share, 0.0
    if total:
        level = total / all_weights
        while True:  # the level rises with each round, and a source once full stays full
            full = F.col("most") <= F.col("weight") * level
            used, free = table.agg(F.sum(F.when(full, F.col("most"))), F.sum(F.when(~full, F.col("weight")))).first()
            now = (total - (used or 0.0)) / free if free else level
            if now <= level * (1 + 1e-15):
                break
            level = now
    return table.withColumn("target", F.least("most", F.col("weight") * level)).drop("weight", "most")


# --- the cube method ---------------------------------------------------------------------------


def _direction(rows):
    """A vector u with sum(u) weighted by either constraint zero, for three units (documents, words)."""
    (a, b), (c, d), (e, f) = rows
    u = (c * f - e * d, e * b - a * f, a * d - c * b)
    scale = max(abs(x) for x in u)
    if scale > 1e-12 * max(1.0, max(b, d, f) * max(a, c, e)):
        return [x / scale for x in u]
    return [c, -a, 0.0]  # units in proportion to each other: two of them balance


def fly(chances, rows, rng):
    """Inclusion probabilities after the flight phase; at most two lie between 0 and 1. ``rows`` holds (documents,
    words).
    """
    chances, active = list(chances), []
    for unit, chance in enumerate(chances):
        if not _NONE < chance < 1 - _NONE:
            chances[unit] = float(round(chance))
            continue
        active.append(unit)
        if len(active) < 3:
            continue
        u = _direction([rows[k] for k in active])
        up = min(((1 - chances[k]) / x if x > 0 else -chances[k] / x) for k, x in zip(active, u) if abs(x) > 1e-12)
        down = min((chances[k] / x if x > 0 else (chances[k] - 1) / x) for k, x in zip(active, u) if abs(x) > 1e-12)
        step = up if rng.random() * (up + down) < down else -down
        for k, x in zip(active, u):
            moved = chances[k] + step * x
            chances[k] = 0.0 if moved <= _NONE else 1.0 if moved >= 1 - _NONE else moved
        active = [k for k in active if 0 < chances[k] < 1]
    return chances


def land(chances, rows):
    """Whole decisions for what the flight left open: of all outcomes, the one nearest in words, then in documents."""
    left = [k for k, c in enumerate(chances) if 0 < c < 1]
    outcomes = np.arange(1 << len(left))
    off = np.zeros((len(outcomes), 2))
    for bit, k in enumerate(left):
        off += ((outcomes >> bit & 1) - chances[k])[:, None] * np.array(rows[k])
    best = np.lexsort((outcomes, np.abs(off[:, 0]).round(6), np.abs(off[:, 1]).round(6)))[0]
    done = list(chances)
    for bit, k in enumerate(left):
        done[k] = float(best >> bit & 1)
    return done


def settle(chances, rows, rng, last):
    """One block: the flight of all but a few units of all lengths; with ``last``, the landing too. Units come by
    falling length.
    """
    still = [k for k, c in enumerate(chances) if _NONE < c < 1 - _NONE]
    back = {still[i * len(still) // HELD_BACK] for i in range(HELD_BACK)} if len(still) > HELD_BACK else set(still)
    free = [k for k in range(len(chances)) if k not in back]
    done = list(chances)
    for k, moved in zip(free, fly([chances[k] for k in free], [rows[k] for k in free], rng)):
        done[k] = moved
    return land(done, rows) if last else done


def _round(seed, level):
    """A function for applyInPandas: one block, settled; it is the last if it is the only one of its source."""

    def run(table):
        table = table.sort_values(["words", "order_a", "order_b"], ascending=[False, True, True], kind="stable")
        rows = list(zip(table["copies"].astype(float), table["words"].astype(float)))
        rng = random.Random(f"{seed}-{level}-{table['rank'].iat[0]}-{table['block'].iat[0]}")
        chances = settle(table["chance"].tolist(), rows, rng, table["blocks"].iat[0] == 1)
        return table.assign(chance=pd.Series(chances, index=table.index, dtype=float))[list(table.columns)]

    return run


def mix(
    docs, id_col="doc_id", text_col="text", source_col="source",
    weights=WEIGHTS, share=SHARE, repeats=REPEATS, block=BLOCK, seed="mix",
):
    """(id, text_hash, source, size, source_size, target, taken, times, copy, copies) for each row of ``docs``.

    Sizes and ``taken`` are in words; a document is taken ``times`` times. ``text_hash`` is xxhash64 of the text. Null
    texts have size 0; null is a source of its own, last in order. Rows with equal id, source and text are the ``copies``
    of one unit, numbered by ``copy``: of those that its share asks for, whole ones are taken as they are and a fraction
    of one is decided like any other. Decisions depend on hashes of ids and texts only, so reruns agree on any number of machines. A
    source of any share of the rows is dealt into blocks of bounded size. Without any word, all targets are 0.
    """
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    names = F.col(id_col).alias("id"), F.col(source_col).alias("source")
    sized = docs.select(*names, F.xxhash64(text).alias("text_hash"), count_words(text_col).alias("size"))
    units = stored(sized.groupBy("id", "source", "text_hash", "size").agg(F.count(F.lit(1)).alias("copies")), "units")
    sources = units.groupBy("source").agg(F.sum(F.col("size") * F.col("copies")).alias("size"), F.count(F.lit(1)).alias("n_units"))
    aims = stored(with_targets(sources, weights, share, repeats).withColumnRenamed("size", "source_size"), "targets")
    ratio = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    aims = aims.withColumns({"whole": F.floor(ratio).cast("long"), "chance": ratio - F.floor(ratio)})
    aims = aims.withColumnRenamed("source", "own")
    placed = units.join(aims, F.col("source").eqNullSafe(F.col("own"))).drop("own")
    order = {"order_a": F.xxhash64("id", "text_hash", F.lit(seed)), "order_b": F.col("text_hash")}
    # Of equal rows, some are taken once more for sure; at most one is open.
    share_of = F.col("chance") * F.col("copies")
    placed = placed.withColumns({"extra": F.floor(share_of).cast("long"), "chance": share_of - F.floor(share_of)})
    placed = placed.withColumnsRenamed({"copies": "n_copies"}).withColumns({"copies": F.lit(1).cast("long"), "words": F.col("size"), **order})
    kind = lambda name: placed.schema[name].dataType.simpleString()
    fields = ["rank", "order_a", "order_b", "copies", "words", "chance"]
    in_blocks = lambda n: F.ceil(n / F.lit(block)).cast("int").alias("blocks")
    # The units of a source are counted already, so the first round deals them without a join by source.
    open_units, decided, level = placed.select(*fields, in_blocks(F.col("n_units"))), None, 0
    while True:
        if level:
            counts = open_units.groupBy("rank").agg(in_blocks(F.count(F.lit(1))))
            open_units = open_units.join(counts, "rank")
        dealt = open_units.withColumn("block", F.pmod(F.xxhash64("order_a", "order_b", F.lit(level)), F.col("blocks")).cast("int"))
        schema = ", ".join(f"{n} {kind(n)}" for n in fields) + ", blocks int, block int"
        # The join may leave the rows dealt by source alone, which would put all blocks of a source into one task.
        spread = dealt.select(*fields, "blocks", "block").repartition("rank", "block")
        flown = stored(spread.groupBy("rank", "block").applyInPandas(_round(seed, level), schema), "flight")
        done = flown.where("chance in (0.0, 1.0)").select("rank", "order_a", "order_b", F.col("chance").cast("long").alias("more"))
        decided = done if decided is None else decided.unionByName(done)
        open_units, level = flown.where("chance not in (0.0, 1.0)").select(*fields), level + 1
        if open_units.isEmpty():
            break
    result = placed.join(decided, ["rank", "order_a", "order_b"])
    result = result.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("n_copies").cast("int"))))
    once_more = (F.col("copy") <= F.col("extra") + F.col("more")).cast("long")
    result = result.withColumn("times", (F.col("whole") + once_more).cast("int"))
    taken = (F.col("size") * F.col("times")).cast("long").alias("taken")
    return result.select(
        F.col("id").alias(id_col), "text_hash", F.col("source").alias(source_col), F.col("size").cast("long"),
        F.col("source_size").cast("long"), "target", taken, "times", "copy", F.col("n_copies").alias("copies"),
    )
