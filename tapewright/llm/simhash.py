"""SimHash near-duplicates by the generalised pigeonhole principle.

Fingerprints that differ in at most ``tau`` of 64 bits are linked, and a class is a connected component of links. Bits
are grouped into ``m`` parts. If thresholds of the parts sum to ``tau - m + 1``, then two linked fingerprints agree in
at least one part up to that part's threshold. So both meet in a bucket if each is filed under its value in every part,
and under every lower value that differs in up to the threshold. Which bits form a part follows from their correlation
over all distinct fingerprints; thresholds come from a dynamic programme over estimated costs.
"""

import math
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import functions as F

from tapewright.llm.components import components
from tapewright.llm.tables import stored
from tapewright.llm.text import SEED, split_words

BITS = 64
CELL = 4096  # fingerprints of one large bucket that are compared at once
SMALL = 96  # buckets up to this size are compared by shifting whole batches
ROW_COST = 300  # one shuffled bucket row costs about as much as so many comparisons


# --- fingerprints ------------------------------------------------------------------------------


def fingerprint(text, shingle=4):
    """The fingerprint of one text as an unsigned integer; 0 for a text without words."""
    words = split_words(text)
    if not words:
        return 0
    count = max(1, len(words) - shingle + 1)
    ones = np.zeros(BITS, np.int64)
    for start in range(0, count, 8192):  # bounded memory for very long texts
        some = range(start, min(start + 8192, count))
        hashes = [xxhash.xxh64_intdigest(b" ".join(words[i : i + shingle]), SEED) for i in some]
        ones += bits_of(np.array(hashes, np.uint64)).sum(axis=0, dtype=np.int64)
    return sum(1 << b for b in range(BITS) if 2 * ones[b] > count)


def bits_of(values):
    """One row of 64 zeros and ones for each value, the lowest bit first."""
    return np.unpackbits(values.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")


def fingerprints(docs, id_col="doc_id", text_col="text", shingle=4):
    """(id, fp) for each row of ``docs``; fp holds the fingerprint's 64 bits as a signed long."""

    def run(batches):
        for batch in batches:
            prints = [fingerprint(text, shingle) for text in batch.column("text").to_pylist()]
            signed = pa.array(np.array(prints, np.uint64).view(np.int64), pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column("id"), signed], ["id", "fp"])

    inputs = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    return inputs.mapInArrow(run, f"id {docs.schema[id_col].dataType.simpleString()}, fp long")


# --- parts and thresholds ----------------------------------------------------------------------


def bit_counts(distinct):
    """64 x 64 counts of fingerprints with both bits set, summed over the whole table in tasks and then by cell."""

    def run(batches):
        total = np.zeros((BITS, BITS), np.int64)
        for batch in batches:
            bits = bits_of(np.asarray(batch.column("fp")).view(np.uint64)).astype(np.float32)
            total += (bits.T @ bits).astype(np.int64)
        yield pa.RecordBatch.from_pydict({"cell": np.arange(BITS * BITS, dtype=np.int32), "n": total.ravel()})

    cells = distinct.select("fp").mapInArrow(run, "cell int, n long").groupBy("cell").agg(F.sum("n").alias("n"))
    counts = np.zeros(BITS * BITS, np.int64)
    for row in cells.collect():  # 4096 rows at any size of the input
        counts[row.cell] = row.n
    return counts.reshape(BITS, BITS)


def group_bits(counts, total, parts):
    """Bits dealt into ``parts`` groups of nearly equal size, each of bits that correlate most."""
    share = np.diag(counts) / max(total, 1)
    spread = np.sqrt(np.maximum(share * (1 - share), 1e-12))
    link = np.abs(counts / max(total, 1) - np.outer(share, share)) / np.outer(spread, spread)
    np.fill_diagonal(link, 0)
    left, groups = list(range(BITS)), []
    for k in range(parts):
        size = BITS // parts + (k < BITS % parts)
        group = [max(left, key=lambda b: (round(link[b, left].sum(), 9), -b))]
        while len(group) < size:
            rest = [b for b in left if b not in group]
            group.append(max(rest, key=lambda b: (round(link[b, group].sum(), 9), -b)))
        left = [b for b in left if b not in group]
        groups.append(sorted(group))
    return groups


def _distance_shares(share, group, most):
    """Probability that two fingerprints differ in at most t bits of the group, for t up to ``most``."""
    chance = np.zeros(most + 2)
    chance[0] = 1
    for b in group:
        differ = 2 * share[b] * (1 - share[b])
        moved = np.roll(chance, 1) * differ
        moved[0] = 0
        moved[-1] += chance[-1] * differ
        chance = chance * (1 - differ) + moved
    return np.cumsum(chance)[: most + 1]


def part_costs(share, total, group, most, collisions=None):
    """Estimated cost of a part for thresholds -1 to ``most``: bucket rows and candidate pairs.

    ``collisions`` is the counted number of pairs that agree in the whole part; it scales the estimate.
    """
    pairs = total * total / 2 * _distance_shares(share, group, most)
    if collisions is not None:
        pairs *= max(collisions, 1) / max(pairs[0], 1e-9)
    costs = [0.0]
    for t in range(most + 1):
        rows = total * (1 + sum(math.comb(len(group), d) for d in range(1, t + 1)) / 2)
        costs.append(ROW_COST * rows + min(pairs[t], total * total / 2))
    return costs


def allocate(costs, tau):
    """Thresholds of the parts, each -1 (part unused) or more, with the least total cost and the sum tau - m + 1."""
    parts = len(costs)
    best = {0: (0.0, [])}  # sum of (threshold + 1) so far -> cheapest choice
    for part in costs:
        step = {}
        for used, (cost, chosen) in best.items():
            for t in range(-1, len(part) - 1):
                at, now = used + t + 1, (cost + part[t + 1], chosen + [t])
                if at not in step or now < step[at]:
                    step[at] = now
        best = step
    return best[tau + 1] if parts and tau + 1 in best else None


def plan_parts(distinct, tau):
    """[(bits, threshold)] of the parts to probe, planned from all distinct fingerprints."""
    total = distinct.count()
    counts = bit_counts(distinct)
    share = np.diag(counts) / max(total, 1)
    plans = []
    for parts in range(2, tau + 2):
        groups = group_bits(counts, total, parts)
        found = allocate([part_costs(share, total, g, tau) for g in groups], tau)
        if found:
            plans.append((found[0], groups))
    groups = min(plans, key=lambda p: p[0])[1] if plans else [list(range(BITS))]
    collisions = _collisions(distinct, groups)
    costs = [part_costs(share, total, g, tau, collisions.get(k, 0)) for k, g in enumerate(groups)]
    return [(g, t) for g, t in zip(groups, allocate(costs, tau)[1]) if t >= 0]


def _collisions(distinct, groups):
    """Counted pairs of fingerprints with equal values, by part."""
    keys = distinct.select("fp").mapInArrow(_filer([(g, 0) for g in groups]), "key long, fp long")
    equal = keys.groupBy("key").agg(F.count(F.lit(1)).cast("double").alias("n")).where("n > 1")
    part = F.pmod("key", F.lit(8)).alias("part")
    return {r.part: r.pairs for r in equal.groupBy(part).agg(F.sum(F.expr("n * (n - 1) / 2")).alias("pairs")).collect()}


# --- probing and verification ------------------------------------------------------------------


def _filer(parts):
    """A function for mapInArrow: each fingerprint under its buckets. Key: the part's value times 8 plus its number."""

    def run(batches):
        for batch in batches:
            prints = np.asarray(batch.column("fp"))
            bits = bits_of(prints.view(np.uint64))
            for number, (group, threshold) in enumerate(parts):
                own = bits[:, group].astype(np.int64)
                powers = 1 << np.arange(len(group), dtype=np.int64)
                values = own @ powers
                yield _rows(values, prints, number)
                for distance in range(1, threshold + 1):
                    for flips in combinations(range(len(group)), distance):
                        # Of two values that differ in these bits, the one with the highest of them set is filed twice.
                        high = own[:, flips[-1]] == 1
                        yield _rows(values[high] ^ powers[list(flips)].sum(), prints[high], number)

    return run


def _rows(values, prints, number):
    return pa.RecordBatch.from_pydict({"key": values * 8 + number, "fp": prints})


def _runs(batches, names):
    """Batches cut so that no run of equal names is divided; a run holds two cells at most."""
    kept = None
    for batch in batches:
        if not batch.num_rows:
            continue
        table = {n: np.asarray(batch.column(n)) for n in [*names, "fp"]}
        if kept is not None:
            table = {n: np.concatenate([kept[n], table[n]]) for n in table}
        change = np.zeros(len(table["fp"]), bool)
        for n in names:
            change[1:] |= table[n][1:] != table[n][:-1]
        change[0] = True
        starts = np.flatnonzero(change)
        last = starts[-1]
        kept = {n: v[last:] for n, v in table.items()}
        if len(starts) > 1:
            yield table["fp"][:last], starts[:-1]
    if kept is not None:
        yield kept["fp"], np.array([0])


def linked(prints, tau):
    """(member, root) pairs that join the distinct ``prints`` into their components, one row for each member but the
    roots.
    """
    left, out_u, out_v = np.sort(prints), [], []
    while len(left) > 1:
        front, left = [left[0]], left[1:]
        root = front[0]
        while front and len(left):
            near = np.bitwise_count(left ^ front.pop()) <= tau
            found = left[near]
            if len(found):
                left = left[~near]
                front.extend(found)
                out_u.append(found)
                out_v.append(np.full(len(found), root))
    empty = np.zeros(0, np.uint64)
    return np.concatenate(out_u or [empty]), np.concatenate(out_v or [empty])


def _linker(tau):
    """A function for mapInArrow over rows sorted by bucket: links found in each bucket, as edges."""

    def run(batches):
        for prints, starts in _runs(batches, ["key", "cell"]):
            prints = prints.view(np.uint64)
            sizes = np.diff(np.append(starts, len(prints)))
            bucket = np.repeat(np.arange(len(starts)), sizes)
            small = sizes[bucket] <= SMALL
            some, of = prints[small], bucket[small]
            for shift in range(1, int(sizes[sizes <= SMALL].max(initial=1))):
                near = (of[shift:] == of[:-shift]) & (np.bitwise_count(some[shift:] ^ some[:-shift]) <= tau)
                near &= some[shift:] != some[:-shift]
                if near.any():
                    yield _edges(some[shift:][near], some[:-shift][near])
            for k in np.flatnonzero(sizes > SMALL):
                found = linked(np.unique(prints[starts[k] : starts[k] + sizes[k]]), tau)
                if len(found[0]):
                    yield _edges(*found)

    return run


def _edges(u, v):
    return pa.RecordBatch.from_pydict({"u": u.view(np.int64), "v": v.view(np.int64)})


def links(distinct, parts, tau):
    """Edges that connect all fingerprints of a bucket that are linked.

    A bucket above ``CELL`` rows is dealt into chunks by hash, and each pair of chunks is a cell of its own, so every
    pair of its rows still meets, in bounded memory and in many tasks.
    """
    filed = distinct.select("fp").mapInArrow(_filer(parts), "key long, fp long")
    large = stored(filed.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > CELL), "large-buckets")
    chunks = F.ceil(F.coalesce("n", F.lit(1)) / CELL).cast("int")
    own = F.pmod(F.xxhash64("fp"), F.col("chunks")).cast("int")
    other = F.explode(F.sequence(F.lit(0), F.col("chunks") - 1))
    cells = (
        filed.join(large, "key", "left").withColumn("chunks", chunks).withColumn("own", own).withColumn("other", other)
        .select("key", (F.least("own", "other") * F.col("chunks") + F.greatest("own", "other")).cast("long").alias("cell"), "fp")
    )
    dealt = cells.repartition("key", "cell").sortWithinPartitions("key", "cell")
    return dealt.mapInArrow(_linker(tau), "u long, v long")


def near_duplicates(docs, id_col="doc_id", text_col="text", shingle=4, tau=4):
    """(id, fp, component) for each row of ``docs``.

    ``fp`` holds the 64 bits as a signed long. ``component`` is the smallest id among all rows reachable over links of
    at most ``tau`` differing bits. Null and empty texts have fingerprint 0 and are linked like any other. Equal
    texts share a fingerprint, and the search runs on distinct fingerprints, so copies cost nothing beyond one
    aggregation. Rows without an id belong to their class, but the class takes its name from the others; it is null
    if there are none. Repeated rows each get a row. Other columns are ignored.
    """
    prints = stored(fingerprints(docs, id_col, text_col, shingle), "fingerprints")
    distinct = stored(prints.groupBy("fp").agg(F.min("id").alias("first_id")), "distinct-fingerprints")
    roots = components(links(distinct, plan_parts(distinct, tau), tau))
    members = distinct.join(roots, distinct.fp == roots.node, "left").select("fp", "first_id", F.coalesce("root", "fp").alias("root"))
    members = stored(members, "members")
    # Written first, so both sides of the join are shuffled for it and Spark can split a large class.
    names = stored(members.groupBy("root").agg(F.min("first_id").alias("component")), "class-names")
    named = stored(members.join(names, "root").select("fp", "component"), "classes")
    return prints.join(named, "fp").select(F.col("id").alias(id_col), "fp", "component")
