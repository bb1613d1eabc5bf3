"""The highest-scoring documents of each item, exactly, by a dual-tree search.

Documents are vectors of term scores and items are sets of terms; a document's score for an item is the sum over the
item's terms of term weight times term score. Both sides stand in a hierarchy. Documents that share their most telling
terms are neighbours, and neighbours form leaves, leaves form nodes; each of them holds, for each term, the highest score
of any document in it. Items are neighbours in the same way, and a node of items holds all their terms. The sum of weight
times highest score over the terms of a node of items is a bound for every pair of an item and a document below the two.
A pair of nodes whose bound is less than the weakest k-th score among its items is left out with all below it; else the
next level is asked. Bounds never fall short of a score and equal ones stay, so nothing is lost.

Documents are read once to make the index, which Spark keeps as a row for each leaf and one for each node. The search
reads the nodes' rows only, then the leaves that some item still needs. Items come in blocks of bounded size, each of
which is held by the workers and searched against the whole index of its terms.
"""

import math
from collections import Counter

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tapewright.llm.tables import stored

#: Bytes of item texts that a block of several items may hold; a single larger item is a block of its own.
BLOCK_BYTES = 16 << 20
#: Documents of a leaf, and term scores after which a leaf is closed earlier.
LEAF_DOCS, LEAF_TERMS = 32, 1 << 15
#: Leaves of a node of documents, and children of a node of items.
NODE_LEAVES, FANOUT = 16, 6
#: Nodes of documents that give each item its first k-th score, those of its highest bounds.
SEEDS = 3
#: Hits that a task holds before it keeps the best of them.
HELD_HITS = 1 << 16

# Fixed values of the ranking: the scale of weights and term scores, and the length correction in percent.
WEIGHT_SCALE, SCORE_SCALE, SLOPE, BASE = 1000, 1_000_000_000, 20, 100 - 50
# End of fixed values.

# A term is a run of ASCII letters, digits and anything beyond ASCII; as bytes, all else becomes a space.
_TERM = bytes(b for b in range(256) if b >= 0x80 or chr(b).isalnum())
_TABLE = bytes((b + 32 if 65 <= b <= 90 else b) if b in _TERM else 32 for b in range(256))


def terms(text):
    """The terms of a text in order, as bytes, A-Z in lower case; none for null."""
    return (text or "").encode("utf-8", "surrogatepass").translate(_TABLE).split(b" ") if text else []


def term_counts(text):
    """How often each term occurs."""
    counts = Counter(terms(text))
    counts.pop(b"", None)
    return counts


# --- items -------------------------------------------------------------------------------------


def item_blocks(items, id_col="item_id", text_col="text", block_bytes=BLOCK_BYTES):
    """Yields {item: set of terms} for blocks of items of bounded size. Rows of one id are one item with all their terms.

    Items are dealt by a hash of their id; while a block of several ids is too large, there are twice as many.
    """
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = items.select(F.col(id_col).alias("item"), text.alias("text")).where(F.length("text") > 0)
    sizes = rows.groupBy("item").agg(F.sum(F.octet_length("text") + 64).alias("size"))
    blocks = max(1, math.ceil((sizes.agg(F.sum("size")).first()[0] or 0) / block_bytes))
    block = lambda: F.pmod(F.xxhash64("item"), F.lit(blocks))
    while sizes.groupBy(block()).agg(F.count(F.lit(1)).alias("ids"), F.sum("size").alias("size")).where(f"ids > 1 AND size > {2 * block_bytes}").head(1):
        blocks *= 2
    for number in range(blocks):
        found = {}
        for row in rows.where(block() == number).collect():
            found.setdefault(row["item"], set()).update(term_counts(row["text"]))
        found = {item: own for item, own in found.items() if own}
        if found:
            yield found


class ItemTree:
    """A block of items as nodes of a hierarchy, level by level from the items up; each node holds all its terms."""

    def __init__(self, found, weights, fanout=FANOUT):
        # Items with the same rarest terms are neighbours.
        ranked = {i: sorted(own, key=lambda t: (-weights[t], t)) for i, own in found.items()}
        self.items = sorted(found, key=lambda i: (ranked[i], i is not None, i if i is not None else 0))
        self.words = sorted(weights)
        self.number = {t: k for k, t in enumerate(self.words)}
        self.weights = np.array([weights[t] for t in self.words], np.int64)
        own = [np.unique(np.array([self.number[t] for t in found[i]], np.int64)) for i in self.items]
        self.levels, self.parents = [self._level(own)], []
        while len(own) > 1:
            groups = [own[k : k + fanout] for k in range(0, len(own), fanout)]
            self.parents.append(np.arange(len(own)) // fanout)
            own = [np.unique(np.concatenate(g)) for g in groups]
            self.levels.append(self._level(own))

    @staticmethod
    def _level(own):
        ends = np.cumsum([0, *map(len, own)])
        return np.concatenate(own), ends

    def sums(self, level, nodes, dense):
        """Sum over the terms of each of ``nodes`` of ``dense``, which holds weight times score of each term."""
        columns, ends = self.levels[level]
        starts, counts = ends[nodes], ends[nodes + 1] - ends[nodes]
        where = np.repeat(starts - np.concatenate([[0], np.cumsum(counts)[:-1]]), counts) + np.arange(counts.sum())
        return np.add.reduceat(dense[columns[where]], np.concatenate([[0], np.cumsum(counts)[:-1]])) if len(nodes) else np.empty(0, np.int64)

    def weakest(self, least):
        """The weakest k-th score below each node, for each level."""
        out = [least]
        for parent in self.parents:
            out.append(np.minimum.reduceat(out[-1], np.flatnonzero(np.diff(parent, prepend=-1))))
        return out

    def alive(self, dense, weakest, among=None):
        """Items whose k-th score a document with at most the term scores of ``dense`` may reach, and their bounds.

        The descent begins at the root; a node whose bound is below its weakest k-th score ends it for all its items.
        ``among`` marks the items that are still asked for, if not all are.
        """
        marks = [among]
        if among is not None:
            for parent in self.parents:
                marks.append(np.logical_or.reduceat(marks[-1], np.flatnonzero(np.diff(parent, prepend=-1))))
        nodes = np.zeros(1, np.int64)
        for level in range(len(self.levels) - 1, -1, -1):
            if level < len(self.levels) - 1:
                first = np.searchsorted(self.parents[level], nodes)
                last = np.searchsorted(self.parents[level], nodes, side="right")
                nodes = np.repeat(first - np.concatenate([[0], np.cumsum(last - first)[:-1]]), last - first) + np.arange((last - first).sum())
            if among is not None:
                nodes = nodes[marks[level][nodes]]
            bounds = self.sums(level, nodes, dense)
            keep = (bounds >= weakest[level][nodes]) & (bounds > 0)
            nodes, bounds = nodes[keep], bounds[keep]
            if not len(nodes):
                break
        return (nodes, bounds) if len(nodes) else (np.empty(0, np.int64), np.empty(0, np.int64))


# --- documents ---------------------------------------------------------------------------------


def _counted(docs, id_col, text_col, number):
    """(id, n, ids, tfs): terms of each document, and how often it has those that ``number`` (a broadcast) names."""

    def run(batches):
        known = number.value
        for batch in batches:
            for k in range(0, batch.num_rows, 256):
                some = batch.slice(k, 256)
                lengths, ids, tfs = [], [], []
                for text in some.column("text").to_pylist():
                    counts = term_counts(text)
                    lengths.append(sum(counts.values()))
                    own = sorted((known[t], n) for t, n in counts.items() if t in known)
                    ids.append([i for i, _ in own])
                    tfs.append([n for _, n in own])
                arrays = [pa.array(lengths, pa.int64()), pa.array(ids, pa.list_(pa.int32())), pa.array(tfs, pa.list_(pa.int64()))]
                yield pa.RecordBatch.from_arrays([some.column("id"), *arrays], ["id", "n", "ids", "tfs"])

    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(run, f"id {docs.schema[id_col].dataType.simpleString()}, n long, ids array<int>, tfs array<long>")


def weight(n_docs, df):
    """The weight of a term that ``df`` of ``n_docs`` documents hold."""
    return math.floor(WEIGHT_SCALE * math.log((2 * n_docs + 2) / (2 * df + 1)))


def _scores(tfs, n, n_docs, total):
    """The term scores of a document of ``n`` terms."""
    m = BASE + (50 * n * n_docs) // total
    return (SCORE_SCALE * tfs) // (WEIGHT_SCALE * tfs + SLOPE * m)


def _scored(counted, weights, n_docs, total):
    """(first, second, id, ids, scores): a document's term scores and its two most telling terms, by which it is placed.

    Documents without a term of any item score 0 and are left out here; they count in the statistics.
    """

    def run(batches):
        for batch in batches:
            ids, tfs = batch.column("ids"), batch.column("tfs")
            first, second, scores = [], [], []
            for k, n in enumerate(batch.column("n").to_pylist()):
                own = _scores(np.asarray(tfs[k].values), n, n_docs, total)
                names = np.asarray(ids[k].values)
                order = np.argsort(-own * weights[names], kind="stable")[:2]
                first.append(int(names[order[0]]))
                second.append(int(names[order[-1]]))
                scores.append(own)
            flat = pa.array(np.concatenate(scores) if scores else np.empty(0, np.int64), pa.int64())
            lists = pa.ListArray.from_arrays(pa.array(np.cumsum([0, *map(len, scores)]), pa.int32()), flat)
            arrays = [pa.array(first, pa.int32()), pa.array(second, pa.int32()), batch.column("id"), ids, lists]
            yield pa.RecordBatch.from_arrays(arrays, ["first", "second", "id", "ids", "scores"])

    kind = counted.schema["id"].dataType.simpleString()
    known = counted.where(F.size("ids") > 0)
    return known.mapInArrow(run, f"first int, second int, id {kind}, ids array<int>, scores array<long>")


def _highest(ids, scores):
    """The terms in ``ids`` once each, with the highest of their scores."""
    order = np.argsort(ids, kind="stable")
    ids, scores = ids[order], scores[order]
    starts = np.flatnonzero(np.diff(ids, prepend=-1))
    return ids[starts], np.maximum.reduceat(scores, starts)


def _flat(column):
    """Values and ends of a list column."""
    ends = np.cumsum([0, *column.value_lengths().to_pylist()])
    return np.asarray(column.flatten()), ends


def index(scored, leaf_docs=LEAF_DOCS, leaf_terms=LEAF_TERMS, node_leaves=NODE_LEAVES):
    """(node, leaf, top_ids, top_scores, node_ids, node_scores, docs, ends, ids, scores): the leaves of the hierarchy.

    ``docs`` are the documents of a leaf, whose terms and scores stand one after another in ``ids`` and ``scores`` up to
    their ``ends``. ``top_`` holds the highest scores in the leaf; ``node_`` those in its node, with the node's first leaf.
    """
    kind = scored.schema["id"].dataType.simpleString()

    def leaves(batches):
        for batch in batches:
            ids, ends = _flat(batch.column("ids"))
            scores = np.asarray(batch.column("scores").flatten())
            names, start = batch.column("id"), 0
            while start < batch.num_rows:
                stop = min(start + leaf_docs, batch.num_rows, max(start + 1, int(np.searchsorted(ends, ends[start] + leaf_terms, side="right")) - 1))
                yield names.slice(start, stop - start), ends[start : stop + 1] - ends[start], ids[ends[start] : ends[stop]], scores[ends[start] : ends[stop]]
                start = stop

    def run(batches):
        # The part of the table names the nodes; a repeated task makes the same ones.
        node, held = TaskContext.get().partitionId() << 40, []

        def rows():
            tops = [_highest(ids, scores) for _, _, ids, scores in held]
            whole = _highest(np.concatenate([t[0] for t in tops]), np.concatenate([t[1] for t in tops]))
            for k, ((names, ends, ids, scores), top) in enumerate(zip(held, tops)):
                of_node = [_cell(v, t) if k == 0 else pa.array([None], pa.list_(t)) for v, t in zip(whole, (pa.int32(), pa.int64()))]
                own = [_cell(v, t) for v, t in ((top[0], pa.int32()), (top[1], pa.int64()))]
                rest = [_cell(v, t) for v, t in ((ends, pa.int32()), (ids, pa.int32()), (scores, pa.int64()))]
                arrays = [pa.array([node]), pa.array([node + k]), *own, *of_node, _cell(names), *rest]
                yield pa.RecordBatch.from_arrays(arrays, _COLUMNS)

        for leaf in leaves(batches):
            held.append(leaf)
            if len(held) == node_leaves:
                yield from rows()
                node, held = node + node_leaves, []
        if held:
            yield from rows()

    schema = ("node long, leaf long, top_ids array<int>, top_scores array<long>, node_ids array<int>, node_scores array<long>, "
              f"docs array<{kind}>, ends array<int>, ids array<int>, scores array<long>")  # fmt: skip
    partitions = int(scored.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    order = ["first", "second", "id"]
    placed = scored.repartitionByRange(partitions, *order).sortWithinPartitions(*order)
    return placed.select("id", "ids", "scores").mapInArrow(run, schema)


_COLUMNS = ["node", "leaf", "top_ids", "top_scores", "node_ids", "node_scores", "docs", "ends", "ids", "scores"]


def _cell(values, kind=None):
    """Values as the list of one row."""
    values = values if kind is None else pa.array(values, kind)
    return pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), values)


# --- search ------------------------------------------------------------------------------------


class _Dense:
    """Weight times score of each term, in one buffer for all vectors that a task looks at."""

    def __init__(self, tree):
        self.tree, self.values = tree, np.zeros(len(tree.words), np.int64)

    def alive(self, ids, scores, weakest, among=None):
        self.values[ids] = scores * self.tree.weights[ids]
        found = self.tree.alive(self.values, weakest, among)
        self.values[ids] = 0
        return found

    def totals(self, items, ids, scores):
        self.values[ids] = scores * self.tree.weights[ids]
        found = self.tree.sums(0, items, self.values)
        self.values[ids] = 0
        return found


def _node_pairs(leaves, tree, least):
    """(node, items, bounds) of the nodes of documents that some items can't do without; reads the nodes' rows only."""

    def run(batches):
        dense, weakest = _Dense(tree), tree.weakest(least)
        for batch in batches:
            nodes, lists, bounds = [], [], []
            for node, ids, scores in zip(*(batch.column(c) for c in ("node", "node_ids", "node_scores"))):
                found, own = dense.alive(np.asarray(ids.values), np.asarray(scores.values), weakest)
                if len(found):
                    nodes.append(node.as_py())
                    lists.append(found)
                    bounds.append(own)
            if nodes:
                arrays = [pa.array(nodes), pa.array(lists, pa.list_(pa.int32())), pa.array(bounds, pa.list_(pa.int64()))]
                yield pa.RecordBatch.from_arrays(arrays, ["node", "items", "bounds"])

    nodes = leaves.where(F.col("node_ids").isNotNull()).select("node", "node_ids", "node_scores")
    return nodes.mapInArrow(run, "node long, items array<int>, bounds array<long>")


def _leaf_hits(pairs, tree, least, k):
    """(item, id, score): the k best documents of each item in a task's leaves that reach its k-th score.

    ``pairs`` are leaves with the items their node still has. A leaf that no item needs is not looked into, and k-th
    scores rise with the hits of the task itself.
    """

    def run(batches):
        dense, weakest, own = _Dense(tree), tree.weakest(least), least.copy()
        held, size = [], 0

        def best():
            """The k best hits held, and the k-th scores they give."""
            items, sums = (np.concatenate([h[c] for h in held]) for c in (0, 2))
            ids = pa.concat_arrays([h[1] for h in held])
            rank = pc.rank(ids, sort_keys="ascending", null_placement="at_start", tiebreaker="first").to_numpy()
            order = np.lexsort((rank, -sums, items))
            place = np.arange(len(items)) - np.searchsorted(items[order], items[order])
            order, last = order[place < k], order[place == k - 1]
            own[items[last]] = np.maximum(own[items[last]], sums[last])
            return items[order], ids.take(pa.array(order)), sums[order]

        for batch in batches:
            for row in range(batch.num_rows):
                cell = lambda c: np.asarray(batch.column(c)[row].values)  # noqa: B023, E731
                among = np.zeros(len(tree.items), bool)
                among[cell("items")] = True
                found, _ = dense.alive(cell("top_ids"), cell("top_scores"), weakest, among)
                if not len(found):
                    continue
                ids, scores, ends = cell("ids"), cell("scores"), cell("ends")
                items, at, sums = [], [], []
                for d, (start, stop) in enumerate(zip(ends[:-1], ends[1:])):
                    totals = dense.totals(found, ids[start:stop], scores[start:stop])
                    good = np.flatnonzero((totals >= own[found]) & (totals > 0))
                    items.append(found[good])
                    at.append(np.full(len(good), d))
                    sums.append(totals[good])
                at = np.concatenate(at)
                if len(at):
                    held.append((np.concatenate(items), batch.column("docs")[row].values.take(pa.array(at)), np.concatenate(sums)))
                    size += len(at)
                if size > HELD_HITS:
                    held = [best()]
                    # What is left are k rows an item at most, which may be more than the limit.
                    size, weakest = 0, tree.weakest(own)
        if held:
            items, ids, sums = best()
            yield pa.RecordBatch.from_arrays([pa.array(items, pa.int32()), ids, pa.array(sums, pa.int64())], ["item", "id", "score"])

    kind = pairs.schema["docs"].dataType.elementType.simpleString()
    return pairs.mapInArrow(run, f"item int, id {kind}, score long")


def _best(hits, k):
    """The k best hits of each item, ranked; the first ones are chosen in tasks before they meet."""
    order = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_first("id"))
    return hits.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def _search_block(spark, docs, found, k, id_col, text_col, totals):
    """(item, rank, id, score) of a block of items; ``item`` is a number in the returned tree."""
    vocabulary = {t: n for n, t in enumerate(sorted(set().union(*found.values())))}
    number = spark.sparkContext.broadcast(vocabulary)
    counted = stored(_counted(docs, id_col, text_col, number), "term-counts")
    if totals is None:
        with_terms = counted.where("n > 0").agg(F.count(F.lit(1)), F.coalesce(F.sum("n"), F.lit(0))).first()
        totals = int(with_terms[0]), int(with_terms[1])
    n_docs, total = totals
    df = dict(counted.select(F.explode("ids").alias("t")).groupBy("t").count().collect())  # of the block's terms
    tree = ItemTree(found, {t: weight(n_docs, df.get(n, 0)) for t, n in vocabulary.items()})
    if not df:
        return None, tree, totals
    leaves = stored(index(_scored(counted, tree.weights, n_docs, total)), "search-index")

    # The nodes of an item's highest bounds give a first k-th score: that of some documents, so never too high.
    least = np.zeros(len(tree.items), np.int64)
    bounds = _node_pairs(leaves, tree, least).select("node", F.explode(F.arrays_zip("items", "bounds")).alias("b"))
    best = bounds.select("node", F.col("b.items").alias("item"), F.col("b.bounds").alias("bound"))
    order = Window.partitionBy("item").orderBy(F.desc("bound"), "node")
    seeds = best.withColumn("place", F.row_number().over(order)).where(F.col("place") <= SEEDS)
    seeds = stored(seeds.groupBy("node").agg(F.collect_list("item").alias("items")), "search-seeds")
    first = _best(_leaf_hits(leaves.join(seeds, "node"), tree, least, k), k)
    for row in first.where(F.col("rank") == k).select("item", "score").collect():  # one for each item of the block
        least[row["item"]] = row["score"]

    pairs = stored(_node_pairs(leaves, tree, least).drop("bounds"), "search-pairs")
    return _best(_leaf_hits(leaves.join(pairs, "node"), tree, least, k), k), tree, totals


def search(docs, items, k=50, id_col="doc_id", text_col="text", item_col="item_id", item_text_col="text", block_bytes=BLOCK_BYTES):
    """(item_id, rank, doc_id, score): each item's ``k`` highest-scoring documents with a score above 0, all if fewer.

    Equal scores go by ascending id, a null id first; rows of one id are documents of their own. A document or an item
    with a null text, an empty one or one without a term has no term: it scores nothing and finds nothing, and such a
    document counts in no statistic. Rows of one item id are one item with the terms of all. Texts are read whole. Other
    columns play no part; an empty table on either side gives no row.
    """
    spark = docs.sparkSession
    kinds = docs.schema[id_col].dataType, items.schema[item_col].dataType
    names = T.StructType([T.StructField("item", T.IntegerType()), T.StructField("item_id", kinds[1])])
    empty = T.StructType([names["item_id"], T.StructField("rank", T.IntegerType()), T.StructField("doc_id", kinds[0]), T.StructField("score", T.LongType())])
    out, totals = spark.createDataFrame([], empty), None
    for found in item_blocks(items, item_col, item_text_col, block_bytes):
        best, tree, totals = _search_block(spark, docs, found, k, id_col, text_col, totals)
        if best is not None:
            named = spark.createDataFrame(list(enumerate(tree.items)), names)
            out = out.unionByName(best.join(named, "item").select("item_id", "rank", F.col("id").alias("doc_id"), "score"))
    return out


# --- the same in SQL ---------------------------------------------------------------------------

SQL = r"""
WITH words AS (
  SELECT doc_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM documents
), tf AS (
  SELECT doc_id, term, count(*) AS tf FROM words GROUP BY doc_id, term
), sizes AS (
  SELECT doc_id, sum(tf)::BIGINT AS n FROM tf GROUP BY doc_id
), totals AS (
  SELECT count(*) AS n_docs, sum(n)::BIGINT AS total FROM sizes
), wanted AS (
  SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark
), weights AS (
  SELECT term, floor(1000 * ln((2 * n_docs + 2) / (2 * df + 1)::DOUBLE))::BIGINT AS w
  FROM (SELECT term, count(*) AS df FROM tf GROUP BY term), totals
), scores AS (
  SELECT item_id, doc_id, sum(w * ((1000000000 * tf) // (1000 * tf + 20 * (50 + (50 * n * n_docs) // total))))::BIGINT AS score
  FROM wanted JOIN weights USING (term) JOIN tf USING (term) JOIN sizes USING (doc_id), totals GROUP BY item_id, doc_id
), ranked AS (
  SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INTEGER AS rank, doc_id, score FROM scores WHERE score > 0
)
SELECT * FROM ranked WHERE rank <= 50
"""
