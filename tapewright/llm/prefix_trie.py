"""Prefix trie of conversations by truncation peeling.

Conversations that begin with the same turns share the nodes of those turns. The trie is built from its deepest level
up: conversations that end at a depth are merged with the nodes that survive from below, which gives all nodes of that
depth with their totals; then the last turn is stripped from each node, and those that now are equal become one node of
the level above. So no conversation is read twice. A node is named by its turns, each as 128 bits of role and text.

A level is one aggregation over nodes in Spark, whose totals combine before they are shuffled, so a group of copies costs
a row for each task. Few conversations go deep, and a round for each of their turns would cost more than its rows. So
below ``NEAR`` turns, conversations that share these turns are peeled together by one task, level by level in the same
way, if they have at most ``TASK_TURNS`` turns in all; where there are more, and above, Spark's rounds do it.
"""

import hashlib

import pyarrow as pa
from pyspark.sql import Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tapewright.llm.tables import stored
from tapewright.llm.text import count_words
from tapewright.session import scratch_dir

#: Ids that are joined to one piece of text before pieces meet at their node.
PIECE = 1024
#: Depth below which conversations with the same turns so far may be peeled by one task, and the turns these may have.
NEAR, TASK_TURNS = 4, 1 << 17

_TOTALS = ["conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens"]
_NODE = "p1 long, p2 long, q1 long, q2 long, depth long, " + ", ".join(f"{c} long" for c in _TOTALS)


def turns_of(rows, conv_col="conv_id", turn_col="turn", role_col="role", text_col="text"):
    """(conv_id, turns): the turns of each conversation in order, each as (h1, h2, words).

    Null turns come first; equal ones are ordered by role and text. Null role or text is the empty text. Rows without a
    conversation id belong to no conversation.
    """
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in (role_col, text_col))
    named = rows.where(F.col(conv_col).isNotNull()).select(
        F.col(conv_col).alias("conv_id"), F.struct(F.col(turn_col).alias("turn"), role.alias("role"), text.alias("text")).alias("t")
    )
    # The leading literal is another seed, so the halves are independent.
    names = F.xxhash64("t.role", "t.text").alias("h1"), F.xxhash64(F.lit(1), "t.role", "t.text").alias("h2")
    order = Window.partitionBy("conv_id").orderBy("t.turn", "t.role", "t.text")
    placed = named.select("conv_id", *names, count_words("t.text").alias("words"), F.row_number().over(order).alias("place"))
    listed = placed.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("place", "h1", "h2", "words"))).alias("turns"))
    return listed.select("conv_id", F.transform("turns", lambda t: F.struct(t["h1"].alias("h1"), t["h2"].alias("h2"), t["words"].alias("words"))).alias("turns"))


def graft(conversations, every=20, most=4):
    """Each conversation c rebuilt: the first h turns of conversation c - c % ``every``, then its own after its first h.

    h is crc32 of c in decimal, modulo ``most``. At most ``every`` conversations share a base, and only its first turns
    are sent to them.
    """
    c = F.col("conv_id")
    base = conversations.where(c % every == 0).select(c.alias("base"), F.slice("turns", 1, most - 1).alias("first"))
    own = conversations.select("conv_id", "turns", (c - c % every).alias("base"), F.pmod(F.crc32(c.cast("string").cast("binary")), F.lit(most)).cast("int").alias("h"))
    first = F.coalesce(F.slice("first", F.lit(1), F.col("h")), F.array().cast(conversations.schema["turns"].dataType))
    rest = F.slice("turns", F.col("h") + 1, F.size("turns"))
    return own.join(base, "base", "left").select("conv_id", F.concat(first, rest).alias("turns"))


def _named(path):
    """128 bits for a path of turns."""
    return F.xxhash64(path).alias("p1"), F.xxhash64(F.lit(1), path).alias("p2")  # the literal is another seed


def _parent(path):
    return F.slice(path, F.lit(1), F.greatest(F.size(path) - 1, F.lit(0)))


def _peel(rows, near):
    """Nodes of some conversations that share their first ``near`` turns, deepest first, and what is left of them there.

    ``rows`` are (names, words, n_convs, conv_id), with a name and the words for each turn behind the first ``near`` - 1.
    Yields (name, parent's name, depth, totals); the parent of the last one is None, and its totals are sums so far.
    """
    ended = {}
    for names, words, n, conv in rows:
        ended.setdefault(len(names), []).append((names, words, n, conv))
    nodes = {}
    for depth in range(max(ended), 0, -1):
        for names, words, n, conv in ended.get(depth, ()):
            nodes[names[-1]] = _joined(nodes.get(names[-1]), [names, words, conv, n, 0, 0, 0])
        above = {}
        for name, (names, words, conv, n, children, leaves, saved) in nodes.items():
            if depth == 1:
                yield name, None, near, (conv, n, children, leaves, saved)
                continue
            leaves, saved = leaves if children else 1, saved + (n - 1) * words[depth - 1]
            up = names[depth - 2]
            yield name, up, near - 1 + depth, (conv, n, children, leaves, saved)
            above[up] = _joined(above.get(up), [names, words, conv, n, 1, leaves, saved])
        nodes = above


def _joined(node, more):
    """Two parts of one node as one."""
    if node is None:
        return more
    return [*node[:2], min(node[2], more[2]), *(a + b for a, b in zip(node[3:], more[3:]))]


def _peeled(ended, near):
    """Runs :func:`_peel` for the groups of ``ended`` that have rows below ``near`` and few turns, each in one task.

    Nodes below ``near`` come with their names; what is left at ``near`` comes with its ``path``.
    """
    path = "array<struct<h1:bigint,h2:bigint,words:bigint>>"

    def columns(found, turns):
        names = [pa.array([f[c][h] if f[c] else None for f in found], pa.int64()) for c in (0, 1) for h in (0, 1)]
        totals = [pa.array([f[3][k] for f in found], pa.int64()) for k in range(len(_TOTALS))]
        first = pa.array([t if f[1] is None else None for f, t in zip(found, turns)], pa.list_(pa.struct([(c, pa.int64()) for c in ("h1", "h2", "words")])))
        arrays = [*names, pa.array([f[2] for f in found], pa.int64()), *totals, first]
        return pa.RecordBatch.from_arrays(arrays, ["p1", "p2", "q1", "q2", "depth", *_TOTALS, "path"])

    def run(batches):
        key, group, first, done, turns = None, [], None, [], []
        for batch in batches:
            parts = [batch.column(c).to_pylist() for c in ("k1", "k2", "names1", "names2", "words", "n_convs", "conv_id", "first")]
            for k1, k2, names1, names2, words, n, conv, own in zip(*parts):
                if (k1, k2) != key:
                    if group:
                        found = list(_peel(group, near))
                        done, turns = done + found, turns + [first] * len(found)
                    if len(done) > 4096:
                        yield columns(done, turns)
                        done, turns = [], []
                    key, group, first = (k1, k2), [], own
                group.append((list(zip(names1, names2)), words, n, conv))
        if group:
            found = list(_peel(group, near))
            done, turns = done + found, turns + [first] * len(found)
        if done:
            yield columns(done, turns)

    # Names and words from the last shared turn on.
    depths = F.sequence(F.lit(near), F.size("path"))
    names = [F.transform(depths, lambda d: _named(F.slice("path", F.lit(1), d))[half]) for half in (0, 1)]  # noqa: B023
    words = F.transform(F.slice("path", F.lit(near), F.size("path")), lambda t: t["words"])
    grouped = ended.select(
        "k1", "k2", names[0].alias("names1"), names[1].alias("names2"), words.alias("words"), "n_convs", "conv_id",
        F.slice("path", 1, near).alias("first"),
    )
    return grouped.repartition("k1", "k2").sortWithinPartitions("k1", "k2").mapInArrow(run, f"{_NODE}, path {path}")


def _nodes(conversations, near=NEAR, task_turns=TASK_TURNS):
    """All nodes with their names and those of their parents, as a stored table; None without a conversation."""
    spark = conversations.sparkSession
    ended = conversations.groupBy(F.col("turns").alias("path")).agg(F.count(F.lit(1)).alias("n_convs"), F.min("conv_id").alias("conv_id"))
    shared = F.slice("path", 1, near)
    ended = stored(
        ended.select("*", F.size("path").alias("depth"), F.xxhash64(shared).alias("k1"), F.xxhash64(F.lit(1), shared).alias("k2")), "ended"
    )
    # Rows that end just at the shared turns belong to their group, so it stays one node.
    sizes = ended.where(F.col("depth") >= near).groupBy("k1", "k2").agg(F.sum(F.col("depth").cast("long")).alias("turns"), F.max("depth").alias("deepest"))
    small = sizes.where((F.col("deepest") > near) & (F.col("turns") <= task_turns)).select("k1", "k2")
    marked = ended.where(F.col("depth") >= near).join(small.withColumn("small", F.lit(True)), ["k1", "k2"], "left")
    marked = stored(marked.withColumn("small", F.coalesce("small", F.lit(False))), "ended-deep")
    peeled = stored(_peeled(marked.where("small"), near), "trie-peeled")

    zeros = [F.lit(0).cast("long").alias(c) for c in ("n_children", "n_leaves", "saved_tokens")]
    part = ["path", "depth", *_TOTALS]
    whole = ended.where(F.col("depth") < near).select("path", "depth", "conv_id", "n_convs", *zeros)
    whole = whole.unionByName(marked.where(~F.col("small")).select("path", "depth", "conv_id", "n_convs", *zeros))
    whole = whole.unionByName(peeled.where(F.col("path").isNotNull()).select("path", F.lit(near).alias("depth"), *_TOTALS))
    parts = scratch_dir(spark, "trie-parts")
    whole.select(part).write.partitionBy("depth").parquet(parts)
    whole = spark.read.schema(whole.select(part).schema).parquet(parts)
    deepest = whole.agg(F.max("depth")).first()[0]
    if deepest is None:
        return None

    root, below = scratch_dir(spark, "trie-levels"), None
    for depth in range(deepest, -1, -1):
        found = whole.where(F.col("depth") == depth).drop("depth")
        if below is not None:
            found = found.unionByName(below)
        merged = found.groupBy("path").agg(
            *[F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "saved_tokens")], F.min("conv_id").alias("conv_id")
        )
        last_words = F.coalesce(F.get("path", F.size("path") - 1)["words"], F.lit(0))
        level = merged.select(
            "path", *_named(F.col("path")), *[c.alias(n) for c, n in zip(_named(_parent(F.col("path"))), ("q1", "q2"))],
            F.lit(depth).cast("long").alias("depth"), "conv_id", "n_convs", "n_children",
            F.when(F.col("n_children") == 0, F.lit(1)).otherwise(F.col("n_leaves")).cast("long").alias("n_leaves"),
            (F.col("saved_tokens") + (F.col("n_convs") - 1) * last_words).alias("saved_tokens"),
        )
        level.write.parquet(f"{root}/level={depth}")
        level = spark.read.schema(level.schema).parquet(f"{root}/level={depth}")
        below = level.select(
            _parent(F.col("path")).alias("path"), "conv_id", "n_convs", F.lit(1).cast("long").alias("n_children"), "n_leaves", "saved_tokens"
        )
    names = T.StructType.fromDDL(_NODE).fieldNames()
    levels = spark.read.schema(level.schema).parquet(root).select(names)
    return levels.unionByName(peeled.where(F.col("path").isNull()).select(names))


def _pieces(batches):
    """Sorted (p1, p2, id) rows to (p1, p2, first, ids): at most ``PIECE`` neighbouring ids of a node, joined by commas."""
    for batch in batches:
        p1, p2, ids = (batch.column(c).to_pylist() for c in ("p1", "p2", "id"))
        rows, start = [], 0
        for k in range(1, len(ids) + 1):
            if k == len(ids) or k - start == PIECE or p1[k] != p1[start] or p2[k] != p2[start]:
                rows.append((p1[start], p2[start], ids[start], ",".join(map(str, ids[start:k]))))
                start = k
        if rows:
            yield pa.RecordBatch.from_arrays(
                [*(pa.array(c, pa.int64()) for c in list(zip(*rows))[:3]), pa.array([r[3] for r in rows], pa.string())], ["p1", "p2", "first", "ids"]
            )


def _digests(batches):
    """Sorted pieces to (p1, p2, sha256), the digest carried from piece to piece."""
    node, state = None, None
    for batch in batches:
        done = []
        for p1, p2, ids in zip(*(batch.column(c).to_pylist() for c in ("p1", "p2", "ids"))):
            if (p1, p2) == node:
                state.update(b"," + ids.encode())
            else:
                if node:
                    done.append((*node, state.hexdigest()))
                node, state = (p1, p2), hashlib.sha256(ids.encode())
        if done:
            yield pa.RecordBatch.from_arrays([pa.array(list(c)) for c in zip(*done)], ["p1", "p2", "ends_sha256"])
    if node:
        yield pa.RecordBatch.from_arrays([pa.array([v]) for v in (*node, state.hexdigest())], ["p1", "p2", "ends_sha256"])


def ends_digests(conversations):
    """(p1, p2, ends_sha256): for each path that a conversation ends at, the SHA-256 of the ids of all that do, in
    decimal and ascending order, joined by commas.

    Ids are sorted by node over all partitions, so those of a group of copies lie in many of them, and joined there in
    pieces. A SHA-256 has to read its text in order: the pieces of a node meet in one task, which reads them one after
    another and never holds the list.
    """
    ids = conversations.select(*_named(F.col("turns")), F.col("conv_id").alias("id"))
    n = int(conversations.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    spread = ids.repartitionByRange(n, "p1", "p2", "id").sortWithinPartitions("p1", "p2", "id")
    pieces = spread.mapInArrow(_pieces, "p1 long, p2 long, first long, ids string")
    ordered = pieces.repartition("p1", "p2").sortWithinPartitions("p1", "p2", "first")
    return ordered.mapInArrow(_digests, "p1 long, p2 long, ends_sha256 string")


def trie(conversations, near=NEAR, task_turns=TASK_TURNS):
    """The nodes of the trie of (conv_id, turns) rows: depth, conv_id, parent_conv_id, n_convs, n_children, n_leaves,
    saved_tokens, ends_sha256.

    A node of depth d is a distinct sequence of first d turns; the conversations that begin with it are its members, and
    ``conv_id`` is the smallest of them. The root, of depth 0, has no turn; all conversations are members, also those
    without a turn. ``saved_tokens`` adds up over the node and all below it: members but one, times the words of the
    node's last turn. ``ends_sha256`` is that of no id for a node at which no conversation ends. A table without
    conversations has no node. Every turn of a conversation is a node, however many there are.
    """
    conversations = stored(conversations.select("conv_id", "turns"), "rebuilt")
    columns = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    nodes = _nodes(conversations, max(1, near), task_turns)
    if nodes is None:
        kinds = ", ".join(f"{c} {'string' if c == 'ends_sha256' else 'long'}" for c in columns)
        return conversations.sparkSession.createDataFrame([], kinds)

    # The root is the parent of the whole next level, so its id goes there as a value.
    top = nodes.where("depth = 0").first()["conv_id"]
    known = F.when(F.col("depth") == 1, F.lit(top)).cast("long")
    upper = nodes.where("depth <= 1").withColumn("parent_conv_id", known)
    parents = nodes.where("depth > 0").select(F.col("p1").alias("q1"), F.col("p2").alias("q2"), F.col("conv_id").alias("parent_conv_id"))
    lower = nodes.where("depth > 1").join(parents, ["q1", "q2"])
    found = upper.unionByName(lower.select(upper.columns))
    done = found.join(ends_digests(conversations), ["p1", "p2"], "left")
    nothing = F.lit(hashlib.sha256(b"").hexdigest())
    return done.withColumn("ends_sha256", F.coalesce("ends_sha256", nothing)).select(columns)


# --- the same in SQL ---------------------------------------------------------------------------

SQL = r"""
WITH ids AS (
  SELECT DISTINCT conv_id FROM conversations WHERE conv_id IS NOT NULL
), crc AS (
  SELECT conv_id,
         xor(list_reduce(list_prepend(4294967295, list_transform(string_split(CAST(conv_id AS VARCHAR), ''), lambda x: CAST(ascii(x) AS BIGINT))),
             lambda crc, byte: list_reduce(list_prepend(xor(crc, byte), range(8)),
                 lambda c, i: CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END)), 4294967295) % 4 AS h
  FROM ids
), own AS (
  SELECT conv_id, list({'role': role, 'text': text} ORDER BY turn NULLS FIRST, role, text) AS turns
  FROM (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL)
  GROUP BY conv_id
), rebuilt AS (
  SELECT o.conv_id, list_concat(coalesce(b.turns[1:c.h], []), o.turns[c.h + 1:]) AS turns
  FROM own o JOIN crc c USING (conv_id) LEFT JOIN own b ON b.conv_id = o.conv_id - o.conv_id % 20
), prefixes AS (
  SELECT conv_id, d AS depth, len(turns) AS size, turns[1:d] AS path, turns[d] AS last
  FROM (SELECT conv_id, turns, unnest(range(len(turns) + 1)) AS d FROM rebuilt)
), nodes AS (
  SELECT sha256(CAST(to_json(path) AS VARCHAR)) AS node, any_value(path) AS path, depth, min(conv_id) AS conv_id, count(*) AS n_convs,
         (count(*) - 1) * any_value(CASE WHEN depth = 0 THEN 0 ELSE len(regexp_extract_all(last.text, '[^\x20\x09-\x0D]+')) END) AS saved,
         sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (size = depth), '')) AS ends_sha256
  FROM prefixes GROUP BY node, depth
), parents AS (
  SELECT n.*, CASE WHEN depth > 0 THEN sha256(CAST(to_json(path[1:depth - 1]) AS VARCHAR)) END AS parent FROM nodes n
), children AS (
  SELECT parent, count(*) AS n_children FROM parents WHERE parent IS NOT NULL GROUP BY parent
), subtree AS (
  SELECT top, count(*) FILTER (leaf) AS n_leaves, sum(saved) AS saved_tokens
  FROM (SELECT sha256(CAST(to_json(path[1:d]) AS VARCHAR)) AS top, saved, node NOT IN (SELECT parent FROM children) AS leaf
        FROM (SELECT node, path, saved, unnest(range(depth + 1)) AS d FROM nodes))
  GROUP BY top
)
SELECT p.conv_id, p.depth, u.conv_id AS parent_conv_id, p.n_convs, coalesce(c.n_children, 0) AS n_children, s.n_leaves,
       CAST(s.saved_tokens AS BIGINT) AS saved_tokens, p.ends_sha256
FROM parents p JOIN subtree s ON s.top = p.node LEFT JOIN children c ON c.parent = p.node LEFT JOIN nodes u ON u.node = p.parent
"""
