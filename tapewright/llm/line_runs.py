"""Lines that many documents share, found through levelled sorted runs of line hashes.

A run holds one row for each line key: its 128-bit hash, in how many documents of the run it is, and the largest id of
those. Runs are tables bucketed and sorted by hash, so a run is never shuffled or sorted again. A new batch of documents
is merge-anti-joined with the runs: a key for which a run says all there is to say, as it has enough documents and none
of the batch has a larger id, adds nothing. What is left becomes a run of level 0. Two runs of one level are compacted
into one of the next by a merge join, so a key is rewritten once a level, and the n-th batch meets at most log2(n) + 1
runs. After the last batch all runs are merged, and lines whose key has enough documents are removed but from the
document with the largest id.

All is DataFrame work. A key in a third of all documents costs a row for each task, as counting combines there; where
lines meet the keys to remove, both sides are shuffled, so Spark can split a hot one.
"""

import uuid

from pyspark.sql import functions as F

from tapewright.llm.tables import stored
from tapewright.session import scratch_dir

#: Fixed: the ASCII white space that is stripped from a line before it is compared.
SPACES = " \t\n\x0b\f\r"
#: Batches that a whole table is cut into.
BATCHES = 4

_HASH = ["h1", "h2"]
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def line_key(line):
    """What makes lines equal: the line without ASCII white space at both ends, A-Z in lower case."""
    return F.translate(_stripped(line), _UPPER, _UPPER.lower())


def _stripped(line):
    return F.btrim(line, F.lit(SPACES))


def keyed_lines(docs, id_col, text_col, min_chars):
    """(id, text_hash, pos, h1, h2) for each line whose key has ``min_chars`` code points or more."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = docs.select(F.col(id_col).alias("id"), F.xxhash64(text).alias("text_hash"), F.posexplode(F.split(text, "\n")).alias("pos", "line"))
    # Letter case does not change the length; a filter on the key itself would make the key twice.
    long_enough = rows.where(F.char_length(_stripped(F.col("line"))) >= min_chars)
    keyed = long_enough.select("id", "text_hash", "pos", line_key(F.col("line")).alias("key"))
    # The leading literal is another seed, so the halves are independent.
    return keyed.select("id", "text_hash", "pos", F.xxhash64("key").alias("h1"), F.xxhash64(F.lit(1), "key").alias("h2"))


def counted(lines):
    """(h1, h2, n, last): of each key, its documents and the largest id. Rows of one id are one document."""
    # Documents of a key are told apart before they are counted, so a hot key is never in one task.
    by_document = lines.select(*_HASH, "id").distinct()
    return by_document.groupBy(*_HASH).agg(F.count(F.lit(1)).alias("n"), F.max("id").alias("last"))


class LineRuns:
    """The runs of one deduplication, as bucketed tables ``<name>_<first batch>_<last batch>``.

    The name of a run tells which batches it covers, and a table appears in the catalog when it is complete. So a run
    within another's batches is one that was compacted, and an interrupted compaction leaves nothing that counts twice;
    :meth:`runs` can be read anew at any time. ``settled_at`` is the number of documents that settles a key.
    """

    def __init__(self, spark, name=None, settled_at=3):
        self.spark, self.settled_at = spark, settled_at
        self.name = name or f"line_runs_{uuid.uuid4().hex}"
        self.buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
        self._root = scratch_dir(spark, "line-runs")

    def _tables(self):
        return [r.tableName for r in self.spark.sql(f"SHOW TABLES LIKE '{self.name}_*'").collect()]

    def runs(self):
        """(first, last) batch of each run that no other run covers, oldest first."""
        spans = [tuple(map(int, name.rsplit("_", 2)[1:])) for name in self._tables()]
        return sorted(s for s in spans if not any(o != s and o[0] <= s[0] and s[1] <= o[1] for o in spans))

    def table(self, span):
        return self.spark.table(f"{self.name}_{span[0]}_{span[1]}")

    def _write(self, rows, span):
        writer = rows.write.bucketBy(self.buckets, *_HASH).sortBy(*_HASH)
        name = f"{self.name}_{span[0]}_{span[1]}"
        writer.option("path", f"{self._root}/{name}-{uuid.uuid4().hex}").saveAsTable(name)

    def _merge(self, older, newer):
        """Writes two runs as one, documents added up and the largest id of both. A join of equal buckets, not a union:
        nothing is shuffled.
        """
        a, b = self.table(older).alias("a"), self.table(newer).alias("b")
        both = a.join(b, (F.col("a.h1") == F.col("b.h1")) & (F.col("a.h2") == F.col("b.h2")), "full")
        hashes = [F.coalesce(f"a.{c}", f"b.{c}").alias(c) for c in _HASH]
        total = sum(F.coalesce(F.col(f"{side}.n"), F.lit(0)) for side in "ab")
        self._write(both.select(*hashes, total.alias("n"), F.greatest("a.last", "b.last").alias("last")), (older[0], newer[1]))

    def add(self, lines):
        """Adds a batch of (id, h1, h2) rows as a run; all rows of an id have to come in one batch."""
        spans = self.runs()
        fresh = counted(lines)
        for span in spans:
            run = self.table(span).where(F.col("n") >= self.settled_at).alias("run")
            told = [F.col(f"fresh.{c}") == F.col(f"run.{c}") for c in _HASH]
            older = F.col("fresh.last").isNull() | (F.col("run.last") >= F.col("fresh.last"))
            fresh = fresh.alias("fresh").join(run, [*told, older], "left_anti")
        number = spans[-1][1] + 1 if spans else 0
        self._write(fresh, (number, number))
        self.compact()

    def compact(self, whole=False):
        """Merges the two newest runs while they are of one level, that is, of as many batches; all with ``whole``."""
        while len(spans := self.runs()) > 1:
            older, newer = spans[-2:]
            if not whole and older[1] - older[0] != newer[1] - newer[0]:
                return
            self._merge(older, newer)

    def settled(self):
        """(h1, h2, last) of all keys with enough documents, after a compaction of all runs."""
        self.compact(whole=True)
        return self.table(self.runs()[0]).where(F.col("n") >= self.settled_at).select(*_HASH, "last")

    def drop(self):
        """Takes the tables out of the catalog; their files stay in the scratch folder, as lazy results may need them."""
        for name in self._tables():
            self.spark.sql(f"DROP TABLE IF EXISTS {name}")


def _mask(positions, n):
    """n characters, 1 at each of the ascending ``positions`` and 0 elsewhere, made in one pass."""
    before = lambda p, k: F.when(k == 0, F.lit(-1)).otherwise(F.get(positions, k - 1))
    runs = F.transform(positions, lambda p, k: F.concat(F.repeat(F.lit("0"), p - before(p, k) - 1), F.lit("1")))
    return F.concat(F.array_join(runs, ""), F.repeat(F.lit("0"), n - 1 - F.get(positions, F.size(positions) - 1)))


def drop_shared_lines(
    docs, id_col="doc_id", text_col="text", min_chars=20, min_docs=3, batches=BATCHES,
    lines_col="n_lines", dropped_col="n_dropped",
):
    """``docs`` without the lines that ``min_docs`` documents or more share, but in the one with the largest id.

    Lines are equal if their :func:`line_key` is; a line whose key has fewer than ``min_chars`` code points always
    stays. Other lines stay as they are, joined by a line feed. ``lines_col`` and ``dropped_col`` count the lines before
    and those removed. New columns replace columns of their names, all others stay.

    A null text stays null and an empty one empty; either has one empty line. Rows of one id are one document: they
    count once, and all of them keep their lines if theirs is the largest id. Rows without an id are one document that
    ranks below all others. A line that a document repeats counts once and goes or stays everywhere in it. Texts are
    read whole; a text is an array of its lines in one row. An empty table stays empty.
    """
    spark, tag = docs.sparkSession, uuid.uuid4().hex
    lines = keyed_lines(docs, id_col, text_col, min_chars)
    slices = F.pmod(F.xxhash64(F.lit(2), "id"), F.lit(max(1, int(batches))))
    # Hashes of all lines, read once from the texts: a batch reads its own folder, the removal all of them.
    path = scratch_dir(spark, "line-hashes")
    lines.withColumn("batch", slices).write.partitionBy("batch").parquet(path)
    schema = lines.withColumn("batch", slices).schema
    hashed = spark.read.schema(schema).parquet(path)

    store = LineRuns(spark, settled_at=min_docs)
    for number in range(max(1, int(batches))):
        store.add(hashed.where(F.col("batch") == number))
    settled = stored(store.settled(), "shared-lines")
    store.drop()

    gone = hashed.join(settled, _HASH).where(~F.col("id").eqNullSafe(F.col("last")))
    # Equal rows have equal lines at equal places; those count once.
    places = gone.groupBy("id", "text_hash").agg(F.sort_array(F.collect_set("pos")).alias("places"))
    places = places.select(F.col("id").alias(f"id_{tag}"), F.col("text_hash").alias(f"hash_{tag}"), F.col("places").alias(f"places_{tag}"))

    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    named = docs.withColumn(f"own_{tag}", F.xxhash64(text))
    same = F.col(id_col).eqNullSafe(F.col(f"id_{tag}")) & (F.col(f"own_{tag}") == F.col(f"hash_{tag}"))
    joined = named.join(places, same, "left")
    own, positions = F.split(text, "\n"), F.col(f"places_{tag}")
    flags = F.split(_mask(positions, F.size(own)), "")
    kept = F.filter(F.arrays_zip(own.alias("line"), flags.alias("gone")), lambda x: x["gone"] == "0")
    cut = F.when(positions.isNull(), F.col(text_col).cast("string")).otherwise(F.array_join(F.transform(kept, lambda x: x["line"]), "\n"))
    new = {
        text_col: cut,
        lines_col: F.size(own).cast("long"),
        dropped_col: F.coalesce(F.size(positions), F.lit(0)).cast("long"),
    }
    names = [*docs.columns, *(n for n in new if n not in docs.columns)]
    return joined.select(*[new[n].alias(n) if n in new else F.col(n) for n in names])


# --- the same in SQL ---------------------------------------------------------------------------

SQL = r"""
WITH lines AS (
  SELECT doc_id, pos, line,
         translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
  FROM (SELECT doc_id, unnest(l) AS line, generate_subscripts(l, 1) AS pos
        FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS l FROM documents))
), shared AS (
  SELECT key, max(doc_id) AS last FROM lines WHERE length(key) >= 20 GROUP BY key HAVING count(DISTINCT doc_id) >= 3
), judged AS (
  SELECT l.*, s.key IS NOT NULL AND l.doc_id <> s.last AS gone FROM lines l LEFT JOIN shared s ON s.key = l.key
)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '')) AS kept_sha256
FROM judged GROUP BY doc_id
"""
