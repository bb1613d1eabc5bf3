"""Repeated passages removed by hashing the units of every text.

A unit is a sentence or the rest of a line, with the white space behind it, so the units of a text put together are the
text. Units that are equal but for A-Z case and white space have one 128-bit digest. Over the whole table, the first
unit of each digest, by id and then by place, stays; a later one is a repeat. Runs of neighbouring repeats with enough
words are removed.
"""

import re
import uuid

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Window
from pyspark.sql import functions as F

from tapewright.llm.tables import stored
from tapewright.llm.text import split_words

UNIT = r"[^.!?\n]*[.!?\n]*[\x20\x09-\x0D]*"
_UNIT = re.compile(UNIT)
MIN_WORDS = 25  # of a run of repeats that is removed


def units(text):
    """The units of a text in order; joined, they are the text."""
    return [u for u in _UNIT.findall(text or "") if u]


def unit_rows(docs, id_col, text_col):
    """(id, text_hash, pos, words, h1, h2) for each unit; h1 and h2 are the digest."""

    def run(batches):
        for batch in batches:
            for k in range(0, batch.num_rows, 256):
                some = batch.slice(k, 256)
                counts, rows, digests = [], [], []
                for text in some.column("text").to_pylist():
                    own = units(text)
                    counts.append(len(own))
                    for pos, unit in enumerate(own):
                        words = split_words(unit)
                        rows.append((pos, len(words)))
                        digests.append(xxhash.xxh3_128_digest(b" ".join(words)))
                at = np.repeat(np.arange(some.num_rows), counts)
                table = np.array(rows, np.int32).reshape(-1, 2)
                halves = np.frombuffer(b"".join(digests), np.int64).reshape(-1, 2)
                names = ["id", "text_hash", "pos", "words", "h1", "h2"]
                yield pa.RecordBatch.from_arrays(
                    [some.column("id").take(pa.array(at)), some.column("text_hash").take(pa.array(at))]
                    + [pa.array(c) for c in (table[:, 0], table[:, 1], halves[:, 0], halves[:, 1])],
                    names,
                )

    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    inputs = docs.select(F.col(id_col).alias("id"), F.xxhash64(text).alias("text_hash"), text.alias("text"))
    kind = docs.schema[id_col].dataType.simpleString()
    return inputs.mapInArrow(run, f"id {kind}, text_hash long, pos int, words int, h1 long, h2 long")


def repeats(docs, id_col="doc_id", text_col="text", min_words=MIN_WORDS):
    """(id, text_hash, positions): the places of the units to remove from each text that has any.

    The first unit of a digest is found by an aggregation that combines in tasks, so a line in a third of all texts
    costs a row per task. Repeated digests are written first: both sides of the join then come from shuffles of their
    own, of which Spark splits those of hot digests.
    """
    rows = unit_rows(docs, id_col, text_col)
    first = rows.groupBy("h1", "h2").agg(F.count(F.lit(1)).alias("n"), F.min(F.struct("id", "text_hash", "pos")).alias("first"))
    first = stored(first.where("n > 1").drop("n"), "repeated-digests")
    later = rows.join(first, ["h1", "h2"]).where(~F.struct("id", "text_hash", "pos").eqNullSafe(F.col("first")))
    # Rows with equal id and text are one text; their units count once.
    later = later.select("id", "text_hash", "pos", "words").distinct()
    text = Window.partitionBy("id", "text_hash")
    run = F.col("pos") - F.row_number().over(text.orderBy("pos"))
    enough = F.sum("words").over(Window.partitionBy("id", "text_hash", "run")) >= min_words
    kept = later.withColumn("run", run).withColumn("enough", enough).where("enough")
    return kept.groupBy("id", "text_hash").agg(F.sort_array(F.collect_list("pos")).alias("positions"))


def _cut(text, positions):
    """What stays of a text; starts and ends of removed spans in code points; units before and removed."""
    own = units(text)
    if positions is None or not len(positions):
        return text, [], [], len(own), 0
    gone = np.zeros(len(own), bool)
    gone[np.asarray(positions)] = True
    ends = np.cumsum([len(u) for u in own])
    edge = np.flatnonzero(np.diff(np.concatenate([[0], gone.view(np.int8), [0]])))
    starts = [int(ends[i - 1]) if i else 0 for i in edge[::2]]
    stops = [int(ends[i - 1]) for i in edge[1::2]]
    return "".join(u for u, g in zip(own, gone) if not g), starts, stops, len(own), int(gone.sum())


def remove_repeats(
    docs, id_col="doc_id", text_col="text", min_words=MIN_WORDS,
    spans_col="removed", units_col="n_units", removed_col="n_removed",
):
    """``docs`` with repeated passages cut from ``text_col``.

    ``spans_col`` holds what was removed as (start, end) code points of the original text, ``units_col`` and
    ``removed_col`` count units. A null text stays null, with no units; an empty one stays empty. A null id ranks before
    all others. Rows with equal id and equal text are one text and keep the same passages. New columns replace columns
    of their names; others stay as they are. All text is read, at any length.
    """
    schema = "text string, starts array<int>, ends array<int>, units int, removed int"

    @F.pandas_udf(schema)
    def cut(texts, positions):
        rows = [_cut(t or "", p) for t, p in zip(texts, positions)]
        return pd.DataFrame(rows, columns=["text", "starts", "ends", "units", "removed"])

    tag = uuid.uuid4().hex  # no column of the caller has such a name
    own_id, own_hash, own_cut = f"id_{tag}", f"hash_{tag}", f"cut_{tag}"
    found = stored(repeats(docs, id_col, text_col, min_words), "repeats").select(
        F.col("id").alias(own_id), F.col("text_hash").alias(f"found_{tag}"), F.col("positions").alias(f"places_{tag}")
    )
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    keyed = docs.withColumn(own_hash, F.xxhash64(text))
    same = F.col(id_col).eqNullSafe(F.col(own_id)) & (F.col(own_hash) == F.col(f"found_{tag}"))
    done = keyed.join(found, same, "left").withColumn(own_cut, cut(text, F.col(f"places_{tag}")))
    spans = F.transform(
        F.arrays_zip(F.col(own_cut)["starts"].alias("start"), F.col(own_cut)["ends"].alias("end")),
        lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end")),
    )
    new = {
        text_col: F.when(F.col(text_col).isNotNull(), F.col(own_cut)["text"]),
        spans_col: spans,
        units_col: F.col(own_cut)["units"],
        removed_col: F.col(own_cut)["removed"],
    }
    names = [*docs.columns, *(n for n in new if n not in docs.columns)]
    return done.select(*[new[n].alias(n) if n in new else F.col(n) for n in names])


# --- the same in SQL ---------------------------------------------------------------------------

SQL = rf"""
WITH units AS (
  SELECT doc_id, pos, unit, length(regexp_extract_all(unit, '[^\x20\x09-\x0D]+')) AS words,
         array_to_string(list_transform(regexp_extract_all(unit, '[^\x20\x09-\x0D]+'),
                         lambda w: translate(w, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')), ' ') AS norm
  FROM (SELECT doc_id, unnest(u) AS unit, generate_subscripts(u, 1) - 1 AS pos
        FROM (SELECT doc_id, list_filter(regexp_extract_all(coalesce(text, ''), '{UNIT}'), lambda x: x <> '') AS u FROM documents))
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY norm ORDER BY doc_id, pos) > 1 AS later FROM units
), runs AS (
  SELECT *, pos - row_number() OVER (PARTITION BY doc_id, later ORDER BY pos) AS run FROM ranked
), judged AS (
  SELECT *, later AND sum(words) OVER (PARTITION BY doc_id, later, run) >= {MIN_WORDS} AS gone,
         sum(length(unit)) OVER (PARTITION BY doc_id ORDER BY pos) AS stop
  FROM runs
), texts AS (
  SELECT doc_id, coalesce(string_agg(unit, '' ORDER BY pos) FILTER (NOT gone), '') AS text, count(*) AS n_units,
         count(*) FILTER (gone) AS n_removed
  FROM judged GROUP BY doc_id
), spans AS (
  SELECT doc_id, string_agg(span_start || '-' || span_end, ',' ORDER BY span_start) AS removed
  FROM (SELECT doc_id, min(stop - length(unit)) AS span_start, max(stop) AS span_end
        FROM (SELECT *, pos - row_number() OVER (PARTITION BY doc_id ORDER BY pos) AS island FROM judged WHERE gone)
        GROUP BY doc_id, island)
  GROUP BY doc_id
)
SELECT d.doc_id, CASE WHEN d.text IS NOT NULL THEN coalesce(t.text, '') END AS text, CAST(coalesce(n_units, 0) AS INTEGER) AS n_units,
       CAST(coalesce(n_removed, 0) AS INTEGER) AS n_removed, coalesce(removed, '') AS removed
FROM documents d LEFT JOIN texts t USING (doc_id) LEFT JOIN spans USING (doc_id)
"""
