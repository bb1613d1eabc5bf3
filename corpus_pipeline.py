"""Documents to a training mix: each stage works on all rows that the stage before it kept.

A stage takes (spark, docs, sf_dir) and returns the columns of ``docs``, the last one those and ``copy``. ``docs`` may
have further columns of any name beside doc_id, text, source and n_chars; they are kept, but a column ``copy`` is
replaced by the last stage. Rows without an id, with null or empty texts, repeated rows and ties pass through every
stage as stated there; texts of any length are read whole; an empty table stays empty.
"""

import uuid

from pyspark.sql import Window
from pyspark.sql import functions as F

from tapewright.llm import decontamination, mixing, passages, simhash, toxicity
from tapewright.llm.tables import stored

#: Fixed: the pipeline's decisions come from trained models, classes and sampling, which SQL can't express.
ORACLE_SQL = None


def _table(spark, sf_dir, name):
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _unused():
    """A name that no column of the caller has."""
    return f"own_{uuid.uuid4().hex}"


def drop_toxic(spark, docs, sf_dir):
    """Rows that the toxicity model gives a score below one half.

    A null or empty text has no word and passes, as does a row without an id; equal texts get one score.
    """
    model, score = toxicity.train(docs, toxicity.learned_rows(_table(spark, sf_dir, "labels"))), _unused()
    scored = toxicity.score(docs, model, score_col=score)
    return scored.where(F.col(score) < 0.5).select(docs.columns)


def drop_near_duplicates(spark, docs, sf_dir):
    """Of each class of near-duplicates, the row with the smallest id; a row without an id only if no other has one.

    Rows with equal id differ by their text; rows equal in both are one row, whichever comes first by a hash of all its
    columns. Null and empty texts are near-duplicates of each other.
    """
    own_hash, place = _unused(), _unused()
    text_hash = F.xxhash64(F.coalesce(F.col("text"), F.lit("")))
    identity = F.struct(F.col("doc_id").isNull().alias("unnamed"), F.col("doc_id").alias("doc_id"), text_hash.alias("text_hash"))
    found = simhash.near_duplicates(docs.select(identity.alias("row"), "text"), "row", "text", shingle=4, tau=4)
    first = found.where("row = component").select("row.doc_id", "row.text_hash").distinct().alias("first")
    named = docs.withColumn(own_hash, text_hash).alias("named")
    kept = named.join(first, F.expr(f"named.doc_id <=> first.doc_id AND named.{own_hash} = first.text_hash"), "left_semi")
    order = Window.partitionBy("doc_id", own_hash).orderBy(F.xxhash64(*docs.columns))
    return kept.withColumn(place, F.row_number().over(order)).where(F.col(place) == 1).select(docs.columns)


def cut_repeated_passages(spark, docs, sf_dir):
    """All rows, without passages that an earlier row has; ``n_chars`` follows the text.

    Earlier is the row of a smaller id, a null id first; rows equal in id and text keep the same passages. A null text
    stays null.
    """
    cut = passages.remove_repeats(docs, spans_col=_unused(), units_col=_unused(), removed_col=_unused())
    return cut.withColumn("n_chars", F.char_length("text").cast("long")).select(docs.columns)


def drop_contaminated(spark, docs, sf_dir):
    """Rows of whose text no benchmark item is covered by half or more; null and empty texts cover none."""
    return decontamination.remove_contaminated(docs, _table(spark, sf_dir, "benchmark"))


def mix_sources(spark, docs, sf_dir):
    """Rows that the mix takes, each as often as it is taken; ``copy`` counts from 1.

    Rows equal in id, text and source are taken as often as all of them are, together; which of them goes once more is
    decided by a hash of all their columns. Rows without words weigh nothing and are taken like their source.
    """
    own_hash, place, times = (_unused() for _ in range(3))
    mixed = stored(mixing.mix(docs).select("doc_id", "text_hash", "source", "times", "copy", "copies"), "mixed")
    units = mixed.where("copy = 1 AND copies = 1").alias("mixed")
    text_hash = F.xxhash64(F.coalesce(F.col("text"), F.lit("")))
    kept = [F.col(f"named.{c}") for c in docs.columns if c != "copy"]
    same = f"named.doc_id <=> mixed.doc_id AND named.{own_hash} = mixed.text_hash AND named.source <=> mixed.source"
    named = docs.withColumn(own_hash, text_hash)
    taken = named.alias("named").join(units, F.expr(same)).select(*kept, F.col("mixed.times").alias(times))
    if not mixed.where("copies > 1").isEmpty():
        equal = Window.partitionBy("doc_id", own_hash, "source").orderBy(F.xxhash64(*docs.columns))
        some = mixed.where("copies > 1").alias("mixed")
        numbered = named.withColumn(place, F.row_number().over(equal)).alias("named")
        taken = taken.unionByName(
            numbered.join(some, F.expr(f"{same} AND named.{place} = mixed.copy")).select(*kept, F.col("mixed.times").alias(times))
        )
    return taken.where(F.col(times) > 0).withColumn("copy", F.explode(F.sequence(F.lit(1), F.col(times)))).drop(times)


STAGES = [
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_duplicates),
    ("repeated_passages", cut_repeated_passages),
    ("decontamination", drop_contaminated),
    ("mixing", mix_sources),
]


def run(spark, sf_dir):
    """All stages over ``documents``; each result is written as Parquet and read again."""
    docs = _table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
