"""One query for each operator, with production parameters, over its whole table."""

from pyspark.sql import functions as F

from tapewright.llm import (
    bloom_lm, decontamination, html, language, lexical_search, licenses, line_runs, mixing, passages, prefix_trie, quality,
    simhash, toxicity,
)
from tapewright.llm.text import fold


def _table(spark, sf_dir, name):
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_html(spark, sf_dir):
    """Main text of all pages."""
    pages = _table(spark, sf_dir, "pages").select("page_id", "url", "html")
    return html.extract(pages).select("page_id", "url", "text", F.char_length("text").cast("long").alias("n_chars"))


def op2_decontamination(spark, sf_dir):
    """Each document and benchmark item of which tiles cover half or more."""
    found = decontamination.contamination(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))
    longest = F.array_max(F.transform("tiles", lambda t: t[2]))
    names = F.col("id").alias("doc_id"), F.col("item").alias("item_id")
    return found.select(*names, "coverage", F.size("tiles").alias("n_tiles"), longest.alias("longest_tile"))


def op3_simhash(spark, sf_dir):
    """Near-duplicate classes of all documents: 4-word shingles, links at 4 bits or fewer."""
    found = simhash.near_duplicates(_table(spark, sf_dir, "documents"), shingle=4, tau=4)
    digits = F.lower(F.lpad(F.hex("fp"), 16, "0"))
    return found.select("doc_id", digits.alias("fingerprint"), F.col("component").alias("component_id"))


def op4_toxicity(spark, sf_dir):
    """Toxicity of all documents, learned from labels outside the held-out fold."""
    docs = _table(spark, sf_dir, "documents")
    model = toxicity.train(docs, toxicity.learned_rows(_table(spark, sf_dir, "labels")))
    scored = toxicity.score(docs.select("doc_id", "text"), model)
    predicted = (F.col("score") >= 0.5).cast("int").alias("predicted")
    return scored.select("doc_id", (fold("doc_id", 5) == 0).alias("held_out"), "score", predicted)


def op5_language(spark, sf_dir):
    """Language of all documents, learned from documents outside the held-out fold."""
    docs = _table(spark, sf_dir, "documents")
    names, vectors = language.prototypes(docs.where(fold("doc_id", 3) != 1))
    found = language.identify(docs.select("doc_id", "text"), names, vectors)
    return found.select("doc_id", (fold("doc_id", 3) == 1).alias("held_out"), "lang_pred", "score")


def op6_mixing(spark, sf_dir):
    """The mix of all documents: 150 % of all words, sources weighted 5, 2, 1, no document above twice."""
    return mixing.mix(_table(spark, sf_dir, "documents")).select("doc_id", "source", "size", "source_size", "target", "taken")


def op7_quality(spark, sf_dir):
    """Base rules and distribution divergence of all documents."""
    found = quality.rules(_table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept",
        "nearest", "class_distance", "word_distance",
    )


def op8_licenses(spark, sf_dir):
    """License notices in all documents."""
    found = licenses.scan(_table(spark, sf_dir, "documents"))
    return found.withColumn("differences", F.array_join("differences", "; "))


def op9_language_model(spark, sf_dir):
    """Scores of all documents by a model of those outside the held-out fold."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    held_out = fold("doc_id", 5) == 1
    scored = bloom_lm.score(docs, docs.where(~held_out))
    return scored.select("doc_id", held_out.alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")


def op10_passages(spark, sf_dir):
    """All documents without repeated passages; spans of what was removed, in code points of the original text."""
    done = passages.remove_repeats(_table(spark, sf_dir, "documents").select("doc_id", "text"))
    spans = F.array_join(F.transform("removed", lambda s: F.concat_ws("-", s["start"], s["end"])), ",")
    return done.select("doc_id", "text", "n_units", "n_removed", spans.alias("removed"))


def op11_lexical_search(spark, sf_dir):
    """The 50 highest-scoring of all documents for each benchmark item."""
    return lexical_search.search(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"), k=50)


def op12_line_dedup(spark, sf_dir):
    """All documents without the lines of 20 code points or more that three or more share, but in the last of those."""
    done = line_runs.drop_shared_lines(_table(spark, sf_dir, "documents").select("doc_id", "text"))
    digest = F.sha2(F.coalesce(F.col("text"), F.lit("")).cast("binary"), 256)
    return done.select("doc_id", "n_lines", "n_dropped", digest.alias("kept_sha256"))


def op13_prefix_trie(spark, sf_dir):
    """Nodes of the prefix trie of all conversations, each rebuilt on the first turns of its base."""
    own = prefix_trie.turns_of(_table(spark, sf_dir, "conversations"))
    return prefix_trie.trie(prefix_trie.graft(own))


QUERIES = {
    q.__name__: q
    for q in [
        op1_html, op2_decontamination, op3_simhash, op4_toxicity, op5_language,
        op6_mixing, op7_quality, op8_licenses, op9_language_model, op10_passages, op11_lexical_search, op12_line_dedup,
        op13_prefix_trie,
    ]
}
ORACLE_SQL = {
    "op10_passages": passages.SQL, "op11_lexical_search": lexical_search.SQL, "op12_line_dedup": line_runs.SQL, "op13_prefix_trie": prefix_trie.SQL,
}
