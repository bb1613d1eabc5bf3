"""Connected components of an edge table by alternating large-star and small-star rounds."""

from pyspark.sql import functions as F

from tapewright.llm.tables import stored


def _stars(edges):
    """Every neighbour above a node is joined to the smallest node around it (large star)."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    lowest = both.groupBy("u").agg(F.min(F.least("u", "v")).alias("low"))
    return both.where("v > u").join(lowest, "u").select(F.col("v").alias("u"), F.col("low").alias("v"))


def _small_stars(edges):
    """A node and its lower neighbours are joined to the lowest of them; edges come with u > v."""
    lowest = edges.groupBy("u").agg(F.min("v").alias("low"))
    below = edges.join(lowest, "u").where("v > low").select(F.col("v").alias("u"), F.col("low").alias("v"))
    return below.unionByName(lowest.select("u", F.col("low").alias("v")))


def components(edges):
    """(node, root) for each node of an edge table (u, v) of longs; the root is the smallest node of the component.

    Only minima are aggregated, before the shuffle as well, so a node with very many edges costs one row per task.
    Each round is written to the shared folder, and the loop ends when a round changes nothing.
    """
    oriented = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).where("u > v").distinct()
    table, before = stored(oriented, "edges"), None
    while True:
        table = stored(_small_stars(_stars(table).where("u > v").distinct()).distinct(), "edges")
        mark = table.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if mark == before:
            break
        before = mark
    roots = table.select(F.col("v").alias("node")).distinct().withColumn("root", F.col("node"))
    return table.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(roots)
