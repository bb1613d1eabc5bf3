"""Analytic functions along an order, without putting one key's whole history into one task."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from tapewright.functions.times import floor_div


def _chunked(rows, order, chunk_size, *keys):
    """Rows shuffled by key and chunk. A lag or sum per chunk and the carry between chunks share this shuffle."""
    return rows.withColumn("_chunk", floor_div(order, chunk_size)).repartition(*keys, "_chunk")


def with_previous(rows, key, order, value, chunk_size, name="previous"):
    """Adds the value of the preceding row of the same key, by the BIGINT column ``order``.

    A key's rows are cut into chunks of ``chunk_size`` along the order. Inside a chunk it is a lag; the
    first row of a chunk gets the last value of the key's chunk before, from a table with one row per
    chunk. (key, order) is a primary key: distinct and not NULL; values are not NULL either.
    """
    # The join below would test the key for NULL on one side only, and each side would then be
    # computed anew. Testing it up front keeps the sides equal.
    chunked = _chunked(rows.where(F.col(key).isNotNull()), order, chunk_size, key)
    inside = Window.partitionBy(key, "_chunk").orderBy(order)
    lagged = chunked.withColumn(name, F.lag(value).over(inside))
    ends = chunked.groupBy(key, "_chunk").agg(F.max_by(value, order).alias("_end"))
    carried = ends.select(
        key, "_chunk", F.lag("_end").over(Window.partitionBy(key).orderBy("_chunk")).alias("_carried")
    )
    return (
        lagged.join(carried, [key, "_chunk"], "left")
        .withColumn(name, F.coalesce(name, "_carried"))
        .drop("_chunk", "_carried")
    )


def with_running_total(rows, order, value, chunk_size=1000, name="running_total"):
    """Adds the sum of ``value`` over all rows up to this one, by the distinct BIGINT column ``order``.

    Chunks are summed in parallel; only one row per chunk passes through the single ordered window.
    """
    chunked = _chunked(rows, order, chunk_size)
    inside = Window.partitionBy("_chunk").orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    local = chunked.withColumn(name, F.sum(value).over(inside))
    sums = chunked.groupBy("_chunk").agg(F.sum(value).alias("_sum"))
    before = Window.orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sums.select("_chunk", F.coalesce(F.sum("_sum").over(before), F.lit(0)).alias("_before"))
    return (
        # An inner join would add a NULL test to this side only, and undo the shared shuffle.
        local.join(offsets, "_chunk", "left")
        .withColumn(name, F.col(name) + F.col("_before"))
        .drop("_chunk", "_before")
    )
