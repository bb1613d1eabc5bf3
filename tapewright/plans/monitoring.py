"""Consumer lag and archive flush figures as tables."""

import json

from pyspark.sql import Window
from pyspark.sql import functions as F

from tapewright.functions.times import DAY_MS
from tapewright.operators.ordered import with_running_total

OFFSETS = "consumer string, topic string, partition int, latest bigint, committed bigint"


def lag_report(offsets):
    """Lag per consumer and log partition, with the consumer's total and highest. The input has one row
    per log partition, so a consumer's window is short."""
    consumer = Window.partitionBy("consumer")
    lagged = offsets.withColumn("lag", F.col("latest") - F.col("committed"))
    return lagged.withColumns({"total_lag": F.sum("lag").over(consumer), "max_lag": F.max("lag").over(consumer)})


def progress_offsets(spark, consumer, progress):
    """Offset rows from a streaming query's last progress, for sources that report them per partition
    as ``{topic: {partition: offset}}``."""
    rows = []
    for source in progress["sources"]:
        ends, newest = source.get("endOffset"), source.get("latestOffset")
        ends = json.loads(ends) if isinstance(ends, str) else ends
        newest = json.loads(newest) if isinstance(newest, str) else newest
        for topic, partitions in (newest or {}).items():
            for number, latest in partitions.items():
                rows.append((consumer, topic, int(number), latest, (ends or {}).get(topic, {}).get(number, 0)))
    return spark.createDataFrame(rows, OFFSETS)


def reported_offsets(progress):
    """Offset rows for :func:`lag_report` from the last report of each query in a progress table, for sources that report
    their positions per partition, see :func:`progress_offsets`.
    """
    last = progress.groupBy("consumer", "query").agg(F.max_by("sources", F.struct("batch", "at")).alias("sources"))
    source = last.select("consumer", F.explode("sources").alias("s"))
    positions = lambda c: F.from_json(c, "map<string,map<string,bigint>>")
    topics = source.select("consumer", F.explode(positions("s.latestOffset")).alias("topic", "newest"), positions("s.endOffset").alias("ends"))
    partitions = topics.select("consumer", "topic", F.explode("newest").alias("partition", "latest"), "ends")
    committed = F.coalesce(F.try_element_at(F.try_element_at("ends", "topic"), "partition"), F.lit(0))
    return partitions.select("consumer", "topic", F.col("partition").cast("int").alias("partition"), "latest", committed.alias("committed"))


def flush_lag(progress, total_rows, chunk_size=1000):
    """What each flush wrote and what it left behind: consumer, batch, rows, first_ms, last_ms, written so far, lag.

    ``progress`` holds the reports of one query, ``total_rows`` the rows its source has. For sources whose positions are
    no row numbers, such as folders of files.
    """
    flushes = progress.where(F.col("rows").isNotNull()).select("consumer", "batch", "rows", "first_ms", "last_ms")
    totals = with_running_total(flushes, "batch", "rows", chunk_size, "written")
    return totals.withColumn("lag", F.lit(total_rows) - F.col("written"))


def flush_counts(flushes):
    """Rows per flush and symbol, from the flush log; ``flush`` is the write stamp in epoch ms."""
    return flushes.groupBy("flush", "symbol").agg(F.sum("records").alias("records"))


def flush_totals(counts, chunk_size=DAY_MS):
    """Records per flush and the running total over flushes; ``counts`` has flush, symbol, records.

    Flushes are summed in chunks of ``chunk_size`` along ``flush``, a day of epoch ms by default, and one row a chunk is
    carried on.
    """
    flushes = counts.groupBy("flush").agg(
        F.sum("records").alias("written"), F.count(F.lit(1)).alias("symbols")
    )
    return with_running_total(flushes, "flush", "written", chunk_size, "total_written")
