"""What streams report of themselves, kept as a table: rows and times of each batch, and the positions of its sources."""

import json
import threading

from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener

from tapewright.streaming import batches

#: Name of the figures that :func:`observed` has Spark count.
FLUSH = "flush"

_REPORT = """id string, runId string, name string, timestamp string, batchId bigint, numInputRows bigint,
    durationMs map<string,bigint>, observedMetrics map<string,map<string,string>>,
    sources array<struct<description string, endOffset string, latestOffset string, numInputRows bigint>>"""


def observed(trades):
    """``trades`` with their number and first and last event time counted along the way, in the batch's own pass."""
    return trades.observe(
        FLUSH, F.count(F.lit(1)).alias("rows"), F.min("event_time").alias("first_ms"), F.max("event_time").alias("last_ms")
    )


class ProgressLog(StreamingQueryListener):
    """Writes each report of the queries of a session to ``folder``, one small file for each batch of a run.

    ``watch`` starts it. A report names its run and batch, so one that comes twice replaces itself. No job is run for
    it. Reports arrive behind the batch; :meth:`wait` returns when those of a query that has ended are all written.
    """

    def __init__(self, spark, folder):
        super().__init__()
        self.spark, self.folder, self._ended = spark, folder, {}

    def watch(self):
        self.spark.streams.addListener(self)
        return self

    def close(self):
        self.spark.streams.removeListener(self)

    def onQueryStarted(self, event):
        self._end_of(event.runId)

    def onQueryProgress(self, event):
        report = json.loads(event.progress.json)
        fs, path = batches.file_system(self.spark, f"{self.folder}/{report['runId']}-{report['batchId']}.json")
        out = fs.create(path, True)
        out.write(bytearray(json.dumps(report).encode()))
        out.close()

    def onQueryIdle(self, event):
        pass

    def onQueryTerminated(self, event):
        self._end_of(event.runId).set()

    def _end_of(self, run):
        return self._ended.setdefault(str(run), threading.Event())

    def wait(self, query, seconds=60):
        """Whether the reports of an ended query came in time."""
        return self._end_of(query.runId).wait(seconds)


def read_progress(spark, folder):
    """One row for each report: consumer, query, run, batch, at, input_rows, rows, first_ms, last_ms, sources.

    ``consumer`` is the query's name, or its id without one. ``rows`` and times are those of :func:`observed`.
    """
    reports = spark.read.schema(_REPORT).json(folder)
    figure = lambda name: F.col("observedMetrics")[FLUSH][name].try_cast("bigint").alias(name)
    return reports.select(
        F.coalesce("name", "id").alias("consumer"), F.col("id").alias("query"), F.col("runId").alias("run"), F.col("batchId").alias("batch"),
        F.col("timestamp").alias("at"), F.col("numInputRows").alias("input_rows"), figure("rows"), figure("first_ms"), figure("last_ms"), "sources",
    )
