"""Batches of one stream in one folder: who may write, and which batches count.

Every folder written batch by batch holds ``_owner``, the id of the stream that writes it, and ``_commits/<id>`` for
each finished batch. Batch ids start anew with a new checkpoint, so a second stream would replace or skip batches of the
first; it is refused before it writes. Names with an underscore in front are no data to Spark's readers.
"""

import uuid

from pyspark.sql import functions as F
from pyspark.sql import types as T

STREAM_ID = "sql.streaming.queryId"


def file_system(spark, path):
    """Hadoop file system and path object of a path."""
    jpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    return jpath.getFileSystem(spark._jsc.hadoopConfiguration()), jpath


def stream_id(rows):
    """The id of the stream whose batch is being written, kept in its checkpoint; None outside of streams."""
    return rows.sparkSession.sparkContext.getLocalProperty(STREAM_ID)


def claim(spark, folder, owner):
    """Makes the stream ``owner`` the writer of ``folder``; raises if another one is. Without an owner, nothing is
    claimed.
    """
    if owner is None:
        return
    fs, path = file_system(spark, f"{folder}/_owner")
    if not fs.exists(path) or not fs.getFileStatus(path).getLen():
        # Written aside and renamed, so a stop in between leaves no claim of nobody; an empty one names nobody.
        _, aside = file_system(spark, f"{folder}/_owner-{uuid.uuid4().hex}")
        out = fs.create(aside, False)
        out.write(bytearray(owner.encode()))
        out.close()
        if fs.exists(path) and not fs.getFileStatus(path).getLen():
            fs.delete(path, False)
        if not fs.rename(aside, path):
            fs.delete(aside, False)
    stream = fs.open(path)
    found = spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    stream.close()
    if found != owner:
        raise ValueError(f"{folder} belongs to the stream {found}; a stream with another checkpoint needs a folder of its own")


def committed(spark, folder):
    """Ids of the finished batches, ascending. One listing, whatever the number of batches."""
    fs, root = file_system(spark, f"{folder}/_commits")
    if not fs.exists(root):
        return []
    return sorted(int(status.getPath().getName()) for status in fs.listStatus(root))


def is_committed(spark, folder, batch_id):
    fs, path = file_system(spark, f"{folder}/_commits/{batch_id}")
    return fs.exists(path)


def commit(spark, folder, batch_id):
    """Marks a batch as finished; to be called when all its files are written."""
    fs, path = file_system(spark, f"{folder}/_commits/{batch_id}")
    fs.create(path, True).close()


def write_once(rows, folder, batch_id, write):
    """Runs ``write`` for a batch that isn't finished yet and marks it. A replayed batch that is, is left alone."""
    spark = rows.sparkSession
    claim(spark, folder, stream_id(rows))
    if not is_committed(spark, folder, batch_id):
        write()
        commit(spark, folder, batch_id)


def write_batch(rows, folder, batch_id, slices=None):
    """A batch as Parquet in a folder of its own, which a repeated attempt replaces; with ``slices``, in one below each
    value of that column.
    """
    if slices is None:
        store = lambda: rows.write.mode("overwrite").parquet(f"{folder}/batch={batch_id}")
    else:
        sliced = rows.withColumn("batch", F.lit(batch_id)).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        store = lambda: sliced.partitionBy(slices, "batch").parquet(folder)
    write_once(rows, folder, batch_id, store)


def read_batches(spark, folder, schema, paths=None):
    """All rows of the finished batches, with ``batch``; empty without any. A stream finishes its batches in order.

    ``paths`` are the folders below ``folder`` to read, if not all are; no other is listed.
    """
    done = committed(spark, folder)
    full = T.StructType(schema.fields + [T.StructField("batch", T.LongType())])
    if not done or paths is not None and not paths:
        return spark.createDataFrame([], full)
    rows = spark.read.schema(full).option("basePath", folder).parquet(*([folder] if paths is None else [f"{folder}/{p}" for p in paths]))
    return rows.where(F.col("batch") <= done[-1])


def values_of(spark, folder, slices):
    """The whole numbers ``slices`` has folders for, ascending. One listing of names."""
    fs, root = file_system(spark, folder)
    names = [s.getPath().getName() for s in fs.listStatus(root)] if fs.exists(root) else []
    return sorted(int(n.split("=")[1]) for n in names if n.startswith(f"{slices}="))
