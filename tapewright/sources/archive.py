"""The trade archive: partitioned Parquet read back, and the listing of its files."""

import re

from pyspark.sql import functions as F
from pyspark.sql import types as T

from tapewright.functions.display import kilobytes
from tapewright.functions.times import iso_utc
from tapewright.operators.keyed import latest_per_key
from tapewright.schemas import ARCHIVE, ARCHIVE_FOLDERS, ARCHIVE_INDEX, FLUSH, LAKE_FILE, TRIGGER
from tapewright.streaming import batches

TRADES_FOLDER, INDEX_FOLDER = "trades", "index"


def _last_flush(spark, root):
    """The newest finished flush, -1 if there is none. Flushes finish in order."""
    return max(batches.committed(spark, f"{root}/{TRADES_FOLDER}"), default=-1)


def read_archive(spark, root, dedupe=False):
    """Archived trades of all finished flushes, with dt, symbol_part and batch; filters on them prune folders.

    ``dedupe`` keeps the last written copy of each trade id; rows without an id have nothing to be a copy of, and all
    stay.
    """
    last = _last_flush(spark, root)
    if last < 0:
        return spark.createDataFrame([], ARCHIVE)
    stored = T.StructType(ARCHIVE.fields + ARCHIVE_FOLDERS.fields[-1:])
    rows = spark.read.schema(stored).parquet(f"{root}/{TRADES_FOLDER}").where(F.col("batch") <= last).select(ARCHIVE.fieldNames())
    if not dedupe:
        return rows
    # One scan: a row without an id is told from its likes by a number that no other has.
    marked = rows.withColumn("_row", F.when(F.col("trade_id").isNull(), F.monotonically_increasing_id()))
    return latest_per_key(marked, ["trade_id", "_row"], ["written_at"]).drop("_row")


def read_flushes(spark, root):
    """The flush log: write stamp, symbol, file, rows and KB of each file, by batch."""
    last = _last_flush(spark, root)
    full = T.StructType(FLUSH.fields + [T.StructField("batch", T.LongType())])
    if last < 0:
        return spark.createDataFrame([], full)
    return spark.read.schema(full).parquet(f"{root}/flushes").where(F.col("batch") <= last)


def read_triggers(spark, root):
    """What caused each finished flush of an archive with triggers of its own, by batch."""
    last = _last_flush(spark, root)
    full = T.StructType(TRIGGER.fields + [T.StructField("batch", T.LongType())])
    if last < 0:
        return spark.createDataFrame([], full)
    return spark.read.schema(full).parquet(f"{root}/triggers").where(F.col("batch") <= last)


def archive_files(spark, root, paths=None):
    """Key, length and modification time of the Parquet files below the archive's trades, with dt, symbol_part, batch and
    slot, as their folders list them; of the folders ``paths`` only, if given. No file is opened: the content column is
    pruned.

    For the flushes themselves, and for checks of their index; queries read the index, see :func:`list_files`.
    """
    base = f"{root.rstrip('/')}/{TRADES_FOLDER}"
    listing = T.StructType.fromDDL("path string, modificationTime timestamp, length bigint, content binary")
    files = (
        spark.read.format("binaryFile").schema(T.StructType(listing.fields + ARCHIVE_FOLDERS.fields))
        .option("basePath", base).option("pathGlobFilter", "*.parquet").load([base] if paths is None else paths)
    )
    fs, top = batches.file_system(spark, root.rstrip("/"))
    # file:/x and file:///x name the same place; the key is what follows the root's full length.
    full = re.sub("^([a-z0-9]+):/+", r"\1:/", fs.makeQualified(top).toString()).rstrip("/")
    path = F.regexp_replace("path", "^([a-z0-9]+):/+", "$1:/")
    key = F.substring(path, F.lit(len(full) + 2), F.length(path)).alias("key")
    return files.select(key, "length", F.col("modificationTime").alias("modified"), *ARCHIVE_FOLDERS.fieldNames())


def _days(spark, root):
    """Names of the folders the index has for the dates of the trades, in key order. One listing of names."""
    fs, top = batches.file_system(spark, f"{root}/{INDEX_FOLDER}")
    names = [s.getPath().getName() for s in fs.listStatus(top)] if fs.exists(top) else []
    return sorted(n for n in names if n.startswith("dt="))


def _indexed(spark, root, days, last):
    """Index rows of the finished flushes, of some dates."""
    full = T.StructType(ARCHIVE_INDEX.fields + [ARCHIVE_FOLDERS["dt"], ARCHIVE_FOLDERS["batch"]])
    if not days or last < 0:
        return spark.createDataFrame([], full)
    base = f"{root}/{INDEX_FOLDER}"
    return spark.read.schema(full).option("basePath", base).parquet(*[f"{base}/{d}" for d in days]).where(F.col("batch") <= last)


def list_files(spark, root, prefix=f"{TRADES_FOLDER}/", max_keys=50, start_after=None, widen=4):
    """The first ``max_keys`` files of finished flushes in key order whose key starts with ``prefix``; with
    ``start_after``, those behind that key, so a caller can page through all.

    Keys come from the index that each flush writes, sorted by key in folders of one date, and dates are in key order
    as well: a page reads the dates from ``start_after`` on until it is full, ``widen`` times as many in each round, and
    within them only row groups that may hold its keys. No folder of the archive is listed.
    """
    if isinstance(max_keys, bool) or not isinstance(max_keys, int) or not 1 <= max_keys <= 200:
        raise ValueError("max_keys must be a whole number between 1 and 200")
    root, after = root.rstrip("/"), start_after or ""
    folder = lambda day: f"{TRADES_FOLDER}/{day}/"
    left = [
        d for d in _days(spark, root)
        if (folder(d).startswith(prefix) or prefix.startswith(folder(d))) and (folder(d) > after or after.startswith(folder(d)))
    ]
    last, wanted = _last_flush(spark, root), F.col("key").startswith(prefix) & (F.col("key") > after)
    chosen, found, size = [], 0, 1
    while left and found < max_keys:
        some, left = left[:size], left[size:]
        chosen, size = chosen + some, size * widen
        if left:  # with nothing left to read, how many there are decides nothing
            found += _indexed(spark, root, some, last).where(wanted).limit(max_keys - found).count()
    return (
        _indexed(spark, root, chosen, last).where(wanted).orderBy("key").limit(max_keys)
        .select("key", kilobytes(F.col("length")).alias("size_kb"), iso_utc("modified").alias("last_modified"))
        .to(LAKE_FILE)
    )
