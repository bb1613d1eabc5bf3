"""Latest row per key, and a Parquet table with upsert semantics built on it."""

import hashlib
from dataclasses import dataclass

from pyspark.sql import functions as F
from pyspark.sql import types as T

from tapewright.functions.times import DAY_MS, floor_div
from tapewright.streaming import batches

BATCH = "batch"
SLICE = "time_slice"
NO_TIME = -(2**62)  # the slice of rows without a time, older than any other


def latest_per_key(rows, keys, version):
    """One row per key: the one with the highest ``version`` columns.

    The maximum of a struct combines per task before the shuffle, so a key with very many copies
    sends one row per task. Equal versions fall to the other columns, so the result never depends
    on row order.
    """
    keys, version = list(keys), list(version)
    rest = [c for c in rows.columns if c not in keys and c not in version]
    best = rows.groupBy(*keys).agg(F.max(F.struct(*version, *rest)).alias("_best"))
    return best.select(*[F.col(c) if c in keys else F.col("_best")[c].alias(c) for c in rows.columns])


def latest_candle(candle_rows):
    """Close and end of the newest candle of each symbol."""
    return candle_rows.groupBy("symbol").agg(
        F.max_by("close_price", "window_end").alias("close_price"), F.max("window_end").alias("window_end")
    )


@dataclass(frozen=True)
class KeyedTable:
    """Upsert table in plain Parquet: idempotent batches, and the latest row of each key on reading.

    ``batch=<id>`` holds the rows of one micro-batch. A later batch beats an earlier one; inside a batch ``order_by``
    decides. A batch counts once the writer has marked it as finished, and a finished batch is never written again, so a
    replay adds nothing. Batch ids are those of one stream checkpoint: a stream with another one is refused.
    ``determined`` names columns that the key fixes, such as the symbol of a trade id; filters on them and on the key
    reach the scan. Rows are sorted by ``cluster_by`` within files, so such filters skip row groups. ``files_per_batch``
    bounds the files of a small batch that comes in many partitions. Merging old batches is left to a table format with
    MERGE behind the same batch function.

    ``slice_by`` names a time that the key fixes, in epoch ms or as a timestamp. Batches are then stored below slices of
    ``slice_ms`` of that time, and :meth:`newest` reads the newest slices only, however long the history is. All
    versions of a key lie in one slice.

    With ``buckets``, the folder is a Spark table bucketed by the key, so all versions of a key are in the files of one
    bucket, and reading resolves them without a shuffle. The table's entry is made in whatever catalog the session has.
    """

    path: str
    schema: T.StructType
    keys: tuple
    order_by: tuple = ()
    cluster_by: tuple = ()
    files_per_batch: int | None = None
    determined: tuple = ()
    slice_by: str | None = None
    slice_ms: int = DAY_MS
    buckets: int | None = None

    def __post_init__(self):
        if self.slice_by is not None and self.slice_by not in self._groups:
            raise ValueError(f"{self.slice_by} must be part of the key or determined by it")

    @property
    def _stored(self):
        names = set(self.schema.fieldNames())
        extra = [T.StructField(c, T.LongType()) for c in self.order_by if c not in names]
        return T.StructType(self.schema.fields + extra)

    @property
    def _groups(self):
        return [*self.keys, *self.determined]

    @property
    def _order(self):
        return [c for c in self.order_by if c not in self._groups]

    def write_batch(self, rows, batch_id, unique=False):
        """Stores one batch. ``unique`` tells that no key occurs twice, which saves the shuffle."""
        rows = rows.select(*self._stored.fieldNames())
        if not unique:
            rows = latest_per_key(rows, self._groups, self._order)
        if self.buckets:
            rows = rows.repartition(self.buckets, *self.keys)  # a file for each bucket
        elif self.files_per_batch:
            # A shuffle and not coalesce, which would also merge the tasks that compute the batch.
            rows = rows.repartition(self.files_per_batch, *self.keys)
        if self.cluster_by:
            rows = rows.sortWithinPartitions(*self.cluster_by)
        if self.slice_by is not None:
            rows = rows.withColumn(SLICE, self._slice())
        if self.buckets:
            batches.write_once(rows, self.path, batch_id, lambda: self._insert(rows.withColumn(BATCH, F.lit(batch_id))))
        else:
            batches.write_batch(rows, self.path, batch_id, SLICE if self.slice_by else None)

    @property
    def _folders(self):
        return [SLICE, BATCH] if self.slice_by else [BATCH]

    def _table(self, spark):
        """The name of the bucketed table over the folder; a catalog that has no such table gets one."""
        name = f"keyed_{hashlib.md5(self.path.encode()).hexdigest()}"
        if not spark.catalog.tableExists(name):
            fields = [(f.name, f.dataType.simpleString()) for f in self._stored.fields] + [(c, "bigint") for c in self._folders]
            quoted = lambda names: ", ".join(f"`{c}`" for c in names)
            spark.sql(
                f"CREATE TABLE IF NOT EXISTS {name} ({', '.join(f'`{c}` {kind}' for c, kind in fields)}) USING parquet "
                f"PARTITIONED BY ({quoted(self._folders)}) CLUSTERED BY ({quoted(self.keys)}) "
                f"SORTED BY ({quoted(self.cluster_by or self.keys)}) INTO {self.buckets} BUCKETS LOCATION '{self.path}'"
            )
            fs, folder = batches.file_system(spark, self.path)
            fs.mkdirs(folder)
            spark.sql(f"ALTER TABLE {name} RECOVER PARTITIONS")
        return name

    def _insert(self, rows):
        """Replaces the folders of a batch. Spark takes the way to overwrite from the session, which gets its own back."""
        conf, key = rows.sparkSession.conf, "spark.sql.sources.partitionOverwriteMode"
        before = conf.get(key)
        conf.set(key, "dynamic")
        try:
            rows.select(*self._stored.fieldNames(), *self._folders).write.insertInto(self._table(rows.sparkSession), overwrite=True)
        finally:
            conf.set(key, before)

    def _versions(self, spark, among):
        """The rows of all finished batches, of some slices if ``among`` names them."""
        if not self.buckets:
            return batches.read_batches(spark, self.path, self._stored, None if among is None else [f"{SLICE}={n}" for n in among])
        done, name = batches.committed(spark, self.path), self._table(spark)
        last = done[-1] if done else -1
        if done and spark.sql(f"SHOW PARTITIONS {name} PARTITION ({BATCH} = {last})").isEmpty():
            spark.sql(f"ALTER TABLE {name} RECOVER PARTITIONS")  # written by an application with another catalog
        rows = spark.table(name).where(F.col(BATCH) <= last)
        return rows if among is None else rows.where(F.col(SLICE).isin(list(among)))

    def _slice(self):
        timestamp = isinstance(self.schema[self.slice_by].dataType, T.TimestampType)
        ms = F.unix_millis(self.slice_by) if timestamp else F.col(self.slice_by)
        return F.coalesce(floor_div(ms, self.slice_ms), F.lit(NO_TIME))

    def read(self, spark, among=None):
        """One current row per key; of the slices ``among`` only, if they are given."""
        rows = self._versions(spark, among)
        return latest_per_key(rows, self._groups, [BATCH, *self._order]).select(*self.schema.fieldNames())

    def newest(self, spark, where, limit, since_ms=None, widen=4):
        """The rows that ``where`` accepts in the newest slices that hold ``limit`` of them, or in all slices if those
        have fewer; none from before ``since_ms``.

        Slices are read newest first, ``widen`` times as many in each round, until there are enough rows. So the files
        read for the newest rows of an active key do not grow with the history; only names of slices are listed.
        """
        if self.slice_by is None:
            raise ValueError("the table is not stored by time")
        first = NO_TIME if since_ms is None else since_ms // self.slice_ms
        left = [n for n in batches.values_of(spark, self.path, SLICE) if n >= first]
        chosen, found, size = [], 0, 1
        while left and found < limit:
            left, some = left[:-size], left[-size:]
            chosen, size = some + chosen, size * widen
            if left:  # with nothing left to read, how many there are decides nothing
                found += self.read(spark, some).where(where).limit(limit - found).count()
        return self.read(spark, chosen).where(where)
