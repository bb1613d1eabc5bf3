"""Where streams end: keyed tables, archive folders, a relational table, the log, the console."""

import time

from pyspark import StorageLevel
from pyspark.sql import Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tapewright.functions.times import now_millis, utc_date
from tapewright.operators import quality
from tapewright.operators.keyed import latest_per_key
from tapewright.plans import serving
from tapewright.schemas import ARCHIVE_FOLDERS, ARCHIVE_INDEX, ARCHIVE_ROWS, REJECT, TRADE, TRADE_COLUMNS, TRIGGER
from tapewright.sources.archive import archive_files
from tapewright.streaming import batches

UNKNOWN_SYMBOL = "UNKNOWN"


def upsert_batch(table, rejects_path, unique=False):
    """foreachBatch function: complete rows go to ``table``, rows with NULLs or an event time that no timestamp holds to
    ``rejects_path``; none is dropped.

    Both outputs are folders of batches, so running a batch again adds nothing.
    """
    required = table.schema.fieldNames()
    times = [c for c in ("event_time",) if c in required]

    def write(rows, batch_id):
        rows = rows.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            good, bad = quality.split_complete(rows, required, times)
            table.write_batch(good, batch_id, unique)
            write_rejects(bad.select(F.to_json(F.struct(*required)).alias("value"), "violations"), rejects_path, batch_id)
        finally:
            rows.unpersist()

    return write


def write_rejects(rejects, path, batch_id):
    batches.write_batch(rejects.select("value", "violations"), path, batch_id)


def read_rejects(spark, path):
    """Payload and reasons of all rejected rows below a reject path."""
    return batches.read_batches(spark, path, REJECT).drop("batch")


def archive_rows(trades, event_date=False):
    """Trade rows with the write stamp and the two partition columns.

    ``dt`` is the UTC date of writing, or of the trade with ``event_date``. The symbol stays in the
    file as well, unchanged, and a missing one goes to the UNKNOWN folder.
    """
    stamped = trades.select(*TRADE_COLUMNS, now_millis().alias("written_at"))
    return stamped.select(
        "*",
        utc_date("event_time" if event_date else "written_at").alias("dt"),
        F.coalesce("symbol", F.lit(UNKNOWN_SYMBOL)).alias("symbol_part"),
    ).select(*ARCHIVE_ROWS.fieldNames())


def archive_batch(root, event_date=False, files=8, max_records_per_file=1_000_000):
    """foreachBatch function: appends a flush to ``root/trades/dt=/symbol_part=/batch=/slot=`` as Snappy Parquet,
    exactly once.

    The batch is read from its source once and kept while its rows are counted by folder. With these counts, a folder's
    rows are dealt into slots in proportion to its share of the batch, ``files`` for all of it, so a symbol with most of
    the rows is spread and small ones share a task. A slot is written by one task. An attempt that failed left folders
    of this batch only, which the next one replaces. The flush log and the file index are written with the batch, from
    the counts and a listing: no file is read.
    """

    def write(rows, batch_id):
        folder = f"{root}/trades"
        stamped = archive_rows(rows, event_date).persist(StorageLevel.MEMORY_AND_DISK)

        def store():
            counts = stamped.groupBy("dt", "symbol_part").agg(F.count(F.lit(1)).alias("records")).persist(StorageLevel.MEMORY_AND_DISK)
            try:
                total = counts.agg(F.sum("records")).first()[0] or 1
                slots = F.ceil(F.col("records") * files / total).cast("int")
                sized = counts.select(F.col("dt").alias("_dt"), F.col("symbol_part").alias("_part"), slots.alias("_slots"))
                same = F.col("dt").eqNullSafe(F.col("_dt")) & (F.col("symbol_part") == F.col("_part"))
                slot = F.pmod(F.xxhash64("trade_id", "event_time", "price", "quantity"), F.col("_slots")).cast("int").alias("slot")
                dealt = stamped.join(sized, same).select(*ARCHIVE_ROWS.fieldNames(), slot)
                (
                    dealt.repartition("dt", "symbol_part", "slot").withColumn("batch", F.lit(batch_id))
                    .select(*ARCHIVE_ROWS.fieldNames(), "batch", "slot")
                    .sortWithinPartitions("dt", "symbol_part", "batch", "slot", "event_time")
                    .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").option("compression", "snappy")
                    .option("maxRecordsPerFile", max_records_per_file).partitionBy("dt", "symbol_part", "batch", "slot").parquet(folder)
                )
                in_slots = dealt.groupBy("dt", "symbol_part", "slot").agg(
                    F.count(F.lit(1)).alias("records"), F.max("written_at").alias("flush")
                )
                log_flush(root, batch_id, in_slots, [r.dt for r in counts.select("dt").distinct().collect()], max_records_per_file)
            finally:
                counts.unpersist()

        try:
            batches.write_once(rows, folder, batch_id, store)
        finally:
            stamped.unpersist()

    return write


def ticker_batch(root):
    """foreachBatch function: the change of each closed candle against the one before of its symbol, in ``root/ticker``.

    The newest close of every symbol is kept in ``root/state`` with each batch, one row a symbol, and is what the first
    candle of the next batch is compared with. Closed windows come in order, so nothing older follows.
    """

    def write(rows, batch_id):
        spark, folder = rows.sparkSession, f"{root}/ticker"
        closes = rows.select("symbol", "window_start", "window_end", "close_price").persist(StorageLevel.MEMORY_AND_DISK)

        def store():
            before = batches.committed(spark, folder)
            if before:
                carried = spark.read.schema(closes.schema).parquet(f"{root}/state/batch={before[-1]}")
            else:
                carried = spark.createDataFrame([], closes.schema)
            both = carried.unionByName(closes)
            known = carried.select("symbol", F.unix_millis("window_start").alias("window_start_ms"))
            changes = serving.ticker_changes(both).join(known, ["symbol", "window_start_ms"], "left_anti")
            changes.write.mode("overwrite").parquet(f"{folder}/batch={batch_id}")
            newest = latest_per_key(both, ["symbol"], ["window_start"])
            newest.write.mode("overwrite").parquet(f"{root}/state/batch={batch_id}")

        try:
            batches.write_once(rows, folder, batch_id, store)
        finally:
            closes.unpersist()

    return write


def read_ticker(spark, root):
    """The changes of all finished batches."""
    schema = "symbol string, window_start_ms bigint, price double, previous double, change double, percent double, direction string, price_label string, percent_label string"
    return batches.read_batches(spark, f"{root}/ticker", T.StructType.fromDDL(schema)).drop("batch")


def triggered_archive_batch(root, rows_per_symbol, seconds, clock=time.time, **options):
    """foreachBatch function: rows wait in ``root/pending`` until a symbol has ``rows_per_symbol`` of them or ``seconds``
    have passed since the last flush, or since the start; then all of them are archived as one flush.

    So a flush spans batches of any source, and its size doesn't depend on how the source cuts them. Waiting rows are
    stored, so a restart goes on with them; a batch that comes again neither waits nor is archived twice. What caused a
    flush is kept in ``root/triggers``. ``clock`` tells the seconds; ``options`` are those of :func:`archive_batch`.
    """
    archive, since = archive_batch(root, **options), [clock()]

    def write(rows, batch_id):
        spark, pending = rows.sparkSession, f"{root}/pending"
        batches.write_batch(rows.select(*TRADE_COLUMNS), pending, batch_id)
        flushed = max(batches.committed(spark, f"{root}/trades"), default=-1)
        waiting = batches.read_batches(spark, pending, TRADE).where(F.col("batch") > flushed)
        counts = waiting.groupBy(F.coalesce("symbol", F.lit(UNKNOWN_SYMBOL)).alias("symbol")).agg(F.count(F.lit(1)).alias("records"))
        most, total = counts.agg(F.max("records"), F.sum("records")).first()
        now = clock()
        trigger = "rows" if (most or 0) >= rows_per_symbol else "time" if total and now - since[0] >= seconds else None
        if trigger is None:
            return
        log = spark.createDataFrame([(trigger, most, total)], TRIGGER).coalesce(1)
        log.write.mode("overwrite").parquet(f"{root}/triggers/batch={batch_id}")
        archive(waiting, batch_id)
        since[0] = now
        fs, _ = batches.file_system(spark, pending)
        for number in batches.values_of(spark, pending, "batch"):
            if number <= batch_id:
                fs.delete(batches.file_system(spark, f"{pending}/batch={number}")[1], True)

    return write


def log_flush(root, batch_id, in_slots, dates, max_records_per_file):
    """Adds the files of a flush to ``root/flushes``, with symbol, rows and KB, and to the index ``root/index``.

    ``in_slots`` counts the rows of each slot; files of one slot are full but for the last. Only the folders of the
    flush are listed, those of its ``dates``.
    """
    spark = in_slots.sparkSession
    paths = [f"{root}/trades/dt={d or '__HIVE_DEFAULT_PARTITION__'}/symbol_part=*/batch={batch_id}/slot=*" for d in dates]
    written = archive_files(spark, root, paths) if paths else spark.createDataFrame([], T.StructType(ARCHIVE_INDEX.fields + ARCHIVE_FOLDERS.fields))
    files = written.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        slot = ["dt", "symbol_part", "slot"]
        place = F.row_number().over(Window.partitionBy(*slot).orderBy("key")) - 1
        counted = files.withColumn("place", place).alias("f").join(
            in_slots.alias("s"), F.expr("f.dt <=> s.dt AND f.symbol_part = s.symbol_part AND f.slot = s.slot")
        )
        records = F.least(F.lit(max_records_per_file), F.col("records") - F.col("place") * max_records_per_file).cast("long")
        log = counted.select(
            "flush", F.col("f.symbol_part").alias("symbol"), F.concat(F.lit(f"{root}/"), "key").alias("path"),
            records.alias("records"), F.bround(F.col("length") / 1024.0, 1).alias("size_kb"),
        )
        log.write.mode("overwrite").parquet(f"{root}/flushes/batch={batch_id}")
        (
            files.select(*ARCHIVE_INDEX.fieldNames(), "dt", F.lit(batch_id).alias("batch"))
            .repartition("dt").sortWithinPartitions("dt", "key")
            .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("dt", "batch").parquet(f"{root}/index")
        )
    finally:
        files.unpersist()


def merge_statement(table, staging, columns, keys):
    """Standard MERGE that upserts all rows of ``staging`` into ``table`` by ``keys``."""
    rest = [c for c in columns if c not in keys]
    on = " AND ".join(f"t.{k} = s.{k}" for k in keys)
    return (
        f"MERGE INTO {table} t USING {staging} s ON {on} "
        f"WHEN MATCHED THEN UPDATE SET {', '.join(f'{c} = s.{c}' for c in rest)} "
        f"WHEN NOT MATCHED THEN INSERT ({', '.join(columns)}) VALUES ({', '.join(f's.{c}' for c in columns)})"
    )


def jdbc_upsert_batch(url, table, staging, schema, keys, rejects_path, order_by=(), properties=None, connections=8):
    """foreachBatch function: the batch replaces a staging table, then one MERGE moves it over; rows with NULLs go to
    ``rejects_path``.

    The rows go from the executors to the database; the driver only sends the statement. ``connections`` bounds the
    parallel writers, not the rows.
    """
    columns = schema.fieldNames()
    properties = dict(properties or {})

    def write(rows, batch_id):
        good, bad = quality.split_complete(rows, columns)
        write_rejects(bad.select(F.to_json(F.struct(*columns)).alias("value"), "violations"), rejects_path, batch_id)
        extra = [c for c in order_by if c not in columns]
        one = latest_per_key(good.select(*columns, *extra), keys, [c for c in order_by if c not in keys])
        one.select(*columns).repartition(connections).write.mode("overwrite").option("truncate", "true").jdbc(
            url, staging, properties=properties
        )
        jvm = rows.sparkSession._jvm
        settings = jvm.java.util.Properties()
        for key, value in properties.items():
            settings.setProperty(key, value)
        connection = jvm.java.sql.DriverManager.getConnection(url, settings)
        try:
            connection.createStatement().executeUpdate(merge_statement(table, staging, columns, keys))
        finally:
            connection.close()

    return write
