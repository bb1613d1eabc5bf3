"""

Every query reads the whole ``events`` table as a trade stream. Time columns are given as epoch
milliseconds or ISO text, so results do not depend on the session time zone.
"""

from __future__ import annotations

import functools
import math
import time
from collections.abc import Callable

import market_events as ev
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tapewright.functions import display
from tapewright.operators import candles as candle_ops
from tapewright.operators import decode, quality
from tapewright.operators.keyed import KeyedTable, latest_per_key
from tapewright.plans import monitoring, serving, views
from tapewright.schemas import CANDLE, TRADE, TRADE_COLUMNS
from tapewright.session import scratch_dir, streaming_session
from tapewright.sources.archive import archive_files, list_files, read_archive, read_flushes, read_triggers
from tapewright.sources.log import read_messages, stream_parquet
from tapewright.streaming import jobs
from tapewright.streaming.progress import ProgressLog, read_progress
from tapewright.streaming.sinks import read_rejects, read_ticker, upsert_batch

try:  # the operators for training text come as a subpackage that may be left out
    import corpus_pipeline
    from tapewright.llm import queries as text_queries
except ModuleNotFoundError as missing:
    if missing.name not in ("corpus_pipeline", "tapewright.llm"):
        raise
    corpus_pipeline = text_queries = None

HOUR = 3600
SYMBOL = "click"


# --- helpers -----------------------------------------------------------------------------------


def _flat(candle_rows):
    """Candles with epoch-ms bounds."""
    return candle_rows.select(
        "symbol",
        F.unix_millis("window_start").alias("window_start_ms"),
        F.unix_millis("window_end").alias("window_end_ms"),
        "open_price",
        "high_price",
        "low_price",
        "close_price",
        "volume",
        "trade_count",
    )


def _candles(spark, sf_dir, seconds=HOUR):
    return candle_ops.candles(ev.read_trades(spark, sf_dir), seconds)


def _stored(spark, sf_dir):
    return decode.raw_trades(ev.read_trades(spark, sf_dir))


def _feed(spark, sf_dir):
    return ev.feed_messages(ev.read_trades(spark, sf_dir))


def _dirty(spark, sf_dir):
    return ev.dirty_messages(ev.read_trades(spark, sf_dir))


def _event_stream(spark, sf_dir):
    """The events as a stream, in a session of its own with stream settings."""
    session = streaming_session(spark)
    path = ev.events_path(sf_dir)
    return ev.trades_of(stream_parquet(session, path, spark.read.parquet(path).schema))


def _run(query):
    query.awaitTermination()


def _candle_table(path, **more):
    return KeyedTable(path, CANDLE, ("symbol", "window_start"), cluster_by=("symbol", "window_start"), **more)


def _trade_table(path, determined=("symbol",), **more):
    by = {"order_by": ("event_id",), "cluster_by": ("symbol", "event_time")}
    return KeyedTable(path, TRADE, ("trade_id",), determined=determined, **by, **more)


def _once(spark, sf_dir, name, build):
    """What ``build`` stores below a fresh folder, done once per application and input: its result."""
    key = (spark.sparkContext.applicationId, sf_dir, name)
    if key not in _STORED:
        started = time.perf_counter()
        _STORED[key] = build(scratch_dir(spark, name))
        BUILD_SECONDS[name] = time.perf_counter() - started
    USED.add(name)
    return _STORED[key]


_STORED = {}
#: How long each stored input took to make, and which were asked for; the bench reports the first and clears the second.
BUILD_SECONDS, USED = {}, set()


SLICE_ROWS = 250_000  # in a file of a slice


def _slices(spark, sf_dir, trades, folder, numbers, count=5):
    """Adds slices of ``trades`` to ``folder``, each a stretch of time; later stretches get later files. The files of a
    slice: as many as the rows of the largest ask for.
    """
    first, last, rows = trades.agg(F.min("event_time"), F.max("event_time"), F.count(F.lit(1))).first()
    number = F.floor((F.col("event_time") - first) * count / (last - first + 1))
    most = trades.groupBy(number).count().agg(F.max("count")).first()[0] if rows > SLICE_ROWS else rows
    files = math.ceil(most / SLICE_ROWS)
    for n in numbers:
        trades.where(number == n).repartition(files).write.mode("append").parquet(folder)
    return files


def _sliced_stream(spark, folder, schema, files=1):
    """A slice for each batch."""
    return stream_parquet(streaming_session(spark), folder, schema, max_files_per_trigger=files)


def _stored_tables(spark, sf_dir):
    """The candle and trade tables as the streams write them: every window in its last state, every trade."""

    def build(root):
        candle_table = _candle_table(f"{root}/ohlcv", slice_by="window_start")
        trade_table = _trade_table(f"{root}/raw", ("symbol", "event_time"), slice_by="event_time")
        stream, paths = _event_stream(spark, sf_dir), (f"{root}/checkpoints", f"{root}/rejects")
        _run(jobs.start_candles(stream, candle_table, f"{paths[0]}/c", f"{paths[1]}/c", HOUR, "366 days", "update"))
        _run(jobs.start_raw_trades(stream, trade_table, f"{paths[0]}/r", f"{paths[1]}/r"))
        return candle_table, trade_table

    return _once(spark, sf_dir, "served", build)


def _served_candles(spark, sf_dir):
    return _stored_tables(spark, sf_dir)[0].read(spark)


def _served_trades(spark, sf_dir):
    return _stored_tables(spark, sf_dir)[1].read(spark)


def _newest_candles(spark, sf_dir, limit):
    return serving.newest(spark, _stored_tables(spark, sf_dir)[0], SYMBOL, limit)


def _newest_trades(spark, sf_dir, limit):
    return serving.newest(spark, _stored_tables(spark, sf_dir)[1], SYMBOL, limit)


# --- candles -----------------------------------------------------------------------------------


def ohlcv_10s(spark, sf_dir):
    return _flat(_candles(spark, sf_dir, 10))


def ohlcv_1h(spark, sf_dir):
    return _flat(_candles(spark, sf_dir, HOUR))


def ohlcv_1d(spark, sf_dir):
    return _flat(_candles(spark, sf_dir, 24 * HOUR))


def ohlcv_7s(spark, sf_dir):
    return _flat(_candles(spark, sf_dir, 7))


def ohlcv_case_mix(spark, sf_dir):
    trades = ev.read_trades(spark, sf_dir)
    mixed = F.when(F.pmod("event_id", F.lit(2)) == 1, F.upper("symbol")).otherwise(F.col("symbol"))
    return _flat(candle_ops.candles(trades.withColumn("symbol", mixed), HOUR))


def ohlcv_tied_times(spark, sf_dir):
    trades = ev.read_trades(spark, sf_dir)
    floored = F.col("event_time") - F.pmod("event_time", F.lit(HOUR * 1000))
    return _flat(candle_ops.candles(trades.withColumn("event_time", floored), HOUR))


def ohlcv_tied_wide_ids(spark, sf_dir):
    """Tied times with trade numbers beyond the narrow order key for every second trade."""
    trades = ev.read_trades(spark, sf_dir)
    floored = F.col("event_time") - F.pmod("event_time", F.lit(HOUR * 1000))
    number = F.when(F.pmod("event_id", F.lit(2)) == 0, F.lit(9 * 10**18) - F.col("event_id")).otherwise(F.col("event_id"))
    wide = trades.withColumn("event_time", floored).withColumn("trade_id", F.concat_ws("-", "symbol", number))
    return _flat(candle_ops.candles(wide, HOUR))


def ohlcv_tied_same_number(spark, sf_dir):
    """Tied times and numbers that occur twice, in ids of which some are equal but for case."""
    trades = ev.read_trades(spark, sf_dir)
    floored = F.col("event_time") - F.pmod("event_time", F.lit(HOUR * 1000))
    name = F.when(F.pmod("event_id", F.lit(2)) == 1, F.upper("symbol")).otherwise(F.col("symbol"))
    tied = trades.withColumn("event_time", floored).withColumn("symbol", name)
    return _flat(candle_ops.candles(tied.withColumn("trade_id", F.concat_ws("-", "symbol", F.expr("event_id div 2"))), HOUR))


def _tied(trades, trade_id):
    """All trades of an hour at one time, under other ids."""
    floored = F.col("event_time") - F.pmod("event_time", F.lit(HOUR * 1000))
    return trades.withColumns({"event_time": floored, "trade_id": trade_id})


def ohlcv_tied_text_ids(spark, sf_dir):
    """Tied times and ids that end in a text, as hexadecimal ones do."""
    trade_id = F.concat_ws("-", "symbol", F.md5(F.col("event_id").cast("string")))
    return _flat(candle_ops.candles(_tied(ev.read_trades(spark, sf_dir), trade_id), HOUR))


def ohlcv_tied_long_ids(spark, sf_dir):
    """Tied times and numbers that occur three times, in ids that differ behind a long common start."""
    parts = F.lit("an-exchange-with-a-long-name"), F.md5(F.col("event_id").cast("string")), F.expr("event_id div 3")
    return _flat(candle_ops.candles(_tied(ev.read_trades(spark, sf_dir), F.concat_ws("-", *parts)), HOUR))


def ohlcv_null_price(spark, sf_dir):
    """Two of three trades without a price; they count, but set no price."""
    trades = ev.read_trades(spark, sf_dir)
    return _flat(candle_ops.candles(trades.withColumn("price", F.when(F.pmod("event_id", F.lit(3)) == 0, F.col("price"))), HOUR))


def feed_to_candles(spark, sf_dir):
    return _flat(candle_ops.candles(decode.normalize_feed(_feed(spark, sf_dir)), HOUR))


# --- decode and quality ------------------------------------------------------------------------


def normalize_exchange_trades(spark, sf_dir):
    return decode.normalize_feed(_feed(spark, sf_dir))


def feed_rejects(spark, sf_dir):
    """Feed messages that are no event, and trades with unusable members."""
    bad = decode.feed_rejects(_feed(spark, sf_dir), carry=["event_id"])
    return bad.select("event_id", F.array_join("violations", ",").alias("violations"))


def lenient_decode(spark, sf_dir):
    return decode.decode_trades(_dirty(spark, sf_dir), carry=["event_id"])


def archive_decode(spark, sf_dir):
    checked = decode.decode_with_rejects(_dirty(spark, sf_dir), carry=["event_id"])
    return checked.select("event_id", *TRADE_COLUMNS, F.array_join("violations", ",").alias("violations"))


def symbol_universe(spark, sf_dir):
    return decode.select_symbols(ev.read_trades(spark, sf_dir), " Click, VIEW,,purchase ").select(*TRADE_COLUMNS)


def symbol_universe_table(spark, sf_dir):
    trades = ev.read_trades(spark, sf_dir)
    wanted = trades.where(F.col("price") > 489).select(F.upper("symbol").alias("symbol"))
    return decode.select_symbols(trades, wanted).select(*TRADE_COLUMNS)


def raw_trades_projection(spark, sf_dir):
    return _stored(spark, sf_dir)


def serialize_trades(spark, sf_dir):
    return decode.serialize_trades(ev.read_trades(spark, sf_dir))


def _violations(messages, rules):
    checked = quality.violations(messages, rules)
    return checked.select("event_id", F.array_join("violations", ",").alias("violations"))


def trade_violations(spark, sf_dir):
    return _violations(_dirty(spark, sf_dir), quality.TRADE_RULES)


def quote_violations(spark, sf_dir):
    return _violations(ev.quote_messages(ev.read_trades(spark, sf_dir)), quality.QUOTE_RULES)


def quarantine_split(spark, sf_dir):
    return quality.split_records(_dirty(spark, sf_dir)).select("event_id", "outcome")


def violation_counts(spark, sf_dir):
    return quality.violation_counts(quality.violations(_dirty(spark, sf_dir)))


# --- keyed tables ------------------------------------------------------------------------------


def _reissued(trades):
    """Ids that repeat every 5000 events, so a later event is a new version of an earlier trade."""
    again = F.concat_ws("-", "symbol", F.pmod("event_id", F.lit(5000)))
    return trades.withColumn("trade_id", again)


def raw_trades_upsert(spark, sf_dir):
    rows = decode.raw_trades(_reissued(ev.read_trades(spark, sf_dir)), carry=["event_id"])
    return latest_per_key(rows, ["trade_id"], ["event_id"]).select(*TRADE_COLUMNS)


def candles_upsert(spark, sf_dir):
    """Candles of two window lengths that start together: the longer one replaces the shorter."""
    trades = ev.read_trades(spark, sf_dir)
    hour = candle_ops.candles(trades, HOUR).withColumn("version", F.lit(1))
    day = candle_ops.candles(trades, 24 * HOUR).withColumn("version", F.lit(2))
    both = latest_per_key(hour.unionByName(day), ["symbol", "window_start"], ["version"])
    return _flat(both)


def keyed_table_roundtrip(spark, sf_dir):
    """All trades in three upsert batches, one of them replayed; read back."""
    rows = decode.raw_trades(_reissued(ev.read_trades(spark, sf_dir)), carry=["event_id"])
    table = _trade_table(scratch_dir(spark, "keyed"))
    cycle = F.floor(F.pmod("event_id", F.lit(15000)) / 5000)
    for batch in (0, 1, 1, 2):
        table.write_batch(rows.where(cycle == batch), batch)
    return table.read(spark)


def keyed_table_bucketed(spark, sf_dir):
    """The same batches in a table bucketed by trade id, which resolves versions without a shuffle."""
    rows = decode.raw_trades(_reissued(ev.read_trades(spark, sf_dir)), carry=["event_id"])
    table = _trade_table(scratch_dir(spark, "bucketed"), buckets=8)
    cycle = F.floor(F.pmod("event_id", F.lit(15000)) / 5000)
    for batch in (0, 1, 1, 2):
        table.write_batch(rows.where(cycle == batch), batch)
    return table.read(spark)


# --- serving -----------------------------------------------------------------------------------


def symbols(spark, sf_dir):
    return serving.symbols(_served_candles(spark, sf_dir))


def candles_last_n(spark, sf_dir):
    return serving.candles(_newest_candles(spark, sf_dir, 60), SYMBOL, 60)


def latest_trades(spark, sf_dir):
    return serving.latest_trades(_newest_trades(spark, sf_dir, 50), SYMBOL, 50)


def serving_stats(spark, sf_dir):
    return serving.pipeline_stats(_served_candles(spark, sf_dir), _served_trades(spark, sf_dir))


def approx_distinct(spark, sf_dir):
    """Users and trade times from daily sketches against exact counts, which they have to meet within four standard
    deviations.
    """
    trades = ev.read_trades(spark, sf_dir).withColumn("day", F.col("event_time").cast("long") - F.pmod("event_time", F.lit(24 * HOUR * 1000)))
    found = []
    for column in ("user_id", "event_time", "symbol"):
        guess = serving.sketched_count(serving.sketches(trades, "day", column))
        exact = trades.agg(F.count_distinct(column).alias("exact"))
        near = F.abs(F.col("approx_distinct") - F.col("exact")) <= F.ceil(F.col("exact") * 4 * 0.013)
        both = guess.unionByName(exact, allowMissingColumns=True).agg(*[F.max(c).alias(c) for c in ("approx_distinct", "exact")])
        found.append(both.select(F.lit(column).alias("counted"), "exact", near.alias("near")))
    return functools.reduce(DataFrame.unionByName, found)


def limit_checks(spark, sf_dir):
    """Which of the limits from -10 to 509 that the events make the lookups take: 1 to 200 for trades, 1 to 500 for
    candles.
    """

    def taken(limit, highest):
        try:
            return serving.check_limit(limit, highest) == limit
        except ValueError:
            return False

    wanted = ev.read_trades(spark, sf_dir).select((F.pmod("event_id", F.lit(520)) - 10).alias("n")).distinct().collect()  # 520 at most
    rows = [(r.n, taken(r.n, 200), taken(r.n, 500)) for r in wanted]
    return spark.createDataFrame(rows, "n bigint, for_trades boolean, for_candles boolean")


def latest_prices(spark, sf_dir):
    return serving.latest_prices(_served_candles(spark, sf_dir))


def price_message(spark, sf_dir):
    return serving.price_message(_served_candles(spark, sf_dir))


def ticker_changes(spark, sf_dir):
    return serving.ticker_changes(_served_candles(spark, sf_dir)).withColumns(
        {"change": F.round("change", 6), "percent": F.round("percent", 6)}
    )


def chart_series(spark, sf_dir):
    return serving.chart_series(_newest_candles(spark, sf_dir, 120), SYMBOL, 120)


def trades_since(spark, sf_dir):
    """A caller that polls: the newest trades of the last two days, by a bound that reaches the scan."""
    trades = _stored_tables(spark, sf_dir)[1].read(spark)
    since = trades.agg(F.max("event_time")).first()[0] - 2 * 24 * HOUR * 1000
    return serving.latest_trades(serving.newest(spark, _stored_tables(spark, sf_dir)[1], SYMBOL, 200, since), SYMBOL, 200, since)


def trade_tape(spark, sf_dir):
    return serving.trade_tape(_newest_trades(spark, sf_dir, 30), SYMBOL, 30)


def sql_views(spark, sf_dir):
    """Plain SQL over the registered tables, in a session of its own."""
    session = spark.newSession()
    session.conf.set("spark.sql.shuffle.partitions", spark.conf.get("spark.sql.shuffle.partitions"))
    candle_table, trade_table = _stored_tables(spark, sf_dir)
    views.register(candle_table.read(session), trade_table.read(session))
    return session.sql(
        """
        SELECT l.symbol, l.close_price, unix_millis(l.window_end) AS window_end_ms, c.candles, t.trades
        FROM latest_ohlcv l
        JOIN (SELECT symbol, count(*) AS candles FROM ohlcv GROUP BY symbol) c ON c.symbol = l.symbol
        JOIN (SELECT symbol, count(*) AS trades FROM raw_trades GROUP BY symbol) t ON t.symbol = l.symbol
        ORDER BY l.symbol
        """
    )


# --- monitoring --------------------------------------------------------------------------------


def lag_report(spark, sf_dir):
    trades = ev.read_trades(spark, sf_dir)
    offsets = trades.groupBy(F.pmod("user_id", F.lit(3)).cast("int").alias("partition")).agg(
        F.max("event_id").alias("latest"),
        F.max(F.when(F.col("user_id") < 100, F.col("event_id"))).alias("committed"),
    )
    return monitoring.lag_report(offsets.withColumn("consumer", F.lit("archive"))).select(
        "consumer", "partition", "latest", "committed", "lag", "total_lag", "max_lag"
    )


def _flushed(spark, sf_dir):
    """An archive of five flushes, each a stretch of time."""

    def build(root):
        trades = ev.read_trades(spark, sf_dir)
        files = _slices(spark, sf_dir, trades, f"{root}/in", range(5))
        stream = _sliced_stream(spark, f"{root}/in", trades.schema, files)
        log = ProgressLog(stream.sparkSession, f"{root}/progress").watch()
        query = jobs.start_archive(stream, root, f"{root}/checkpoint")
        _run(query)
        log.wait(query)
        log.close()
        return root

    return _once(spark, sf_dir, "flushed", build)


def flush_totals(spark, sf_dir):
    """Rows and running total of the five flushes of an archive, numbered in order."""
    totals = monitoring.flush_totals(monitoring.flush_counts(read_flushes(spark, _flushed(spark, sf_dir))))
    number = F.row_number().over(Window.orderBy("flush")).cast("long")  # one row a flush
    return totals.select((number - 1).alias("flush"), "written", "symbols", "total_written")


def flush_triggers(spark, sf_dir):
    """An archive over ten slices that flushes at a quarter of the largest symbol's rows or after 60 seconds, by a clock
    that first goes on 25 seconds a slice, then 70: the flushes, what caused them, their rows by symbol.
    """

    def build(root):
        trades = ev.read_trades(spark, sf_dir)
        most = trades.groupBy("symbol").count().agg(F.max("count")).first()[0]
        files = _slices(spark, sf_dir, trades, f"{root}/in", range(10), 10)
        stream = _sliced_stream(spark, f"{root}/in", trades.schema, files)
        times = iter([0, *(25 * k for k in range(5)), *(100 + 70 * k for k in range(1, 99))])
        paths = root, f"{root}/checkpoint"
        _run(jobs.start_triggered_archive(stream, *paths, rows_per_symbol=most // 4, clock=lambda: next(times)))
        return root

    root = _once(spark, sf_dir, "triggers", build)
    by_symbol = read_archive(spark, root).groupBy("batch", F.col("symbol_part").alias("symbol")).agg(F.count(F.lit(1)).alias("records"))
    return by_symbol.join(read_triggers(spark, root).drop("records"), "batch").select("batch", "trigger", "most", "symbol", "records")


def flush_lag(spark, sf_dir):
    """Rows and times of five flushes as the stream reported them, and the rows each of them left unread."""
    reports = read_progress(spark, f"{_flushed(spark, sf_dir)}/progress")
    found = monitoring.flush_lag(reports, spark.read.parquet(ev.events_path(sf_dir)).count())
    return found.select("batch", "rows", "first_ms", "last_ms", "written", "lag")


def flush_log(spark, sf_dir):
    """Each flush and symbol: rows from the flush log, and whether its files and KB are those that the folders hold."""
    root = _flushed(spark, sf_dir)
    stored = archive_files(spark, root).select("key", F.bround(F.col("length") / 1024.0, 1).alias("stored_kb"))
    log = read_flushes(spark, root).withColumn("key", F.substring_index("path", f"{root}/", -1))
    both = log.join(stored, "key", "full").groupBy("batch", "symbol")
    return both.agg(
        F.sum("records").alias("records"), (F.count("path") > 0).alias("has_files"),
        F.bool_and(F.coalesce(F.col("size_kb") == F.col("stored_kb"), F.lit(False))).alias("sizes_match"),
    )


# --- streams -----------------------------------------------------------------------------------


def stream_ohlcv_closed(spark, sf_dir):
    """Append mode with the default delay: closed candles only, through the keyed table."""
    root = scratch_dir(spark, "candles")
    table = _candle_table(f"{root}/table")
    _run(jobs.start_candles(_event_stream(spark, sf_dir), table, f"{root}/checkpoint", f"{root}/rejects", HOUR))
    return _flat(table.read(spark))


def stream_open_windows(spark, sf_dir):
    """Append mode stopped at the end of the trades: the closed candles, and from its state those still open."""
    root, state = scratch_dir(spark, "open"), []
    for plain in (True, False):
        table = _candle_table(f"{root}/table-{plain}")
        names = [f"{root}/{name}-{plain}" for name in ("checkpoint", "rejects")]
        _run(jobs.start_candles(_event_stream(spark, sf_dir), table, *names, HOUR, plain_ids=plain))
        rows = {"closed": table.read(spark), "open": candle_ops.open_candles(spark, names[0], HOUR, plain)}
        state += [_flat(r).select("*", F.lit(k).alias("state"), F.lit(plain).alias("plain_ids")) for k, r in rows.items()]
    return functools.reduce(DataFrame.unionByName, state)


def stream_ticker(spark, sf_dir):
    """The ticker's changes from a stream of five batches, each compared with the closes that the one before left."""
    root, trades = scratch_dir(spark, "ticker"), ev.read_trades(spark, sf_dir)
    files = _slices(spark, sf_dir, trades, f"{root}/in", range(5))
    stream = _sliced_stream(spark, f"{root}/in", trades.schema, files)
    _run(jobs.start_ticker(stream, root, f"{root}/checkpoint", HOUR, plain_ids=True))
    return read_ticker(spark, root).withColumns({"change": F.round("change", 6), "percent": F.round("percent", 6)})


def stream_positions(spark, sf_dir):
    """A stream that starts at the first of three slices at hand, ends, and goes on behind them when there are five:
    rows and times of each batch as it reported them.
    """

    def build(root):
        trades = ev.read_trades(spark, sf_dir)
        table = _trade_table(f"{root}/table")
        for numbers in (range(3), range(3, 5)):
            files = _slices(spark, sf_dir, trades, f"{root}/in", numbers)
            stream = _sliced_stream(spark, f"{root}/in", trades.schema, files)
            log = ProgressLog(stream.sparkSession, f"{root}/progress").watch()
            query = jobs.start_raw_trades(stream, table, f"{root}/checkpoint", f"{root}/rejects")
            _run(query)
            log.wait(query)
            log.close()
        return f"{root}/progress"

    return read_progress(spark, _once(spark, sf_dir, "positions", build)).where("rows > 0").select("batch", "rows", "first_ms", "last_ms")


def stream_idle(spark, sf_dir):
    """Two sources, one of which has no more trades after the first fifth of the time: windows close all the same."""
    root, trades = scratch_dir(spark, "idle"), ev.read_trades(spark, sf_dir)
    first, last = trades.agg(F.min("event_time"), F.max("event_time")).first()
    early = F.floor((F.col("event_time") - first) * 5 / (last - first + 1)) == 0
    quiet = F.pmod("user_id", F.lit(2)) == 0
    trades.where(quiet & early).write.parquet(f"{root}/quiet")
    files = _slices(spark, sf_dir, trades.where(~quiet), f"{root}/in", range(5))
    session = streaming_session(spark)
    busy = stream_parquet(session, f"{root}/in", trades.schema, max_files_per_trigger=files)
    table = _candle_table(f"{root}/table")
    both = busy.unionByName(stream_parquet(session, f"{root}/quiet", trades.schema))
    _run(jobs.start_candles(both, table, f"{root}/checkpoint", f"{root}/rejects", HOUR, plain_ids=True))
    return _flat(table.read(spark))


def stream_restart(spark, sf_dir):
    """Append mode over five files in time order, ended after three and started again from its checkpoint."""
    root, trades = scratch_dir(spark, "restart"), ev.read_trades(spark, sf_dir)
    table = _candle_table(f"{root}/table")
    for numbers in (range(3), range(3, 5)):
        files = _slices(spark, sf_dir, trades, f"{root}/in", numbers)
        stream = _sliced_stream(spark, f"{root}/in", trades.schema, files)
        _run(jobs.start_candles(stream, table, f"{root}/checkpoint", f"{root}/rejects", HOUR))
    return _flat(table.read(spark))


def stream_late(spark, sf_dir):
    """Every 50th trade comes last, as do all of the last stretch: what the watermark has passed misses its candle."""
    root, trades = scratch_dir(spark, "late"), ev.read_trades(spark, sf_dir)
    late = F.pmod("event_id", F.lit(50)) == 0
    punctual = trades.where(~late)
    files = _slices(spark, sf_dir, punctual, f"{root}/in", range(5))
    trades.where(late).repartition(files).write.mode("append").parquet(f"{root}/in")
    table = _candle_table(f"{root}/table")
    stream = _sliced_stream(spark, f"{root}/in", trades.schema, files)
    _run(jobs.start_candles(stream, table, f"{root}/checkpoint", f"{root}/rejects", HOUR))
    return _flat(table.read(spark))


def _revised(spark, sf_dir, change=lambda trades: trades, **options):
    """Hourly candles in update mode over files that each span the whole time, so every batch revises most of them."""

    def build(root):
        slices = ev.read_trades(spark, sf_dir).withColumn("slice", F.pmod("event_id", F.lit(7)))
        slices.write.partitionBy("slice").parquet(root)
        return root

    staged = _once(spark, sf_dir, "slices", build)
    root = scratch_dir(spark, "revised")
    files = len(spark.read.parquet(staged).inputFiles())
    session = streaming_session(spark)
    schema = T.StructType(TRADE.fields + [T.StructField("event_id", T.LongType()), T.StructField("slice", T.IntegerType())])
    trades = change(stream_parquet(session, staged, schema, max_files_per_trigger=math.ceil(files / 7)))
    table = _candle_table(f"{root}/table")
    _run(jobs.start_candles(trades, table, f"{root}/checkpoint", f"{root}/rejects", HOUR, "366 days", "update", **options))
    return _flat(table.read(spark))


def stream_ohlcv_update(spark, sf_dir):
    """Update mode with plain ids, which a stream aggregates by hashing."""
    return _revised(spark, sf_dir, plain_ids=True)


def stream_tied_text_ids(spark, sf_dir):
    """Update mode over tied times and ids that end in a text."""
    return _revised(spark, sf_dir, lambda t: _tied(t, F.concat_ws("-", "symbol", F.md5(F.col("event_id").cast("string")))))


def stream_raw_upsert(spark, sf_dir):
    root = scratch_dir(spark, "raw")
    table = _trade_table(f"{root}/table")
    _run(jobs.start_raw_trades(_reissued(_event_stream(spark, sf_dir)), table, f"{root}/checkpoint", f"{root}/rejects"))
    return table.read(spark)


def stream_replay(spark, sf_dir):
    """A stream of five batches, after which its first and last batches come once more."""
    root, trades = scratch_dir(spark, "replay"), ev.read_trades(spark, sf_dir)
    files = _slices(spark, sf_dir, trades, f"{root}/in", range(5))
    table = _trade_table(f"{root}/table")
    _run(jobs.start_raw_trades(_sliced_stream(spark, f"{root}/in", trades.schema, files), table, f"{root}/checkpoint", f"{root}/rejects"))
    again = upsert_batch(table, f"{root}/rejects")
    for batch_id in (0, 4):
        again(decode.raw_trades(trades, carry=["event_id"]).withColumn("price", F.lit(0.0)), batch_id)
    return table.read(spark)


def pipeline_rejects(spark, sf_dir):
    """What the whole pipeline can't store: trades without a price, a time or a symbol, candles without a price or a
    symbol.
    """
    root, trades = scratch_dir(spark, "rejects"), _event_stream(spark, sf_dir)
    broken = trades.withColumns(
        {
            "price": F.when(F.floor(F.col("event_time") / (HOUR * 1000)) % 20 != 0, F.col("price")),
            "symbol": F.when(F.pmod("event_id", F.lit(29)) != 0, F.col("symbol")),
            "event_time": F.when(F.pmod("event_id", F.lit(37)) != 0, F.col("event_time")),
        }
    )
    tables = _candle_table(f"{root}/ohlcv"), _trade_table(f"{root}/raw")
    for query in jobs.start_pipeline(broken, *tables, f"{root}/checkpoints", f"{root}/rejects", window_seconds=HOUR):
        _run(query)
    found = [read_rejects(spark, f"{root}/rejects/{kind}").withColumn("kind", F.lit(kind)) for kind in ("raw", "candles")]
    both = found[0].unionByName(found[1]).withColumn("violations", F.array_join("violations", ","))
    return both.groupBy("kind", "violations").agg(F.count(F.lit(1)).alias("records"))


def _archived(spark, sf_dir):
    """An archive by event date, of trades of which some have no symbol."""

    def build(root):
        symbol = F.when(F.pmod("event_id", F.lit(29)) != 0, F.col("symbol"))
        trades = _event_stream(spark, sf_dir).withColumn("symbol", symbol)
        _run(jobs.start_archive(trades, root, f"{root}/checkpoint", event_date=True))
        return root

    return _once(spark, sf_dir, "archive", build)


def stream_archive_roundtrip(spark, sf_dir):
    """The archive read back; a trade without a symbol is in the UNKNOWN folder. Write stamps are there, their values
    vary.
    """
    stamped = (F.col("written_at") > F.col("event_time")).alias("stamped")
    return read_archive(spark, _archived(spark, sf_dir)).select(*TRADE_COLUMNS, "dt", "symbol_part", stamped)


def archive_flushes(spark, sf_dir):
    """Rows per symbol of the one flush that archives everything at hand, from the flush log."""
    return monitoring.flush_counts(read_flushes(spark, _archived(spark, sf_dir))).select("symbol", "records")


def _pages(spark, root, prefix="trades/"):
    """All files of a prefix, page by page."""
    pages, after = None, None
    while True:
        page = list_files(spark, root, prefix, max_keys=200, start_after=after)
        after = page.agg(F.max("key")).first()[0]
        if after is None and pages is not None:
            return pages
        pages = page if pages is None else pages.unionByName(page)
        if after is None:
            return pages


def lake_files(spark, sf_dir):
    """All files of the archive, page by page, by folder, as names vary; sizes against those of a walk of the folders."""
    root = _archived(spark, sf_dir)
    walked = archive_files(spark, root).select(F.col("key").alias("walked"), F.bround(F.col("length") / 1024.0, 2).alias("kb"))
    both = _pages(spark, root).join(walked, F.col("key") == F.col("walked"), "full")
    parts = [F.regexp_extract(F.coalesce("key", "walked"), "^trades/dt=([^/]+)/symbol_part=([^/]+)/batch=0/", k) for k in (1, 2)]
    return both.groupBy(parts[0].alias("dt"), parts[1].alias("symbol")).agg(
        (F.count("key") > 0).alias("has_files"), F.bool_and(F.coalesce(F.col("size_kb") == F.col("kb"), F.lit(False))).alias("has_size")
    )


def lake_files_day(spark, sf_dir):
    """The symbols with files on the first day, listed by that day's prefix."""
    root = _archived(spark, sf_dir)
    day = read_archive(spark, root).agg(F.min("dt")).first()[0]
    files = _pages(spark, root, f"trades/dt={day}/")
    symbol = F.regexp_extract("key", f"^trades/dt={day}/symbol_part=([^/]+)/batch=0/", 1)
    return files.select(F.lit(day).alias("dt"), symbol.alias("symbol")).distinct()


def size_labels(spark, sf_dir):
    """File sizes in KB as the listing shows them, of lengths made from the events."""
    events = spark.read.parquet(ev.events_path(sf_dir))
    length = (F.col("event_id") * 37 + F.col("user_id") * 128).alias("length")
    return events.select("event_id", length).select("event_id", "length", display.kilobytes(F.col("length")).alias("size_kb"))


def stream_publish_decode(spark, sf_dir):
    """Exchange messages through the publishing stream and back through the lenient decode."""
    root = scratch_dir(spark, "published")
    messages = ev.feed_messages(_event_stream(spark, sf_dir))
    _run(jobs.start_publish(messages, f"{root}/checkpoint", "text", {"path": f"{root}/log"}))
    return decode.decode_trades(read_messages(spark, f"{root}/log"))


_QUERIES = [
    ohlcv_10s,
    ohlcv_1h,
    ohlcv_1d,
    ohlcv_7s,
    ohlcv_case_mix,
    ohlcv_tied_times,
    ohlcv_tied_wide_ids,
    ohlcv_tied_same_number,
    ohlcv_tied_text_ids,
    ohlcv_tied_long_ids,
    ohlcv_null_price,
    feed_to_candles,
    normalize_exchange_trades,
    feed_rejects,
    lenient_decode,
    archive_decode,
    symbol_universe,
    symbol_universe_table,
    raw_trades_projection,
    serialize_trades,
    trade_violations,
    quote_violations,
    quarantine_split,
    violation_counts,
    raw_trades_upsert,
    candles_upsert,
    keyed_table_roundtrip,
    keyed_table_bucketed,
    symbols,
    candles_last_n,
    latest_trades,
    trades_since,
    serving_stats,
    approx_distinct,
    limit_checks,
    latest_prices,
    price_message,
    ticker_changes,
    chart_series,
    trade_tape,
    sql_views,
    lag_report,
    flush_totals,
    flush_lag,
    flush_log,
    flush_triggers,
    stream_ohlcv_closed,
    stream_open_windows,
    stream_ticker,
    stream_positions,
    stream_idle,
    stream_restart,
    stream_late,
    stream_ohlcv_update,
    stream_tied_text_ids,
    stream_raw_upsert,
    stream_replay,
    pipeline_rejects,
    stream_archive_roundtrip,
    archive_flushes,
    lake_files,
    lake_files_day,
    size_labels,
    stream_publish_decode,
]


def entry(spark: SparkSession) -> DataFrame:
    """Hourly candles of the smallest data set."""
    return ohlcv_1h(spark, "/root/testdata/sf0.001")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    found = {q.__name__: q for q in _QUERIES}
    if text_queries:
        found |= text_queries.QUERIES | {"pipeline": corpus_pipeline.run}
    return found


# --- SQL counterparts --------------------------------------------------------------------------

_TRADES = """
SELECT event_type || '-' || event_id AS trade_id, event_type AS symbol, value AS price,
       (CAST(props::JSON->>'$.k' AS BIGINT) + 1) / 100.0::DOUBLE AS quantity,
       CASE WHEN user_id % 2 = 0 THEN 'sell' ELSE 'buy' END AS side,
       epoch_us(ts) // 1000 AS event_time, event_id, user_id
FROM events
"""


def _ohlcv_sql(seconds, source="trades", seq="event_id", body=_TRADES, extra=""):
    ms = seconds * 1000
    return f"""
WITH trades AS ({body}){extra}
SELECT upper(symbol) AS symbol, event_time - event_time % {ms} AS window_start_ms,
       event_time - event_time % {ms} + {ms} AS window_end_ms,
       arg_min(price, (event_time, {seq})) AS open_price, max(price) AS high_price, min(price) AS low_price,
       arg_max(price, (event_time, {seq})) AS close_price, round(sum(quantity), 6) AS volume,
       count(*) AS trade_count
FROM {source}
GROUP BY ALL
"""


def _with_candles(select, seconds=HOUR):
    return f"WITH candles AS ({_ohlcv_sql(seconds)}), stored AS (SELECT * REPLACE (upper(symbol) AS symbol) FROM ({_TRADES}))\n{select}"


# Messages with text behind their object.
_TAIL = "(event_id % 61 = 0 OR event_id % 59 = 0 OR event_id % 53 = 0 OR event_id % 47 = 0)"
_FEED_TRADES = f"""
SELECT * FROM ({_TRADES}) WHERE symbol <> 'error' AND NOT {_TAIL} AND event_id % 43 <> 0 AND event_id % 41 <> 0
"""

_NAMELESS = f"SELECT * REPLACE (CASE WHEN event_id % 29 <> 0 THEN symbol END AS symbol) FROM ({_TRADES})"

# What the watermark lets into hourly candles if every 50th trade comes in a sixth file. A batch is held against the
# watermark of the
# batch before, so the sixth against the latest time of the first four.
_PUNCTUAL = f"""
WITH all_trades AS ({_TRADES}), punctual AS (SELECT * FROM all_trades WHERE event_id % 50 <> 0),
     span AS (SELECT min(event_time) AS first, max(event_time) AS last FROM punctual),
     passed AS (SELECT max(event_time) - 5000 AS mark FROM punctual, span WHERE (event_time - first) * 5 // (last - first + 1) <= 3)
SELECT * FROM all_trades
WHERE event_id % 50 <> 0 OR event_time - event_time % 3600000 + 3600000 > (SELECT mark FROM passed)
"""

_DIRTY_CASE = f"""
CASE WHEN event_id % 97 = 0 OR {_TAIL} THEN 'broken' WHEN event_id % 89 = 0 THEN 'negative'
     WHEN event_id % 83 = 0 THEN 'hold' WHEN event_id % 79 = 0 THEN 'extra'
     WHEN event_id % 73 = 0 THEN 'short' WHEN event_id % 71 = 0 THEN 'untimed'
     WHEN event_id % 67 = 0 THEN 'quoted' ELSE 'clean' END
"""

_DIRTY_ROWS = f"""
SELECT event_id, trade_id, CASE WHEN defect = 'short' THEN 'ab' ELSE symbol END AS symbol,
       CASE WHEN defect = 'negative' THEN -price ELSE price END AS price, quantity,
       CASE WHEN defect = 'hold' THEN 'hold' ELSE side END AS side,
       CASE WHEN defect <> 'untimed' THEN event_time END AS event_time, defect
FROM (SELECT *, {_DIRTY_CASE} AS defect FROM ({_TRADES}))
"""

# Reasons in member order, so that several join as the query joins them.
_TRADE_REASON = """
CASE WHEN defect = 'broken' THEN 'record:object' ELSE concat_ws(',',
     CASE WHEN defect = 'untimed' THEN 'event_time:required' END,
     CASE WHEN defect = 'quoted' THEN 'price:type' WHEN price <= 0 THEN 'price:range' END,
     CASE WHEN defect = 'extra' THEN 'record:extra' END,
     CASE WHEN defect = 'hold' THEN 'side:enum' END,
     CASE WHEN defect = 'short' THEN 'symbol:length' END) END
"""

_REISSUED_LATEST = f"""
SELECT trade_id, upper(symbol) AS symbol, price, quantity, side, event_time
FROM (SELECT * REPLACE (symbol || '-' || event_id % 5000 AS trade_id) FROM ({_TRADES}))
QUALIFY row_number() OVER (PARTITION BY trade_id ORDER BY event_id DESC) = 1
"""

# Ids that repeat every 5000 events, in batches of which later ones win.
_CYCLES = f"""
SELECT trade_id, upper(symbol) AS symbol, price, quantity, side, event_time
FROM (SELECT * REPLACE (symbol || '-' || event_id % 5000 AS trade_id) FROM ({_TRADES}))
QUALIFY row_number() OVER (PARTITION BY trade_id ORDER BY event_id % 15000 // 5000 DESC, event_id DESC) = 1
"""

_TRADE_LIST = "trade_id, symbol, price, quantity, side, event_time"
_ISO = "strftime(make_timestamp({} * 1000), '%Y-%m-%dT%H:%M:%S') || '+00:00'"
_LABEL = "CASE WHEN {0} < 10 THEN format('{{:,.4f}}', round({0}, 4)) ELSE format('{{:,.2f}}', round({0}, 2)) END"
_FLOORED = f"SELECT * REPLACE (event_time - event_time % 3600000 AS event_time) FROM ({_TRADES})"


# The stretch of time, of five, that a trade belongs to.
_SPAN = f"SELECT min(event_time) AS first, max(event_time) AS last FROM ({_TRADES})"
_FLUSH = "(event_time - first) * 5 // (last - first + 1)"


# Every second user goes quiet after the first fifth of the time.
_QUIET = f"SELECT t.* FROM ({_TRADES}) t, ({_SPAN}) WHERE user_id % 2 = 1 OR {_FLUSH} = 0"


def _ticker_sql(where=""):
    return _with_candles(
        f"""
SELECT symbol, window_start_ms, price, previous, round(price - previous, 6) AS change, round(percent, 6) AS percent,
       CASE WHEN price >= previous THEN 'up' ELSE 'down' END AS direction, {_LABEL.format('price')} AS price_label,
       CASE WHEN price >= previous THEN '+' ELSE '-' END || format('{{:,.2f}}', round(abs(percent), 2)) || '%' AS percent_label
FROM (SELECT *, CASE WHEN previous <> 0 THEN (price - previous) / previous * 100 ELSE 0.0 END AS percent
      FROM (SELECT symbol, window_start_ms, close_price AS price,
                   coalesce(lag(close_price) OVER (PARTITION BY symbol ORDER BY window_start_ms), close_price) AS previous
            FROM candles {where}))
"""
    )


def oracle_sql() -> dict[str, str]:
    return _trade_sql() | (text_queries.ORACLE_SQL if text_queries else {})


def _trade_sql():
    start, end = _ISO.format("window_start_ms"), _ISO.format("window_end_ms")
    newest = "SELECT DISTINCT ON (symbol) symbol, close_price, window_end_ms FROM candles ORDER BY symbol, window_end_ms DESC"
    hour, day = _ohlcv_sql(HOUR), _ohlcv_sql(24 * HOUR)
    measures = "symbol, window_start_ms, window_end_ms, open_price, high_price, low_price, close_price, volume, trade_count"
    return {
        "ohlcv_10s": _ohlcv_sql(10),
        "ohlcv_1h": hour,
        "ohlcv_1d": day,
        "ohlcv_7s": _ohlcv_sql(7),
        "ohlcv_case_mix": hour,
        "ohlcv_tied_times": _ohlcv_sql(HOUR, body=_FLOORED),
        "ohlcv_tied_wide_ids": _ohlcv_sql(
            HOUR,
            seq="CASE WHEN event_id % 2 = 0 THEN 9000000000000000000 - event_id ELSE event_id END",
            body=_FLOORED,
        ),
        "ohlcv_tied_same_number": _ohlcv_sql(
            HOUR,
            seq="event_id // 2, CASE WHEN event_id % 2 = 1 THEN upper(symbol) ELSE symbol END || '-' || event_id // 2",
            body=_FLOORED,
        ),
        "ohlcv_tied_text_ids": _ohlcv_sql(HOUR, seq="md5(CAST(event_id AS VARCHAR))", body=_FLOORED),
        "ohlcv_tied_long_ids": _ohlcv_sql(HOUR, seq="event_id // 3, md5(CAST(event_id AS VARCHAR))", body=_FLOORED),
        "ohlcv_null_price": _ohlcv_sql(HOUR, body=f"SELECT * REPLACE (CASE WHEN event_id % 3 = 0 THEN price END AS price) FROM ({_TRADES})"),
        "feed_to_candles": _ohlcv_sql(HOUR, body=_FEED_TRADES),
        "normalize_exchange_trades": f"SELECT {_TRADE_LIST} FROM ({_FEED_TRADES})",
        "feed_rejects": f"""
SELECT event_id, CASE WHEN {_TAIL} THEN 'message:event' ELSE
       concat_ws(',', CASE WHEN event_id % 43 = 0 THEN 'p:unusable' END, CASE WHEN event_id % 41 = 0 THEN 'T:unusable' END) END AS violations
FROM ({_TRADES}) WHERE {_TAIL} OR (symbol <> 'error' AND (event_id % 43 = 0 OR event_id % 41 = 0))
""",
        "lenient_decode": f"SELECT event_id, {_TRADE_LIST} FROM ({_DIRTY_ROWS}) WHERE defect <> 'broken'",
        "archive_decode": f"""
SELECT event_id, CASE WHEN ok THEN trade_id END AS trade_id, CASE WHEN ok THEN symbol END AS symbol,
       CASE WHEN ok THEN price END AS price, CASE WHEN ok THEN quantity END AS quantity,
       CASE WHEN ok THEN side END AS side, CASE WHEN ok THEN event_time END AS event_time,
       CASE WHEN ok THEN '' ELSE 'message:object' END AS violations
FROM (SELECT *, defect <> 'broken' AS ok FROM ({_DIRTY_ROWS}))
""",
        "symbol_universe": f"SELECT {_TRADE_LIST} FROM ({_TRADES}) WHERE symbol IN ('click', 'view', 'purchase')",
        "symbol_universe_table": f"""
WITH trades AS ({_TRADES})
SELECT {_TRADE_LIST} FROM trades WHERE symbol IN (SELECT symbol FROM trades WHERE price > 489)
""",
        "raw_trades_projection": f"SELECT {_TRADE_LIST.replace('symbol', 'upper(symbol) AS symbol')} FROM ({_TRADES})",
        "serialize_trades": f"""
SELECT symbol AS key, '{{"trade_id":"' || trade_id || '","symbol":"' || symbol || '","price":' || price
       || ',"quantity":' || quantity || ',"side":"' || side || '","event_time":' || event_time || '}}' AS value
FROM ({_TRADES})
""",
        "trade_violations": f"SELECT event_id, {_TRADE_REASON} AS violations FROM ({_DIRTY_ROWS})",
        "quote_violations": """
SELECT event_id, concat_ws(',', CASE WHEN value <= 0 THEN 'ask_price:range' END,
                           CASE WHEN value <= 0 OR event_id % 61 = 0 THEN 'bid_price:range' END) AS violations
FROM events
""",
        "quarantine_split": f"""
SELECT event_id, CASE WHEN {_TRADE_REASON} = '' THEN 'valid' ELSE 'rejected' END AS outcome FROM ({_DIRTY_ROWS})
""",
        "violation_counts": f"""
SELECT violation, count(*) AS records
FROM (SELECT unnest(string_split({_TRADE_REASON}, ',')) AS violation FROM ({_DIRTY_ROWS})) WHERE violation <> '' GROUP BY 1
""",
        "raw_trades_upsert": _REISSUED_LATEST,
        "candles_upsert": f"""
SELECT {measures}
FROM (SELECT *, 1 AS version FROM ({hour}) UNION ALL SELECT *, 2 AS version FROM ({day}))
QUALIFY row_number() OVER (PARTITION BY symbol, window_start_ms ORDER BY version DESC) = 1
""",
        "keyed_table_roundtrip": _CYCLES,
        "keyed_table_bucketed": _CYCLES,
        "symbols": _with_candles("SELECT DISTINCT symbol FROM candles ORDER BY symbol"),
        "candles_last_n": _with_candles(
            f"""
SELECT symbol, {start} AS window_start, {end} AS window_end, open_price, high_price, low_price, close_price, volume, trade_count
FROM (SELECT * FROM candles WHERE symbol = 'CLICK' ORDER BY window_start_ms DESC LIMIT 60) ORDER BY window_start_ms
"""
        ),
        "latest_trades": _with_candles(
            f"SELECT {_TRADE_LIST} FROM stored WHERE symbol = 'CLICK' ORDER BY event_time DESC, event_id DESC LIMIT 50"
        ),
        "trades_since": _with_candles(
            f"""
SELECT {_TRADE_LIST} FROM stored WHERE symbol = 'CLICK' AND event_time >= (SELECT max(event_time) FROM stored) - 172800000
ORDER BY event_time DESC, event_id DESC LIMIT 200
"""
        ),
        "serving_stats": _with_candles(
            f"""
SELECT (SELECT count(*) FROM candles) AS total_candles, (SELECT count(*) FROM stored) AS total_trades_stored,
       (SELECT count(DISTINCT symbol) FROM candles) AS active_symbols,
       (SELECT {_ISO.format('max(window_end_ms)')} FROM candles) AS latest_candle_at
"""
        ),
        "latest_prices": _with_candles(
            f"SELECT symbol, close_price AS price, {end} AS updated_at FROM ({newest}) ORDER BY symbol"
        ),
        "price_message": _with_candles(
            f"""
SELECT '{{"type":"price_update","prices":[' || string_agg('{{"symbol":"' || symbol || '","price":' || close_price
       || ',"updated_at":"' || {end} || '"}}', ',' ORDER BY symbol) || ']}}' AS message
FROM ({newest})
"""
        ),
        "approx_distinct": """
SELECT 'user_id' AS counted, count(DISTINCT user_id) AS exact, true AS near FROM events
UNION ALL SELECT 'event_time', count(DISTINCT epoch_us(ts) // 1000), true FROM events
UNION ALL SELECT 'symbol', count(DISTINCT event_type), true FROM events
""",
        "limit_checks": """
SELECT DISTINCT n, n BETWEEN 1 AND 200 AS for_trades, n BETWEEN 1 AND 500 AS for_candles FROM (SELECT event_id % 520 - 10 AS n FROM events)
""",
        "stream_ticker": _ticker_sql("WHERE window_end_ms <= (SELECT max(epoch_us(ts) // 1000) - 5000 FROM events)"),
        "stream_positions": f"""
SELECT {_FLUSH} AS batch, count(*) AS rows, min(event_time) AS first_ms, max(event_time) AS last_ms FROM ({_TRADES}), ({_SPAN}) GROUP BY 1
""",
        "stream_idle": f"""
SELECT * FROM ({_ohlcv_sql(HOUR, body=_QUIET)})
WHERE window_end_ms <= (SELECT max(epoch_us(ts) // 1000) - 5000 FROM events WHERE user_id % 2 = 1)
""",
        "ticker_changes": _ticker_sql(),
        "chart_series": _with_candles(
            """
SELECT window_start_ms // 1000 AS time, open_price AS open, high_price AS high, low_price AS low, close_price AS close
FROM (SELECT * FROM candles WHERE symbol = 'CLICK' ORDER BY window_start_ms DESC LIMIT 120) ORDER BY time
"""
        ),
        "trade_tape": _with_candles(
            f"""
SELECT trade_id, strftime(make_timestamp(event_time * 1000), '%H:%M:%S') AS time, {_LABEL.format('price')} AS price,
       format('{{:,.4f}}', round(quantity, 4)) AS quantity, upper(side) AS side
FROM (SELECT * FROM stored WHERE symbol = 'CLICK' ORDER BY event_time DESC, event_id DESC LIMIT 30)
"""
        ),
        "sql_views": _with_candles(
            f"""
SELECT symbol, close_price, window_end_ms, candles, trades
FROM ({newest}) JOIN (SELECT symbol, count(*) AS candles FROM candles GROUP BY 1) USING (symbol)
     JOIN (SELECT symbol, count(*) AS trades FROM stored GROUP BY 1) USING (symbol)
ORDER BY symbol
"""
        ),
        "lag_report": """
SELECT 'archive' AS consumer, *, sum(lag) OVER ()::BIGINT AS total_lag, max(lag) OVER () AS max_lag
FROM (SELECT CAST(user_id % 3 AS INTEGER) AS partition, max(event_id) AS latest,
             max(event_id) FILTER (user_id < 100) AS committed, latest - committed AS lag
      FROM events GROUP BY 1)
""",
        "flush_totals": f"""
SELECT flush, written, symbols, CAST(sum(written) OVER (ORDER BY flush) AS BIGINT) AS total_written
FROM (SELECT (event_time - first) * 5 // (last - first + 1) AS flush, count(*) AS written, count(DISTINCT symbol) AS symbols
      FROM ({_TRADES}), (SELECT min(event_time) AS first, max(event_time) AS last FROM ({_TRADES})) GROUP BY 1)
""",
        "flush_lag": f"""
SELECT *, CAST(sum(rows) OVER (ORDER BY batch) AS BIGINT) AS written, CAST(sum(rows) OVER () - sum(rows) OVER (ORDER BY batch) AS BIGINT) AS lag
FROM (SELECT {_FLUSH} AS batch, count(*) AS rows, min(event_time) AS first_ms, max(event_time) AS last_ms
      FROM ({_TRADES}), ({_SPAN}) GROUP BY 1)
""",
        "flush_triggers": f"""
WITH RECURSIVE counts AS (
  SELECT (event_time - first) * 10 // (last - first + 1) AS slice, symbol, count(*) AS n
  FROM ({_TRADES}), ({_SPAN}) GROUP BY 1, 2
), bound AS (
  SELECT max(n) // 4 AS most FROM (SELECT sum(n)::BIGINT AS n FROM counts GROUP BY symbol)
), pending AS (
  SELECT a.slice AS first_slice, b.slice AS last_slice, max(n)::BIGINT AS most
  FROM (SELECT DISTINCT slice FROM counts) a
  JOIN LATERAL (SELECT DISTINCT slice FROM counts) b ON b.slice >= a.slice
  JOIN LATERAL (SELECT sum(n) AS n FROM counts c WHERE c.slice BETWEEN a.slice AND b.slice GROUP BY symbol) ON true
  GROUP BY ALL
), steps AS (
  SELECT 0::BIGINT AS slice, 0::BIGINT AS first_slice, 0::BIGINT AS since, NULL::VARCHAR AS trigger, 0::BIGINT AS start
  UNION ALL
  SELECT slice + 1, CASE WHEN cause IS NULL THEN first_slice ELSE slice + 1 END, CASE WHEN cause IS NULL THEN since ELSE now END, cause, first_slice
  FROM (SELECT s.slice, s.first_slice, s.since, CASE WHEN s.slice < 5 THEN 25 * s.slice ELSE 100 + 70 * (s.slice - 4) END AS now,
               CASE WHEN p.most >= bound.most THEN 'rows' WHEN now - since >= 60 THEN 'time' END AS cause
        FROM steps s JOIN pending p ON p.first_slice = s.first_slice AND p.last_slice = s.slice, bound WHERE s.slice < 10)
)
SELECT s.slice - 1 AS batch, s.trigger, p.most, c.symbol, sum(c.n)::BIGINT AS records
FROM steps s JOIN pending p ON p.first_slice = s.start AND p.last_slice = s.slice - 1
     JOIN counts c ON c.slice BETWEEN s.start AND s.slice - 1
WHERE s.trigger IS NOT NULL GROUP BY ALL
""",
        "flush_log": f"""
SELECT {_FLUSH} AS batch, symbol, count(*) AS records, true AS has_files, true AS sizes_match
FROM ({_TRADES}), ({_SPAN}) GROUP BY 1, 2
""",
        "stream_ohlcv_closed": f"""
SELECT * FROM ({hour}) WHERE window_end_ms <= (SELECT max(epoch_us(ts) // 1000) - 5000 FROM events)
""",
        "stream_open_windows": f"""
SELECT *, CASE WHEN window_end_ms <= (SELECT max(epoch_us(ts) // 1000) - 5000 FROM events) THEN 'closed' ELSE 'open' END AS state
FROM ({hour}), (VALUES (true), (false)) AS plain(plain_ids)
""",
        "stream_restart": f"""
SELECT * FROM ({hour}) WHERE window_end_ms <= (SELECT max(epoch_us(ts) // 1000) - 5000 FROM events)
""",
        "stream_late": f"""
SELECT * FROM ({_ohlcv_sql(HOUR, body=_PUNCTUAL)}) WHERE window_end_ms <= (SELECT max(epoch_us(ts) // 1000) - 5000 FROM events)
""",
        "stream_ohlcv_update": hour,
        "stream_tied_text_ids": _ohlcv_sql(HOUR, seq="md5(CAST(event_id AS VARCHAR))", body=_FLOORED),
        "stream_raw_upsert": _REISSUED_LATEST,
        "stream_replay": f"SELECT {_TRADE_LIST.replace('symbol', 'upper(symbol) AS symbol')} FROM ({_TRADES})",
        "pipeline_rejects": f"""
WITH broken AS (
  SELECT upper(CASE WHEN event_id % 29 <> 0 THEN symbol END) AS symbol, quantity, CASE WHEN event_time // 3600000 % 20 <> 0 THEN price END AS price,
         CASE WHEN event_id % 37 <> 0 THEN event_time END AS event_time
  FROM ({_TRADES})
), candles AS (
  SELECT symbol, event_time - event_time % 3600000 + 3600000 AS window_end, max(price) AS price
  FROM broken WHERE event_time IS NOT NULL GROUP BY ALL
)
SELECT 'raw' AS kind, concat_ws(',', CASE WHEN symbol IS NULL THEN 'symbol:null' END, CASE WHEN price IS NULL THEN 'price:null' END,
                                CASE WHEN event_time IS NULL THEN 'event_time:null' END) AS violations, count(*) AS records
FROM broken WHERE symbol IS NULL OR price IS NULL OR event_time IS NULL GROUP BY ALL
UNION ALL
SELECT 'candles', concat_ws(',', CASE WHEN symbol IS NULL THEN 'symbol:null' END,
       CASE WHEN price IS NULL THEN 'open_price:null,high_price:null,low_price:null,close_price:null' END), count(*)
FROM candles WHERE (symbol IS NULL OR price IS NULL) AND window_end <= (SELECT max(event_time) - 5000 FROM broken) GROUP BY ALL
""",
        "stream_archive_roundtrip": f"""
SELECT {_TRADE_LIST}, strftime(make_timestamp(event_time * 1000), '%Y-%m-%d') AS dt, coalesce(symbol, 'UNKNOWN') AS symbol_part,
       true AS stamped
FROM ({_NAMELESS})
""",
        "archive_flushes": f"SELECT coalesce(symbol, 'UNKNOWN') AS symbol, count(*) AS records FROM ({_NAMELESS}) GROUP BY 1",
        "lake_files": f"""
SELECT DISTINCT strftime(make_timestamp(event_time * 1000), '%Y-%m-%d') AS dt, coalesce(symbol, 'UNKNOWN') AS symbol,
       true AS has_files, true AS has_size
FROM ({_NAMELESS})
""",
        "lake_files_day": f"""
SELECT DISTINCT dt, coalesce(symbol, 'UNKNOWN') AS symbol
FROM (SELECT *, strftime(make_timestamp(event_time * 1000), '%Y-%m-%d') AS dt FROM ({_NAMELESS}))
WHERE dt = (SELECT strftime(make_timestamp(min(event_time) * 1000), '%Y-%m-%d') FROM ({_NAMELESS}))
""",
        "size_labels": """
SELECT event_id, length, round_even(length / 1024.0::DOUBLE, 2) AS size_kb
FROM (SELECT event_id, event_id * 37 + user_id * 128 AS length FROM events)
""",
        "stream_publish_decode": f"SELECT {_TRADE_LIST} FROM ({_FEED_TRADES})",
    }
