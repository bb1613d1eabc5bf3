"""The user-facing queries over candle and trade tables. All are lazy; an unknown symbol gives no rows."""

from pyspark.sql import functions as F

from tapewright.functions import display
from tapewright.functions.text import trade_sequence
from tapewright.functions.times import DAY_MS, epoch_seconds, iso_utc, utc_clock
from tapewright.operators.keyed import latest_candle
from tapewright.operators.ordered import with_previous
from tapewright.schemas import CANDLE_COLUMNS, TRADE_COLUMNS


def check_limit(limit, highest):
    """Fails before any plan is built when ``limit`` is out of range."""
    if isinstance(limit, bool) or not isinstance(limit, int) or not 1 <= limit <= highest:
        raise ValueError(f"limit must be a whole number between 1 and {highest}")
    return limit


def symbols(candle_rows):
    """Distinct symbols in alphabetical order."""
    return candle_rows.select("symbol").distinct().orderBy("symbol")


def _last_candles(candle_rows, symbol, limit, since_ms):
    """The newest ``limit`` candles of a symbol, oldest first. A top-k per task, then a merge."""
    wanted = candle_rows.where(F.col("symbol") == symbol.upper())
    if since_ms is not None:
        wanted = wanted.where(F.col("window_start") >= F.timestamp_millis(F.lit(since_ms)))
    return wanted.orderBy(F.desc("window_start")).limit(limit).orderBy("window_start")


def candles(candle_rows, symbol, limit=60, since_ms=None):
    """The last ``limit`` candles of a symbol, oldest first, with ISO-8601 bounds.

    ``since_ms`` asks for windows starting at that epoch time or later only. A caller that polls knows
    such a bound; it reaches the scan, so files and row groups of older times are not read.
    """
    rows = _last_candles(candle_rows, symbol, check_limit(limit, 500), since_ms)
    return rows.select(
        "symbol",
        iso_utc("window_start").alias("window_start"),
        iso_utc("window_end").alias("window_end"),
        *CANDLE_COLUMNS[3:],
    )


def latest_trades(trade_rows, symbol, limit=50, since_ms=None):
    """The last ``limit`` trades of a symbol, newest first; equal times follow the trade number.

    ``since_ms`` asks for trades of that epoch time or later only, see :func:`candles`. It reaches the scan of a stored
    table that declares ``event_time`` as determined by the trade id.
    """
    check_limit(limit, 200)
    wanted = trade_rows.where(F.col("symbol") == symbol.upper())
    if since_ms is not None:
        wanted = wanted.where(F.col("event_time") >= since_ms)
    newest = wanted.orderBy(
        F.desc("event_time"), F.desc(trade_sequence()), F.desc("trade_id")
    )
    return newest.limit(limit).select(*TRADE_COLUMNS)


def newest(spark, table, symbol, limit, since_ms=None):
    """The rows of a symbol in the newest time slices of a stored table that hold ``limit`` of them.

    For the lookups below, which take them like any rows: ``latest_trades(newest(spark, raw, "btc", 50), "btc", 50)``
    reads the last day or so, and not the symbol's history.
    """
    return table.newest(spark, F.col("symbol") == symbol.upper(), limit, since_ms)


def pipeline_stats(candle_rows, trade_rows):
    """One row: candles, stored trades, symbols with candles, end of the newest candle or NULL."""
    per_symbol = candle_rows.groupBy("symbol").agg(
        F.count(F.lit(1)).alias("candles"), F.max("window_end").alias("newest")
    )
    # COUNT(DISTINCT symbol) leaves a NULL symbol out, so count(symbol) and not count(1).
    of_candles = per_symbol.agg(
        F.sum("candles").alias("total_candles"),
        F.count("symbol").alias("active_symbols"),
        F.max("newest").alias("newest"),
    )
    of_trades = trade_rows.agg(F.count(F.lit(1)).alias("total_trades_stored"))
    return (
        of_candles.unionByName(of_trades, allowMissingColumns=True)
        .agg(
            F.coalesce(F.sum("total_candles"), F.lit(0)).alias("total_candles"),
            F.coalesce(F.sum("total_trades_stored"), F.lit(0)).alias("total_trades_stored"),
            F.coalesce(F.sum("active_symbols"), F.lit(0)).alias("active_symbols"),
            F.max("newest").alias("newest"),
        )
        .select(
            "total_candles", "total_trades_stored", "active_symbols", iso_utc("newest").alias("latest_candle_at")
        )
    )


def sketches(rows, group, column, lg_k=12):
    """A sketch of the distinct values of ``column`` for each ``group``, such as a batch: mergeable, and a few KB however
    many values there are.
    """
    return rows.groupBy(group).agg(F.hll_sketch_agg(column, lg_k).alias("sketch"))


def sketched_count(sketched):
    """One row: the approximate number of distinct values over all sketches, for where an exact count is not needed.

    The relative error is 0.8 / sqrt(2^lg_k) in one standard deviation, 1.3 % for lg_k = 12, however many are merged.
    """
    return sketched.agg(F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias("approx_distinct"))


def latest_prices(candle_rows):
    """Newest close per symbol, by symbol."""
    return (
        latest_candle(candle_rows)
        .select("symbol", F.col("close_price").alias("price"), iso_utc("window_end").alias("updated_at"))
        .orderBy("symbol")
    )


def price_message(candle_rows):
    """The ticker push: one JSON text with all symbols in order. It grows with the symbols only."""
    prices = latest_candle(candle_rows).agg(
        F.sort_array(
            F.collect_list(
                F.struct("symbol", F.col("close_price").alias("price"), iso_utc("window_end").alias("updated_at"))
            )
        ).alias("prices")
    )
    return prices.select(F.to_json(F.struct(F.lit("price_update").alias("type"), "prices")).alias("message"))


def ticker_changes(candle_rows, chunk_ms=DAY_MS):
    """Each candle's close against the one before of its symbol: change, percent, direction, labels.

    The first candle of a symbol is compared with itself.
    """
    closes = candle_rows.select(
        "symbol", F.unix_millis("window_start").alias("window_start_ms"), F.col("close_price").alias("price")
    )
    paired = with_previous(closes, "symbol", "window_start_ms", "price", chunk_ms)
    previous = F.coalesce("previous", "price")
    changed = paired.withColumn("previous", previous).withColumn("change", F.col("price") - F.col("previous"))
    with_percent = changed.withColumn(
        "percent", F.when(F.col("previous") != 0, F.col("change") / F.col("previous") * 100).otherwise(0.0)
    )
    return with_percent.select(
        "symbol",
        "window_start_ms",
        "price",
        "previous",
        "change",
        "percent",
        F.when(F.col("change") >= 0, "up").otherwise("down").alias("direction"),
        display.price_label(F.col("price")).alias("price_label"),
        display.percent_label(F.col("change"), F.col("percent")).alias("percent_label"),
    )


def chart_series(candle_rows, symbol, limit=120, since_ms=None):
    """Chart points of the last ``limit`` candles: whole epoch seconds and open, high, low, close."""
    return _last_candles(candle_rows, symbol, check_limit(limit, 500), since_ms).select(
        epoch_seconds("window_start").alias("time"),
        F.col("open_price").alias("open"),
        F.col("high_price").alias("high"),
        F.col("low_price").alias("low"),
        F.col("close_price").alias("close"),
    )


def trade_tape(trade_rows, symbol, limit=30, since_ms=None):
    """Display rows of the last ``limit`` trades: UTC clock time, price, quantity, side."""
    return latest_trades(trade_rows, symbol, limit, since_ms).select(
        "trade_id",
        utc_clock("event_time").alias("time"),
        display.price_label(F.col("price")).alias("price"),
        display.grouped(F.col("quantity"), 4).alias("quantity"),
        F.upper("side").alias("side"),
    )
