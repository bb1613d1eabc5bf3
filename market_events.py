"""The ``events`` table read as a trade stream, and message texts derived from it."""

from pyspark.sql import functions as F

from tapewright.functions.times import ntz_millis


def events_path(sf_dir):
    return f"{sf_dir.rstrip('/')}/events.parquet"


def trades_of(events):
    """Canonical trades: symbol = event type, price = value, quantity = (k + 1) / 100."""
    return events.select(
        F.expr("concat(event_type, '-', event_id) AS trade_id"),
        F.col("event_type").alias("symbol"),
        F.col("value").alias("price"),
        F.expr("(try_cast(get_json_object(props, '$.k') AS BIGINT) + 1) / 100 AS quantity"),
        F.expr("CASE WHEN pmod(user_id, 2) = 0 THEN 'sell' ELSE 'buy' END AS side"),
        ntz_millis("ts").alias("event_time"),
        "event_id",
        "user_id",
    )


def read_trades(spark, sf_dir):
    return trades_of(spark.read.parquet(events_path(sf_dir)))


def _text(column):
    return F.col(column).cast("string")


def every(n):
    return F.pmod("event_id", F.lit(n)) == 0


def _with_tail(body):
    """Some messages go on behind their object: with another one, with junk, or with text that closes and reopens a
    wrapper.
    """
    return (
        F.when(every(61), F.concat(body, body))
        .when(every(59), F.concat(body, F.lit(" junk }")))
        .when(every(53), F.concat(body, F.lit("] ["), body))
        .when(every(47), F.concat(body, F.lit('}} {"r":'), body))
        .otherwise(body)
    )


def feed_messages(trades):
    """Exchange messages: ``error`` events are pings, odd event ids come without an envelope, some are broken, see
    ``_with_tail``.

    Every 43rd has a price that is no number, every 41st no time.
    """
    body = F.concat(
        F.lit('{"e":"'),
        F.when(F.col("symbol") == "error", "ping").otherwise("trade"),
        F.lit('","s":"'),
        F.col("symbol"),
        F.lit('","t":'),
        _text("event_id"),
        F.lit(',"p":"'),
        F.when(every(43), "x").otherwise(_text("price")),
        F.lit('","q":"'),
        _text("quantity"),
        F.lit('","m":'),
        F.when(F.col("side") == "sell", "true").otherwise("false"),
        F.when(every(41), "").otherwise(F.concat(F.lit(',"T":'), _text("event_time"))),
        F.lit("}"),
    )
    wrapped = F.concat(F.lit('{"stream":"'), F.col("symbol"), F.lit('@trade","data":'), body, F.lit("}"))
    message = F.when(F.pmod("event_id", F.lit(2)) == 1, body).otherwise(wrapped)
    return trades.select("event_id", _with_tail(message).alias("value"))


def dirty_messages(trades):
    """Canonical JSON with one defect by event id; see the rules in FIXTURES."""
    symbol = F.when(every(73) & ~every(79) & ~every(83) & ~every(89), "ab").otherwise(F.col("symbol"))
    price = F.when(every(89), F.concat(F.lit("-"), _text("price"))).when(
        every(67) & ~every(71) & ~every(73) & ~every(79) & ~every(83),
        F.concat(F.lit('"'), _text("price"), F.lit('"')),
    ).otherwise(_text("price"))
    side = F.when(every(83) & ~every(89), "hold").otherwise(F.col("side"))
    extra = F.when(every(79) & ~every(83) & ~every(89), ',"venue":"x"').otherwise("")
    time = F.when(every(71) & ~every(73) & ~every(79) & ~every(83) & ~every(89), "").otherwise(
        F.concat(F.lit(',"event_time":'), _text("event_time"))
    )
    body = F.concat(
        F.lit('{"trade_id":"'),
        F.col("trade_id"),
        F.lit('","symbol":"'),
        symbol,
        F.lit('","price":'),
        price,
        F.lit(',"quantity":'),
        _text("quantity"),
        F.lit(',"side":"'),
        side,
        F.lit('"'),
        time,
        extra,
    )
    # Truncated text has no closing brace and stops inside the last member.
    return trades.select("event_id", F.when(every(97), body).otherwise(_with_tail(F.concat(body, F.lit("}")))).alias("value"))


def quote_messages(trades):
    """Top-of-book JSON around the trade price; every 61st bid is zero."""
    bid = F.when(F.pmod("event_id", F.lit(61)) == 0, F.lit(0.0)).otherwise(F.col("price") * 0.999)
    size = F.col("quantity") * 100
    return trades.select(
        "event_id",
        F.to_json(
            F.struct(
                "symbol",
                bid.alias("bid_price"),
                size.alias("bid_size"),
                (F.col("price") * 1.001).alias("ask_price"),
                size.alias("ask_size"),
                "event_time",
            )
        ).alias("value"),
    )
