"""OHLCV candles over tumbling event-time windows, the same plan for tables and streams."""

import re

from pyspark.sql import functions as F

from tapewright.functions.text import TRADE_SEQUENCE
from tapewright.functions.times import event_timestamp

# Window length and watermark delay used when the caller names none.
DEFAULT_WINDOW_SECONDS = 10
DEFAULT_WATERMARK = "5 seconds"
# End of fixed values.

def with_event_time(trades, watermark=None):
    """Adds ``ts`` and drops rows without a usable event time; sets the watermark on a stream."""
    timed = trades.withColumn("ts", event_timestamp("event_time")).where("ts IS NOT NULL")
    return timed.withWatermark("ts", watermark) if watermark and trades.isStreaming else timed


# An id is plain if it is the symbol in one case, a dash and the trade number: 0 for upper, 1 for lower case.
_PLAIN = """CASE WHEN trade_id = concat(_symbol, '-', _seq) THEN 0L
                 WHEN trade_id = concat(lower(_symbol), '-', _seq) THEN 1L END"""
_HIGH = f"{1 << 65}BD"  # above a 64-bit number and the bit of its case


def _plain_keys(window_ms, plain_ids):
    """SQL expressions that order the priced trades with plain ids of one window by (event time, trade number, case).

    Spark aggregates by hashing only when the buffer has fixed width; ordering by a struct with a text makes it sort its
    whole input, which took three times as long over 10 million rows. A plain id says no more than its number and its
    case, so the order goes into one BIGINT, or a DECIMAL if the number is too large for that.
    """
    offset_bits = max(1, (window_ms - 1).bit_length())
    shift = 63 - offset_bits
    offset = f"pmod(event_time, {window_ms}L)"
    fits = f"_seq < {1 << (shift - 1)}L"
    other = "raise_error(concat('not a plain trade id: ', coalesce(trade_id, 'NULL')))" if plain_ids else "NULL"
    narrow = f"CASE WHEN price IS NULL THEN NULL WHEN _lower IS NULL THEN {other} WHEN {fits} THEN shiftleft({offset}, {shift}) | shiftleft(_seq, 1) | _lower END"
    decimals = [f"CAST({x} AS DECIMAL({n},0))" for x, n in ((offset, 12), ("_seq", 20), ("_lower", 1))]
    wide = f"CASE WHEN price IS NOT NULL AND _lower IS NOT NULL AND NOT {fits} THEN {decimals[0]} * {_HIGH} + {decimals[1]} * 2BD + {decimals[2]} END"
    return narrow, wide, shift


# The whole order: event time, trade number, the id as text; a trade with a smaller price first if even those are equal.
_ORDER = "named_struct('at', pmod(event_time, {0}L), 'number', coalesce(_seq, -1L), 'id', coalesce(trade_id, ''), 'price', price)"


_MEASURES = {"high_price": "max(price)", "low_price": "min(price)", "volume": "round(sum(quantity), 6)", "trade_count": "count(1)"}


def _aggregates(window_ms, plain_ids, stream):
    """Order keys by name, the aggregates of a candle by name, and the bits of a number in the narrow key.

    ``_open_`` and ``_close_`` are prices by a key, ``_first_`` and ``_last_`` the keys themselves.
    """
    narrow, wide, shift = _plain_keys(window_ms, plain_ids)
    whole = _ORDER.format(window_ms)
    if stream and not plain_ids:
        keys = {"t": f"CASE WHEN price IS NOT NULL THEN {whole} END"}
        edges = {"_first_t": "min(_t)", "_last_t": "max(_t)"}
    else:
        keys = {"n": narrow, "w": wide}
        ends = (("min", "open", "first"), ("max", "close", "last"))
        edges = {
            name: e for k in keys for f, price, key in ends
            for name, e in ((f"_{price}_{k}", f"{f}_by(price, _{k})"), (f"_{key}_{k}", f"{f}(_{k})"))
        }
        if not plain_ids:
            # DISTINCT makes every such trade a group of its own below the shuffle; plain ones share the group of NULL.
            keys["t"] = f"CASE WHEN price IS NOT NULL AND _lower IS NULL THEN {whole} END"
            edges |= {"_first_t": "min_by(DISTINCT _t, _t)", "_last_t": "max_by(DISTINCT _t, _t)"}
    return keys, edges | _MEASURES, shift


def candles(trades, window_seconds=DEFAULT_WINDOW_SECONDS, watermark=DEFAULT_WATERMARK, plain_ids=False):
    """One row per upper-cased symbol and window: open, high, low, close, volume, trade_count.

    Open and close follow event time, then trade number, then trade id, and never arrival; an id without a number comes
    before all others of its time. Trades without a price count, but set no price. All measures combine partially before
    the one shuffle on (symbol, window), so a hot symbol or a hot window sends one row per map task and not its trades.

    Trades with plain ids are aggregated by hashing. Others have to be ordered by their whole id: each is a group of its
    own, by (time, number, id), until it meets the others of its window behind the shuffle. A stream has no such two
    steps; there the ids of all trades are compared, in an aggregate that sorts. ``plain_ids`` tells that there are only
    plain ids, as the exchange feed makes them: then a stream hashes, too, and any other id is an error.
    """
    window_seconds = max(1, int(window_seconds))
    keys, aggregates, shift = _aggregates(window_seconds * 1000, plain_ids, trades.isStreaming)
    grouped = (
        with_event_time(trades, watermark)
        # The exchange's own number ends the trade id.
        .selectExpr("*", f"{TRADE_SEQUENCE} AS _seq", "upper(symbol) AS _symbol")
        .selectExpr("*", f"{_PLAIN} AS _lower")
        .selectExpr("_symbol AS symbol", "ts", "price", "quantity", *[f"{key} AS _{k}" for k, key in keys.items()])
        .groupBy("symbol", F.window("ts", f"{window_seconds} seconds").alias("w"))
        .agg(*[F.expr(f"{e} AS {name}") for name, e in aggregates.items()])
    )
    return _finished(grouped, keys, shift)


def open_candles(spark, checkpoint, window_seconds=DEFAULT_WINDOW_SECONDS, plain_ids=False):
    """The candles so far of the windows that a stream in append mode has not closed, from the state in its checkpoint.

    ``window_seconds`` and ``plain_ids`` are those of the stream. Reads its last finished batch, whether it runs or not.
    A stream in update mode keeps its windows until the watermark has passed them, so there closed ones come as well.
    """
    keys, aggregates, shift = _aggregates(max(1, int(window_seconds)) * 1000, plain_ids, True)
    state = spark.read.format("statestore").load(checkpoint)
    fields = _state_fields(state.schema["value"].dataType.fields)
    if set(fields) - {""} != set(aggregates):
        raise ValueError(f"{checkpoint} holds the state of another aggregate, or of candles with other ids")
    kinds = [f.dataType.simpleString() for f in state.schema["value"].dataType.fields]
    named = ", ".join(f"{name or f'_{n}'}: {kind}" for n, (name, kind) in enumerate(zip(fields, kinds)))
    values = [f"round(v.{name}, 6) AS {name}" if name == "volume" else f"v.{name}" for name in aggregates]
    return _finished(state.selectExpr("key", f"CAST(value AS STRUCT<{named}>) AS v").selectExpr("key.symbol", "key.window AS w", *values), keys, shift)


def _state_fields(fields):
    """Which aggregate each field of the state belongs to, '' for the ordering of a price by a key.

    Spark names a field by what it does and orders them as the result uses them, so open comes before close.
    """
    keys = {"bigint": "n", "decimal": "w", "struct": "t"}
    key_of = lambda field: keys.get(re.split("[(<]", field.dataType.simpleString())[0], "")
    found = []
    for k, field in enumerate(fields):
        if field.name in ("sum", "count"):
            name = {"sum": "volume", "count": "trade_count"}[field.name]
        elif field.name.startswith("value") and k + 1 < len(fields):
            key = key_of(fields[k + 1])
            name = f"_close_{key}" if f"_open_{key}" in found else f"_open_{key}"
        elif field.name in ("min", "max"):
            key = key_of(field)
            name = f"_{'first' if field.name == 'min' else 'last'}_{key}" if key else {"min": "low_price", "max": "high_price"}[field.name]
        else:
            name = ""
        found.append(name)
    return found


def _finished(grouped, keys, shift):
    """Candles of aggregated windows."""
    stream, plain_ids = "n" not in keys, "t" not in keys

    def edge(kind, name):
        """The price at one end: that of the only key, else of the outer one in the whole order."""
        if stream:
            return f"_{kind}_t.price"
        n, w = f"_{kind}_n", f"_{kind}_w"
        low_w = f"CAST({w} % {_HIGH} AS DECIMAL(38,0))"
        ids = "concat(CASE WHEN %s THEN symbol ELSE lower(symbol) END, '-', %s)"
        parts = [
            (n, f"shiftright({n}, {shift})", f"shiftright({n} & {(1 << shift) - 1}L, 1)", f"{n} & 1L = 0"),
            (w, f"CAST(floor({w} / {_HIGH}) AS BIGINT)", f"CAST(floor({low_w} / 2BD) AS BIGINT)", f"{low_w} % 2BD = 0"),
        ]
        found = [
            f"CASE WHEN {key} IS NOT NULL THEN named_struct('at', {at}, 'number', {number}, 'id', {ids % (upper, number)}, 'price', _{name}_{key[-1]}) END"
            for key, at, number, upper in parts
        ]
        others = [] if plain_ids else [f"_{kind}_t"]
        outer = f"array_{'min' if kind == 'first' else 'max'}(array({', '.join(found + others)})).price"
        alone = " AND ".join(f"{x} IS NULL" for x in [w, *others])
        return f"CASE WHEN {alone} THEN _{name}_n ELSE {outer} END"

    return grouped.selectExpr(
        "symbol",
        "w.start AS window_start",
        "w.end AS window_end",
        f"{edge('first', 'open')} AS open_price",
        "high_price",
        "low_price",
        f"{edge('last', 'close')} AS close_price",
        "volume",
        "trade_count",
    )
