"""Messages in, canonical trades out: lenient decode, exchange feed, serialisation."""

from pyspark.sql import functions as F

from tapewright.functions import text
from tapewright.operators.rows import emit_where, reason_list
from tapewright.schemas import TRADE, TRADE_COLUMNS

# Member names of an exchange trade event with the names used here for them, the event
# type kept, and the symbols followed when the caller names none.
FEED_MEMBERS = [
    ("e", "kind", "string"),
    ("s", "pair", "string"),
    ("t", "number", "string"),
    ("p", "price_text", "string"),
    ("q", "quantity_text", "string"),
    ("m", "maker", "boolean"),
    ("T", "time_text", "string"),
]
TRADE_EVENT = "trade"
DEFAULT_SYMBOLS = "btcusdt,ethusdt,solusdt,bnbusdt,xrpusdt"
# End of fixed values.

_FEED_WIRE = ", ".join(f"{wire}: {kind}" for wire, _, kind in FEED_MEMBERS)
_FEED_NAMED = ", ".join(f"{name}: {kind}" for _, name, kind in FEED_MEMBERS)

_TEXT_TRADE = ", ".join(f"{c} string" for c in TRADE_COLUMNS)


def _parsed_trade(messages, value, *keep):
    """``keep``, the parsed members as ``_t`` (NULL if there is no object), and whether the message is one JSON object
    as ``_object``; one parse.
    """
    # Read as text and cast later: a typed read would turn "12.5" in quotes into NULL.
    elements = F.from_json(text.wrapped(value), f"array<struct<{_TEXT_TRADE}, {text.END} string>>", text.JSON_OPTIONS)
    parsed = messages.select(*keep, elements.alias("_elements"), text.end_mark(value).alias("_mark"))
    sole = text.is_sole(F.col("_elements"), F.col("_mark"))
    names = [c if isinstance(c, str) else "value" for c in keep]
    return parsed.select(*names, F.when(sole, F.get("_elements", F.lit(0))).alias("_t"), sole.alias("_object"))


def _typed(parsed):
    return [parsed[f.name].try_cast(f.dataType).alias(f.name) for f in TRADE.fields]


def decode_trades(messages, value="value", carry=()):
    """JSON text to the six trade columns. A bad or missing field is NULL, a message that is no
    JSON object is dropped. ``carry`` names input columns to keep, such as the log offset."""
    parsed = _parsed_trade(messages, F.col(value), *carry)
    return emit_where(parsed, F.col("_object"), *carry, *_typed(F.col("_t")))


def decode_with_rejects(messages, value="value", carry=()):
    """Like :func:`decode_trades`, but nothing is dropped: adds ``value`` and ``violations``.

    ``violations`` is empty for a usable record. Missing fields are no violation; a message that is
    no object and a field whose text does not fit its type are.
    """
    parsed = F.col("_t")
    typed = _parsed_trade(messages, F.col(value), *carry, F.col(value).alias("value")).select(
        *carry,
        "value",
        "_object",
        *_typed(parsed),
        *[parsed[f.name].isNotNull().alias(f"_has_{f.name}") for f in TRADE.fields],
    )
    misfit = [F.when(F.col(f"_has_{c}") & F.col(c).isNull(), f"{c}:type") for c in TRADE_COLUMNS]
    reasons = F.when(~F.col("_object"), "message:object").otherwise(F.concat_ws(",", *misfit))
    return typed.select(*carry, "value", *TRADE_COLUMNS, reasons.alias("_joined")).select(
        *carry, "value", *TRADE_COLUMNS, reason_list(F.col("_joined")).alias("violations")
    )


def feed_events(messages, value="value", carry=()):
    """Exchange messages with the optional ``{stream, data}`` envelope removed.

    One parse reads the envelope and the bare form together. Member names differ by case only
    (t, T), which column access cannot tell apart, so the struct is renamed by position.
    """
    raw = F.col(value)
    end = f"{text.END}: string"
    parsed = F.from_json(
        text.wrapped(raw), f"array<struct<data: struct<{_FEED_WIRE}>, {_FEED_WIRE}, {end}>>", text.JSON_OPTIONS
    ).cast(f"array<struct<data: struct<{_FEED_NAMED}>, {_FEED_NAMED}, {end}>>")
    names = [name for _, name, _ in FEED_MEMBERS]
    wire = F.col("_w")
    bare = F.struct(*[wire[n].alias(n) for n in names])
    # The key list is only read when the text mentions "data" and no object was found under it.
    empty_envelope = wire["data"].isNull() & raw.contains('"data"') & F.array_contains(F.json_object_keys(raw), "data")
    event = F.when(wire["data"].isNotNull(), wire["data"]).when(~F.coalesce(empty_envelope, F.lit(False)), bare)
    first = F.when(text.is_sole(F.col("_elements"), F.col("_mark")), F.get("_elements", F.lit(0)))
    read = messages.select("*", parsed.alias("_elements"), text.end_mark(raw).alias("_mark")).select("*", first.alias("_w"))
    return read.select(*carry, raw.alias("value"), event.alias("event"))


def map_feed(messages, value="value", carry=()):
    """Exchange messages to canonical trades plus ``value``, ``kind`` and ``violations``.

    The side names the aggressor: when the buyer is the maker, the trade is a sell.
    """
    e = F.col("event")
    mapped = feed_events(messages, value, carry).select(
        *carry,
        "value",
        e["kind"].alias("kind"),
        e["pair"].alias("symbol"),
        e["number"].alias("_number"),
        text.finite(text.to_double(e["price_text"])).alias("price"),
        text.finite(text.to_double(e["quantity_text"])).alias("quantity"),
        F.when(e["maker"], "sell").when(~e["maker"], "buy").alias("side"),
        text.to_bigint(e["time_text"]).alias("event_time"),
    )
    needed = ["symbol", "_number", "price", "quantity", "side", "event_time"]
    wire_name = dict(zip(needed, ["s", "t", "p", "q", "m", "T"]))
    unusable = F.concat_ws(",", *[F.when(F.col(c).isNull(), f"{wire_name[c]}:unusable") for c in needed])
    reasons = F.when(F.col("kind").isNull(), "message:event").otherwise(unusable)
    return mapped.select(
        *carry,
        "value",
        "kind",
        # concat, not concat_ws: a missing part must not give a shorter id.
        F.concat("symbol", F.lit("-"), "_number").alias("trade_id"),
        *TRADE_COLUMNS[1:],
        reasons.alias("_joined"),
    ).select(*carry, "value", "kind", *TRADE_COLUMNS, reason_list(F.col("_joined")).alias("violations"))


def normalize_feed(messages, value="value", carry=()):
    """Trades of the feed. Other event types and unusable messages are left out."""
    mapped = map_feed(messages, value, carry)
    usable = (F.col("kind") == TRADE_EVENT) & (F.size("violations") == 0)
    return emit_where(mapped, usable, *carry, *TRADE_COLUMNS)


def feed_rejects(messages, value="value", carry=()):
    """Messages of the feed that are no event at all, or trade events with unusable members."""
    mapped = map_feed(messages, value, carry)
    wanted = F.col("kind").isNull() | (F.col("kind") == TRADE_EVENT)
    return emit_where(mapped, wanted & (F.size("violations") > 0), *carry, "value", "violations")


def decode_rejects(messages, value="value", carry=()):
    """Messages that are no JSON object or hold a field that does not fit its type."""
    checked = decode_with_rejects(messages, value, carry)
    return emit_where(checked, F.size("violations") > 0, *carry, "value", "violations")


def select_symbols(trades, symbols=DEFAULT_SYMBOLS, column="symbol"):
    """Rows whose symbol is in the universe, in any case.

    ``symbols`` is a comma list, a Python list, or a DataFrame with a ``symbol`` column. A DataFrame
    is joined with left_semi, and Spark broadcasts it only if its own size estimate allows.
    """
    if isinstance(symbols, (str, list, tuple)):
        return trades.where(F.lower(F.col(column)).isin(text.symbol_list(symbols)))
    wanted = symbols.select(F.lower(F.trim("symbol")).alias("_symbol")).where("_symbol != ''").distinct()
    return trades.join(wanted, F.lower(trades[column]) == wanted["_symbol"], "left_semi")


def serialize_trades(trades):
    """Key and JSON value for the log; the key is the symbol, so one symbol keeps its order."""
    return trades.select(F.col("symbol").alias("key"), F.to_json(F.struct(*TRADE_COLUMNS)).alias("value"))


def raw_trades(trades, carry=()):
    """The stored-trade projection: six columns, symbol in upper case."""
    return trades.select(
        *carry, "trade_id", F.upper("symbol").alias("symbol"), *[c for c in TRADE_COLUMNS if c not in ("trade_id", "symbol")]
    )
