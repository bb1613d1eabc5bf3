"""JSON text checks, numeric text, trade ids."""

from pyspark.sql import functions as F

JSON_SPACE = " \t\r\n"

# One message is one JSON object: no single-quoted names, bad fields give NULL instead of an error.
JSON_OPTIONS = {"mode": "PERMISSIVE", "allowSingleQuotes": "false"}


# Member of the element that closes a wrapped message.
END = "_end"


def end_mark(value):
    """What the closing element of a wrapped message holds: a hash of the message, so no message can bring it along."""
    return F.xxhash64(value).cast("string")


def wrapped(value):
    """A message as the first element of a JSON array, with a closing element behind it; NULL if it starts with no
    brace.

    A JSON reader stops at the end of the first value and ignores what follows, so text after the object would go
    unseen. Inside an array, such text is an error, an element too many, or it cuts the closing element off.
    """
    opened = F.ltrim(value, F.lit(JSON_SPACE)).startswith("{")
    closing = F.concat(F.lit(f',{{"{END}":"'), end_mark(value), F.lit('"}]'))
    return F.when(opened, F.concat(F.lit("["), value, closing))


def is_sole(elements, mark):
    """Whether a parsed array of wrapped elements is one object and the closing element."""
    return F.coalesce((F.size(elements) == 2) & (F.get(elements, F.lit(1))[END] == mark), F.lit(False))


def to_double(value):
    return value.try_cast("double")


def to_bigint(value):
    return value.try_cast("bigint")


def finite(value):
    """Value if it is neither NaN nor infinite, else NULL."""
    return F.when(~F.isnan(value) & (F.abs(value) < float("inf")), value)


# The exchange's own number at the end of a trade id (``BTCUSDT-123`` gives 123), else NULL.
TRADE_SEQUENCE = "try_cast(substring_index(trade_id, '-', -1) AS BIGINT)"


def trade_sequence():
    """The number of the trade id in the column ``trade_id``."""
    return F.expr(TRADE_SEQUENCE)


def symbol_list(symbols):
    """Comma list to lower-case names without blanks; a ready list passes through the same rule."""
    parts = symbols.split(",") if isinstance(symbols, str) else symbols
    return [p.strip().lower() for p in parts if p.strip()]
