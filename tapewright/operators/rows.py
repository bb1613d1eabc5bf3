"""Row filters that keep costly expressions single."""

from pyspark.sql import functions as F


def emit_where(rows, condition, *columns):
    """Rows meeting ``condition``, with ``columns``.

    A filter over parsed text is pushed below the projection that parses it, and the parse is then
    copied into it once per use. Emitting zero or one row from a generator has no such copy; use it
    where the condition reads parsed members, and ``where`` everywhere else.
    """
    return rows.select(F.inline(F.when(condition, F.array(F.struct(*columns)))))


def reason_list(joined):
    """Comma-joined reasons as an array. Nearly all rows have none, so joining first is cheap."""
    return F.when(joined == "", F.array().cast("array<string>")).otherwise(F.split(joined, ","))
