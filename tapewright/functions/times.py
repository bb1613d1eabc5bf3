"""Epoch arithmetic and time text that do not depend on the session time zone."""

from pyspark.sql import functions as F

# 0001-01-01 and 9999-12-31 in epoch milliseconds: the span Spark timestamps are documented for.
MIN_EVENT_MS = -62135596800000
MAX_EVENT_MS = 253402300799999

DAY_MS = 86_400_000


def _col(c):
    return F.col(c) if isinstance(c, str) else c


def _epoch():
    return F.expr("TIMESTAMP_NTZ'1970-01-01 00:00:00'")


def floor_div(value, unit):
    """Floored whole-number division, also right below zero."""
    value = _col(value)
    return F.call_function("div", value - F.pmod(value, F.lit(unit)), F.lit(unit))


def event_timestamp(event_ms):
    """Epoch ms to TIMESTAMP; a value no timestamp can hold gives NULL where the plain cast would
    end the job with an overflow."""
    event_ms = _col(event_ms)
    return F.when(event_ms.between(MIN_EVENT_MS, MAX_EVENT_MS), F.timestamp_millis(event_ms))


def ntz_millis(ts):
    """Epoch ms of a zone-less timestamp, read as UTC and floored."""
    return floor_div(F.timestamp_diff("MICROSECOND", _epoch(), _col(ts)), 1000)


def _utc_text(seconds):
    """'yyyy-MM-dd HH:mm:ss' in UTC."""
    return F.timestamp_add("SECOND", seconds, _epoch()).cast("string")


def iso_utc(ts):
    """ISO-8601 with a +00:00 offset; the fraction has six digits and is left out when zero."""
    micros = F.unix_micros(_col(ts))
    fraction = F.pmod(micros, F.lit(1_000_000))
    return F.concat(
        F.translate(_utc_text(floor_div(micros, 1_000_000)), " ", "T"),
        F.when(fraction != 0, F.concat(F.lit("."), F.lpad(fraction.cast("string"), 6, "0"))).otherwise(""),
        F.lit("+00:00"),
    )


def utc_date(epoch_ms):
    """'yyyy-MM-dd' in UTC of an epoch-ms value; NULL outside the timestamp span."""
    epoch_ms = _col(epoch_ms)
    return F.when(
        epoch_ms.between(MIN_EVENT_MS, MAX_EVENT_MS),
        F.substring(_utc_text(floor_div(epoch_ms, 1000)), 1, 10),
    )


def utc_clock(epoch_ms):
    """'HH:mm:ss' in UTC of an epoch-ms value; NULL outside the timestamp span."""
    epoch_ms = _col(epoch_ms)
    return F.when(
        epoch_ms.between(MIN_EVENT_MS, MAX_EVENT_MS),
        F.substring(_utc_text(floor_div(epoch_ms, 1000)), 12, 8),
    )


def epoch_seconds(ts):
    return F.unix_seconds(_col(ts))


def now_millis():
    """Query start time in epoch ms; constant within one micro-batch and the same on its replay."""
    return F.unix_millis(F.current_timestamp())
