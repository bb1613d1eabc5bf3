"""Row layouts shared by every module."""

from pyspark.sql import types as T

TRADE = T.StructType(
    [
        T.StructField("trade_id", T.StringType()),
        T.StructField("symbol", T.StringType()),
        T.StructField("price", T.DoubleType()),
        T.StructField("quantity", T.DoubleType()),
        T.StructField("side", T.StringType()),
        T.StructField("event_time", T.LongType()),
    ]
)
TRADE_COLUMNS = TRADE.fieldNames()

CANDLE = T.StructType(
    [
        T.StructField("symbol", T.StringType()),
        T.StructField("window_start", T.TimestampType()),
        T.StructField("window_end", T.TimestampType()),
        T.StructField("open_price", T.DoubleType()),
        T.StructField("high_price", T.DoubleType()),
        T.StructField("low_price", T.DoubleType()),
        T.StructField("close_price", T.DoubleType()),
        T.StructField("volume", T.DoubleType()),
        T.StructField("trade_count", T.LongType()),
    ]
)
CANDLE_COLUMNS = CANDLE.fieldNames()

# Archive files hold the trade columns and the write stamp; dt, symbol_part and batch live in the path.
ARCHIVE_FILE = T.StructType(TRADE.fields + [T.StructField("written_at", T.LongType())])
ARCHIVE_ROWS = T.StructType(
    ARCHIVE_FILE.fields
    + [T.StructField("dt", T.StringType()), T.StructField("symbol_part", T.StringType())]
)
ARCHIVE = T.StructType(ARCHIVE_ROWS.fields + [T.StructField("batch", T.LongType())])
# The folders of archive files below the root of the trades; a slot is one file, or several of limited size.
ARCHIVE_FOLDERS = T.StructType(ARCHIVE.fields[-3:] + [T.StructField("slot", T.IntegerType())])

# The index of archive files, in key order within a date.
ARCHIVE_INDEX = T.StructType(
    [
        T.StructField("key", T.StringType()),
        T.StructField("length", T.LongType()),
        T.StructField("modified", T.TimestampType()),
    ]
)

# The flush log: one row per archive file.
FLUSH = T.StructType(
    [
        T.StructField("flush", T.LongType()),
        T.StructField("symbol", T.StringType()),
        T.StructField("path", T.StringType()),
        T.StructField("records", T.LongType()),
        T.StructField("size_kb", T.DoubleType()),
    ]
)

# What caused a flush: its name, the rows of the symbol with most, and all rows.
TRIGGER = T.StructType(
    [
        T.StructField("trigger", T.StringType()),
        T.StructField("most", T.LongType()),
        T.StructField("records", T.LongType()),
    ]
)

LAKE_FILE = T.StructType(
    [
        T.StructField("key", T.StringType()),
        T.StructField("size_kb", T.DoubleType()),
        T.StructField("last_modified", T.StringType()),
    ]
)

REJECT = T.StructType(
    [
        T.StructField("value", T.StringType()),
        T.StructField("violations", T.ArrayType(T.StringType())),
    ]
)
