"""The continuous queries. Each owns a checkpoint, which is also its read position."""

from tapewright.operators import candles as candle_ops
from tapewright.operators import decode
from tapewright.sources.log import FLUSH_ROWS
from tapewright.streaming import batches, progress, sinks


# How often the archive flushes when the caller follows the stream.
ARCHIVE_EVERY = "60 seconds"
# End of fixed values.


def _triggered(writer, every):
    """``every`` is an interval such as '60 seconds', or None to process what is there and end."""
    return writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)


def candle_stream(
    trades, window_seconds=candle_ops.DEFAULT_WINDOW_SECONDS, watermark=candle_ops.DEFAULT_WATERMARK, plain_ids=False
):
    """Candles of a trade stream with the watermark in place."""
    return candle_ops.candles(trades, window_seconds, watermark, plain_ids)


def start_candles(
    trades,
    table,
    checkpoint,
    rejects_path,
    window_seconds=candle_ops.DEFAULT_WINDOW_SECONDS,
    watermark=candle_ops.DEFAULT_WATERMARK,
    output_mode="append",
    every=None,
    plain_ids=False,
):
    """Upserts candles by (symbol, window_start); a candle without any price goes to ``rejects_path``.

    ``append`` writes a window once, when the watermark passes its end; ``update`` writes its state so
    far with every batch. Either way a key occurs once per batch. ``plain_ids`` tells that all ids are as the exchange
    feed makes them, which is faster, see :func:`candles.candles`.
    """
    writer = (
        candle_stream(trades, window_seconds, watermark, plain_ids)
        .writeStream.outputMode(output_mode)
        .option("checkpointLocation", checkpoint)
        .foreachBatch(sinks.upsert_batch(table, rejects_path, unique=True))
    )
    return _triggered(writer, every).start()


def start_raw_trades(trades, table, checkpoint, rejects_path, every=None):
    """Upserts every trade by id; one with a missing field goes to ``rejects_path``. No watermark: a late trade is
    stored like any other.
    """
    projected = decode.raw_trades(trades, carry=[c for c in table.order_by if c not in table.schema.fieldNames()])
    writer = progress.observed(projected).writeStream.option("checkpointLocation", checkpoint).foreachBatch(
        sinks.upsert_batch(table, rejects_path)
    )
    return _triggered(writer, every).start()


def start_pipeline(trades, candle_table, trade_table, checkpoints, rejects, console=False, **candle_options):
    """The whole serving side of one trade stream: stored trades, candles, and candles on the console if asked. Each
    query reads the source on its own, keeps its own position below ``checkpoints`` and what it can't store in ``raw``
    or ``candles`` below ``rejects``.
    """
    every = candle_options.get("every")
    queries = [
        start_raw_trades(trades, trade_table, f"{checkpoints}/raw", f"{rejects}/raw", every),
        start_candles(trades, candle_table, f"{checkpoints}/candles", f"{rejects}/candles", **candle_options),
    ]
    if console:
        seconds = candle_options.get("window_seconds", candle_ops.DEFAULT_WINDOW_SECONDS)
        queries.append(start_console(trades, f"{checkpoints}/console", seconds, every))
    return queries


def start_archive(trades, root, checkpoint, every=None, event_date=False, files=8, max_records_per_file=1_000_000):
    """Appends trades to ``root/trades/dt=/symbol_part=/batch=`` as Snappy Parquet, exactly once, and to the flush log
    ``root/flushes``.

    A flush is a micro-batch: time-bound by ``every`` (usually ``ARCHIVE_EVERY``), size-bound by the source's limit per
    trigger (``sources.log.FLUSH_ROWS`` by default for a log). ``files`` bounds the files of one folder in a flush, see
    ``sinks.archive_batch``. The rows of a flush and their times are counted in its own pass and reported, see
    ``progress.ProgressLog``.
    """
    writer = progress.observed(trades).writeStream.option("checkpointLocation", checkpoint).foreachBatch(
        sinks.archive_batch(root, event_date, files, max_records_per_file)
    )
    return _triggered(writer, every).start()


def start_triggered_archive(trades, root, checkpoint, rows_per_symbol=FLUSH_ROWS, seconds=60, every=None, **options):
    """The archive with both of its triggers: a flush when a symbol has ``rows_per_symbol`` waiting trades, or when
    ``seconds`` have passed since the last one, whatever batches the source makes. ``every`` is how often to look.

    Time is looked at when a batch comes; trades that wait while none does are archived with the next one. See
    ``sinks.triggered_archive_batch`` for ``options``.
    """
    writer = progress.observed(trades).writeStream.option("checkpointLocation", checkpoint).foreachBatch(
        sinks.triggered_archive_batch(root, rows_per_symbol, seconds, **options)
    )
    return _triggered(writer, every).start()


def start_ticker(trades, root, checkpoint, window_seconds=candle_ops.DEFAULT_WINDOW_SECONDS, every=None, plain_ids=False):
    """The ticker's changes as candles close, see ``sinks.ticker_batch``; ``sinks.read_ticker`` reads them."""
    closed = candle_stream(trades, window_seconds, plain_ids=plain_ids).where("close_price IS NOT NULL")
    writer = closed.writeStream.outputMode("append").option("checkpointLocation", checkpoint).foreachBatch(sinks.ticker_batch(root))
    return _triggered(writer, every).start()


def start_publish(messages, checkpoint, fmt="kafka", options=None, every=None):
    """Exchange messages to canonical trades on the log, keyed by symbol.

    As text, the messages go to folders of batches below the option ``path``; see :func:`start_rejects`.
    """
    out = decode.serialize_trades(decode.normalize_feed(messages))
    if fmt == "text":
        folder = options["path"]

        def write(rows, batch_id):
            text = rows.select("value")
            store = lambda: text.write.mode("overwrite").text(f"{folder}/batch={batch_id}")
            batches.write_once(rows, folder, batch_id, store)

        writer = out.writeStream.foreachBatch(write)
    else:
        writer = out.writeStream.format(fmt).options(**(options or {}))
    return _triggered(writer.option("checkpointLocation", checkpoint), every).start()


def start_rejects(messages, path, checkpoint, kind="feed", every=None):
    """Keeps the messages the other queries skip, with payload and reasons, in folders of batches;
    ``sinks.read_rejects`` reads them.

    A stream with another checkpoint is refused there, as its batch ids would collide.
    """
    bad = decode.feed_rejects(messages) if kind == "feed" else decode.decode_rejects(messages)
    writer = bad.writeStream.option("checkpointLocation", checkpoint).foreachBatch(
        lambda rows, batch_id: sinks.write_rejects(rows, path, batch_id)
    )
    return _triggered(writer, every).start()


def start_console(trades, checkpoint, window_seconds=candle_ops.DEFAULT_WINDOW_SECONDS, every=None):
    """Prints closed candles."""
    writer = (
        candle_stream(trades, window_seconds)
        .writeStream.outputMode("append")
        .format("console")
        .option("checkpointLocation", checkpoint)
    )
    return _triggered(writer, every).start()
