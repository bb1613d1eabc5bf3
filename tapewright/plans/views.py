"""The stored tables under their SQL names, for callers who write SQL."""

from tapewright.operators.keyed import latest_candle


def register(candle_rows, trade_rows):
    """Temporary views ``ohlcv``, ``raw_trades`` and ``latest_ohlcv`` in the session of ``candle_rows``."""
    candle_rows.createOrReplaceTempView("ohlcv")
    trade_rows.createOrReplaceTempView("raw_trades")
    latest_candle(candle_rows).createOrReplaceTempView("latest_ohlcv")
