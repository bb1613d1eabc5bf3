"""Structured Streaming queries: candles, raw trades, archive, publishing."""
