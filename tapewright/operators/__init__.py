"""DataFrame to DataFrame operators; all run on batch tables, the stateless ones and candles on streams too."""
