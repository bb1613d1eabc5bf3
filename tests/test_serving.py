import json

import pytest
from plans import plan_of
from pyspark.sql import functions as F

from tapewright.operators.keyed import KeyedTable
from tapewright.operators.ordered import with_previous, with_running_total
from tapewright.plans import serving
from tapewright.schemas import CANDLE, TRADE


@pytest.fixture(scope="module")
def candle_rows(spark):
    data = [("ABC", n * 10, float(n), 2.0 + n) for n in range(8)] + [("XYZ", 5, 9.5, 12345.625), ("NEG", 5, 1.0, 3.0)]
    frame = spark.createDataFrame(data, "symbol string, at int, low double, close double")
    return frame.select(
        "symbol",
        F.timestamp_seconds("at").alias("window_start"),
        F.timestamp_seconds(F.col("at") + 10).alias("window_end"),
        F.col("low").alias("open_price"),
        F.col("close").alias("high_price"),
        F.col("low").alias("low_price"),
        F.col("close").alias("close_price"),
        F.lit(1.5).alias("volume"),
        F.lit(2).cast("long").alias("trade_count"),
    )


@pytest.fixture(scope="module")
def trade_rows(spark):
    data = [(f"ABC-{n}", "ABC", 9.99999 if n % 2 else 10.0, 1234.56785, "buy", 1000 * (n // 3)) for n in range(12)]
    return spark.createDataFrame(data, TRADE)


def test_symbols(candle_rows):
    assert [r.symbol for r in serving.symbols(candle_rows).collect()] == ["ABC", "NEG", "XYZ"]


def test_candles_newest_kept_oldest_first(candle_rows):
    rows = serving.candles(candle_rows, "abc", 3).collect()
    assert [r.window_start for r in rows] == [f"1970-01-01T00:00:{s}+00:00" for s in ("50", "60", "70")[:1]] + [
        "1970-01-01T00:01:00+00:00",
        "1970-01-01T00:01:10+00:00",
    ]
    assert rows[0].window_end == "1970-01-01T00:01:00+00:00"
    assert len(rows[0]) == 9
    assert serving.candles(candle_rows, "ABC", 3).collect() == rows


def test_unknown_symbol_is_empty(candle_rows, trade_rows):
    assert serving.candles(candle_rows, "nope").collect() == []
    assert serving.latest_trades(trade_rows, "nope").collect() == []


@pytest.mark.parametrize("limit", [0, 501, -1, True, 1.5, "5"])
def test_candle_limits(candle_rows, limit):
    with pytest.raises(ValueError):
        serving.candles(candle_rows, "ABC", limit)


@pytest.mark.parametrize("limit", [0, 201])
def test_trade_limits(trade_rows, limit):
    with pytest.raises(ValueError):
        serving.latest_trades(trade_rows, "ABC", limit)


def test_limits_at_the_edge(candle_rows, trade_rows):
    assert serving.candles(candle_rows, "ABC", 500).count() == 8
    assert serving.latest_trades(trade_rows, "ABC", 200).count() == 12


def test_latest_trades_ties_by_number(trade_rows):
    got = [r.trade_id for r in serving.latest_trades(trade_rows, "abc", 4).collect()]
    assert got == ["ABC-11", "ABC-10", "ABC-9", "ABC-8"]


def test_since_bounds_the_lookup(spark, candle_rows, trade_rows, tmp_path):
    assert [r.time for r in serving.chart_series(candle_rows, "abc", 5, since_ms=60000).collect()] == [60, 70]
    assert [r.event_time for r in serving.latest_trades(trade_rows, "abc", 9, since_ms=3000).collect()] == [3000] * 3
    trade_rows.write.parquet(str(tmp_path / "t"))
    text = plan_of(serving.trade_tape(spark.read.parquet(str(tmp_path / "t")), "abc", since_ms=3000))
    assert "GreaterThanOrEqual(event_time,3000)" in text


def test_stats(candle_rows, trade_rows, spark):
    row = serving.pipeline_stats(candle_rows, trade_rows).first()
    assert tuple(row) == (10, 12, 3, "1970-01-01T00:01:20+00:00")
    empty = serving.pipeline_stats(spark.createDataFrame([], CANDLE), spark.createDataFrame([], TRADE)).collect()
    assert [tuple(r) for r in empty] == [(0, 0, 0, None)]


def test_latest_prices_and_message(candle_rows):
    rows = serving.latest_prices(candle_rows).collect()
    assert [(r.symbol, r.price) for r in rows] == [("ABC", 9.0), ("NEG", 3.0), ("XYZ", 12345.625)]
    message = json.loads(serving.price_message(candle_rows).first().message)
    assert message["type"] == "price_update"
    assert message["prices"] == [r.asDict() for r in rows]


def test_ticker_changes(candle_rows):
    rows = {(r.symbol, r.window_start_ms): r for r in serving.ticker_changes(candle_rows, chunk_ms=20000).collect()}
    first, second = rows["ABC", 0], rows["ABC", 10000]
    assert (first.previous, first.change, first.percent, first.direction) == (2.0, 0.0, 0.0, "up")
    assert (first.price_label, first.percent_label) == ("2.0000", "+0.00%")
    assert (second.previous, second.change, second.percent, second.percent_label) == (2.0, 1.0, 50.0, "+50.00%")
    assert rows["XYZ", 5000].price_label == "12,345.63"
    assert [rows["ABC", n * 10000].previous for n in range(8)] == [2.0, 2.0, 3.0, 4.0, 5.0, 6.0, 7.0, 8.0]


def test_falling_price_labels(spark):
    data = [("A", 0, 0.0), ("A", 10, 5.0), ("A", 20, 4.9999), ("A", 30, 2.5)]
    frame = spark.createDataFrame(data, "symbol string, at int, close_price double").withColumn(
        "window_start", F.timestamp_seconds("at")
    )
    rows = sorted(serving.ticker_changes(frame).collect(), key=lambda r: r.window_start_ms)
    # From zero there is no percentage; a fall too small for two decimals keeps its sign.
    assert [(r.direction, r.percent_label) for r in rows] == [
        ("up", "+0.00%"),
        ("up", "+0.00%"),
        ("down", "-0.00%"),
        ("down", "-50.00%"),
    ]


def test_chart_series(candle_rows):
    rows = serving.chart_series(candle_rows, "abc", 2).collect()
    assert [tuple(r) for r in rows] == [(60, 6.0, 8.0, 6.0, 8.0), (70, 7.0, 9.0, 7.0, 9.0)]


def test_trade_tape(trade_rows):
    rows = serving.trade_tape(trade_rows, "ABC", 2).collect()
    assert [tuple(r) for r in rows] == [
        ("ABC-11", "00:00:03", "10.0000", "1,234.5679", "BUY"),
        ("ABC-10", "00:00:03", "10.00", "1,234.5679", "BUY"),
    ]


def test_lookups_push_the_symbol_and_use_top_k(spark, tmp_path, trade_rows, candle_rows):
    trade_rows.write.parquet(str(tmp_path / "t"))
    candle_rows.write.parquet(str(tmp_path / "c"))
    text = plan_of(serving.latest_trades(spark.read.parquet(str(tmp_path / "t")), "abc"))
    assert "EqualTo(symbol,ABC)" in text and "TakeOrderedAndProject" in text and "Exchange" not in text
    text = plan_of(serving.chart_series(spark.read.parquet(str(tmp_path / "c")), "abc"))
    assert "EqualTo(symbol,ABC)" in text and "TakeOrderedAndProject" in text
    assert "volume" not in text.split("ReadSchema: ")[1].split("\n")[0]


def test_both_sides_of_the_carry_share_one_shuffle(spark, candle_rows):
    frame = serving.ticker_changes(candle_rows)
    frame.collect()
    assert "ReusedExchange" in frame._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("chunk", [1, 3, 1000])
def test_previous_and_running_total_in_chunks(spark, chunk):
    data = [(k, n * 7 - 20, n) for k in ("a", "b") for n in range(15)]
    frame = spark.createDataFrame(data, "k string, o long, v long").repartition(3)
    previous = {(r.k, r.o): r.previous for r in with_previous(frame, "k", "o", "v", chunk).collect()}
    assert previous == {(k, o): (n - 1 if n else None) for k, o, n in data}
    single = frame.where("k = 'a'")
    totals = {r.o: r.running_total for r in with_running_total(single, "o", "v", chunk).collect()}
    assert totals == {n * 7 - 20: sum(range(n + 1)) for n in range(15)}


def test_stored_tables_are_read_by_symbol(spark, tmp_path, trade_rows, candle_rows):
    """Lookups over tables as the streams write them push the symbol into the scan of all batches."""
    raw = KeyedTable(str(tmp_path / "raw"), TRADE, ("trade_id",), cluster_by=("symbol", "event_time"), determined=("symbol",))
    ohlcv = KeyedTable(str(tmp_path / "ohlcv"), CANDLE, ("symbol", "window_start"), cluster_by=("symbol", "window_start"))
    for batch in (0, 1):
        raw.write_batch(trade_rows, batch)
        ohlcv.write_batch(candle_rows, batch, unique=True)
    for frame in (serving.latest_trades(raw.read(spark), "abc"), serving.trade_tape(raw.read(spark), "abc"), serving.candles(ohlcv.read(spark), "abc"), serving.chart_series(ohlcv.read(spark), "abc")):
        assert "EqualTo(symbol,ABC)" in plan_of(frame)
    assert serving.latest_trades(raw.read(spark), "abc").collect() == serving.latest_trades(trade_rows, "abc").collect()
    assert serving.candles(ohlcv.read(spark), "abc").collect() == serving.candles(candle_rows, "abc").collect()


@pytest.mark.parametrize("lg_k", [10, 14])
def test_merged_sketches_stay_within_their_error(spark, lg_k):
    rows = spark.range(200_000).selectExpr("id % 7 AS day", "CAST(id % 50000 AS STRING) AS symbol")
    sketched = serving.sketches(rows, "day", "symbol", lg_k)
    assert sketched.count() == 7
    guess = serving.sketched_count(sketched).first().approx_distinct
    assert abs(guess - 50_000) <= 4 * 0.8 / 2 ** (lg_k / 2) * 50_000
    assert serving.sketched_count(serving.sketches(rows.where("day > 9"), "day", "symbol")).first().approx_distinct in (None, 0)
