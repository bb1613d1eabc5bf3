import random

import pytest
from plans import plan_of
from pyspark.sql import functions as F

from tapewright.operators.keyed import KeyedTable, latest_candle, latest_per_key
from tapewright.schemas import TRADE
from tapewright.streaming import batches
from tapewright.streaming.sinks import merge_statement, read_rejects, upsert_batch

VERSIONED = "trade_id string, symbol string, price double, quantity double, side string, event_time long, event_id long"


def rows(spark, *items):
    """(id, price, version) triples as trades."""
    return spark.createDataFrame([(i, "ABC", float(p), 1.0, "buy", 1, v) for i, p, v in items], VERSIONED)


def content(frame):
    return sorted((r.trade_id, r.price) for r in frame.collect())


@pytest.fixture
def table(tmp_path):
    return KeyedTable(str(tmp_path / "table"), TRADE, ("trade_id",), ("event_id",), ("symbol", "event_time"))


def test_latest_per_key_does_not_depend_on_order(spark):
    items = [("a", p, p % 3) for p in range(30)] + [("b", 1, None), ("b", 2, 0)]
    random.shuffle(items)
    got = content(latest_per_key(rows(spark, *items).repartition(5), ["trade_id"], ["event_id"]))
    assert got == [("a", 29.0), ("b", 2.0)]


def test_hot_key_is_combined_before_the_shuffle(spark):
    frame = latest_per_key(rows(spark, ("a", 1, 1)), ["trade_id"], ["event_id"])
    text = plan_of(frame)
    assert "partial_max" in text and text.count("Exchange") - text.count("ReusedExchange") >= 1


def test_empty_table(spark, table):
    assert table.read(spark).collect() == []
    assert table.read(spark).schema.fieldNames() == TRADE.fieldNames()


def test_replayed_batch_adds_nothing(spark, table, tmp_path):
    write = upsert_batch(table, str(tmp_path / "rejects"))
    first, second = rows(spark, ("a", 1, 1), ("b", 1, 1)), rows(spark, ("a", 2, 2), ("c", 2, 2))
    for batch, number in [(first, 0), (second, 1), (first, 0), (second, 1)]:
        write(batch, number)
    assert content(table.read(spark)) == [("a", 2.0), ("b", 1.0), ("c", 2.0)]


def test_later_batch_wins_even_with_a_lower_version(spark, table):
    table.write_batch(rows(spark, ("a", 1, 9)), 0)
    table.write_batch(rows(spark, ("a", 2, 1)), 1)
    assert content(table.read(spark)) == [("a", 2.0)]


def test_inside_a_batch_the_version_wins(spark, table):
    table.write_batch(rows(spark, ("a", 1, 1), ("a", 3, 3), ("a", 2, 2)), 0)
    assert content(table.read(spark)) == [("a", 3.0)]


def test_many_batches(spark, table):
    expected = {}
    rng = random.Random(5)
    for batch in range(6):
        items = [(f"k{rng.randrange(8)}", batch * 10 + n, n) for n in range(4)]
        table.write_batch(rows(spark, *items), batch)
        for key, price, _ in items:
            expected[key] = float(price)
        assert content(table.read(spark)) == sorted(expected.items())


def test_files_per_batch(spark, tmp_path):
    table = KeyedTable(str(tmp_path / "few"), TRADE, ("trade_id",), ("event_id",), files_per_batch=1)
    many = rows(spark, *[(f"k{n}", n, 1) for n in range(50)]).repartition(8)
    table.write_batch(many, 0, unique=True)
    assert len(table.read(spark).inputFiles()) == 1
    assert table.read(spark).count() == 50


def test_unfinished_batches_are_not_read(spark, table, tmp_path):
    table.write_batch(rows(spark, ("a", 1, 1)), 0)
    rows(spark, ("a", 2, 2)).write.parquet(str(tmp_path / "table" / "batch=1"))  # an attempt that did not end
    assert content(table.read(spark)) == [("a", 1.0)]
    table.write_batch(rows(spark, ("a", 3, 3)), 1)
    assert content(table.read(spark)) == [("a", 3.0)]


def test_batches_count_without_marker_files(spark, table, tmp_path):
    """A cluster may be set to write no _SUCCESS files."""
    table.write_batch(rows(spark, ("a", 1, 1), ("b", 1, 1)), 0)
    (tmp_path / "table" / "batch=0" / "_SUCCESS").unlink(missing_ok=True)
    assert content(table.read(spark)) == [("a", 1.0), ("b", 1.0)]


def test_lookup_filter_reaches_all_batches(spark, tmp_path):
    table = KeyedTable(str(tmp_path / "t"), TRADE, ("trade_id",), ("event_id",), ("symbol", "event_time"), determined=("symbol",))
    table.write_batch(rows(spark, ("a", 1, 1), ("b", 1, 1)), 0)
    table.write_batch(rows(spark, ("b", 2, 2)), 1)
    found = table.read(spark).where("symbol = 'ABC' AND price < 9")
    text = plan_of(found)
    assert "EqualTo(symbol,ABC)" in text and "LessThan(price" not in text  # an older version could win a filter on other columns
    assert content(found) == [("a", 1.0), ("b", 2.0)]
    assert content(table.read(spark).where("price < 2")) == [("a", 1.0)]


def test_rejects_are_kept(spark, table, tmp_path):
    bad = rows(spark, ("a", 1, 1)).unionByName(rows(spark, ("b", 1, 1)).withColumn("price", F.lit(None).cast("double")))
    for _ in range(2):
        upsert_batch(table, str(tmp_path / "rejects"))(bad, 4)
    assert content(table.read(spark)) == [("a", 1.0)]
    kept = read_rejects(spark, str(tmp_path / "rejects")).collect()
    assert [r.violations for r in kept] == [["price:null"]]
    assert '"trade_id":"b"' in kept[0].value


def test_times_beyond_any_timestamp_are_rejected(spark, table, tmp_path):
    """No candle could hold them; so they are told, not left out."""
    far = rows(spark, ("a", 1, 1)).unionByName(rows(spark, ("b", 1, 1)).withColumn("event_time", F.lit(2**62)))
    upsert_batch(table, str(tmp_path / "rejects"))(far, 0)
    assert content(table.read(spark)) == [("a", 1.0)]
    assert [r.violations for r in read_rejects(spark, str(tmp_path / "rejects")).collect()] == [["event_time:range"]]


def test_latest_candle(spark):
    frame = spark.createDataFrame(
        [("A", 1.0, 10), ("A", 2.0, 30), ("A", 3.0, 20), ("B", 4.0, 5)], "symbol string, close_price double, at int"
    ).withColumn("window_end", F.timestamp_seconds("at"))
    got = latest_candle(frame)
    assert sorted((r.symbol, r.close_price) for r in got.collect()) == [("A", 2.0), ("B", 4.0)]
    assert "SortAggregate" not in plan_of(got)


def test_merge_statement():
    assert merge_statement("ohlcv", "ohlcv_new", ["symbol", "at", "v"], ["symbol", "at"]) == (
        "MERGE INTO ohlcv t USING ohlcv_new s ON t.symbol = s.symbol AND t.at = s.at "
        "WHEN MATCHED THEN UPDATE SET v = s.v "
        "WHEN NOT MATCHED THEN INSERT (symbol, at, v) VALUES (s.symbol, s.at, s.v)"
    )


def days(spark, first, last, per_day=10, symbol="ABC"):
    """Trades with the numbers and the days ``first`` to ``last``, all of one symbol, and one a day of another."""
    items = [(f"{symbol}-{d}-{n}", symbol, 1.0, 1.0, "buy", d * 86_400_000 + n, 0) for d in range(first, last) for n in range(per_day)]
    items += [(f"RARE-{d}", "RARE", 1.0, 1.0, "buy", d * 86_400_000, 0) for d in range(first, last)]
    return spark.createDataFrame(items, VERSIONED)


def sliced(path, **more):
    return KeyedTable(str(path), TRADE, ("trade_id",), ("event_id",), ("symbol", "event_time"), determined=("symbol", "event_time"), slice_by="event_time", **more)


def test_newest_rows_do_not_read_the_history(spark, tmp_path):
    table, read = sliced(tmp_path / "t", files_per_batch=1), []
    for batch in range(3):
        table.write_batch(days(spark, batch * 10, batch * 10 + 10), batch)
        found = table.newest(spark, F.col("symbol") == "ABC", 7)
        assert found.count() == 10
        read.append(len(found.inputFiles()))
    assert read == [1, 1, 1] and len(table.read(spark).inputFiles()) == 30
    # A symbol with few trades widens the search; one without any ends it at the last slice.
    assert table.newest(spark, F.col("symbol") == "RARE", 7).count() == 21
    assert table.newest(spark, F.col("symbol") == "RARE", 100).count() == 30
    assert table.newest(spark, F.col("symbol") == "NONE", 7).collect() == []


def test_newest_rows_are_those_of_the_whole_table(spark, tmp_path):
    table = sliced(tmp_path / "t", slice_ms=3_600_000)
    rng = random.Random(3)
    for batch in range(3):  # late trades, new versions of old ones, times below zero
        items = [(f"k{n}", rng.choice("AB"), float(batch), 1.0, "buy", n * 1_700_000 - 20_000_000, batch) for n in rng.sample(range(40), 15)]
        fixed = [(i, "A" if int(i[1:]) % 3 else "B", p, q, s, at, v) for i, _, p, q, s, at, v in items]
        table.write_batch(spark.createDataFrame(fixed, VERSIONED), batch)
    for symbol in "AB":
        for limit in (1, 3, 50):
            order = [F.desc("event_time"), "trade_id"]
            want = table.read(spark).where(F.col("symbol") == symbol).orderBy(*order).limit(limit).collect()
            assert table.newest(spark, F.col("symbol") == symbol, limit).orderBy(*order).limit(limit).collect() == want


def test_a_time_bound_reaches_the_scan(spark, tmp_path):
    table = sliced(tmp_path / "t")
    table.write_batch(days(spark, 0, 6), 0)
    since = 4 * 86_400_000 + 5
    found = table.newest(spark, F.col("symbol") == "ABC", 100, since).where(F.col("event_time") >= since)
    assert f"GreaterThanOrEqual(event_time,{since})" in plan_of(found) and "EqualTo(symbol,ABC)" in plan_of(found)
    assert found.count() == 15 and {f.split("time_slice=")[1][0] for f in found.inputFiles()} == {"4", "5"}


def test_a_sliced_batch_is_replaced_and_unfinished_ones_are_not_read(spark, tmp_path):
    table = sliced(tmp_path / "t")
    table.write_batch(days(spark, 0, 2), 0)
    (tmp_path / "t" / "_commits" / "0").unlink()
    assert table.read(spark).collect() == [] and table.newest(spark, F.col("symbol") == "ABC", 3).collect() == []
    table.write_batch(days(spark, 0, 2), 0)
    table.write_batch(days(spark, 0, 2), 0)
    assert table.read(spark).count() == 22 == spark.read.parquet(str(tmp_path / "t")).count()


def test_only_a_time_that_the_key_fixes_slices(spark, tmp_path):
    with pytest.raises(ValueError, match="determined"):
        KeyedTable(str(tmp_path / "t"), TRADE, ("trade_id",), slice_by="event_time")
    with pytest.raises(ValueError, match="not stored by time"):
        KeyedTable(str(tmp_path / "t"), TRADE, ("trade_id",)).newest(spark, F.lit(True), 1)


def test_an_owner_file_of_a_stopped_claim_names_nobody(spark, tmp_path):
    folder = tmp_path / "owned"
    folder.mkdir()
    (folder / "_owner").touch()
    batches.claim(spark, str(folder), "stream-1")
    assert (folder / "_owner").read_text() == "stream-1" and [p.name for p in folder.iterdir() if not p.name.startswith(".")] == ["_owner"]
    batches.claim(spark, str(folder), "stream-1")
    with pytest.raises(ValueError, match="belongs to the stream stream-1"):
        batches.claim(spark, str(folder), "stream-2")


def bucketed(path, **more):
    return KeyedTable(str(path), TRADE, ("trade_id",), ("event_id",), ("symbol", "event_time"), buckets=3, **more)


@pytest.mark.parametrize("sliced_by", [None, "event_time"])
def test_a_bucketed_table_resolves_versions_without_a_shuffle(spark, tmp_path, sliced_by):
    table = bucketed(tmp_path / "t", determined=("symbol", "event_time"), slice_by=sliced_by)
    assert table.read(spark).collect() == []
    for batch, price in ((0, 1.0), (1, 2.0), (1, 9.0), (2, 3.0)):
        table.write_batch(days(spark, batch, batch + 2).withColumn("price", F.lit(price)), batch)
    found = table.read(spark)
    plan = plan_of(found)
    assert "Exchange" not in plan and "Bucketed: true" in plan
    assert sorted((r.event_time // 86_400_000, r.price) for r in found.collect()) == sorted([(0, 1.0)] * 11 + [(1, 2.0)] * 11 + [(2, 3.0)] * 11 + [(3, 3.0)] * 11)
    pushed = plan_of(found.where("symbol = 'RARE'"))
    assert "EqualTo(symbol,RARE)" in pushed and "Exchange" not in pushed
    assert spark.conf.get("spark.sql.sources.partitionOverwriteMode").lower() == "static"
    if sliced_by:
        newest = table.newest(spark, F.col("symbol") == "ABC", 5)
        assert newest.count() == 10 and "PartitionFilters: [isnotnull" in plan_of(newest)


def test_a_bucketed_table_outlives_its_catalog_entry(spark, tmp_path):
    table = bucketed(tmp_path / "t")
    table.write_batch(rows(spark, ("a", 1, 1), ("b", 1, 1)), 0)
    table.write_batch(rows(spark, ("a", 2, 2)), 1)
    spark.sql(f"DROP TABLE {table._table(spark)}")
    assert content(table.read(spark)) == [("a", 2.0), ("b", 1.0)]
    # Another application writes a batch that this catalog has not seen.
    table.write_batch(rows(spark, ("b", 3, 3)), 2)
    spark.sql(f"ALTER TABLE {table._table(spark)} DROP PARTITION (batch = 2)")
    other = KeyedTable(str(tmp_path / "copy"), TRADE, ("trade_id",), ("event_id",))
    assert content(table.read(spark)) == [("a", 2.0), ("b", 3.0)] and other.read(spark).collect() == []


def test_an_unfinished_bucketed_batch_is_replaced(spark, tmp_path):
    table = bucketed(tmp_path / "t")
    table.write_batch(rows(spark, ("a", 1, 1)), 0)
    table.write_batch(rows(spark, ("a", 2, 2), ("c", 2, 2)), 1)
    (tmp_path / "t" / "_commits" / "1").unlink()
    assert content(table.read(spark)) == [("a", 1.0)]
    table.write_batch(rows(spark, ("a", 3, 3)), 1)
    assert content(table.read(spark)) == [("a", 3.0)]
