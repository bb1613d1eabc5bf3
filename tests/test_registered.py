"""Every registered query against its SQL counterpart on the smallest tables."""

import pytest
from oracle import compare, connect

import __spark_entry__ as entry

SF = "/root/testdata/sf0.001"
QUERIES, ORACLE = entry.queries(), entry.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.mark.parametrize("name", list(entry._trade_sql()))
def test_matches_sql(spark, con, name):
    assert compare(spark, con, name, QUERIES[name], ORACLE[name], SF) is None


def test_every_query_has_sql():
    assert {q.__name__ for q in entry._QUERIES} == set(entry._trade_sql())


@pytest.mark.parametrize("name", ["ohlcv_1h", "candles_last_n", "trade_tape", "stream_archive_roundtrip"])
def test_time_zone_does_not_matter(spark, con, name):
    other = spark.newSession()
    other.conf.set("spark.sql.session.timeZone", "America/New_York")
    assert compare(other, con, name, QUERIES[name], ORACLE[name], SF) is None


def test_entry(spark):
    frame = entry.entry(spark)
    assert frame.count() > 0
