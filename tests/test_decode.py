import json

import pytest
from plans import plan_of

from tapewright.functions.text import symbol_list
from tapewright.operators import decode


def messages(spark, *texts):
    return spark.createDataFrame([(t,) for t in texts], "value string")


def trade(**changes):
    body = {"trade_id": "A-1", "symbol": "ABC", "price": 1.5, "quantity": 2, "side": "buy", "event_time": 10}
    body.update(changes)
    return json.dumps({k: v for k, v in body.items() if v is not ...})


def one(spark, text):
    return [tuple(r) for r in decode.decode_trades(messages(spark, text)).collect()]


@pytest.mark.parametrize(
    "text", ["not json", "[1]", "null", "", "  ", '[{"trade_id":"A-1"}]', "{'trade_id':'x'}", '{"trade_id":"A', None, "7"]
)
def test_undecodable_is_dropped_and_rejected(spark, text):
    assert one(spark, text) == []
    bad = decode.decode_rejects(messages(spark, text)).collect()
    assert [(r.value, r.violations) for r in bad] == [(text, ["message:object"])]


@pytest.mark.parametrize(
    "changes, expected",
    [
        ({}, ("A-1", "ABC", 1.5, 2.0, "buy", 10)),
        ({"price": "12.5"}, ("A-1", "ABC", 12.5, 2.0, "buy", 10)),
        ({"symbol": 7}, ("A-1", "7", 1.5, 2.0, "buy", 10)),
        ({"event_time": 1.5}, ("A-1", "ABC", 1.5, 2.0, "buy", None)),
        ({"quantity": {"a": 1}}, ("A-1", "ABC", 1.5, None, "buy", 10)),
        ({"price": "abc"}, ("A-1", "ABC", None, 2.0, "buy", 10)),
        ({"symbol": ...}, ("A-1", None, 1.5, 2.0, "buy", 10)),
        ({"side": None}, ("A-1", "ABC", 1.5, 2.0, None, 10)),
        ({"venue": "x"}, ("A-1", "ABC", 1.5, 2.0, "buy", 10)),
        ({"event_time": 10**30}, ("A-1", "ABC", 1.5, 2.0, "buy", None)),
    ],
)
def test_bad_field_is_null(spark, changes, expected):
    assert one(spark, trade(**changes)) == [expected]
    assert one(spark, " \n" + trade(**changes) + "\t ") == [expected]


TRAILING = ["{0}{0}", "{0} junk }}", "{0},{0}", "{0}] [{0}", '{0}}} {{"r":{0}', "{0}]", "{0},", '{0},{{"_end":"1"}}] [{0}', "{0} // note"]


@pytest.mark.parametrize("form", TRAILING)
def test_text_after_the_object_is_rejected(spark, form):
    text = form.format(trade())
    assert one(spark, text) == []
    assert [r.violations for r in decode.decode_rejects(messages(spark, text)).collect()] == [["message:object"]]
    for body in (json.dumps(feed()), json.dumps({"stream": "x", "data": feed()})):
        message = messages(spark, form.format(body))
        assert decode.normalize_feed(message).collect() == []
        assert [r.violations for r in decode.feed_rejects(message).collect()] == [["message:event"]]


def test_one_parse_per_message(spark):
    for build in (decode.decode_trades, decode.decode_with_rejects, decode.normalize_feed, decode.feed_rejects):
        assert plan_of(build(messages(spark, trade()))).count("from_json(") <= 2  # one node, shown once or twice


def test_rejects_tell_misfits_but_not_missing_fields(spark):
    texts = [trade(), trade(symbol=...), trade(price="x", event_time=1.5)]
    bad = decode.decode_rejects(messages(spark, *texts)).collect()
    assert [(r.value, r.violations) for r in bad] == [(texts[2], ["price:type", "event_time:type"])]


def feed(**changes):
    body = {"e": "trade", "s": "BTCUSDT", "t": 5, "p": "1.5", "q": "0.25", "m": True, "T": 123}
    body.update(changes)
    return {k: v for k, v in body.items() if v is not ...}


GOOD = ("BTCUSDT-5", "BTCUSDT", 1.5, 0.25, "sell", 123)


@pytest.mark.parametrize(
    "message, expected",
    [
        (feed(), GOOD),
        ({"stream": "btcusdt@trade", "data": feed()}, GOOD),
        (feed(m=False), GOOD[:4] + ("buy", 123)),
        (feed(s="btcusdt"), ("btcusdt-5", "btcusdt") + GOOD[2:]),
        (feed(p=1.5, q=0.25), GOOD),
        (feed(T="123"), GOOD),
        (feed(t="5"), GOOD),
        (feed(s="database"), ("database-5", "database") + GOOD[2:]),
    ],
)
def test_feed_mapping(spark, message, expected):
    rows = decode.normalize_feed(messages(spark, json.dumps(message))).collect()
    assert [tuple(r) for r in rows] == [expected]
    assert decode.feed_rejects(messages(spark, json.dumps(message))).count() == 0


@pytest.mark.parametrize(
    "message, reasons",
    [
        ({"data": None, "e": "trade"}, ["message:event"]),
        ({"data": "x", **feed()}, ["message:event"]),
        (feed(m=...), ["m:unusable"]),
        (feed(m="true"), ["m:unusable"]),
        (feed(s=None, T=1.9), ["s:unusable", "T:unusable"]),
        (feed(p="abc", q="NaN"), ["p:unusable", "q:unusable"]),
        (feed(t=...), ["t:unusable"]),
    ],
)
def test_feed_rejects(spark, message, reasons):
    frame = messages(spark, json.dumps(message))
    assert decode.normalize_feed(frame).count() == 0
    assert [r.violations for r in decode.feed_rejects(frame).collect()] == [reasons]


def test_other_events_are_dropped_silently(spark):
    frame = messages(spark, json.dumps(feed(e="ping")), json.dumps({"data": feed(e="aggTrade")}))
    assert decode.normalize_feed(frame).count() == 0
    assert decode.feed_rejects(frame).count() == 0


def test_one_bad_message_does_not_stop_the_feed(spark):
    frame = messages(spark, "garbage", "", json.dumps(feed()), json.dumps(feed())[:40])
    assert decode.normalize_feed(frame).count() == 1
    assert decode.feed_rejects(frame).count() == 3


def test_symbol_list():
    assert symbol_list(" BTCusdt, ,ethusdt,") == ["btcusdt", "ethusdt"]
    assert symbol_list("") == []


def test_select_symbols(spark, trades_frame):
    rows = trades_frame([("A-1", "Abc", 1.0, 1.0, "buy", 1), ("B-1", "BCD", 1.0, 1.0, "buy", 1)])
    assert [r.symbol for r in decode.select_symbols(rows, "abc").collect()] == ["Abc"]
    pair = trades_frame([("A-1", "BTCUSDT", 1.0, 1.0, "buy", 1), ("B-1", "ZZZ", 1.0, 1.0, "buy", 1)])
    assert [r.symbol for r in decode.select_symbols(pair).collect()] == ["BTCUSDT"]
    table = spark.createDataFrame([(" bcd ",), ("",), ("BCD",)], "symbol string")
    assert [r.symbol for r in decode.select_symbols(rows, table).collect()] == ["BCD"]


def test_serialize_round_trip(spark, trades_frame):
    rows = [("A-1", "Abc", 1.25, 0.1, "buy", 1), ("B-1", "BCD", 1e-7, 3.0, "sell", 2)]
    out = decode.serialize_trades(trades_frame(rows))
    assert [r.key for r in out.collect()] == ["Abc", "BCD"]
    assert sorted(tuple(r) for r in decode.decode_trades(out).collect()) == rows


def test_raw_projection(trades_frame):
    row = decode.raw_trades(trades_frame([("a-1", "abc", 1.0, 2.0, "buy", 3)])).first()
    assert tuple(row) == ("a-1", "ABC", 1.0, 2.0, "buy", 3)
