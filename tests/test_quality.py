import json

import pytest
from plans import plan_of

from tapewright.operators import quality

TRADE = {"trade_id": "A-1", "symbol": "ABC", "price": 1.5, "quantity": 2, "side": "buy", "event_time": 10}
QUOTE = {"symbol": "ABC", "bid_price": 2, "bid_size": 1, "ask_price": 1.5, "ask_size": 1, "event_time": 0}


def reasons(spark, text, rules=quality.TRADE_RULES):
    frame = spark.createDataFrame([(text,)], "value string")
    return quality.violations(frame, rules).first().violations


@pytest.mark.parametrize(
    "changes, expected",
    [
        ({}, []),
        ({"event_time": 0}, []),
        ({"symbol": 7}, ["symbol:type"]),
        ({"symbol": "ab"}, ["symbol:length"]),
        ({"symbol": None}, ["symbol:type"]),
        ({"price": "12.5"}, ["price:type"]),
        ({"price": True}, ["price:type"]),
        ({"price": 0}, ["price:range"]),
        ({"price": -1.5, "quantity": 0.0}, ["price:range", "quantity:range"]),
        ({"side": "hold"}, ["side:enum"]),
        ({"side": "BUY"}, ["side:enum"]),
        ({"event_time": -1}, ["event_time:range"]),
        ({"event_time": "1"}, ["event_time:type"]),
        ({"venue": None}, ["record:extra"]),
        ({"trade_id": 5}, ["trade_id:type"]),
        ({"quantity": {"a": 1}}, ["quantity:type"]),
    ],
)
def test_trade_rules(spark, changes, expected):
    assert reasons(spark, json.dumps({**TRADE, **changes})) == expected


@pytest.mark.parametrize(
    "number, whole", [("1", True), ("1.0", True), ("1e2", True), ("1.5", False), ("12345678901234567.5", False), ("15e-1", False)]
)
def test_integer_is_about_the_value(spark, number, whole):
    text = json.dumps(TRADE).replace('"event_time": 10', f'"event_time": {number}')
    assert reasons(spark, text) == ([] if whole else ["event_time:type"])


def test_required_members(spark):
    for name in TRADE:
        rest = {k: v for k, v in TRADE.items() if k != name}
        assert reasons(spark, json.dumps(rest)) == [f"{name}:required"]


@pytest.mark.parametrize("text", ["not json", "[1]", "null", "", None, json.dumps(TRADE)[:-1], json.dumps([TRADE])])
def test_no_object(spark, text):
    assert reasons(spark, text) == ["record:object"]


@pytest.mark.parametrize("form", ["{0}{0}", "{0} junk }}", "{0},{0}", "{0}] [{0}", '{0}}} {{"r":{0}', "{0}]", '{0},{{"_end":"1"}}] [{0}'])
def test_text_after_the_object(spark, form):
    assert reasons(spark, form.format(json.dumps(TRADE))) == ["record:object"]


def test_quotes_may_cross(spark):
    assert reasons(spark, json.dumps(QUOTE), quality.QUOTE_RULES) == []
    assert reasons(spark, json.dumps({**QUOTE, "bid_price": 0}), quality.QUOTE_RULES) == ["bid_price:range"]


def test_split_and_counts(spark):
    texts = [json.dumps(TRADE), json.dumps({**TRADE, "price": 0, "side": "x"}), "x", json.dumps({**TRADE, "price": -1})]
    frame = spark.createDataFrame(list(enumerate(texts)), "n int, value string")
    split = quality.split_records(frame)
    rows = split.collect()
    assert [(r.n, r.value) for r in rows if r.outcome == "valid"] == [(0, texts[0])]
    assert plan_of(split).count("parse_json") <= 2  # one node, shown once or twice
    assert {r.n: r.violations for r in rows if r.outcome == "rejected"} == {
        1: ["price:range", "side:enum"],
        2: ["record:object"],
        3: ["price:range"],
    }
    counts = {r.violation: r.records for r in quality.violation_counts(quality.violations(frame)).collect()}
    assert counts == {"price:range": 2, "side:enum": 1, "record:object": 1}


def test_split_complete_keeps_nan(spark):
    rows = spark.createDataFrame([("a", 1.0), (None, 1.0), ("b", None), ("c", float("nan"))], "k string, v double")
    good, bad = quality.split_complete(rows, ["k", "v"])
    assert sorted(r.k for r in good.collect()) == ["a", "c"]
    assert sorted((r.violations for r in bad.collect())) == [["k:null"], ["v:null"]]
