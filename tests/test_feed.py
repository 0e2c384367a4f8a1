"""What becomes of a feed message: its route, and the trade that a match gives."""

import json

import pytest

from barforge.sources.feed import feed_to_trades, parse_feed, route_feed


def _match(**changes):
    """A match of the SOL-EUR book; a change to ``...`` leaves the field out."""
    message = {"type": "match", "product_id": "SOL-EUR", "side": "sell", "trade_id": 71, "sequence": 9,
               "price": "142.5", "size": "3", "time": "2024-02-29T23:59:59.000001Z"} | changes
    return {k: v for k, v in message.items() if v is not ...}


def _raw(spark, *messages):
    return spark.createDataFrame([(m if isinstance(m, str) else json.dumps(m),) for m in messages], "value string")


def _route(spark, message):
    return route_feed(parse_feed(_raw(spark, message))).first()["route"]


def test_match_gives_a_trade_of_the_six_contract_fields(spark):
    (trade,) = feed_to_trades(_raw(spark, _match(maker_order_id="m", extra=[1, 2]))).collect()
    assert trade.asDict() == {"symbol": "SOL-EUR", "side": "sell", "trade_id": 71, "price": 142.5, "size": 3.0,
                              "ts": "2024-02-29T23:59:59.000001Z"}


@pytest.mark.parametrize("text, value", [("0.5", 0.5), ("7", 7.0), ("2.5e-07", 2.5e-07), ("-1", -1.0), (" 4 ", 4.0)])
def test_quoted_numbers_become_doubles(spark, text, value):
    (trade,) = feed_to_trades(_raw(spark, _match(size=text))).collect()
    assert trade["size"] == value


@pytest.mark.parametrize("field", ["product_id", "price", "size", "side", "trade_id", "time"])
@pytest.mark.parametrize("lost", [..., None])
def test_match_that_lacks_a_field_is_a_reject(spark, field, lost):
    assert _route(spark, _match(**{field: lost})) == "reject"


@pytest.mark.parametrize("text", ["NaN", "Infinity", "12d", "0x1F", "", "1,5", "--3"])
def test_match_with_text_that_is_no_plain_number_is_a_reject(spark, text):
    assert _route(spark, _match(price=text)) == "reject"


@pytest.mark.parametrize("message, route", [
    (_match(), "trade"), (_match(type="last_match"), "ignored"), ({"type": "ticker"}, "ignored"), ({}, "ignored"),
    ({"type": "heartbeat"}, "heartbeat"), ({"type": "subscriptions", "channels": []}, "subscriptions"),
    ({"type": "error"}, "error"), ("{\"type\": ", "undecodable"), ("7", "undecodable"), ("[]", "undecodable")])
def test_route_follows_the_type(spark, message, route):
    assert _route(spark, message) == route


def test_only_trades_pass(spark):
    got = feed_to_trades(_raw(spark, _match(trade_id=1), _match(price="?"), {"type": "error"}, _match(trade_id=2))).collect()
    assert [t["trade_id"] for t in got] == [1, 2]
