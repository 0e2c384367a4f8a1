"""Scalar expressions not covered elsewhere (F12, F13, F16, strict numbers)."""

import json

from pyspark.sql import functions as F

from barforge.functions.exprs import axis_pad, clean_number, strict_double, trade_json, typical_price


def test_axis_pad(spark):
    df = spark.createDataFrame([(1.0, 1.0), (100.0, 110.0)], "lo double, hi double")
    assert [r["p"] for r in df.select(axis_pad("lo", "hi").alias("p")).collect()] == [1.0, (110.0 - 100.0) * 0.08]


def test_clean_number(spark):
    df = spark.createDataFrame([("1.5",), (None,), ("NaN",), ("abc",), ("7",)], "x string")
    assert [r["c"] for r in df.select(clean_number("x").alias("c")).collect()] == [1.5, 0.0, 0.0, 0.0, 7.0]


def test_strict_double(spark):
    texts = ["1", "1.5", ".5", "8e-08", " 2 ", "-3.0", "nan", "inf", "1f", "1.0d", "1_000", "", None]
    got = [r["d"] for r in spark.createDataFrame([(t,) for t in texts], "t string").select(strict_double("t").alias("d")).collect()]
    assert got == [1.0, 1.5, 0.5, 8e-08, 2.0, -3.0, None, None, None, None, None, None, None]


def test_trade_json_round_trip(spark):
    df = spark.createDataFrame([("BTC-USD", 1.25, 8e-08, "buy", 7, "2026-07-01 10:12:39.996920")],
                               "symbol string, price double, size double, side string, trade_id long, ts string")
    df = df.withColumn("ts", F.col("ts").cast("timestamp"))
    text = df.select(trade_json().alias("j")).first()["j"]
    assert json.loads(text) == {"symbol": "BTC-USD", "price": 1.25, "size": 8e-08, "side": "buy", "trade_id": 7,
                                "ts": "2026-07-01T10:12:39.996920Z"}


def test_typical_price(spark):
    df = spark.createDataFrame([(3.0, 1.0, 2.0)], "h double, l double, c double")
    assert df.select(typical_price("h", "l", "c").alias("t")).first()["t"] == 2.0
