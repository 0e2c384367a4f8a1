"""Which candle moves raise an alert, and how the alert reads."""

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from barforge.functions.exprs import alert_message, pct_change
from barforge.operators.alerts import derive_alerts

START = datetime(2024, 3, 9, 23, 58)
CANDLE = "symbol string, window_start timestamp, window_end timestamp, open double, close double"


def _moves(spark, *open_close):
    """One two-minute candle per (open, close), of symbols S0, S1, ..."""
    rows = [(f"S{i}", START, START + timedelta(minutes=2), o, c) for i, (o, c) in enumerate(open_close)]
    return spark.createDataFrame(rows, CANDLE)


def test_only_moves_beyond_the_threshold_alert(spark):
    # 8 -> 10 is exactly 25 %, either side of it alerts or not; both signs count
    candles = _moves(spark, (8.0, 10.0), (8.0, 10.5), (8.0, 6.0), (8.0, 5.5), (8.0, 8.0))
    assert sorted(a["symbol"] for a in derive_alerts(candles, 25.0).collect()) == ["S1", "S3"]


def test_threshold_is_compared_before_rounding(spark):
    candles = _moves(spark, (1000.0, 1000.0 * 1.250001), (1000.0, 1000.0 * 1.249999))
    assert [a["symbol"] for a in derive_alerts(candles, 25.0).collect()] == ["S0"]


def test_opens_without_a_value_never_alert(spark):
    candles = _moves(spark, (0.0, 7.0), (None, 7.0), (7.0, None))
    assert derive_alerts(candles, 0.0).collect() == []
    assert [r["p"] for r in candles.select(pct_change("open", "close").alias("p")).collect()] == [0.0, 0.0, None]


def test_alert_carries_the_end_of_its_window_and_the_close(spark):
    (alert,) = derive_alerts(_moves(spark, (64.0, 48.0)), 10.0).collect()
    assert alert.asDict() == {
        "symbol": "S0", "ts": datetime(2024, 3, 10), "price": 48.0, "pct_change": -25.0,
        "message": "S0 moved -25.00% in the 23:58-00:00 window"}


@pytest.mark.parametrize("value", [0.125, -0.125, 0.005, 2.675, -0.001, 1234.5678, 0.0, 99.995])
def test_message_rounds_as_python_does(spark, value):
    at = F.lit("2024-03-09 23:58:00").cast("timestamp")
    text = spark.range(1).select(alert_message(F.lit("S"), F.lit(value), at, at).alias("m")).first()["m"]
    assert text == f"S moved {value:+.2f}% in the 23:58-23:58 window"
