"""Table checks and small read-side helpers."""

from datetime import datetime

from barforge.operators import quality, serving

CANDLES = "symbol string, window_start timestamp, window_end timestamp, open double, high double, low double, close double, volume double"


def _candles(spark):
    rows = [
        ("A", datetime(2024, 1, 1, 10), datetime(2024, 1, 1, 11), 1.0, 2.0, 0.5, 1.5, 3.0),
        ("B", datetime(2024, 1, 1, 9), datetime(2024, 1, 1, 9, 30), 1.0, 1.0, 1.0, 1.0, None),
    ]
    return spark.createDataFrame(rows, CANDLES)


def test_audit_finds_planted_violations(spark):
    c = _candles(spark)
    row = quality.stored_audit("t", c.unionByName(c.limit(1)), ["symbol", "window_start"], ["symbol", "volume"], "1 hour").first()
    assert (row["table"], row["rows"], row["nulls"], row["duplicates"], row["bad_window_end"]) == ("t", 3, 1, 1, 1)
    empty = quality.stored_audit("t", c.where("false"), ["symbol"], ["symbol"]).first()
    assert (empty["rows"], empty["nulls"], empty["duplicates"], empty["bad_window_end"]) == (0, 0, 0, 0)


def test_freshness_and_metric_value(spark):
    assert serving.freshness(_candles(spark)).first()["last_candle"] == datetime(2024, 1, 1, 11)
    ledger = spark.createDataFrame(
        [("malformed_dropped", 3, datetime(2024, 1, 1)), ("malformed_dropped", 4, datetime(2024, 1, 2)),
         ("other", 9, datetime(2024, 1, 2))],
        "metric string, value long, updated_at timestamp",
    )
    assert serving.metric_value(ledger).first()["value"] == 7
    assert serving.metric_value(ledger, "absent").first()["value"] == 0


def test_ordered_output_edge(spark):
    got = [(r["symbol"], r["window_start"].hour) for r in serving.ordered(_candles(spark)).collect()]
    assert got == [("A", 10), ("B", 9)]
