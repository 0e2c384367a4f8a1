"""Rates: counter resets, zero-filled throughput, sliding windows, tick sampling."""

from datetime import datetime, timedelta


from barforge.operators.rates import counter_rate, sliding_rate, throughput, tick_samples


def test_counter_rate_with_reset(spark):
    t0 = datetime(2024, 1, 1)
    vals = [0, 5, 9, 2, 6, 6, 12]
    df = spark.createDataFrame([("s", t0 + timedelta(seconds=10 * i), v) for i, v in enumerate(vals)],
                               "symbol string, ts timestamp, value long")
    out = {r["ts"]: (r["increase"], r["rate"]) for r in counter_rate(df, 60).collect()}
    assert out[t0 + timedelta(seconds=60)] == (21, 0.35)
    assert out[t0] == (0, None)


def test_counter_rate_across_bucket_edges(spark):
    # samples every 7 minutes for 3 days, counter +3 per sample, range 1 hour
    t0 = datetime(2024, 1, 1)
    rows = [("s", t0 + timedelta(minutes=7 * i), 3 * i) for i in range(620)]
    df = spark.createDataFrame(rows, "symbol string, ts timestamp, value long")
    got = counter_rate(df, 3600).orderBy("ts").collect()
    assert len(got) == 620
    for r in got[9:]:
        # 9 samples in a 60-minute frame (8 intervals of 7 min => 56 min span)
        assert r["increase"] == 24 and abs(r["rate"] - 24 / 3360) < 1e-12


def test_throughput_zero_fill(spark):
    t0 = datetime(2024, 1, 1, 0, 0, 3)
    trades = spark.createDataFrame([("A", t0), ("A", t0 + timedelta(seconds=1)), ("B", t0 + timedelta(seconds=25)),
                                    ("Z", t0)], "symbol string, ts timestamp")
    rows = {(r["window_start"].second, r["symbol"]): (r["trades"], r["rate"], r["total_rate"])
            for r in throughput(trades, ["A", "B", " ", "C"]).collect()}
    assert len(rows) == 9  # 3 windows x 3 configured symbols
    assert rows[(0, "A")] == (2, 0.2, 0.2) and rows[(10, "A")] == (0, 0.0, 0.0) and rows[(20, "B")] == (1, 0.1, 0.1)
    assert rows[(0, "C")] == (0, 0.0, 0.2)


def test_sliding_rate_counts_each_event_in_six_windows(spark):
    df = spark.createDataFrame([("A", datetime(2024, 1, 1, 0, 0, 35))], "symbol string, ts timestamp")
    out = sliding_rate(df, keys=["symbol"]).collect()
    assert len(out) == 6 and all(r["trades"] == 1 and abs(r["rate"] - 1 / 60) < 1e-15 for r in out)


def test_tick_sample_latest_per_second(spark):
    t = datetime(2024, 1, 1, 0, 0, 1)
    df = spark.createDataFrame([("A", 1.0, 1.0, 5, t), ("A", 2.0, 1.0, 4, t), ("A", 3.0, 2.0, 1, t + timedelta(milliseconds=10))],
                               "symbol string, price double, size double, trade_id long, ts timestamp")
    (r,) = tick_samples(df).collect()
    assert float(r["price"]) == 3.0 and float(r["size"]) == 2.0
    assert str(tick_samples(df).schema["price"].dataType) == "DecimalType(20,8)"
