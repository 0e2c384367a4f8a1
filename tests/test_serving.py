"""Read side: KPI rows, freshness, text formats, top-k, look-back."""

from datetime import datetime, timedelta

from pyspark.sql import functions as F

from barforge.functions.exprs import age_text, freshness_state, money_text, range_move, to_stored_price
from barforge.operators import serving

CANDLES = "symbol string, window_start timestamp, window_end timestamp, open double, high double, low double, close double, volume double"


def _candles(spark):
    t0 = datetime(2024, 1, 1, 10)
    rows = [("A", t0 + timedelta(minutes=i), t0 + timedelta(minutes=i + 1), 100.0 + i, 0.0, 0.0, 101.0 + i, 1.0) for i in range(5)]
    rows += [("Z", t0, t0 + timedelta(minutes=1), 0.0, 0.0, 0.0, 5.0, 1.0), ("B", t0, t0 + timedelta(minutes=1), 50.0, 0.0, 0.0, 40.0, 1.0)]
    return spark.createDataFrame(rows, CANDLES)


def test_kpi_rows(spark):
    live = spark.createDataFrame([("A", 110.0)], "symbol string, price double")
    rows = {r["symbol"]: r for r in serving.kpi_table(_candles(spark), live, ["A", "B", "Z", "Q", " "]).collect()}
    assert set(rows) == {"A", "B", "Z", "Q"}
    assert rows["A"]["price"] == 110.0 and rows["A"]["is_live"] is True and rows["A"]["change_pct"] == 10.0
    assert rows["B"]["price"] == 40.0 and rows["B"]["change_pct"] is None and rows["B"]["direction"] == "up"
    assert rows["Q"]["status"] == "no data" and rows["Q"]["candles"] == 0 and rows["Q"]["price"] is None


def test_freshness_and_age_text(spark):
    df = spark.createDataFrame([(v,) for v in [0.5, 59.9, 60.0, 180.0, 180.5, 360.0, 361.0, 3725.2]], "a double")
    got = [(r["s"], r["t"]) for r in df.select(freshness_state("a").alias("s"), age_text("a").alias("t")).collect()]
    assert got == [("Live", "0s"), ("Live", "59s"), ("Live", "1m 0s"), ("Live", "3m 0s"), ("Lagging", "3m 0s"),
                   ("Lagging", "6m 0s"), ("Stale", "6m 1s"), ("Stale", "62m 5s")]


def test_money_and_range_move(spark):
    df = spark.createDataFrame([(1234.5, 0.0, 10.0), (-5.0, 100.0, 101.0)], "x double, o double, c double")
    got = [(r["m"], r["mv"]) for r in df.select(money_text("x").alias("m"), range_move("o", "c").alias("mv")).collect()]
    assert got == [("$1,234.50", 0.0), ("$-5.00", 1.0)]


def test_stored_decimal_overflow_is_null(spark):
    df = spark.createDataFrame([(1e13,), (1.123456785,)], "x double")
    got = [r["d"] for r in df.select(to_stored_price("x").alias("d")).collect()]
    assert got[0] is None and str(got[1]) == "1.12345679"


def test_latest_n_and_newest(spark):
    c = _candles(spark)
    top = serving.latest_n(c, 2).filter(F.col("symbol") == "A").collect()
    assert sorted(r["window_start"].minute for r in top) == [3, 4]
    a = c.select("symbol", F.col("window_end").alias("ts"))
    assert [(r["symbol"], r["ts"].minute) for r in serving.newest(a, 3).collect()] == [("A", 5), ("A", 4), ("A", 3)]


def test_lookback_filter_reaches_the_scan(spark, scratch):
    _candles(spark).write.parquet(f"{scratch}/c")
    as_of = F.lit("2024-01-01 10:05:00").cast("timestamp")
    df = serving.lookback(spark.read.parquet(f"{scratch}/c"), as_of, 2)
    assert df.count() == 2
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(window_start), GreaterThanOrEqual(window_start" in plan


def test_lookback_ends_at_as_of(spark):
    as_of = F.lit("2024-01-01 10:02:00").cast("timestamp")
    got = serving.lookback(_candles(spark), as_of, 1).select("window_start").distinct().collect()
    assert sorted(r["window_start"].minute for r in got) == [1, 2]
    assert serving.lookback(_candles(spark), as_of, None).count() == _candles(spark).count()


def test_pipeline_status_without_metrics(spark):
    ledger = spark.createDataFrame([], "metric string, value long, updated_at timestamp")
    as_of = F.lit("2024-01-01 10:09:00").cast("timestamp")
    (r,) = serving.pipeline_status(_candles(spark), ledger, as_of).collect()
    assert r["state"] == "Lagging" and r["age_text"] == "4m 0s" and r["malformed_dropped"] == 0
