"""Late rows, redelivered trades, mergeable candles, tick retention in storage, supervision."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from barforge.operators.candles import candles_of, corrected_candles, finished, merge_candles, partial_candles
from barforge.operators.sinks import late_sink, tick_sink
from barforge.schema import TRADE_SCHEMA
from barforge.sources import tables
from barforge.streaming import jobs, progress

START = datetime(2025, 3, 5, 9)


def trade(symbol, at, price, number, size=1.0):
    return symbol, float(price), float(size), "buy", number, START + timedelta(seconds=at)


def trades(spark, rows):
    return spark.createDataFrame([dict(zip(("symbol", "price", "size", "side", "trade_id", "ts"), r)) for r in rows], TRADE_SCHEMA)


def texts(spark, rows, path, slots):
    df = trades(spark, rows).withColumn("ts", F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'"))
    pairs = spark.createDataFrame(list(zip([r[4] for r in rows], slots)), "trade_id long, slot int")
    jobs.write_slots(df.join(pairs, "trade_id").select("slot", F.to_json(F.struct(*df.columns)).alias("value")), path)


def config(root, **more):
    return jobs.StreamConfig(f"{root}/tables", f"{root}/checkpoints", available_now=True, state_partitions=2, **more)


def test_late_rows_are_those_the_candle_query_drops(spark, scratch):
    rows = [trade("A", 10, 5, 1), trade("A", 200, 6, 2), trade("B", 205, 7, 3),  # newest 205 s
            trade("A", 30, 9, 4), trade("A", 300, 3, 7),  # closes what ends by 145 s, but 30 s is still in time
            trade("A", 70, 1, 5), trade("B", 139, 2, 6), trade("A", 500, 4, 8),  # 70 is late, 139 is not; closes by 240 s
            trade("B", 185, 8, 9), trade("A", 241, 4, 10)]  # 185 is late, 241 is not
    slots = [0] * 3 + [1] * 2 + [2] * 3 + [3] * 2
    texts(spark, rows, f"{scratch}/inbox", slots)
    cfg = config(scratch, progress_root=f"{scratch}/progress")
    stream = lambda: jobs.text_stream(spark, f"{scratch}/inbox/slot=*", 1)
    queries = jobs.run_both(stream(), cfg)
    jobs.supervise({"late": jobs.start_late(stream(), cfg)})
    late = jobs.stored_late_rows(spark, cfg.table_root).collect()
    assert sorted((r.trade_id, r.batch_id) for r in late) == [(5, 2), (9, 3)]
    assert all(r.window_end <= r.watermark for r in late)
    names = {str(q.id): n for n, q in queries.items()}
    summary = progress.progress_summary(progress.stored_progress(spark, cfg.progress_root, names)).where("query = 'candles'").first()
    assert summary["late_rows_dropped"] == len({(r.symbol, r.window_start, r.batch_id) for r in late}) == 2
    stored = jobs.stored_candles(spark, cfg.table_root)
    assert stored.where("symbol = 'A' and minute(window_start) = 0").first()["close"] == 9.0
    assert stored.where("symbol = 'A' and minute(window_start) = 1").count() == 0  # the late 70 alone was there


def test_late_sink_goes_on_after_a_restart_and_a_retry(spark, scratch):
    first, second = trades(spark, [trade("A", 600, 1, 1)]), trades(spark, [trade("A", 5, 1, 2), trade("A", 601, 1, 3), trade(None, 6, 1, 4)])
    late_sink(scratch, "1 minute", "1 minute", "q")(first, 0)
    late_sink(scratch, "1 minute", "1 minute", "q")(second.where("false"), 1)
    for _ in range(2):
        late_sink(scratch, "1 minute", "1 minute", "q")(second, 2)
    late_sink(scratch, "1 minute", "1 minute", "q")(second.where("false"), 3)
    assert sorted(r.trade_id for r in jobs.stored_late_rows(spark, scratch).collect()) == [2, 4]


def test_redelivered_trades_count_once_only_if_asked(spark, scratch):
    rows = [trade("A", 5, 2, 1, 3), trade("B", 6, 2, 1, 4), trade("A", 7, 4, 2, 5), trade("A", 400, 1, 3)]
    for name, wanted in (("plain", 16.0), ("dropped", 8.0)):
        df = trades(spark, rows).withColumn("ts", F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'"))
        twice = df.unionByName(df).withColumn("slot", F.when(F.col("trade_id") == 3, 1).otherwise(0))
        jobs.write_slots(twice.select("slot", F.to_json(F.struct(*df.columns)).alias("value")), f"{scratch}/{name}/inbox")
        cfg = config(f"{scratch}/{name}", drop_redelivered=name == "dropped")
        jobs.supervise({"c": jobs.start_candles(jobs.text_stream(spark, f"{scratch}/{name}/inbox/slot=*", 1), cfg)})
        got = {r.symbol: r.volume for r in jobs.stored_candles(spark, cfg.table_root).collect()}
        assert got["A"] == wanted and got["B"] == wanted / 2


def random_trades(rng, n):
    return [trade(rng.choice("ABC"), rng.choice([rng.randrange(90_000), 60 * rng.randrange(1500)]), rng.randrange(1, 99), i, rng.randrange(1, 9))
            for i in range(n)]


def test_partial_candles_roll_up_and_merge_like_the_trades(spark):
    rng = random.Random(7)
    rows = random_trades(rng, 800)
    rng.shuffle(rows)
    whole, a, b = trades(spark, rows), trades(spark, rows[:500]), trades(spark, rows[500:])
    want = lambda width: sorted(map(tuple, candles_of(whole, width).collect()))
    minutes = partial_candles(a, "1 minute").unionByName(partial_candles(b, "1 minute"))
    for width in ("1 minute", "1 hour", "1 day"):
        assert sorted(map(tuple, finished(merge_candles(minutes, width)).collect())) == want(width)
    twice = merge_candles(merge_candles(minutes, "5 minutes"), "1 hour")
    assert sorted(map(tuple, finished(twice).collect())) == want("1 hour")
    stored = partial_candles(a, "1 hour")
    changed = corrected_candles(stored, b.limit(3), "1 hour")
    assert 1 <= changed.count() <= 3
    changed = corrected_candles(stored, b, "1 hour")
    same = stored.join(changed.select("symbol", "window_start"), ["symbol", "window_start"], "left_anti")
    assert sorted(map(tuple, finished(same.select(changed.columns).unionByName(changed)).collect())) == want("1 hour")
    assert merge_candles(minutes.where("false"), "1 hour").count() == 0


def ticks(spark, *seconds):
    rows = [("A", START + timedelta(seconds=s), START + timedelta(seconds=s), 1.0, 2.0) for s in seconds]
    df = spark.createDataFrame(rows, "symbol string, second timestamp, ts timestamp, price double, size double")
    return df.withColumns({"price": F.col("price").cast("decimal(20,8)"), "size": F.col("size").cast("decimal(30,8)")})


def test_ticks_older_than_the_limit_leave_the_storage(spark, scratch):
    sink = tick_sink(scratch, "q", keep_minutes=10)
    kept = lambda: sorted((r.ts - START).total_seconds() for r in jobs.stored_ticks(spark, scratch).collect())
    sink(ticks(spark, 0, 60, 700), 0)
    assert kept() == [700]  # 0 and 60 were too old when they came
    sink(ticks(spark, 900), 1)
    sink(ticks(spark, 900), 1)
    assert kept() == [700, 900]
    sink(ticks(spark, 1350), 2)
    assert kept() == [900, 1350]
    sink(ticks(spark, 100), 3)  # a late one is not written
    assert kept() == [900, 1350]
    sink(ticks(spark, 9000), 4)
    assert kept() == [9000]


def test_newest_days_are_enough(spark, scratch):
    rows = [(f"2025-03-{d:02d}", d, i) for d in (1, 2, 3) for i in range(d)]
    spark.createDataFrame(rows, "date string, d int, i int").write.partitionBy("date").parquet(f"{scratch}/t")
    for wanted, days in ((1, {3}), (3, {3}), (4, {2, 3}), (6, {1, 2, 3}), (99, {1, 2, 3})):
        df = tables.read_newest(spark, f"{scratch}/t", wanted)
        assert {r.d for r in df.collect()} == days and "date" in df.columns


class FakeQuery:
    def __init__(self, error=None, ends_after=0):
        self.error, self.left, self.stopped = error, ends_after, False

    @property
    def isActive(self):
        self.left -= 1
        return not self.stopped and self.left >= 0

    def exception(self):
        return self.error

    def stop(self):
        self.stopped = True


def test_a_failed_query_stops_the_other():
    good, bad = FakeQuery(ends_after=10**9), FakeQuery(error="disk full")
    with pytest.raises(RuntimeError, match="disk full"):
        jobs.supervise({"candles": good, "malformed": bad}, poll_s=0.01)
    assert good.stopped


def test_a_timeout_stops_all():
    queries = {n: FakeQuery(ends_after=10**9) for n in ("candles", "malformed")}
    with pytest.raises(TimeoutError, match="malformed"):
        jobs.supervise(queries, timeout_s=0.05, poll_s=0.01)
    assert all(q.stopped for q in queries.values())


def test_a_second_start_that_fails_stops_the_first(monkeypatch):
    first = FakeQuery(ends_after=10**9)
    monkeypatch.setattr(jobs, "start_candles", lambda *a: first)

    def fail(*args):
        raise ValueError("no such topic")

    monkeypatch.setattr(jobs, "start_malformed", fail)

    class Stream:
        sparkSession = None

    with pytest.raises(ValueError):
        jobs.run_both(Stream(), jobs.StreamConfig("t", "c", available_now=True))
    assert first.stopped


def test_a_stream_that_fails_inside_spark(spark, scratch):
    """One real query whose sink raises: the error names it and the other one ends."""
    source = spark.readStream.format("rate").option("rowsPerSecond", 10).load()

    def broken(df, n):
        raise RuntimeError("executor lost")

    queries = {"fails": source.writeStream.foreachBatch(broken).option("checkpointLocation", f"{scratch}/a").start(),
               "runs": source.writeStream.format("noop").option("checkpointLocation", f"{scratch}/b").start()}
    with pytest.raises(RuntimeError, match="fails"):
        jobs.supervise(queries, timeout_s=120)
    assert not any(q.isActive for q in queries.values())
