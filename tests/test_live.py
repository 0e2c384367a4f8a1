"""Throughput and indicators kept by the stream: gaps, retries, torn batches, another checkpoint."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from barforge.operators import live
from barforge.operators.indicators import gap_fill, moving_averages, session_vwap
from barforge.operators.sinks import candle_sink, committed, path_exists
from barforge.schema import CANDLE_SCHEMA
from barforge.streaming import jobs

START = datetime(2025, 3, 5, 23, 59, 30)


def counts(spark, rows):
    rows = [(START + timedelta(seconds=10 * k), s, n) for k, s, n in rows]
    return spark.createDataFrame(rows, "window_start timestamp, symbol string, n long")


def reported(spark, root):
    rows = jobs.stored_throughput(spark, root).collect()
    out = {(int((r.window_start - START).total_seconds()) // 10, r.symbol): (r.trades, r.rate, r.total_rate) for r in rows}
    assert len(out) == len(rows)
    return out


def test_throughput_fills_silent_symbols_and_gaps_between_batches(spark, scratch):
    write = live.throughput_sink(scratch, ["A", "B"], query_id="q")
    write(counts(spark, [(0, "A", 4), (2, "B", 1)]), 0)
    write(counts(spark, []), 1)
    write(counts(spark, [(5, "A", 2), (5, "X", 9)]), 2)  # X is not configured, its interval counts all the same
    got = reported(spark, scratch)
    assert sorted(got) == [(k, s) for k in range(6) for s in "AB"]
    assert got[0, "A"] == (4, 0.4, 0.4) and got[0, "B"] == (0, 0.0, 0.4) and got[2, "B"] == (1, 0.1, 0.1)
    assert got[5, "A"] == (2, 0.2, 0.2) and all(got[k, s][0] == 0 for k in (1, 3, 4) for s in "AB")


def test_throughput_is_reported_once(spark, scratch):
    first, second = counts(spark, [(0, "A", 1), (1, "A", 2)]), counts(spark, [(4, "A", 3)])
    for query in ("one", "two"):  # another checkpoint brings all intervals again, and one more
        write = live.throughput_sink(scratch, ["A"], query_id=query)
        for _ in range(2):  # a retry after the commit
            write(first, 0)
        write(second, 1)
    live.throughput_sink(scratch, ["A"], query_id="two")(counts(spark, [(5, "A", 7)]), 2)
    assert [got[0] for _, got in sorted(reported(spark, scratch).items())] == [1, 2, 0, 0, 3, 7]


def test_throughput_of_a_torn_batch_is_written_again(spark, scratch, monkeypatch):
    write = live.throughput_sink(scratch, ["A"], query_id="q")
    with monkeypatch.context() as m:
        m.setattr(live, "mark_committed", lambda *a: (_ for _ in ()).throw(OSError("lost")))
        with pytest.raises(OSError):
            write(counts(spark, [(0, "A", 1)]), 0)
    assert reported(spark, scratch) == {}
    write(counts(spark, [(0, "A", 1)]), 0)
    assert reported(spark, scratch) == {(0, "A"): (1, 0.1, 0.1)}


def candles(spark, rows):
    """(symbol, minute, close, volume) as candles."""
    at = lambda m: START.replace(second=0) + timedelta(minutes=m)
    data = [(s, at(m), at(m + 1), c - 0.5, c + 1.0, c - 1.0, float(c), float(v)) for s, m, c, v in rows]
    names = ["symbol", "window_start", "window_end", "open", "high", "low", "close", "volume"]
    return spark.createDataFrame([dict(zip(names, r)) for r in data], CANDLE_SCHEMA)


LENGTHS = {"ma_fast": 3, "ma_slow": 5}


def feed(spark, root, batches, query="q", lengths=LENGTHS):
    first, second = candle_sink(root, 0.3, query), live.indicator_sink(root, jobs.stored_candle_schema(), 60, query, lengths)
    for number, rows in batches:
        df = candles(spark, rows)
        first(df, number)
        second(df, number)


def by_slot(df):
    rows = df.select("symbol", "window_start", "close", F.round("ma_fast", 9), F.round("ma_slow", 9), F.round("vwap", 9)).collect()
    assert len({r[:2] for r in rows}) == len(rows)
    return {tuple(r[:2]): tuple(r[2:]) for r in rows}


def of_stored(spark, root):
    """The batch operators over all stored candles."""
    grid = gap_fill(jobs.stored_candles(spark, root).drop("window_end"), 60)
    return by_slot(session_vwap(moving_averages(grid, 60, LENGTHS)))


def test_indicators_equal_the_batch_operators(spark, scratch):
    rng = random.Random(4)
    rows = [(s, m, rng.randint(5, 90), rng.choice([0, 0, 1, 2.5])) for s, share, begin in (("A", 0.9, 0), ("B", 0.4, 7), ("C", 0.05, 0))
            for m in range(begin, 60) if rng.random() < share]
    rows += [("D", 2, 5, 0), ("D", 58, 6, 0)]  # no volume at all, one long gap
    cuts = [0, 1, 13, 14, 40, 60]
    batches = [(i, [r for r in rows if lo <= r[1] < hi]) for i, (lo, hi) in enumerate(zip(cuts, cuts[1:]))]
    feed(spark, scratch, [*batches, (5, [])])
    want = of_stored(spark, scratch)
    assert by_slot(jobs.stored_indicators(spark, scratch)) == want
    assert any(v[0] is None for v in want.values()) and any(v[2] is not None for v in want.values())


def test_indicators_after_a_torn_batch_and_another_checkpoint(spark, scratch, monkeypatch):
    rows = [("A", m, 10 + m, 1) for m in range(12) if m != 6]
    feed(spark, scratch, [(0, rows[:4])])
    with monkeypatch.context() as m:
        m.setattr(live, "mark_committed", lambda *a: (_ for _ in ()).throw(OSError("lost")))
        with pytest.raises(OSError):
            feed(spark, scratch, [(1, rows[4:8])])  # its candles are committed, its indicators are not
    assert len(by_slot(jobs.stored_indicators(spark, scratch))) == 4
    feed(spark, scratch, [(1, rows[4:8]), (1, rows[4:8])])
    feed(spark, scratch, [(0, rows[:8]), (1, rows[6:])], query="other")  # brings eight candles again
    assert by_slot(jobs.stored_indicators(spark, scratch)) == of_stored(spark, scratch)
    # one state is kept, the last one
    assert [path_exists(spark, f"{scratch}/indicator_state/query_id={q}/batch_id={b}") for q, b in (("q", 0), ("q", 1), ("other", 1))] == [False, False, True]
    assert committed(spark, scratch, live.INDICATOR_JOB) == {"q": 1, "other": 1}


def test_newest_rows_are_merged_batch_by_batch(spark, scratch, monkeypatch):
    schema = "symbol string, ts timestamp, price double"
    rows = [(s, START + timedelta(seconds=k), float(k)) for s, every in (("A", 1), ("B", 7), ("C", 31)) for k in range(0, 60, every)]
    random.Random(5).shuffle(rows)  # batches are not in time order
    batches = [rows[:30], [], rows[30:50] + [(None, START, 1.0), ("A", None, 2.0)], rows[50:] + rows[:10]]
    for query in ("one", "two"):
        for number, batch in enumerate(batches):
            df = spark.createDataFrame(batch, schema)
            if query == "one" and number == 2:
                with monkeypatch.context() as m:
                    m.setattr(live, "mark_committed", lambda *a: (_ for _ in ()).throw(OSError("lost")))
                    with pytest.raises(OSError):
                        live.newest_sink(scratch, "ticks", 3, query_id=query)(df, number)
            for _ in range(2):
                live.newest_sink(scratch, "ticks", 3, query_id=query)(df, number)
        kept = live.newest_rows(spark, scratch, "ticks", df.schema)
        want = sorted(r for s in "ABC" for r in sorted((r for r in rows if r[0] == s), key=lambda r: r[1])[-3:])
        assert sorted(map(tuple, kept.collect())) == want
