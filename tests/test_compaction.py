"""Compaction: few files, the same rows before, during and after, wherever a round stops."""

import json
import os
from datetime import date, datetime, timedelta
from pathlib import Path

import pyarrow as pa
import pyarrow.parquet as pq
import pytest

from barforge.operators import compaction, sinks
from barforge.operators.compaction import TableSpec, compact
from barforge.operators.sinks import candle_sink, mark_committed
from barforge.streaming import jobs

COLUMNS = "symbol string, window_start timestamp, window_end timestamp, open double, high double, low double, close double, volume double"
DAY = datetime(2025, 3, 5)


def minute_candles(spark, slots, symbols=("AAA", "BBB"), close=2.0, day=DAY):
    rows = [(s, day + timedelta(minutes=m), day + timedelta(minutes=m + 1), 1.0, 3.0, 0.5, close, 4.0) for m in slots for s in symbols]
    return spark.createDataFrame(rows, COLUMNS)


def folders(root, table):
    return sorted(str(p.relative_to(root)) for p in Path(root, table).glob("date=*/*/*") if any(p.glob("*.parquet")))


def rows_of(spark, root):
    return sorted(tuple(r) for r in jobs.stored_candles(spark, root).collect())


def test_five_hundred_batches_of_a_day_become_few_files(spark, scratch):
    """A stream's folders as they lie on disk after 500 commits, without running it 500 times."""
    schema = pa.schema([("symbol", pa.string()), ("window_start", pa.timestamp("us", "UTC")), ("window_end", pa.timestamp("us", "UTC")),
                        *[(c, pa.decimal128(20, 8)) for c in ("open", "high", "low", "close")], ("volume", pa.decimal128(30, 8))])
    for batch in range(500):
        start = DAY + timedelta(minutes=2 * batch)
        folder = f"{scratch}/candles/date={start.date()}/query_id=q/batch_id={batch}"
        os.makedirs(folder)
        row = {"symbol": ["AAA"], "window_start": [start], "window_end": [start + timedelta(minutes=1)],
               **{c: [batch] for c in ("open", "high", "low", "close", "volume")}}
        pq.write_table(pa.Table.from_pydict(row, schema=schema), f"{folder}/part-0.parquet")
    mark_committed(spark, scratch, "candles", "q", 499)
    before = rows_of(spark, scratch)
    assert len(before) == 500 and jobs.compact_stream(spark, scratch) == 1
    assert rows_of(spark, scratch) == before
    jobs.compact_stream(spark, scratch)  # the next round deletes what the first replaced
    assert folders(scratch, "candles") == []
    files = list(Path(scratch, "candles_compact").glob("date=*/hour=*/gen=*/*.parquet"))
    assert len(files) == 17 and rows_of(spark, scratch) == before  # one an hour of 1,000 minutes
    assert jobs.compact_stream(spark, scratch) is None


def test_rounds_between_batches(spark, scratch):
    sink = candle_sink(scratch, 10.0, "q")
    sink(minute_candles(spark, range(50, 70)), 0)
    jobs.compact_stream(spark, scratch)
    sink(minute_candles(spark, range(70, 80)), 1)
    sink(minute_candles(spark, range(40, 90), close=9.0), 2)  # overlaps compacted and later rows: the first writer stays
    want = {m: (9.0 if m < 50 or m >= 80 else 2.0) for m in range(40, 90)}
    for _ in range(3):
        got = rows_of(spark, scratch)
        assert len(got) == 100 and all(r[6] == want[int((r[1] - DAY).total_seconds() // 60)] for r in got)
        jobs.compact_stream(spark, scratch)
    candle_sink(scratch, 10.0, "other")(minute_candles(spark, range(40, 90), close=5.0), 0)
    assert rows_of(spark, scratch) == got
    days = sinks.read_table(spark, scratch, "candles", jobs.stored_candle_schema(), "candles", True, [date(2025, 3, 5)])
    assert days.count() == 100
    assert sinks.read_table(spark, scratch, "candles", jobs.stored_candle_schema(), "candles", True, [date(2025, 3, 6)]).count() == 0


@pytest.mark.parametrize("step", ["_rewrite", "write_once", "_delete"])
def test_a_stop_at_any_step_changes_no_row(spark, scratch, monkeypatch, step):
    sink = candle_sink(scratch, 10.0, "q")
    sink(minute_candles(spark, range(10)), 0)
    jobs.compact_stream(spark, scratch)
    sink(minute_candles(spark, range(10, 20)), 1)
    before = rows_of(spark, scratch)
    real, calls = getattr(compaction, step), []

    def stop(*args):
        calls.append(args)
        if step == "_rewrite" and len(calls) == 1:
            return real(*args)  # the first table is written, then the job is lost
        raise RuntimeError("executor lost")

    with monkeypatch.context() as patched:
        patched.setattr(compaction, step, stop)
        with pytest.raises(RuntimeError):
            jobs.compact_stream(spark, scratch)
    assert rows_of(spark, scratch) == before
    sink(minute_candles(spark, range(20, 25)), 2)
    after = rows_of(spark, scratch)
    assert len(after) == 50
    for _ in range(2):
        jobs.compact_stream(spark, scratch)
        assert rows_of(spark, scratch) == after
    live = {gen for gen, _ in sinks.latest_compaction(spark, scratch, "candles")["tables"]["candles"]["hours"].values()}
    on_disk = {p.name[4:] for p in Path(scratch, "candles_compact").glob("date=*/hour=*/gen=*")}
    assert live <= on_disk and len(on_disk - live) <= 1  # at most what the last round replaced
    assert not list(Path(scratch, "_compactions/candles/attempts").glob("[0-9]*"))


def test_a_reader_planned_before_the_switch_can_finish(spark, scratch):
    candle_sink(scratch, 10.0, "q")(minute_candles(spark, range(30)), 0)
    planned = jobs.stored_candles(spark, scratch)
    planned.explain()
    jobs.compact_stream(spark, scratch)
    assert planned.count() == 60


def test_of_two_rounds_at_once_the_second_fails(spark, scratch, monkeypatch):
    candle_sink(scratch, 10.0, "q")(minute_candles(spark, range(5)), 0)
    before, real = rows_of(spark, scratch), compaction._rewrite

    def another_first(*args):
        marker = Path(scratch, "_compactions/candles/1")
        if not marker.exists():
            monkeypatch.setattr(compaction, "_rewrite", real)
            jobs.compact_stream(spark, scratch)
        return real(*args)

    monkeypatch.setattr(compaction, "_rewrite", another_first)
    with pytest.raises(RuntimeError, match="first"):
        jobs.compact_stream(spark, scratch)
    assert rows_of(spark, scratch) == before


def test_keys_inserted_by_two_queries_at_once_become_one(spark, scratch):
    for query, close in (("b", 7.0), ("a", 8.0)):
        rows = sinks.to_stored_candles(minute_candles(spark, [1], close=close))
        sinks.write_dated_batch(rows, f"{scratch}/candles", query, 0, "window_start", 2)
    for query in ("a", "b"):
        mark_committed(spark, scratch, "candles", query, 0)
    assert len(rows_of(spark, scratch)) == 4
    jobs.compact_stream(spark, scratch)
    assert [(r[0], r[6]) for r in rows_of(spark, scratch)] == [("AAA", 8.0), ("BBB", 8.0)]


def test_large_hours_get_several_files_and_other_tables_are_left_alone(spark, scratch):
    candle_sink(scratch, 10.0, "q")(minute_candles(spark, range(60), symbols=["HOT"]), 0)
    spec = TableSpec(jobs.stored_candle_schema(), "window_start", ("symbol", "window_start"))
    alerts = jobs.stored_alerts(spark, scratch).count()
    compact(spark, scratch, "candles", {"candles": spec}, rows_per_file=10)
    files = list(Path(scratch, "candles_compact").glob("date=*/hour=0/gen=*/*.parquet"))
    assert len(files) >= 4 and len(rows_of(spark, scratch)) == 60
    assert alerts > 0 and jobs.stored_alerts(spark, scratch).count() == alerts
    compact(spark, scratch, "candles", jobs.candle_tables())
    assert jobs.stored_alerts(spark, scratch).count() == alerts and len(rows_of(spark, scratch)) == 60


def test_empty_tables(spark, scratch):
    assert jobs.compact_stream(spark, scratch) is None
    mark_committed(spark, scratch, "candles", "q", 0)
    assert jobs.compact_stream(spark, scratch) == 1 and jobs.stored_candles(spark, scratch).count() == 0


def test_a_batch_in_time_order_reads_nothing_stored(spark, scratch, monkeypatch):
    """The spans of the commit notes tell that no stored key can be met, whatever the day holds."""
    sink, read = candle_sink(scratch, 10.0, "q"), []
    real = sinks.read_table
    monkeypatch.setattr(sinks, "read_table", lambda spark, root, table, *rest: read.append(table) or real(spark, root, table, *rest))
    sink(minute_candles(spark, range(10)), 0)
    sink(minute_candles(spark, range(10, 30)), 1)
    sink(minute_candles(spark, range(5), day=DAY + timedelta(days=1)), 2)
    assert read == []
    sink(minute_candles(spark, [29, 30]), 3)
    assert "candles" in read and len(rows_of(spark, scratch)) == 72
    note = json.loads(next(Path(scratch, "_commits/candles/query_id=q").glob("3")).read_text())
    assert set(note["window_start"]) == {"2025-03-05", "2025-03-06"}


def test_a_marker_without_a_note_means_that_all_is_compared(spark, scratch):
    sink = candle_sink(scratch, 10.0, "q")
    sink(minute_candles(spark, range(3)), 0)
    Path(scratch, "_commits/candles/query_id=q/0").write_text("")
    Path(scratch, "_commits/candles/query_id=q/.0.crc").unlink(missing_ok=True)
    sink(minute_candles(spark, range(5), close=8.0), 1)
    assert len(rows_of(spark, scratch)) == 10 and sum(r[6] == 8.0 for r in rows_of(spark, scratch)) == 4


def test_a_hot_day_is_written_by_several_tasks(spark, scratch, monkeypatch):
    monkeypatch.setattr(sinks, "ROWS_PER_FILE", 200)
    candle_sink(scratch, 1e9, "q")(minute_candles(spark, range(1440), symbols=["HOT"]), 0)
    assert len(list(Path(scratch, "candles/date=2025-03-05").rglob("*.parquet"))) >= 4 and len(rows_of(spark, scratch)) == 1440
