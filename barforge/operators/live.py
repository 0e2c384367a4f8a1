"""Throughput (A9), chart indicators (W1-W4) and newest rows (T1, T3) kept up by the stream itself.

All are written batch by batch with one commit each, like the candles, and go on after
a restart from what the last commit notes. None reads the history it stored: throughput
needs the end of the last interval reported, indicators a table of one row per symbol, the newest
rows n per symbol.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from barforge.operators.indicators import MA_FAST, MA_SLOW, moving_averages, session_vwap
from barforge.operators.rates import REPORT_INTERVAL_S, fill_intervals
from barforge.operators.serving import latest_n
from barforge.operators.sinks import (
    CANDLE_JOB,
    _fs_path,
    batch_rows,
    commit_notes,
    committed,
    forget_attempt,
    mark_committed,
    query_id_of,
    remove_attempt,
    write_dated_batch,
)
from barforge.operators.timegrid import gap_fill

THROUGHPUT_JOB, INDICATOR_JOB = "throughput", "indicators"
STATE = "symbol string, last timestamp, recent array<struct<t: timestamp, close: double>>, ctv double, cv double"


def throughput_sink(table_root: str, symbols: list[str], interval_s: int = REPORT_INTERVAL_S,
                    query_id: str | None = None) -> Callable[[DataFrame, int], None]:
    """A9 on the stream: counts of closed intervals in, a row per configured symbol and interval out, 0 when silent.

    A batch brings the intervals that its watermark has closed, in order, so all up to the last of them
    are closed: each is reported with the batch that closes a later one or itself, gaps between them as
    zeros. The commit notes where the next batch starts. An interval is reported once, by the first query
    that closes it: what another checkpoint brings again lies before that mark and is left out.
    """
    root, step_us = table_root.rstrip("/"), interval_s * 1_000_000

    def write(batch_df: DataFrame, batch_id: int) -> None:
        spark = batch_df.sparkSession
        query = query_id or query_id_of(spark)
        if committed(spark, root, THROUGHPUT_JOB).get(query, -1) >= batch_id:
            batch_df.write.format("noop").mode("overwrite").save()
            return
        remove_attempt(spark, root, ["throughput"], query, batch_id)
        marks = [n["next"] for n in commit_notes(spark, root, THROUGHPUT_JOB).values() if n["next"] is not None]
        mark = max(marks, default=None)
        start = F.unix_micros("window_start")
        counts = (batch_df if mark is None else batch_df.filter(start >= mark)).persist()
        low, high = counts.agg(F.min(start), F.max(start)).first()
        if high is not None:
            first = low if mark is None else mark
            after = (high - first) // step_us
            bounds = spark.range(1).select(F.lit(first).alias("_lo"), F.lit(after).cast("long").alias("_n"))
            write_dated_batch(fill_intervals(counts, bounds, symbols, interval_s), f"{root}/throughput", query, batch_id,
                              "window_start", (after + 1) * len(symbols))
            mark = high + step_us
        mark_committed(spark, root, THROUGHPUT_JOB, query, batch_id, {"next": mark})
        forget_attempt(spark, root, query, batch_id)
        counts.unpersist()

    return write


def _latest_note(spark: SparkSession, root: str, job: str) -> dict:
    """The note of the job's newest commit, whichever query made it."""
    return max(commit_notes(spark, root, job).values(), key=lambda n: n["version"], default={"version": 0, "state": None})


def _state(spark: SparkSession, root: str, folder: str | None, schema: StructType | str) -> DataFrame:
    return spark.read.schema(schema).parquet(f"{root}/{folder}") if folder else spark.createDataFrame([], schema)


def _commit_state(spark: SparkSession, root: str, job: str, query: str, batch_id: int, before: dict, folder: str | None) -> None:
    """Commit a batch that leaves its state in ``folder``, then remove the state before it."""
    mark_committed(spark, root, job, query, batch_id, {"version": before["version"] + 1, "state": folder})
    forget_attempt(spark, root, query, batch_id)
    if before["state"] not in (None, folder):
        old, fs = _fs_path(spark, f"{root}/{before['state']}")
        fs.delete(old, True)


def newest_sink(table_root: str, table: str, n: int = 1, key: str = "symbol", ts: str = "ts",
                query_id: str | None = None) -> Callable[[DataFrame, int], None]:
    """T1/T3 kept current: the ``n`` newest rows per key of all batches, for readers that want no more of the history.

    A batch's own newest rows (a top-n per task first) are merged with those kept, n a key; the merged table is written
    anew and the commit switches readers to it. Rows that come again, by a retry or another checkpoint, have a key and
    time that is there already, and the kept row stays. Rows without key or time are left out.
    """
    root, job = table_root.rstrip("/"), f"{table}-newest"

    def write(batch_df: DataFrame, batch_id: int) -> None:
        spark = batch_df.sparkSession
        query = query_id or query_id_of(spark)
        if committed(spark, root, job).get(query, -1) >= batch_id:
            batch_df.write.format("noop").mode("overwrite").save()
            return
        before = _latest_note(spark, root, job)
        kept = _state(spark, root, before["state"], batch_df.schema)
        fresh = latest_n(batch_df.filter(F.col(key).isNotNull() & F.col(ts).isNotNull()).dropDuplicates([key, ts]), n, key, ts)
        fresh = fresh.join(kept.select(key, ts), [key, ts], "left_anti").select(batch_df.columns)
        folder = f"{table}_newest/query_id={query}/batch_id={int(batch_id)}"
        latest_n(kept.unionByName(fresh), n, key, ts).write.mode("overwrite").parquet(f"{root}/{folder}")
        _commit_state(spark, root, job, query, batch_id, before, folder)

    return write


def newest_rows(spark: SparkSession, table_root: str, table: str, schema: StructType) -> DataFrame:
    """What :func:`newest_sink` keeps, as of its last commit (empty before the first)."""
    root = table_root.rstrip("/")
    return _state(spark, root, _latest_note(spark, root, f"{table}-newest")["state"], schema)


def indicator_sink(table_root: str, candle_schema: StructType, step_s: int, query_id: str | None = None,
                   lengths: dict[str, int] | None = None) -> Callable[[DataFrame, int], None]:
    """W1-W4 on the stream: moving averages and VWAP of the candles that the same batch of the candle sink inserted.

    To be run after the candle sink, with its batch. Per symbol, ``indicator_state`` holds the
    last slot, the closes of the slots that the longest average looks back on, and the running sums; a batch writes
    it anew (a row per symbol) and its commit names the folder, the one before is removed. Slots
    without a candle between a symbol's candles become rows without close. A candle at or before the last slot
    of its symbol, which only a second query over older windows brings, does not change slots already written.
    """
    root = table_root.rstrip("/")
    lengths = lengths or {"ma_fast": MA_FAST, "ma_slow": MA_SLOW}
    halo_us = (max(lengths.values()) - 1) * step_s * 1_000_000

    def inserted(spark: SparkSession, query: str, batch_id: int) -> DataFrame:
        note = commit_notes(spark, root, CANDLE_JOB).get(query, {})
        keep = (F.col("query_id") == query) & (F.col("batch_id") == int(batch_id))
        days = [dt.date.fromisoformat(d) for d in note.get("days", [])]
        rows = batch_rows(spark, root, "candles", candle_schema, True, keep, days)
        return rows.select("symbol", "window_start", *[F.col(c).cast("double").alias(c) for c in ("high", "low", "close", "volume")])

    def after_last(last: str = "last") -> Column:
        return F.col(last).isNull() | (F.col("window_start") > F.col(last))

    def write(batch_df: DataFrame, batch_id: int) -> None:
        spark = batch_df.sparkSession
        query = query_id or query_id_of(spark)
        if committed(spark, root, INDICATOR_JOB).get(query, -1) >= batch_id:
            return
        remove_attempt(spark, root, ["indicators"], query, batch_id)
        newest = _latest_note(spark, root, INDICATOR_JOB)
        state = _state(spark, root, newest["state"], STATE)
        fresh = inserted(spark, query, batch_id).join(state.select("symbol", "last"), "symbol", "left").filter(after_last()).drop("last").persist()
        folder = newest["state"]
        if not fresh.isEmpty():
            known = state.join(fresh.select("symbol").distinct(), "symbol", "left_semi")
            seeds = known.select("symbol", F.inline("recent")).withColumnRenamed("t", "window_start")
            grid = gap_fill(fresh.unionByName(seeds, allowMissingColumns=True), step_s)
            averaged = moving_averages(grid, step_s, lengths, keep_bucket="_hb").join(state.drop("recent"), "symbol", "left")
            averaged = averaged.persist()
            rows = session_vwap(averaged.filter(after_last()), bucket_col="_hb", before={"_ctv": "ctv", "_cv": "cv"}, materialize=False).persist()
            write_dated_batch(rows.select("symbol", "window_start", "close", *lengths, "vwap"), f"{root}/indicators", query, batch_id,
                              "window_start", rows.count())
            ends = rows.groupBy("symbol").agg(F.max("window_start").alias("last"), F.max_by("_ctv", "window_start").alias("ctv"),
                                              F.max_by("_cv", "window_start").alias("cv"))
            # at most one slot per step of the look-back and symbol
            near = (averaged.select("symbol", "window_start", "close").join(ends.select("symbol", "last"), "symbol")
                    .filter(F.unix_micros("window_start") > F.unix_micros("last") - halo_us)
                    .filter(F.col("close").isNotNull() | (F.col("window_start") == F.col("last"))))
            recent = near.groupBy("symbol").agg(F.collect_list(F.struct(F.col("window_start").alias("t"), "close")).alias("recent"))
            changed = ends.join(recent, "symbol", "left").select("symbol", "last", "recent", "ctv", "cv")
            folder = f"indicator_state/query_id={query}/batch_id={int(batch_id)}"
            changed.unionByName(state.join(ends, "symbol", "left_anti")).write.mode("overwrite").parquet(f"{root}/{folder}")
            for df in (rows, averaged):
                df.unpersist()
        _commit_state(spark, root, INDICATOR_JOB, query, batch_id, newest, folder)
        fresh.unpersist()

    return write
