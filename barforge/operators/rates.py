"""Rates and tick sampling.

* A9: trades per reporting interval per configured symbol, zero-filled, plus total.
* A10: rate over a trailing range, from events (sliding windows) or from sampled
  cumulative counters with resets (per-sample increase / observed span).
* A11: ingestion rate of all messages over a trailing minute.
* A12: cumulative trade count per symbol.
* W6: latest trade per symbol per second (live-price tick buffer).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barforge.functions.exprs import to_stored_price, to_stored_volume
from barforge.operators.candles import packed_order_key
from barforge.operators.serving import allow_list
from barforge.operators.timegrid import DAY_S, running_sums, trailing
from barforge.session import shared_dir

# Reporting interval and the trailing rate range (seconds).
REPORT_INTERVAL_S = 10
RATE_RANGE_S = 60


def _interval(s: int) -> str:
    return f"{int(s)} seconds"


def interval_counts(trades: DataFrame, interval_s: int = REPORT_INTERVAL_S) -> DataFrame:
    """``(window_start, symbol, n)``: trades per interval and symbol, of a table or of a stream with a watermark."""
    counts = trades.groupBy(F.window("ts", _interval(interval_s)).alias("_w"), "symbol").agg(F.count(F.lit(1)).alias("n"))
    return counts.select(F.col("_w.start").alias("window_start"), "symbol", "n")


def fill_intervals(counts: DataFrame, bounds: DataFrame, symbols: list[str], interval_s: int = REPORT_INTERVAL_S) -> DataFrame:
    """``(window_start, symbol, trades, rate, total_rate)`` for every configured symbol and every interval that the one
    row of ``bounds`` names: the first one's start in microseconds (``_lo``) and the number of those after it (``_n``).

    Counts are reduced to one row per interval holding a symbol -> count map
    (at most one entry per configured symbol) and the interval total; only the
    interval grid (generated per day chunk, in parallel) is joined to it, and the
    configured symbols are expanded after the join, so the windows x symbols
    output is never shuffled.
    """
    wanted = [s.strip() for s in symbols if s and s.strip()]
    per_window = (
        allow_list(counts, wanted)
        .groupBy("window_start")
        .agg(F.map_from_entries(F.collect_list(F.struct("symbol", "n"))).alias("_counts"),
             F.sum("n").alias("_total"))
    )
    step_us = interval_s * 1_000_000
    per_chunk = max(1, DAY_S // interval_s)
    chunks = bounds.select(
        "_lo", "_n",
        F.explode(F.sequence(F.lit(0).cast("long"), F.floor(F.col("_n") / per_chunk).cast("long"))).alias("_c"),
    ).repartition("_c")
    windows = chunks.select(
        "_lo",
        F.explode(F.sequence(F.col("_c") * per_chunk, F.least((F.col("_c") + 1) * per_chunk - 1, F.col("_n")))).alias("_k"),
    ).select(F.timestamp_micros(F.col("_lo") + F.col("_k") * step_us).alias("window_start"))
    filled = windows.join(per_window, "window_start", "left")
    return filled.select(
        "window_start",
        F.explode(F.array(*[F.lit(s) for s in wanted])).alias("symbol"),
        "_counts",
        F.coalesce(F.col("_total"), F.lit(0)).cast("long").alias("_total"),
    ).select(
        "window_start",
        "symbol",
        F.coalesce(F.try_element_at("_counts", F.col("symbol")), F.lit(0)).cast("long").alias("trades"),
        (F.coalesce(F.try_element_at("_counts", F.col("symbol")), F.lit(0)) / float(interval_s)).alias("rate"),
        (F.col("_total") / float(interval_s)).alias("total_rate"),
    )


def throughput(trades: DataFrame, symbols: list[str], interval_s: int = REPORT_INTERVAL_S) -> DataFrame:
    """``(window_start, symbol, trades, rate, total_rate)`` for every interval
    between the first and last trade and every configured symbol (0 when silent).
    """
    # The bounds and the counts come from one scan of the trades: per-window counts, written once.
    shared_dir(trades.sparkSession)
    counts = interval_counts(trades, interval_s).checkpoint()
    lo_us = F.unix_micros(F.min("window_start"))
    bounds = counts.agg(
        lo_us.alias("_lo"),
        F.floor((F.unix_micros(F.max("window_start")) - lo_us) / (interval_s * 1_000_000)).cast("long").alias("_n"),
    )
    return fill_intervals(counts, bounds, symbols, interval_s)


def sliding_rate(df: DataFrame, ts: str = "ts", keys: list[str] | None = None,
                 range_s: int = RATE_RANGE_S, slide_s: int = REPORT_INTERVAL_S, count_name: str = "trades") -> DataFrame:
    """A10/A11 on events: count per sliding window of ``range_s`` every ``slide_s``, / range."""
    keys = keys or []
    w = F.window(ts, _interval(range_s), _interval(slide_s))
    return df.groupBy(w.alias("w"), *keys).agg(F.count(F.lit(1)).alias(count_name)).select(
        *keys,
        F.col("w.start").alias("window_start"),
        F.col("w.end").alias("window_end"),
        count_name,
        (F.col(count_name) / float(range_s)).alias("rate"),
    )


def trade_totals(trades: DataFrame) -> DataFrame:
    """Trades per symbol (a cumulative counter read at the end)."""
    return trades.groupBy("symbol").agg(F.count(F.lit(1)).alias("trades"))


def counter_samples(trades: DataFrame, scrape_s: int, reset_at: Column | None = None) -> DataFrame:
    """Cumulative trade counter per symbol, read at the end of every scrape interval
    that saw trades. With ``reset_at`` the counter restarts from 0 at that time
    (a process restart)."""
    seg = (F.col("ts") >= reset_at).cast("int") if reset_at is not None else F.lit(0)
    per = trades.withColumn("_seg", seg).groupBy(
        "symbol", "_seg", F.window("ts", _interval(scrape_s)).end.alias("ts")
    ).agg(F.count(F.lit(1)).alias("_n"))
    # ``per`` is an aggregate over raw trades; checkpoint it once instead of
    # scanning the trades again for the second branch of the running sum.
    out = running_sums(per, ["symbol", "_seg"], "ts", {"value": F.col("_n")}, materialize=True)
    return out.select("symbol", "ts", F.col("value").cast("long").alias("value"))


def counter_rate(samples: DataFrame, range_s: int, key: str = "symbol", ts: str = "ts", value: str = "value") -> DataFrame:
    """A10 on counter samples: per-second increase over the trailing ``range_s``.

    delta = value - previous value; a drop means a reset, so delta = value.
    increase = sum of deltas in the frame minus the frame's first delta (the first
    sample is the baseline); rate = increase / (t - first sample time), NULL when
    the frame holds a single sample. No extrapolation to the range edges.
    """

    def fn_delta(base):
        d = F.col(value) - F.lag(value).over(base)
        return F.coalesce(F.when(d < 0, F.col(value)).otherwise(d), F.lit(0))

    def fn_increase(base):
        f = base.rangeBetween(-range_s, 0)
        return F.sum("_delta").over(f) - F.first("_delta").over(f)

    def fn_span(base):
        return F.col("_s") - F.min("_s").over(base.rangeBetween(-range_s, 0))

    # One pass: every sample in a home row's frame except the frame's first has its
    # predecessor inside the same (key, bucket + halo) partition, so its delta is
    # exact; the first sample's delta is subtracted whatever it is.
    res = trailing(samples, key, ts, range_s, 1, {"_delta": fn_delta, "_inc": fn_increase, "_span": fn_span})
    return res.select(
        key, ts, value,
        F.col("_inc").cast("long").alias("increase"),
        F.try_divide(F.col("_inc"), F.when(F.col("_span") > 0, F.col("_span"))).alias("rate"),
    )


def offset_rate(samples: DataFrame, range_s: int, partition: str = "partition", ts: str = "ts", value: str = "value") -> DataFrame:
    """``(ts, partitions, increase, rate)``: :func:`counter_rate` of each partition's
    offsets, summed over the partitions sampled at that time."""
    each = counter_rate(samples, range_s, partition, ts, value)
    return each.groupBy(ts).agg(F.count(F.lit(1)).alias("partitions"), F.sum("increase").alias("increase"), F.sum("rate").alias("rate"))


def tick_samples(trades: DataFrame, every_s: int = 1) -> DataFrame:
    """Latest trade per symbol per ``every_s`` seconds, by ``(ts, trade_id)``,
    with the stored decimal types of the tick table."""
    k = packed_order_key()
    return trades.groupBy("symbol", F.window("ts", _interval(every_s)).start.alias("second")).agg(
        F.max_by("ts", k).alias("ts"),
        F.max_by("price", k).alias("price"),
        F.max_by("size", k).alias("size"),
    ).select("symbol", "second", "ts", to_stored_price("price").alias("price"), to_stored_volume("size").alias("size"))
