"""Read-side operators.

The reference runs these per symbol in a web process (SQL, then pandas on one
thread). Here each is one DataFrame plan over *all* symbols at once; time
filters stay on plain columns so they reach the Parquet scan as pushed filters.
``as_of`` is always an explicit parameter (no wall clock).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from barforge.functions.exprs import (
    age_seconds,
    age_text,
    axis_pad,
    direction,
    freshness_state,
    hhmm,
    kpi_change,
    money_text,
    preferred_price,
    range_move,
    signed_pct_text,
)
from barforge.operators.candles import packed_order_key

# Fixed values of the read side.
MALFORMED_METRIC = "malformed_dropped"
ALL_RANGE_LIMIT = 2000
TICK_RETENTION_MIN = 10


def minutes_before(as_of: Column, minutes: int) -> Column:
    return as_of - F.expr(f"INTERVAL {int(minutes)} MINUTES")


def lookback(df: DataFrame, as_of: Column, minutes: int | None, ts: str = "window_start") -> DataFrame:
    """Rows with ``as_of - minutes <= ts <= as_of`` (all rows when minutes is None).

    Where the input still has the ``date`` partition column of a stored table, it
    is bounded too, so partitions outside the range are not opened.
    """
    if minutes is None:
        return df
    lower = minutes_before(as_of, minutes)
    if dict(df.dtypes).get("date") == "date":
        df = df.filter(F.col("date").between(F.to_date(lower), F.to_date(as_of)))
    return df.filter(F.col(ts).between(lower, as_of))


def allow_list(df: DataFrame, symbols: list[str], key: str = "symbol") -> DataFrame:
    """Keep configured symbols only (blank entries dropped). A literal IN list,
    pushed to the scan; no join needed."""
    wanted = [s.strip() for s in symbols if s and s.strip()]
    return df.filter(F.col(key).isin(*wanted))


def retention(ticks: DataFrame, as_of: Column, minutes: int = TICK_RETENTION_MIN, ts: str = "ts") -> DataFrame:
    """P10: ticks of the last ``minutes`` up to ``as_of``."""
    return lookback(ticks, as_of, minutes, ts)


def latest_n(df: DataFrame, n: int = ALL_RANGE_LIMIT, key: str = "symbol", ts: str = "window_start",
             day: str | None = None) -> DataFrame:
    """Newest ``n`` rows per key. ``row_number() <= n`` is planned as a
    WindowGroupLimit, so each map task ships at most ``n`` rows per key.

    With ``day``, the date column of a stored table, counts per (key, day) first tell
    on which days a key's newest ``n`` rows lie; only those days are ranked, so a key
    sends at most ``n`` rows and one day to its task, however many tasks read it.
    """
    if day:
        newer = Window.partitionBy(key).orderBy(F.col(day).desc()).rowsBetween(Window.unboundedPreceding, -1)
        days = (df.groupBy(key, day).agg(F.count(F.lit(1)).alias("_n")).withColumn("_newer", F.sum("_n").over(newer))
                .filter(F.coalesce("_newer", F.lit(0)) < n).select(key, day))
        df = df.join(days, [key, day], "left_semi")
    w = Window.partitionBy(key).orderBy(F.col(ts).desc())
    return df.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") <= n).drop("_rn")


def newest(df: DataFrame, n: int, ts: str = "ts", tiebreak: str = "symbol") -> DataFrame:
    """Newest ``n`` rows overall (TakeOrderedAndProject: a bounded top-k per task)."""
    return df.orderBy(F.col(ts).desc(), F.col(tiebreak).asc()).limit(n)


def latest_per_key(trades: DataFrame, key: str = "symbol", cols=("price", "ts")) -> DataFrame:
    """Latest row per key by ``(ts, trade_id)`` (``DISTINCT ON`` without a sort).

    One ``max_by`` per column on the packed order key keeps every buffer
    fixed-width, so this is a HashAggregate with map-side partial results.
    """
    k = packed_order_key()
    return trades.groupBy(key).agg(*[F.max_by(c, k).alias(c) for c in cols])


def ordered(df: DataFrame, *cols: str) -> DataFrame:
    """T4: ascending order at the output edge only."""
    return df.orderBy(*(cols or ("symbol", "window_start")))


def freshness(candles: DataFrame) -> DataFrame:
    """A5: newest ``window_end`` over all symbols (one row)."""
    return candles.agg(F.max("window_end").alias("last_candle"))


def metric_totals(ledger: DataFrame) -> DataFrame:
    """Cumulative value per metric over the per-batch ledger (replays overwrite
    their ledger row, so the sum counts every batch once)."""
    return ledger.groupBy("metric").agg(
        F.sum("value").alias("value"), F.max("updated_at").alias("updated_at")
    )


def metric_value(ledger: DataFrame, metric: str = MALFORMED_METRIC) -> DataFrame:
    """One metric's total, 0 when absent (one row)."""
    return ledger.filter(F.col("metric") == metric).agg(
        F.coalesce(F.sum("value"), F.lit(0)).cast("long").alias("value")
    )


def slice_summary(slice_df: DataFrame, key: str = "symbol") -> DataFrame:
    """A13 + A14 + D4 + F10 + F12: per key, first open / last close of the slice,
    move %, candle count, low min, high max and the padded axis range."""
    s = slice_df.groupBy(key).agg(
        F.min_by("open", "window_start").alias("first_open"),
        F.max_by("close", "window_start").alias("last_close"),
        F.count(F.lit(1)).alias("candles"),
        F.min("low").alias("low"),
        F.max("high").alias("high"),
    )
    pad = axis_pad("low", "high")
    return s.select(
        key,
        "first_open",
        "last_close",
        range_move("first_open", "last_close").alias("move_pct"),
        direction(range_move("first_open", "last_close")).alias("direction"),
        "candles",
        "low",
        "high",
        (F.col("low") - pad).alias("axis_lo"),
        (F.col("high") + pad).alias("axis_hi"),
    )


def configured_symbols(spark_df: DataFrame, symbols: list[str]) -> DataFrame:
    """The configured symbol list as a one-column frame (a literal, no input scan)."""
    wanted = [s.strip() for s in symbols if s and s.strip()]
    return spark_df.sparkSession.range(1).select(F.explode(F.array(*[F.lit(s) for s in wanted])).alias("symbol"))


def kpi_table(kpi_slice: DataFrame, live: DataFrame, symbols: list[str]) -> DataFrame:
    """One row per configured symbol, with 'no data' rows for silent ones.

    price prefers the live tick (F8); change is vs the slice's first open (F9).
    Both inputs are first reduced to one row per configured symbol, so the joins
    are between frames bounded by the configured list; AQE picks their strategy.
    """
    per_symbol = allow_list(kpi_slice, symbols).groupBy("symbol").agg(
        F.min_by("open", "window_start").alias("first_open"),
        F.max_by("close", "window_start").alias("last_close"),
        F.count(F.lit(1)).alias("candles"),
    )
    live_px = allow_list(live, symbols).select("symbol", F.col("price").alias("live_price"))
    base = configured_symbols(kpi_slice, symbols)
    joined = base.join(per_symbol, "symbol", "left").join(live_px, "symbol", "left")
    has_data = F.col("candles").isNotNull()
    price = preferred_price("live_price", "last_close")
    change = kpi_change(price, "first_open", "candles")
    return joined.select(
        "symbol",
        F.when(has_data, F.lit("ok")).otherwise(F.lit("no data")).alias("status"),
        F.when(has_data, price).alias("price"),
        F.when(has_data, F.col("live_price").isNotNull()).alias("is_live"),
        "first_open",
        "last_close",
        F.coalesce(F.col("candles"), F.lit(0)).alias("candles"),
        F.when(has_data, change).alias("change_pct"),
        F.when(has_data, F.coalesce(direction(change), F.lit("up"))).alias("direction"),
    )


def alert_feed(alerts: DataFrame, n: int) -> DataFrame:
    """D5 (T2 + F5 + F14): newest ``n`` alerts as display fields."""
    top = newest(alerts, n)
    return top.select(
        "symbol",
        "ts",
        direction("pct_change").alias("direction"),
        F.concat(signed_pct_text("pct_change"), F.lit("%")).alias("pct_text"),
        hhmm("ts").alias("time_text"),
        money_text("price").alias("price_text"),
        "message",
    )


def pipeline_status(candles: DataFrame, ledger: DataFrame, as_of: Column) -> DataFrame:
    """D6 (A5 + A7 + F6 + F7): last candle time, its age, state and the malformed total.

    One aggregation over the union of the two inputs (no join of 1-row frames).
    """
    both = candles.select(F.col("window_end").alias("we"), F.lit(None).cast("long").alias("v")).unionByName(
        ledger.filter(F.col("metric") == MALFORMED_METRIC).select(
            F.lit(None).cast("timestamp").alias("we"), F.col("value").cast("long").alias("v")
        )
    )
    agg = both.agg(F.max("we").alias("last_candle"), F.coalesce(F.sum("v"), F.lit(0)).cast("long").alias("malformed_dropped"))
    age = age_seconds(as_of, "last_candle")
    return agg.select(
        "last_candle",
        age.alias("age_seconds"),
        freshness_state(age).alias("state"),
        age_text(age).alias("age_text"),
        "malformed_dropped",
    )
