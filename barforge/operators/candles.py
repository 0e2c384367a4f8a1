"""OHLCV candles per symbol per tumbling event-time window.

One function for batch and stream. open/close are the prices of the first/last
trade by ``(ts, trade_id)``; high/low/volume are order-free. The aggregation is
two-phase (partial per input partition, then one shuffle by (window, symbol)),
so a hot symbol is pre-aggregated on the map side before it is shuffled.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType

_D38 = DecimalType(38, 0)
# Fixed values of the packed order key: ts micros * 10^20 + (trade_id + 2^63).
# trade_id + 2^63 lies in [0, 1.85e19) < 10^20, so the packing is order-preserving
# for every long trade_id and every timestamp up to year 9999 (|micros| < 2.6e17).
_TS_SCALE = 10**20
_ID_OFFSET = 2**63


def struct_order_key(ts: str = "ts", trade_id: str = "trade_id") -> Column:
    """Composite order ``(ts, trade_id)``; NULL trade_id sorts lowest."""
    return F.struct(F.col(ts), F.col(trade_id))


def packed_order_key(ts: str = "ts", trade_id: str = "trade_id") -> Column:
    """The same order as :func:`struct_order_key` as one DECIMAL(38,0).

    A fixed-width aggregation buffer lets Spark plan a HashAggregate instead of
    the SortAggregate it needs for a struct-valued ``min_by`` key: no per-partition
    sort of the input before the partial aggregate.
    """
    micros = F.unix_micros(F.col(ts).cast("timestamp")).cast(_D38)
    tid = F.coalesce(
        F.col(trade_id).cast(_D38) + F.lit(Decimal(_ID_OFFSET)).cast(_D38),
        F.lit(-1).cast(_D38),
    )
    return F.when(F.col(ts).isNotNull(), micros * F.lit(Decimal(_TS_SCALE)).cast(_D38) + tid)


def _by_order(key: Column) -> dict[str, Column]:
    """The measures of a candle; open and close by the trade order, the others in any order."""
    return {"open": F.min_by("price", key), "high": F.max("price"), "low": F.min("price"),
            "close": F.max_by("price", key), "volume": F.sum("size")}


def candles_of(trades: DataFrame, width: str, key: Column | None = None) -> DataFrame:
    """A1: one row per symbol and non-empty window of ``width`` (half-open, aligned to the epoch in UTC).

    Trades without a time are in no window. ``key`` orders trades within a window
    (default: the packed key). On a stream, the caller sets the watermark.
    """
    window = F.window("ts", width)
    measures = _by_order(packed_order_key() if key is None else key)
    per_window = trades.groupBy("symbol", window.alias("w")).agg(*(c.alias(n) for n, c in measures.items()))
    return per_window.select("symbol", F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), *measures)


# --- mergeable candles -----------------------------------------------------------

#: Beside a candle's own columns: the order keys of the trades that gave open and close.
ORDER_KEYS = ["open_key", "close_key"]
PARTIAL_COLUMNS = ["symbol", "window_start", "window_end", "open", "high", "low", "close", "volume", *ORDER_KEYS]


def partial_candles(trades: DataFrame, width: str) -> DataFrame:
    """Candles that remember when their open and close were traded, so that they can be merged."""
    key = packed_order_key()
    measures = _by_order(key) | {"open_key": F.min(key), "close_key": F.max(key)}
    per_window = trades.groupBy("symbol", F.window("ts", width).alias("w")).agg(*(c.alias(n) for n, c in measures.items()))
    return per_window.select("symbol", F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), *measures)


def merge_candles(partials: DataFrame, width: str) -> DataFrame:
    """Partial candles of any trades, of windows that ``width`` is a multiple of, as partial candles of ``width``.

    Equal to :func:`partial_candles` over all those trades, if no trade is in two of them:
    roll-up of minutes to hours and days, or candles of new trades added to stored ones.
    """
    merged = {"open": F.min_by("open", "open_key"), "high": F.max("high"), "low": F.min("low"),
              "close": F.max_by("close", "close_key"), "volume": F.sum("volume"),
              "open_key": F.min("open_key"), "close_key": F.max("close_key")}
    per_window = partials.groupBy("symbol", F.window("window_start", width).alias("w")).agg(*(c.alias(n) for n, c in merged.items()))
    return per_window.select("symbol", F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), *merged)


def corrected_candles(stored: DataFrame, added_trades: DataFrame, width: str) -> DataFrame:
    """The partial candles that ``added_trades`` (replayed dead letters, late rows) change or add, in their new form.

    Only the stored candles of those windows are read into the merge.
    """
    added = partial_candles(added_trades, width)
    touched = stored.join(added.select("symbol", "window_start"), ["symbol", "window_start"], "left_semi")
    return merge_candles(touched.select(PARTIAL_COLUMNS).unionByName(added), width)


def finished(partials: DataFrame) -> DataFrame:
    """Plain candles."""
    return partials.drop(*ORDER_KEYS)
