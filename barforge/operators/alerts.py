"""Volatility alerts derived from finalised candles (D1 = F1 + F2 + F3).

A pure projection + filter of the candle stream: it runs on the executors, in
the same stage as whatever produced the candles, batch or micro-batch.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barforge.functions.exprs import alert_message, exceeds, pct_change

DEFAULT_THRESHOLD_PCT = 0.3  # fixed default of the reference


def derive_alerts(candles: DataFrame, threshold: float = DEFAULT_THRESHOLD_PCT) -> DataFrame:
    """``(symbol, ts = window_end, price = close, pct_change, message)`` for every
    candle whose |open -> close| move is strictly above ``threshold`` percent.

    pct_change is the unrounded double (the comparison uses it too); a zero or
    NULL open gives 0 % and so never alerts.
    """
    with_pct = candles.select(
        "symbol", "window_start", "window_end", "close", pct_change("open", "close").alias("pct_change")
    )
    return with_pct.filter(exceeds("pct_change", threshold)).select(
        "symbol",
        F.col("window_end").alias("ts"),
        F.col("close").alias("price"),
        "pct_change",
        alert_message("symbol", "pct_change", "window_start", "window_end").alias("message"),
    )
