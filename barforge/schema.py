"""The single trade contract and the stored (table-boundary) types."""

from __future__ import annotations

from pyspark.sql.types import (
    DecimalType,
    DoubleType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)

# Fixed values of the trade contract: field names, required list, side enum.
REQUIRED_FIELDS = ["symbol", "price", "size", "side", "trade_id", "ts"]
SIDES = ["buy", "sell"]

# Wire schema of one trade message value (ts arrives as RFC 3339 text).
TRADE_WIRE_SCHEMA = StructType(
    [
        StructField("symbol", StringType()),
        StructField("price", DoubleType()),
        StructField("size", DoubleType()),
        StructField("side", StringType()),
        StructField("trade_id", LongType()),
        StructField("ts", StringType()),
    ]
)

# Parsed, typed trade.
TRADE_SCHEMA = StructType(
    [
        StructField("symbol", StringType()),
        StructField("price", DoubleType()),
        StructField("size", DoubleType()),
        StructField("side", StringType()),
        StructField("trade_id", LongType()),
        StructField("ts", TimestampType()),
    ]
)

# Exchange feed message: every field kept as text, numbers are quoted strings.
FEED_SCHEMA = StructType(
    [
        StructField("type", StringType()),
        StructField("product_id", StringType()),
        StructField("price", StringType()),
        StructField("size", StringType()),
        StructField("side", StringType()),
        StructField("trade_id", StringType()),
        StructField("time", StringType()),
        StructField("message", StringType()),
    ]
)

CANDLE_SCHEMA = StructType(
    [
        StructField("symbol", StringType()),
        StructField("window_start", TimestampType()),
        StructField("window_end", TimestampType()),
        StructField("open", DoubleType()),
        StructField("high", DoubleType()),
        StructField("low", DoubleType()),
        StructField("close", DoubleType()),
        StructField("volume", DoubleType()),
    ]
)

# Stored decimal types at the table boundary (fixed values of the storage contract).
PRICE_DECIMAL = DecimalType(20, 8)
VOLUME_DECIMAL = DecimalType(30, 8)
PCT_DECIMAL = DecimalType(10, 4)

STORED_CANDLE_TYPES = {
    "open": PRICE_DECIMAL,
    "high": PRICE_DECIMAL,
    "low": PRICE_DECIMAL,
    "close": PRICE_DECIMAL,
    "volume": VOLUME_DECIMAL,
}

TICK_SCHEMA = StructType(
    [
        StructField("symbol", StringType()),
        StructField("second", TimestampType()),
        StructField("ts", TimestampType()),
        StructField("price", PRICE_DECIMAL),
        StructField("size", VOLUME_DECIMAL),
    ]
)

METRICS_SCHEMA = StructType(
    [
        StructField("metric", StringType()),
        StructField("value", LongType()),
        StructField("updated_at", TimestampType()),
    ]
)
