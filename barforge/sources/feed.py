"""Exchange feed capture -> trade records (S2) and message routing (S3).

Feed messages are JSON objects discriminated by ``type``; prices and sizes are
quoted decimal strings. Everything is read as text first, then converted with a
strict number syntax so that only plain decimal numbers are accepted.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barforge.functions.exprs import strict_double
from barforge.schema import FEED_SCHEMA

# Message types handled by name, and the route labels.
ROUTE_TRADE = "trade"
ROUTE_REJECT = "reject"
ROUTE_UNDECODABLE = "undecodable"
ROUTE_IGNORED = "ignored"
NAMED_TYPES = ["heartbeat", "subscriptions", "error"]


def parse_feed(raw: DataFrame, value_col: str = "value") -> DataFrame:
    """Parse feed text into the all-string feed struct plus the mapped trade fields."""
    msg = raw.select(F.col(value_col).cast("string").alias("raw_json")).select(
        "raw_json", F.from_json("raw_json", FEED_SCHEMA).alias("m")
    )
    fields = F.struct(
        F.col("m.type").alias("type"),
        F.col("m.product_id").alias("symbol"),
        strict_double(F.col("m.price")).alias("price"),
        strict_double(F.col("m.size")).alias("size"),
        F.col("m.side").alias("side"),
        F.col("m.trade_id").try_cast("long").alias("trade_id"),
        F.col("m.time").alias("ts"),
        # Whether the text decoded to a JSON object at all.
        F.json_object_keys("raw_json").isNotNull().alias("decoded"),
    )
    # One-row ``inline`` (Generate): route filters stay above it, so each
    # message is parsed once (see ``sources.trades.parse_trades``).
    return msg.select("raw_json", F.inline(F.array(fields)))


def route_feed(parsed: DataFrame) -> DataFrame:
    """S3: add ``route``: trade / reject / heartbeat / subscriptions / error / ignored / undecodable.

    A ``match`` is a trade only if every mapped field is present and numeric
    fields hold plain decimal numbers; otherwise it is a reject.
    """
    mapped_ok = (
        F.col("symbol").isNotNull()
        & F.col("price").isNotNull()
        & F.col("size").isNotNull()
        & F.col("side").isNotNull()
        & F.col("trade_id").isNotNull()
        & F.col("ts").isNotNull()
    )
    route = (
        F.when(~F.col("decoded"), F.lit(ROUTE_UNDECODABLE))
        .when(F.col("type") == "match", F.when(mapped_ok, F.lit(ROUTE_TRADE)).otherwise(F.lit(ROUTE_REJECT)))
        .when(F.col("type").isin(*NAMED_TYPES), F.col("type"))
        .otherwise(F.lit(ROUTE_IGNORED))
    )
    return parsed.withColumn("route", route)


def feed_to_trades(raw: DataFrame, value_col: str = "value") -> DataFrame:
    """Mapped trade records (``ts`` kept as the received RFC 3339 text)."""
    return (
        route_feed(parse_feed(raw, value_col))
        .filter(F.col("route") == ROUTE_TRADE)
        .select("symbol", "price", "size", "side", "trade_id", "ts")
    )


def route_counts(raw: DataFrame, value_col: str = "value") -> DataFrame:
    """S3 report: messages per route (map-side partial count, one small shuffle)."""
    return route_feed(parse_feed(raw, value_col)).groupBy("route").agg(F.count(F.lit(1)).alias("messages"))
