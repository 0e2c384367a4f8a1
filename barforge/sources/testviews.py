"""Views that turn the driver's ``events`` table into trade-shaped inputs.

Mapping (fixed): symbol = event_type, price = value, size = props.k,
side = buy for even event_id else sell, trade_id = event_id, ts = ts (UTC).

The message views serialise every event and corrupt some of them by a fixed
rule on ``event_id`` (fault injection: every row is kept and processed, the
rule only decides which defect a message carries). Each text is built by plain
concatenation so a SQL engine can rebuild the very same text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from barforge.session import ensure_utc

# Fixed values of the fault-injection rules.
TRADE_FAULT_MOD = 17  # 0 truncated, 1 no price, 2 bad ts, 3 quoted price, 4 extra key, 5 bad side, 6 negative size
TRADE_TRUNCATE_AT = 30
FEED_TYPE_MOD = 11  # 0 heartbeat, 1 last_match, 2 error, 3 subscriptions, 4 undecodable, else match
FEED_FAULT_MOD = 13  # for matches: 0 non-numeric price, 1 no size, 2 size in e-notation
TS_TEXT_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'"


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def trades_from_events(events: DataFrame, symbol_col: str = "event_type") -> DataFrame:
    """Typed trades (ts as TIMESTAMP, so it can carry a watermark).

    ``symbol_col="user_id"`` gives many symbols (150 at sf0.01) instead of 5.
    """
    return events.select(
        F.col(symbol_col).cast("string").alias("symbol"),
        F.col("value").alias("price"),
        F.get_json_object("props", "$.k").try_cast("double").alias("size"),
        F.when(F.col("event_id") % 2 == 0, F.lit("buy")).otherwise(F.lit("sell")).alias("side"),
        F.col("event_id").alias("trade_id"),
        F.col("ts").cast("timestamp").alias("ts"),
    )


def trades(spark: SparkSession, sf_dir: str, symbol_col: str = "event_type") -> DataFrame:
    ensure_utc(spark)
    return trades_from_events(load(spark, sf_dir, "events"), symbol_col)


def _ts_text(events_ts: Column) -> Column:
    return F.date_format(events_ts, TS_TEXT_FORMAT)


def trade_messages_from_events(events: DataFrame) -> DataFrame:
    """Trade JSON text, one per event, as a ``value`` column (plus ``trade_id`` for audits)."""
    r = F.col("event_id") % TRADE_FAULT_MOD
    sym = F.col("event_type")
    price_txt = F.col("value").cast("string")
    size_txt = F.get_json_object("props", "$.k").try_cast("double").cast("string")
    side = F.when(F.col("event_id") % 2 == 0, F.lit("buy")).otherwise(F.lit("sell"))
    price_part = (
        F.when(r == 1, F.lit(""))
        .when(r == 3, F.concat(F.lit('"price":"'), price_txt, F.lit('",')))
        .otherwise(F.concat(F.lit('"price":'), price_txt, F.lit(",")))
    )
    size_part = F.when(r == 6, F.concat(F.lit("-"), size_txt)).otherwise(size_txt)
    side_part = F.when(r == 5, F.lit("hold")).otherwise(side)
    ts_part = F.when(r == 2, F.lit("not-a-time")).otherwise(_ts_text(F.col("ts")))
    extra = F.when(r == 4, F.lit(',"venue":"x"')).otherwise(F.lit(""))
    full = F.concat(
        F.lit('{"symbol":"'), sym, F.lit('",'),
        price_part,
        F.lit('"size":'), size_part,
        F.lit(',"side":"'), side_part,
        F.lit('","trade_id":'), F.col("event_id").cast("string"),
        F.lit(',"ts":"'), ts_part, F.lit('"'),
        extra,
        F.lit("}"),
    )
    value = F.when(r == 0, F.substring(full, 1, TRADE_TRUNCATE_AT)).otherwise(full)
    return events.select(F.col("event_id"), F.col("ts").alias("event_ts"), value.alias("value"))


def trade_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    ensure_utc(spark)
    return trade_messages_from_events(load(spark, sf_dir, "events"))


def feed_messages_from_events(events: DataFrame) -> DataFrame:
    """Exchange-feed JSON text, one message per event, as a ``value`` column."""
    t = F.col("event_id") % FEED_TYPE_MOD
    f = F.col("event_id") % FEED_FAULT_MOD
    sym = F.col("event_type")
    eid = F.col("event_id").cast("string")
    k = F.get_json_object("props", "$.k")
    side = F.when(F.col("event_id") % 2 == 0, F.lit("buy")).otherwise(F.lit("sell"))
    price_part = F.when(f == 0, F.lit('"price":"not-a-number",')).otherwise(
        F.concat(F.lit('"price":"'), F.col("value").cast("string"), F.lit('",'))
    )
    size_part = (
        F.when(f == 1, F.lit(""))
        .when(f == 2, F.concat(F.lit('"size":"'), k, F.lit('e-08",')))
        .otherwise(F.concat(F.lit('"size":"'), k, F.lit('",')))
    )

    def trade_like(type_name: str) -> Column:
        return F.concat(
            F.lit('{"type":"' + type_name + '","trade_id":'), eid,
            F.lit(',"maker_order_id":"m","taker_order_id":"t","side":"'), side, F.lit('",'),
            size_part, price_part,
            F.lit('"product_id":"'), sym,
            F.lit('","sequence":'), eid,
            F.lit(',"time":"'), _ts_text(F.col("ts")), F.lit('"}'),
        )

    value = (
        F.when(t == 0, F.concat(F.lit('{"type":"heartbeat","product_id":"'), sym, F.lit('","sequence":'), eid, F.lit("}")))
        .when(t == 1, trade_like("last_match"))
        .when(t == 2, F.lit('{"type":"error","message":"rate limited"}'))
        .when(t == 3, F.lit('{"type":"subscriptions","channels":["matches","heartbeat"]}'))
        .when(t == 4, F.concat(F.lit("not json "), eid))
        .otherwise(trade_like("match"))
    )
    return events.select(F.col("event_id"), value.alias("value"))


def feed_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    ensure_utc(spark)
    return feed_messages_from_events(load(spark, sf_dir, "events"))
