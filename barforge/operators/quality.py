"""Table-level checks used as semantics: uniqueness (A8/C2), NOT NULL (C1),
derived window end (C3). Each is one distributed aggregation."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def duplicate_audit(df: DataFrame, keys: list[str]) -> DataFrame:
    """``rows``, ``distinct_keys`` and ``duplicates = rows - distinct_keys`` (one row).

    The distinct count is exact; Spark plans it as a two-level aggregation
    (partial distinct per partition, then a shuffle by key), so a hot key is
    collapsed before it moves.
    """
    return df.agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_distinct(F.struct(*keys)).alias("distinct_keys"),
    ).withColumn("duplicates", F.col("rows") - F.col("distinct_keys"))


def duplicate_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """A8 listing: every key that occurs more than once, with its number of copies."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("copies")).filter(F.col("copies") > 1)


def candle_constraints(candles: DataFrame, window_duration: str) -> DataFrame:
    """C1 + C3 in a single pass over the candles."""
    expected = F.col("window_start") + F.expr(f"INTERVAL {window_duration}")
    cols = ["symbol", "window_start", "window_end", "open", "high", "low", "close", "volume"]
    return candles.agg(
        F.count(F.lit(1)).alias("rows"),
        *[F.count_if(F.col(c).isNull()).alias(f"nulls_{c}") for c in cols],
        F.count_if(F.col("window_end") != expected).alias("bad_window_end"),
        F.count_if(F.col("low") > F.col("high")).alias("low_above_high"),
    )


def stored_audit(table: str, rows: DataFrame, keys: list[str], not_null: list[str], duration: str | None = None) -> DataFrame:
    """C1 + C2 + C3 of a stored table as one row: table, rows, nulls, duplicates, bad_window_end (0 for valid tables)."""
    nulls = F.lit(0).cast("long")
    for c in not_null:
        nulls = nulls + F.count_if(F.col(c).isNull())
    bad = F.count_if(F.col("window_end") != F.col("window_start") + F.expr(f"INTERVAL {duration}")) if duration else F.lit(0).cast("long")
    return (rows.agg(F.count(F.lit(1)).alias("rows"), nulls.alias("nulls"),
                     (F.count(F.lit(1)) - F.count_distinct(F.struct(*keys))).alias("duplicates"), bad.alias("bad_window_end"))
            .select(F.lit(table).alias("table"), "rows", "nulls", "duplicates", "bad_window_end"))
