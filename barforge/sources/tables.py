"""Stored-table readers (S4, S5) and the candle table layout (C4).

Candle tables are written partitioned by UTC ``date`` and clustered by
``(symbol, window_start)`` inside each file, so a per-symbol look-back read
prunes date partitions and skips Parquet row groups by symbol min/max.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from barforge.operators.sinks import _fs_path
from barforge.operators.serving import ALL_RANGE_LIMIT, lookback

DEFAULT_FILES_PER_WRITE = None  # let the cluster's shuffle partitions decide


def write_candle_table(candles: DataFrame, path: str, files: int | None = DEFAULT_FILES_PER_WRITE,
                       mode: str = "overwrite") -> None:
    """C4: hash-partition by (date, symbol), sort within files by (symbol,
    window_start), write partitioned by date.

    A (date, symbol) group holds at most one day of windows for one symbol (1,440
    rows at 1-minute candles), so a hot symbol spreads over its days and no task
    gets an unbounded group; unlike range partitioning, no sampling pass has to
    evaluate the (expensive) input a second time.
    """
    with_date = candles.withColumn("date", F.to_date("window_start"))
    keys = [F.col("date"), F.col("symbol")]
    parts = with_date.repartition(files, *keys) if files else with_date.repartition(*keys)
    parts.sortWithinPartitions("symbol", "window_start").write.mode(mode).partitionBy("date").parquet(path)


def write_dated(df: DataFrame, path: str, time_col: str) -> None:
    """C4 for alerts and ticks: a folder a UTC date, spread by (date, symbol), sorted by (symbol, time)."""
    parts = df.withColumn("date", F.to_date(time_col)).repartition("date", "symbol")
    parts.sortWithinPartitions("symbol", time_col).write.partitionBy("date").parquet(path)


def read_candles(spark: SparkSession, path: str) -> DataFrame:
    """The whole candle table (the ``date`` partition column included)."""
    return spark.read.parquet(path)


def read_newest(spark: SparkSession, path: str, rows: int) -> DataFrame:
    """The newest days of a dated table that hold ``rows`` rows or more (all days if there are fewer).

    Days are asked from the newest on, so older ones are neither listed nor opened.
    """
    folder, fs = _fs_path(spark, path)
    days = sorted((s.getPath().getName() for s in fs.listStatus(folder) if s.getPath().getName().startswith("date=")), reverse=True)
    taken: list[str] = []
    for day in days:
        taken.append(f"{path}/{day}")
        rows -= spark.read.parquet(taken[-1]).count()  # from the files' footers
        if rows <= 0:
            break
    return spark.read.option("basePath", path).parquet(*taken or [path])


def candles_for(spark: SparkSession, path: str, symbol: str, minutes: int | None, as_of: Column,
                limit: int = ALL_RANGE_LIMIT) -> DataFrame:
    """S4 + P6 / T1 + T4: candles of one symbol in the look-back window, or, with
    ``minutes=None``, its newest ``limit`` candles; ascending by time either way.

    The symbol and time predicates reach the scan (row-group skipping); the
    derived ``date`` predicate prunes partitions.
    """
    df = read_candles(spark, path).filter(F.col("symbol") == symbol)
    if minutes is not None:
        df = lookback(df, as_of, minutes)
    else:
        df = df.orderBy(F.col("window_start").desc()).limit(limit)
    return df.drop("date").orderBy("window_start")


def read_ticks(spark: SparkSession, path: str, as_of: Column | None = None, minutes: int | None = None) -> DataFrame:
    """S5 tick buffer; with ``as_of``/``minutes`` only the retained window (P10),
    pruning date partitions first."""
    df = spark.read.parquet(path)
    if as_of is not None and minutes is not None:
        df = lookback(df, as_of, minutes, ts="ts")
    return df.drop("date")
