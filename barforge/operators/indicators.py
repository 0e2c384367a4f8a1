"""Chart indicators over candle series.

Semantics follow a rolling-window chart over a complete time grid:
* moving averages need ``n`` non-NULL closes in the last ``n`` grid slots;
* session VWAP = cumulative sum(typical * volume) / cumulative sum(volume) over the
  visible slice, NULL on gap rows and while the cumulative volume is 0.

All of it is partitioned by (symbol, time bucket), never by symbol alone.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from barforge.functions.exprs import direction, typical_price
from barforge.operators.timegrid import gap_fill, running_sums, trailing

# Fixed values of the chart: fast/slow moving-average lengths (slots) and sparkline size.
MA_FAST = 10
MA_SLOW = 20
SPARK_W = 150
SPARK_H = 36


def moving_averages(grid: DataFrame, step_s: int, lengths: dict | None = None,
                    key: str = "symbol", ts: str = "window_start", value: str = "close",
                    keep_bucket: str | None = None) -> DataFrame:
    """``avg(value)`` over the last ``n`` slots, only when all ``n`` are present.

    A RANGE frame of ``(n-1)*step`` seconds on the grid equals a ROWS frame of
    ``n`` rows; evaluated with :func:`trailing` so it is exact across bucket edges.
    """
    lengths = lengths or {"ma_fast": MA_FAST, "ma_slow": MA_SLOW}
    halo = (max(lengths.values()) - 1) * step_s

    def ma(n):
        def fn(base):
            frame = base.rangeBetween(-(n - 1) * step_s, 0)
            return F.when(F.count(value).over(frame) == n, F.avg(value).over(frame))
        return fn

    return trailing(grid, key, ts, halo, step_s, {name: ma(n) for name, n in lengths.items()}, keep_bucket=keep_bucket)


def session_vwap(grid: DataFrame, key: str = "symbol", ts: str = "window_start", bucket_col: str | None = None,
                 before: dict[str, str] | None = None, materialize: bool = True) -> DataFrame:
    """Cumulative typical-price VWAP from the first row of each key's slice.

    NaN counts as missing, in either sum, and such a row has no VWAP. The grid, a join of two aggregates, is
    checkpointed once (``materialize``): the totals and the rows would each compute it again otherwise.

    With ``before``, columns of sums that lie before the slice (``_ctv``: price times volume, ``_cv``: volume; NULL
    where there is none), the sums go on from these and are kept in the result under the two names.
    """
    none = F.lit(None).cast("double")
    volume = F.nanvl(F.col("volume").cast("double"), none)
    tv = F.nanvl(typical_price("high", "low", "close") * volume, none)
    out = running_sums(grid, [key], ts, {"_ctv": tv, "_cv": volume}, bucket_col=bucket_col, materialize=materialize)
    for name, prior in (before or {}).items():
        known = F.col(name).isNotNull() | F.col(prior).isNotNull()
        out = out.withColumn(name, F.when(known, F.coalesce(name, F.lit(0.0)) + F.coalesce(prior, F.lit(0.0))))
    vwap = F.when(tv.isNotNull(), F.try_divide(F.col("_ctv"), F.when(F.col("_cv") != 0, F.col("_cv"))))
    out = out.withColumn("vwap", vwap)
    return out if before else out.drop("_ctv", "_cv")


def chart_series(slice_df: DataFrame, step_s: int, key: str = "symbol") -> DataFrame:
    """D3: slice -> gap grid -> MA fast/slow -> VWAP -> candle direction."""
    grid = gap_fill(slice_df, step_s, key)
    # VWAP's running sums reuse the (key, bucket) partitioning of the MA windows.
    with_ma = moving_averages(grid, step_s, key=key, keep_bucket="_hb")
    with_vwap = session_vwap(with_ma, key=key, bucket_col="_hb").drop("_hb")
    return with_vwap.withColumn(
        "direction", F.when(F.col("close").isNotNull(), direction(F.col("close") - F.col("open")))
    )


def sparkline_points(slice_df: DataFrame, key: str = "symbol", ts: str = "window_start",
                     value: str = "close", width: int = SPARK_W, height: int = SPARK_H) -> DataFrame:
    """Per key, ordered non-NULL values as (pos, x, y) plot points, min-max
    normalised (a flat series uses range 1). Keys with fewer than 2 points get none.

    Bounded input: it reads a look-back slice (``lookback`` minutes / step rows per key).
    """
    vals = slice_df.filter(F.col(value).isNotNull())
    w = Window.partitionBy(key)
    wo = Window.partitionBy(key).orderBy(ts)
    pts = (
        vals.select(
            key, ts, value,
            F.count(F.lit(1)).over(w).alias("_n"),
            F.min(value).over(w).alias("_lo"),
            F.max(value).over(w).alias("_hi"),
            (F.row_number().over(wo) - 1).alias("pos"),
        )
        .filter(F.col("_n") >= 2)
    )
    rng = F.when((F.col("_hi") - F.col("_lo")) == 0, F.lit(1.0)).otherwise(F.col("_hi") - F.col("_lo"))
    return pts.select(
        key,
        "pos",
        F.col(value).alias("value"),
        (F.lit(2.0) + F.col("pos") / (F.col("_n") - 1) * (width - 4)).alias("x"),
        (F.lit(float(height - 3)) - (F.col(value) - F.col("_lo")) / rng * (height - 6)).alias("y"),
    )
