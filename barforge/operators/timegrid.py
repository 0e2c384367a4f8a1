"""Time-series building blocks that stay parallel when one key holds most rows.

A window function partitioned by ``symbol`` alone sends a symbol's whole history
to one task. The helpers here partition by ``(key, time bucket)`` instead:

* :func:`regular_grid` generates a per-key time grid chunk by chunk, so grid
  generation is spread over tasks (W1).
* :func:`halo_buckets` copies the rows that lie within ``halo`` seconds of the
  next bucket into that bucket too, so a trailing frame of up to ``halo`` seconds
  is complete for every row of its home bucket (exact, no approximation).
* :func:`running_sums` computes cumulative sums as per-bucket totals, a prefix
  over buckets (one small row per key and bucket), plus the in-bucket running sum.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from barforge.session import shared_dir

DAY_S = 86_400


def seconds(ts: str | Column) -> Column:
    """Timestamp -> fractional epoch seconds (microsecond exact for frames)."""
    c = F.col(ts) if isinstance(ts, str) else ts
    return F.unix_micros(c.cast("timestamp")) / 1_000_000.0


def bucket_size(halo_s: int, step_s: int = 1) -> int:
    """A bucket at least one day long and at least four halos long, a whole number of steps."""
    size = max(DAY_S, 4 * int(halo_s))
    return ((size + step_s - 1) // step_s) * step_s


def regular_grid(df: DataFrame, step_s: int, key: str = "symbol", ts: str = "window_start",
                 chunk_s: int = DAY_S) -> DataFrame:
    """W1 grid: for each key, every ``lo + k*step`` between its own min and max ``ts``.

    Keys are expanded to (key, chunk) rows first, repartitioned, then each chunk
    expands to its points, so no single task generates a whole key's grid.
    """
    per_chunk = max(1, chunk_s // step_s)
    bounds = df.groupBy(key).agg(F.min(ts).alias("_lo"), F.max(ts).alias("_hi"))
    n_steps = F.floor((F.unix_micros(F.col("_hi").cast("timestamp")) - F.unix_micros(F.col("_lo").cast("timestamp")))
                      / (step_s * 1_000_000)).cast("long")
    chunks = bounds.select(
        key, "_lo", n_steps.alias("_n"),
    ).select(
        key, "_lo", "_n",
        F.explode(F.sequence(F.lit(0).cast("long"), F.floor(F.col("_n") / per_chunk).cast("long"))).alias("_c"),
    ).repartition(key, "_c")
    points = chunks.select(
        key, "_lo",
        F.explode(
            F.sequence(
                F.col("_c") * per_chunk,
                F.least((F.col("_c") + 1) * per_chunk - 1, F.col("_n")),
            )
        ).alias("_k"),
    )
    return points.select(
        key,
        F.timestamp_micros(F.unix_micros(F.col("_lo").cast("timestamp")) + F.col("_k") * (step_s * 1_000_000)).alias(ts),
    )


def gap_fill(df: DataFrame, step_s: int, key: str = "symbol", ts: str = "window_start") -> DataFrame:
    """Left-join the rows onto their key's regular grid; missing steps become NULL rows.

    A key with a single row keeps just that row (its grid has one point).
    """
    grid = regular_grid(df, step_s, key, ts)
    out = grid.join(df.withColumn(ts, F.col(ts).cast("timestamp")), [key, ts], "left")
    return out


def halo_buckets(df: DataFrame, ts: str, halo_s: int, bucket_s: int) -> DataFrame:
    """Add ``_bucket`` (home bucket, plus a copy in the next bucket for rows within
    ``halo_s`` of its start) and ``_home`` (True on the original row)."""
    if halo_s >= bucket_s:
        raise ValueError("halo must be shorter than the bucket")
    s = seconds(ts)
    b = F.floor(s / bucket_s).cast("long")
    in_halo = s >= (b + 1) * bucket_s - halo_s
    return (
        df.withColumn("_b0", b)
        .withColumn("_bucket", F.explode(F.when(in_halo, F.array(b, b + 1)).otherwise(F.array(b))))
        .withColumn("_home", F.col("_bucket") == F.col("_b0"))
        .drop("_b0")
    )


def trailing(df: DataFrame, key: str, ts: str, halo_s: int, step_s: int, columns: dict,
             keep_bucket: str | None = None, bucket_s: int | None = None) -> DataFrame:
    """Evaluate trailing-frame expressions exactly, partitioned by (key, bucket).

    ``columns`` maps output name -> ``fn(window_spec) -> Column`` where the spec
    is ordered by epoch seconds; frames must look back at most ``halo_s``.
    ``keep_bucket`` keeps the home bucket id under that name, so a following
    per-(key, bucket) step can reuse this partitioning without a new shuffle.
    """
    bucket_s = bucket_s or bucket_size(halo_s, step_s)
    h = halo_buckets(df, ts, halo_s, bucket_s).withColumn("_s", seconds(ts))
    base = Window.partitionBy(key, "_bucket").orderBy("_s")
    for name, fn in columns.items():
        h = h.withColumn(name, fn(base))
    out = h.filter("_home").drop("_home", "_s")
    return out.withColumnRenamed("_bucket", keep_bucket) if keep_bucket else out.drop("_bucket")


def running_sums(df: DataFrame, keys: list[str], ts: str, sums: dict, bucket_s: int = DAY_S,
                 bucket_col: str | None = None, materialize: bool = False) -> DataFrame:
    """Cumulative sums per key in ``ts`` order, NULL inputs skipped (SQL running SUM).

    ``sums`` maps output name -> Column to accumulate. Cost: one aggregation to
    (key, bucket) totals, a window over those small rows, one join back on
    (key, bucket), and an in-bucket running window on the same partitioning.
    ``bucket_col`` names an existing bucket id column (e.g. from :func:`trailing`)
    whose partitioning is then reused; otherwise buckets of ``bucket_s`` seconds.
    The input feeds two branches (totals and rows); with ``materialize`` it is
    checkpointed once to the shared checkpoint folder (eager, reliable) so an
    expensive input, e.g. an aggregate over raw trades, is not computed twice.
    """
    b = bucket_col or "_b"
    with_b = df if bucket_col else df.withColumn(b, F.floor(seconds(ts) / bucket_s).cast("long"))
    for name, expr in sums.items():
        with_b = with_b.withColumn(f"_v_{name}", expr)
    if materialize:
        shared_dir(with_b.sparkSession)  # make sure a checkpoint folder is configured
        with_b = with_b.checkpoint(eager=True)
    totals = with_b.groupBy(*keys, b).agg(*[F.sum(f"_v_{n}").alias(f"_t_{n}") for n in sums])
    wb = Window.partitionBy(*keys).orderBy(b).rowsBetween(Window.unboundedPreceding, -1)
    prefix = totals.select(*keys, b, *[F.sum(f"_t_{n}").over(wb).alias(f"_p_{n}") for n in sums])
    joined = with_b.join(prefix, [*keys, b], "left")
    win = Window.partitionBy(*keys, b).orderBy(F.col(ts).asc()).rowsBetween(Window.unboundedPreceding, 0)
    out = joined
    for n in sums:
        inside = F.sum(f"_v_{n}").over(win)
        prior = F.col(f"_p_{n}")
        # NULL when nothing non-NULL has been seen yet (like a SQL running SUM).
        out = out.withColumn(
            n,
            F.when(inside.isNull() & prior.isNull(), F.lit(None)).otherwise(
                F.coalesce(prior, F.lit(0)) + F.coalesce(inside, F.lit(0))
            ),
        )
    dropped = [f"_v_{n}" for n in sums] + [f"_p_{n}" for n in sums]
    return out.drop(*dropped) if bucket_col else out.drop(b, *dropped)
