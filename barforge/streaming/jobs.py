"""Structured Streaming jobs.

Two queries on one source, as in a production deployment:

* candles: parse -> valid -> watermark -> tumbling-window OHLCV (append mode, each
  candle emitted once when the watermark passes its end) -> foreachBatch sink
  writing insert-if-absent candles and their alerts (K1, K2);
* malformed: parse -> NOT valid -> foreachBatch dead letters + per-batch metric
  ledger (K3, K4).

With ``indicators`` the candle query also writes moving averages and VWAP of the candles it inserts (W1-W4);
:func:`start_throughput` is a third query that reports zero-filled trade counts per interval (A9).

All keep offsets and state in a checkpoint folder on shared storage (R7), so a
restarted job resumes where it stopped, and the sinks make a replayed batch a
no-op (R10). The source is Kafka in production or a folder of text files.
"""

from __future__ import annotations

import time
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StringType, StructField, StructType, TimestampType

from barforge.operators.candles import candles_of
from barforge.operators.compaction import TableSpec, compact
from barforge.operators.live import INDICATOR_JOB, THROUGHPUT_JOB, indicator_sink, throughput_sink
from barforge.operators.rates import REPORT_INTERVAL_S, interval_counts
from barforge.operators.sinks import (
    CANDLE_JOB,
    CANDLE_KEYS,
    LATE_JOB,
    TICK_JOB,
    candle_sink,
    dead_letter_sink,
    late_sink,
    read_by_job,
    read_table,
)
from barforge.schema import (
    CANDLE_SCHEMA,
    METRICS_SCHEMA,
    PCT_DECIMAL,
    PRICE_DECIMAL,
    STORED_CANDLE_TYPES,
    TICK_SCHEMA,
    TRADE_SCHEMA,
)
from barforge.sources.trades import parse_trades, read_text_stream, split_trades
from barforge.streaming.progress import ProgressListener

# Fixed defaults of the reference deployment.
WINDOW_DURATION = "1 minute"
WATERMARK_DELAY = "1 minute"
TRIGGER_INTERVAL = "5 seconds"

ALERT_SCHEMA = StructType([
    StructField("symbol", StringType()), StructField("ts", TimestampType()), StructField("price", PRICE_DECIMAL),
    StructField("pct_change", PCT_DECIMAL), StructField("message", StringType()),
])

LATE_SCHEMA = StructType([f for f in TRADE_SCHEMA.fields if f.name != "ts"] + [
    StructField(c, TimestampType()) for c in ("ts", "window_start", "window_end", "watermark")])

STATE_STORES = {
    "rocksdb": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "hdfs": "org.apache.spark.sql.execution.streaming.state.HDFSBackedStateStoreProvider",
}


@dataclass
class StreamConfig:
    table_root: str
    checkpoint_root: str
    window_duration: str = WINDOW_DURATION
    watermark_delay: str = WATERMARK_DELAY
    threshold: float = 0.3
    processing_time: str | None = TRIGGER_INTERVAL
    available_now: bool = False
    # Candle state is bounded by (open windows x symbols): the watermark evicts a
    # window once it is final, so the default in-memory (HDFS-backed) provider
    # fits; "rocksdb" moves state off the JVM heap for very wide key spaces. The
    # provider and the number of state partitions are fixed by a checkpoint's first run.
    state_store: str | None = None
    state_partitions: int | None = None
    progress_root: str | None = None  # folder for progress records (R9)
    # A trade delivered again within the watermark delay is dropped by (symbol, trade_id).
    # Off by default: like the reference, a redelivered trade then counts again.
    drop_redelivered: bool = False
    indicators: bool = False  # the candle query keeps moving averages and VWAP as well
    symbols: tuple[str, ...] = ()  # those the throughput query reports on
    report_interval_s: int = REPORT_INTERVAL_S


def apply_state_settings(spark: SparkSession, cfg: "StreamConfig") -> None:
    """Session settings read when a stateful query starts on a new checkpoint."""
    if cfg.state_store:
        spark.conf.set("spark.sql.streaming.stateStore.providerClass", STATE_STORES[cfg.state_store])
        if cfg.state_store == "rocksdb":
            spark.conf.set("spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled", "true")
    if cfg.state_partitions:
        spark.conf.set("spark.sql.shuffle.partitions", str(cfg.state_partitions))


def _trigger(writer, cfg: StreamConfig):
    if cfg.available_now:
        return writer.trigger(availableNow=True)
    if cfg.processing_time:
        return writer.trigger(processingTime=cfg.processing_time)
    return writer


def candle_frames(raw_stream: DataFrame, cfg: StreamConfig) -> tuple[DataFrame, DataFrame]:
    """(candles, malformed) streaming frames from a raw ``value`` stream."""
    valid, malformed = split_trades(parse_trades(raw_stream))
    trades = valid.drop("raw_json").withWatermark("ts", cfg.watermark_delay)
    if cfg.drop_redelivered:
        trades = trades.dropDuplicatesWithinWatermark(["symbol", "trade_id"])
    return candles_of(trades, cfg.window_duration), malformed


def start_candles(raw_stream: DataFrame, cfg: StreamConfig, query_name: str | None = None) -> StreamingQuery:
    """Append-mode candle query with the insert-if-absent sink."""
    apply_state_settings(raw_stream.sparkSession, cfg)
    candles, _ = candle_frames(raw_stream, cfg)
    sinks = [candle_sink(cfg.table_root, cfg.threshold)]
    if cfg.indicators:
        step_s = int(pd.Timedelta(cfg.window_duration).total_seconds())
        sinks.append(indicator_sink(cfg.table_root, stored_candle_schema(), step_s))

    def write(batch_df: DataFrame, batch_id: int) -> None:
        for sink in sinks:
            sink(batch_df, batch_id)

    writer = (
        candles.writeStream.outputMode("append")
        .foreachBatch(write)
        .option("checkpointLocation", f"{cfg.checkpoint_root.rstrip('/')}/candles")
    )
    if query_name:
        writer = writer.queryName(query_name)
    return _trigger(writer, cfg).start()


def start_malformed(raw_stream: DataFrame, cfg: StreamConfig, query_name: str | None = None) -> StreamingQuery:
    """Stateless dead-letter query (K3/K4) on the same source."""
    _, malformed = candle_frames(raw_stream, cfg)
    writer = (
        malformed.writeStream.outputMode("append")
        .foreachBatch(dead_letter_sink(cfg.table_root))
        .option("checkpointLocation", f"{cfg.checkpoint_root.rstrip('/')}/malformed")
    )
    if query_name:
        writer = writer.queryName(query_name)
    return _trigger(writer, cfg).start()


def start_throughput(raw_stream: DataFrame, cfg: StreamConfig, query_name: str | None = None) -> StreamingQuery:
    """Trades per interval and configured symbol, written once an interval is closed (see :func:`throughput_sink`)."""
    apply_state_settings(raw_stream.sparkSession, cfg)
    valid, _ = split_trades(parse_trades(raw_stream))
    counts = interval_counts(valid.select("symbol", "ts").withWatermark("ts", cfg.watermark_delay), cfg.report_interval_s)
    writer = (counts.writeStream.outputMode("append")
              .foreachBatch(throughput_sink(cfg.table_root, list(cfg.symbols), cfg.report_interval_s))
              .option("checkpointLocation", f"{cfg.checkpoint_root.rstrip('/')}/throughput"))
    if query_name:
        writer = writer.queryName(query_name)
    return _trigger(writer, cfg).start()


def stored_throughput(spark: SparkSession, table_root: str) -> DataFrame:
    schema = StructType.fromDDL("window_start timestamp, symbol string, trades long, rate double, total_rate double")
    return read_table(spark, table_root, "throughput", schema, THROUGHPUT_JOB, dated=True).select(schema.names)


def stored_indicators(spark: SparkSession, table_root: str) -> DataFrame:
    schema = StructType.fromDDL("symbol string, window_start timestamp, close double, ma_fast double, ma_slow double, vwap double")
    return read_table(spark, table_root, "indicators", schema, INDICATOR_JOB, dated=True).select(schema.names)


def start_late(raw_stream: DataFrame, cfg: StreamConfig, query_name: str | None = None) -> StreamingQuery:
    """Stores the trades that come after their window was closed (see :func:`late_sink`).

    To be started with the candle query's source options and trigger, so that both cut their batches alike.
    """
    valid, _ = split_trades(parse_trades(raw_stream))
    writer = (valid.drop("raw_json").writeStream.outputMode("append")
              .foreachBatch(late_sink(cfg.table_root, cfg.window_duration, cfg.watermark_delay))
              .option("checkpointLocation", f"{cfg.checkpoint_root.rstrip('/')}/late"))
    if query_name:
        writer = writer.queryName(query_name)
    return _trigger(writer, cfg).start()


def stored_late_rows(spark: SparkSession, table_root: str) -> DataFrame:
    """Late trades, with the window they missed and the batch they came in."""
    return read_table(spark, table_root, "late_rows", LATE_SCHEMA, LATE_JOB).drop("query_id")


def run_both(raw_stream: DataFrame, cfg: StreamConfig, timeout_s: float | None = None) -> dict[str, StreamingQuery]:
    """Start both queries; with ``available_now`` wait until both finish (else call :func:`supervise`)."""
    spark = raw_stream.sparkSession
    listener = ProgressListener(spark, cfg.progress_root) if cfg.progress_root else None
    if listener:
        spark.streams.addListener(listener)
    queries = {"candles": start_candles(raw_stream, cfg)}
    try:
        queries["malformed"] = start_malformed(raw_stream, cfg)
    except BaseException:
        queries["candles"].stop()  # both or neither
        raise
    if cfg.available_now:
        try:
            supervise(queries, timeout_s)
        finally:
            if listener:
                listener.wait([str(q.runId) for q in queries.values()])
                spark.streams.removeListener(listener)
    return queries


def supervise(queries: dict[str, StreamingQuery], timeout_s: float | None = None, poll_s: float = 0.5) -> None:
    """Wait until all queries end. If one fails the others are stopped and its error is raised;
    if ``timeout_s`` runs out all are stopped and TimeoutError is raised. In continuous mode this is the main loop."""
    end = None if timeout_s is None else time.monotonic() + timeout_s
    try:
        while any(q.isActive for q in queries.values()):
            _raise_failure(queries)
            if end is not None and time.monotonic() > end:
                raise TimeoutError(f"still running after {timeout_s} s: {[n for n, q in queries.items() if q.isActive]}")
            time.sleep(poll_s)
        _raise_failure(queries)
    except BaseException:
        for q in queries.values():
            q.stop()
        raise


def _raise_failure(queries: dict[str, StreamingQuery]) -> None:
    for name, q in queries.items():
        if not q.isActive and q.exception() is not None:
            raise RuntimeError(f"stream {name} failed: {q.exception()}")


def stored_candles(spark: SparkSession, table_root: str) -> DataFrame:
    """The candle table as doubles (what the read side consumes)."""
    t = read_table(spark, table_root, "candles", stored_candle_schema(), CANDLE_JOB, dated=True)
    return t.select(
        "symbol", "window_start", "window_end",
        *[F.col(c).cast("double").alias(c) for c in ("open", "high", "low", "close", "volume")],
    )


def stored_alerts(spark: SparkSession, table_root: str) -> DataFrame:
    return read_table(spark, table_root, "alerts", ALERT_SCHEMA, CANDLE_JOB, dated=True)


def stored_rejects(spark: SparkSession, table_root: str) -> DataFrame:
    """Candles whose numbers do not fit the stored decimals, as computed."""
    return read_table(spark, table_root, "rejects", CANDLE_SCHEMA, CANDLE_JOB, dated=True)


def stored_rejected_alerts(spark: SparkSession, table_root: str) -> DataFrame:
    """Alerts of stored candles whose numbers do not fit the stored decimals, as computed."""
    schema = "symbol string, ts timestamp, price double, pct_change double, message string"
    return read_table(spark, table_root, "rejected_alerts", StructType.fromDDL(schema), CANDLE_JOB, dated=True)


def stored_dead_letters(spark: SparkSession, table_root: str) -> DataFrame:
    schema = StructType([StructField("key", StringType()), StructField("value", StringType())])
    return read_by_job(spark, table_root, "dead_letters", schema)


def stored_ticks(spark: SparkSession, table_root: str) -> DataFrame:
    """The tick buffer, with its ``date`` partition column for look-backs."""
    return read_table(spark, table_root, "ticks", TICK_SCHEMA, TICK_JOB, dated=True).drop("query_id", "batch_id")


def stored_metrics(spark: SparkSession, table_root: str) -> DataFrame:
    return read_by_job(spark, table_root, "metrics", METRICS_SCHEMA)


def candle_tables() -> dict[str, TableSpec]:
    """What the candle job writes, for compaction."""
    alerts = StructType.fromDDL("symbol string, ts timestamp, price double, pct_change double, message string")
    return {"candles": TableSpec(stored_candle_schema(), "window_start", tuple(CANDLE_KEYS)),
            "alerts": TableSpec(ALERT_SCHEMA, "ts", ("symbol", "ts")),
            "rejects": TableSpec(CANDLE_SCHEMA, "window_start"), "rejected_alerts": TableSpec(alerts, "ts")}


def compact_stream(spark: SparkSession, table_root: str) -> int | None:
    """K1/K2: one compaction round over the candle job's tables; to be run beside the stream, every hour or so."""
    return compact(spark, table_root, CANDLE_JOB, candle_tables())


def stored_candle_schema():
    """Candle columns with the stored decimal types."""
    return StructType([StructField(f.name, STORED_CANDLE_TYPES.get(f.name, f.dataType)) for f in CANDLE_SCHEMA.fields])


def write_ordered_input(df: DataFrame, path: str, files: int, ts_col: str, value_col: str = "value") -> list[str]:
    """Test/backfill input for the file source: ``files`` text files, each one
    contiguous event-time range, modification times ascending with the range.

    The file source takes files in modification-time order, so with
    ``maxFilesPerTrigger=1`` each micro-batch is one time range and no row is
    late. Returns the file paths in order. (Only file metadata is touched on the
    driver; the data is written by the tasks.)
    """
    spark = df.sparkSession
    before = set(list_parts(spark, path))
    df.repartitionByRange(files, F.col(ts_col)).select(F.col(value_col)).write.mode("append").text(path)
    return set_ordered_mtimes(spark, path, only_new=before)


def write_slots(df: DataFrame, path: str, slot_col: str = "slot", value_col: str = "value") -> None:
    """Test input in a given order: one text file a slot, below ``path/slot=<n>``, modification times in slot order."""
    spark = df.sparkSession
    (df.select(F.col(slot_col).cast("int").alias("slot"), F.col(value_col).alias("value")).repartition("slot")
     .write.partitionBy("slot").text(path))
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    now = int(time.time() * 1000) - 1_000_000
    for folder in fs.listStatus(p):
        name = folder.getPath().getName()
        for status in fs.listStatus(folder.getPath()) if name.startswith("slot=") else []:
            fs.setTimes(status.getPath(), now + 1000 * int(name[5:]), -1)


def list_parts(spark: SparkSession, path: str) -> list[str]:
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(p):
        return []
    return sorted(s.getPath().toString() for s in fs.listStatus(p) if s.getPath().getName().startswith("part-"))


def set_ordered_mtimes(spark: SparkSession, path: str, only_new: set[str] | None = None) -> list[str]:
    """Give the part files of ``path`` (those not in ``only_new`` when given)
    modification times one second apart, in name order, ending now."""
    import time

    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    names = sorted(
        s.getPath().toString() for s in fs.listStatus(p) if s.getPath().getName().startswith("part-")
    )
    if only_new is not None:
        names = [n for n in names if n not in only_new]
    base_ms = int(time.time() * 1000) - len(names) * 1000
    for i, name in enumerate(names):
        fs.setTimes(jvm.org.apache.hadoop.fs.Path(name), base_ms + i * 1000, -1)
    return names


def text_stream(spark: SparkSession, path: str, max_files_per_trigger: int | None = 1) -> DataFrame:
    return read_text_stream(spark, path, max_files_per_trigger)


def duplicates(df: DataFrame, keys=CANDLE_KEYS) -> int:
    """A8 after recovery: rows minus distinct keys (0 expected)."""
    row = df.agg((F.count(F.lit(1)) - F.count_distinct(F.struct(*keys))).alias("d")).first()
    return int(row["d"])
