"""Sinks (K1-K7): idempotent insert-if-absent tables on shared storage.

A micro-batch is known by its query's id, which lives in the checkpoint, and its
batch number: a retry keeps both, a new checkpoint gets a new id. Candles, alerts
and rejected rows go to ``<table>/date=<UTC day>/query_id=<id>/batch_id=<n>``, dead
letters and the metric ledger to ``<table>/query_id=<id>/batch_id=<n>``.

The commit of a batch is one marker file, made after all of its tables are written.
Readers and the insert-if-absent anti join see committed batches alone, so candles
and alerts appear together or not at all; what an attempt left behind is removed
before the next attempt of the batch and is never read. Batches of a query commit
in order, so one marker per query (the last number) is enough.
"""

from __future__ import annotations

import datetime as dt
import json
import uuid
from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, LongType, StringType, StructField, StructType

from barforge.functions.exprs import (
    parse_ts,
    strict_double,
    to_stored_pct,
    to_stored_price,
    to_stored_volume,
    trade_json,
)
from barforge.operators.alerts import derive_alerts
from barforge.schema import STORED_CANDLE_TYPES
from barforge.sources.trades import parse_trades, split_trades

CANDLE_KEYS = ["symbol", "window_start"]
ALERT_KEYS = ["symbol", "ts"]


# --- DataFrame-level semantics -------------------------------------------------


def dedupe_first(df: DataFrame, keys: list[str], order_col: str | None = None) -> DataFrame:
    """One row per key: the first by ``order_col`` when given (deterministic), else any."""
    if order_col is None:
        return df.dropDuplicates(keys)
    w = Window.partitionBy(*keys).orderBy(F.col(order_col).asc())
    return df.withColumn("_rn", F.row_number().over(w)).filter("_rn = 1").drop("_rn")


def insert_if_absent(target: DataFrame, incoming: DataFrame, keys: list[str], order_col: str | None = None,
                     assume_unique: bool = False) -> DataFrame:
    """K1 as a relation: ``target`` plus incoming rows whose key is not yet present.

    ``assume_unique`` skips the de-duplication (and its shuffle) for input that is
    unique per key by construction, e.g. the output of a group-by on the keys.
    """
    rows = incoming if assume_unique else dedupe_first(incoming, keys, order_col)
    new_rows = rows.join(target.select(*keys), keys, "left_anti")
    return target.unionByName(new_rows.select(*target.columns))


# --- storage helpers ---------------------------------------------------------------


def _fs_path(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """A small file of the driver's own, on whatever store the path names."""
    p, fs = _fs_path(spark, path)
    out = fs.create(p, True)
    out.write(bytearray(text.encode()))
    out.close()


def table_stamp(spark: SparkSession, path: str) -> tuple:
    """(modification time, length) of a table's files: changes when the table is written again."""
    p, fs = _fs_path(spark, path)
    files = fs.listStatus(p) if fs.exists(p) else []
    return tuple(sorted((s.getPath().getName(), s.getModificationTime(), s.getLen()) for s in files))


def path_exists(spark: SparkSession, path: str) -> bool:
    p, fs = _fs_path(spark, path)
    return bool(fs.exists(p))


def _batch_fields(dated: bool) -> list[StructField]:
    return ([StructField("date", DateType())] if dated else []) + [
        StructField("query_id", StringType()), StructField("batch_id", LongType())]


def query_id_of(spark: SparkSession) -> str:
    """Id of the streaming query whose batch function runs now; "manual" outside of one."""
    return spark.sparkContext.getLocalProperty("sql.streaming.queryId") or "manual"


def write_once(spark: SparkSession, path: str, text: str) -> bool:
    """A file that is there with its whole text or not at all; False if another writer was first."""
    p, fs = _fs_path(spark, path)
    part, _ = _fs_path(spark, f"{p.getParent()}/.{p.getName()}-{uuid.uuid4().hex}")
    write_text(spark, part.toString(), text)
    if fs.exists(p) or not fs.rename(part, p):
        fs.delete(part, False)
        return False
    return True


def read_text(spark: SparkSession, path: str) -> str:
    p, fs = _fs_path(spark, path)
    source = fs.open(p)
    try:
        return bytes(spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toByteArray(source)).decode()
    finally:
        source.close()


def mark_committed(spark: SparkSession, root: str, job: str, query_id: str, batch_id: int, note: dict | None = None) -> None:
    """Commit a batch: make its marker, with a note for the next batches, then drop the query's older ones."""
    folder, fs = _fs_path(spark, f"{root}/_commits/{job}/query_id={query_id}")
    write_once(spark, f"{root}/_commits/{job}/query_id={query_id}/{int(batch_id)}", json.dumps(note or {}))
    for status in fs.listStatus(folder):
        name = status.getPath().getName()
        if name.isdigit() and int(name) < batch_id:
            fs.delete(status.getPath(), False)


def commit_notes(spark: SparkSession, root: str, job: str) -> dict[str, dict]:
    """The note of each query's last commit."""
    return {query: json.loads(read_text(spark, f"{root}/_commits/{job}/query_id={query}/{last}") or "{}")
            for query, last in committed(spark, root, job).items()}


def committed(spark: SparkSession, root: str, job: str) -> dict[str, int]:
    """Last committed batch of each query (one entry per checkpoint ever used)."""
    folder, fs = _fs_path(spark, f"{root}/_commits/{job}")
    out = {}
    for query in fs.listStatus(folder) if fs.exists(folder) else []:
        names = [s.getPath().getName() for s in fs.listStatus(query.getPath())]
        numbers = [int(n) for n in names if n.isdigit()]
        if numbers:
            out[query.getPath().getName().split("=", 1)[1]] = max(numbers)
    return out


def up_to(last: dict[str, int]) -> Column:
    """Filter on the partition columns: batches up to the given one of each query."""
    keep = F.lit(False)
    for query_id, number in last.items():
        keep = keep | ((F.col("query_id") == query_id) & (F.col("batch_id") <= number))
    return keep


def is_committed(spark: SparkSession, root: str, job: str) -> Column:
    """Filter on the partition columns that keeps committed batches."""
    return up_to(committed(spark, root, job))


def latest_compaction(spark: SparkSession, root: str, job: str) -> dict:
    """The newest switch of a job's readers to compacted files (see :mod:`barforge.operators.compaction`)."""
    folder, fs = _fs_path(spark, f"{root}/_compactions/{job}")
    numbers = [int(s.getPath().getName()) for s in (fs.listStatus(folder) if fs.exists(folder) else [])
               if s.getPath().getName().isdigit()]
    if not numbers:
        return {"number": 0, "tables": {}}
    return json.loads(read_text(spark, f"{root}/_compactions/{job}/{max(numbers)}"))


def compacted_rows(spark: SparkSession, root: str, table: str, schema: StructType, hours: dict[str, list]) -> DataFrame:
    """Rows of the given hours ("<date>/<hour>" -> [generation, rows]) of a table's compacted files."""
    full = StructType(list(schema.fields) + _batch_fields(True))
    if not hours:
        return spark.createDataFrame([], full)
    base = f"{root}/{table}_compact"
    folders = [f"{base}/date={k.split('/')[0]}/hour={k.split('/')[1]}/gen={gen}" for k, (gen, _) in sorted(hours.items())]
    typed = StructType(list(full.fields) + [StructField("hour", LongType()), StructField("gen", StringType())])
    return spark.read.schema(typed).option("basePath", base).parquet(*folders).select(full.names)


def batch_rows(spark: SparkSession, root: str, table: str, schema: StructType, dated: bool, keep: Column,
               days: list | None = None) -> DataFrame:
    """Rows of the batch folders that ``keep`` (on the partition columns) accepts; with ``days`` only theirs are listed."""
    path = f"{root}/{table}"
    full = StructType(list(schema.fields) + _batch_fields(dated))
    folders = [path] if days is None else [f"{path}/date={d.isoformat()}" for d in days]
    folders = [f for f in folders if path_exists(spark, f)]
    if not folders:
        return spark.createDataFrame([], full)
    return spark.read.schema(full).option("basePath", path).parquet(*folders).filter(keep)


def read_table(spark: SparkSession, root: str, table: str, schema: StructType, job: str, dated: bool = False,
               days: list | None = None) -> DataFrame:
    """Committed rows of a batch-keyed table (empty when absent); with ``days`` only their folders are listed.

    Hours that were compacted come from their compacted files, later batches from their own folders.
    """
    root = root.rstrip("/")
    keep = is_committed(spark, root, job)
    switch = latest_compaction(spark, root, job)["tables"].get(table) if dated else None
    if not switch:
        return batch_rows(spark, root, table, schema, dated, keep, days)
    rows = batch_rows(spark, root, table, schema, dated, keep & ~up_to(switch["upto"]), days)
    hours = switch["hours"]
    if days is not None:
        wanted = {d.isoformat() for d in days}
        hours = {k: v for k, v in hours.items() if k.split("/")[0] in wanted}
    return rows.unionByName(compacted_rows(spark, root, table, schema, hours))


def write_batch(df: DataFrame, path: str, query_id: str, batch_id: int) -> None:
    """Overwrite exactly one batch's folder."""
    df.write.mode("overwrite").parquet(f"{path}/query_id={query_id}/batch_id={int(batch_id)}")


ROWS_PER_FILE = 1_000_000


def write_dated_batch(df: DataFrame, path: str, query_id: str, batch_id: int, time_col: str, rows: int) -> None:
    """Add ``date=<day of time_col>/query_id=<id>/batch_id=<n>`` folders, in (symbol, time) order.

    A day's rows are spread by (symbol, hour) over as many tasks and files as ``rows``, the batch's number of rows, asks for.
    """
    parts = ["date", "query_id", "batch_id"]
    keyed = (df.withColumn("date", F.to_date(time_col)).withColumn("query_id", F.lit(query_id))
             .withColumn("batch_id", F.lit(int(batch_id)).cast("long")))
    files = -(-rows // ROWS_PER_FILE)
    spread = F.pmod(F.xxhash64("symbol", F.hour(time_col)), F.lit(files))
    # a given number of partitions is not merged again, the other form is
    placed = keyed.repartition(4 * files, "date", spread) if files > 1 else keyed.repartition("date")
    placed.sortWithinPartitions(*parts, "symbol", time_col).write.mode("append").partitionBy(*parts).parquet(path)


def remove_attempt(spark: SparkSession, root: str, tables: list[str], query_id: str, batch_id: int) -> None:
    """Delete what an attempt that did not commit left of a batch; without one nothing is listed.

    The first thing an attempt does is to leave a note of itself; a note that is
    there already means that an earlier attempt stopped half-way.
    """
    note, fs = _fs_path(spark, f"{root}/_attempts/query_id={query_id}/{int(batch_id)}")
    if fs.exists(note):
        for table in tables:
            pattern, _ = _fs_path(spark, f"{root}/{table}/date=*/query_id={query_id}/batch_id={int(batch_id)}")
            for status in fs.globStatus(pattern) or []:
                fs.delete(status.getPath(), True)
    fs.create(note, True).close()


def forget_attempt(spark: SparkSession, root: str, query_id: str, batch_id: int) -> None:
    note, fs = _fs_path(spark, f"{root}/_attempts/query_id={query_id}/{int(batch_id)}")
    fs.delete(note, False)


def to_stored_candles(candles: DataFrame) -> DataFrame:
    """candle doubles -> DECIMAL(20,8) / DECIMAL(30,8) (half-up, NULL on overflow)."""
    cols = []
    for f in candles.columns:
        if f in STORED_CANDLE_TYPES:
            conv = to_stored_volume if f == "volume" else to_stored_price
            cols.append(conv(f).alias(f))
        else:
            cols.append(F.col(f))
    return candles.select(*cols)


def to_stored_alerts(alerts: DataFrame) -> DataFrame:
    return alerts.select(
        "symbol", "ts", to_stored_price("price").alias("price"), to_stored_pct("pct_change").alias("pct_change"), "message"
    )


def fits_stored(columns: list[str]) -> Column:
    """No value became NULL by the conversion to stored decimals (overflow and NaN do)."""
    fits = F.lit(True)
    for c in columns:
        fits = fits & F.col(c).isNotNull()
    return fits


# --- foreachBatch sink factories ----------------------------------------------------

CANDLE_JOB, MALFORMED_JOB, TICK_JOB, LATE_JOB = "candles", "malformed", "ticks", "late"
DATED = ["candles", "alerts", "rejects", "rejected_alerts"]
STORED_NUMBERS = ["open", "high", "low", "close", "volume"]
ALERT_NUMBERS = ["price", "pct_change"]


#: A candle's key lies in the first, an alert's in the second.
SPAN_COLUMNS = ["window_start", "window_end"]


def spans_of(candles: DataFrame) -> dict[str, dict[str, list[int]]]:
    """Per column: day -> [least, greatest] time of its rows in microseconds; at most one entry per day of a batch."""
    pairs = F.explode(F.array(*[F.struct(F.lit(c).alias("c"), F.col(c).alias("t")) for c in SPAN_COLUMNS]))
    found = (candles.select(pairs.alias("p")).groupBy("p.c", F.to_date("p.t").cast("string").alias("day"))
             .agg(F.min(F.unix_micros("p.t")).alias("low"), F.max(F.unix_micros("p.t")).alias("high")))
    out: dict[str, dict[str, list[int]]] = {c: {} for c in SPAN_COLUMNS}
    for r in found.collect():
        out[r.c][r.day] = [r.low, r.high]
    return out


def overlaps(spans: dict[str, list[int]], stored: dict[str, list[int]] | None) -> bool:
    """Can a stored row have a time in ``spans``? Unknown spans can."""
    if stored is None:
        return True
    return any(d in stored and low <= stored[d][1] and high >= stored[d][0] for d, (low, high) in spans.items())


def joined(stored: dict[str, list[int]] | None, spans: dict[str, list[int]]) -> dict[str, list[int]]:
    out = dict(stored or {})
    for day, (low, high) in spans.items():
        had = out.get(day, [low, high])
        out[day] = [min(low, had[0]), max(high, had[1])]
    return out


def candle_sink(table_root: str, threshold: float, query_id: str | None = None) -> Callable[[DataFrame, int], None]:
    """K1 + K2: insert-if-absent candles and the alerts of the inserted ones, in one commit.

    Candles whose numbers do not fit the stored decimals go to the ``rejects`` table,
    alerts whose numbers do not to ``rejected_alerts``, both as computed.
    Alerts are unique by (symbol, ts): the first stored one stays.

    A commit notes the span of window times stored so far per day. A stream closes its
    windows in order, so its next batch lies beyond that span: nothing stored is read then,
    however much the day holds. Only a batch that overlaps a span (a replay, another
    checkpoint) is compared with the stored keys of its days and times.

    One query owns a table at a time: two that run at once on overlapping windows can both
    insert a key, as each sees the other's commits only at its start; compaction keeps one row.
    """
    root = table_root.rstrip("/")

    def write(batch_df: DataFrame, batch_id: int) -> None:
        spark = batch_df.sparkSession
        query = query_id or query_id_of(spark)
        if committed(spark, root, CANDLE_JOB).get(query, -1) >= batch_id:
            # a retry after the commit: the query's state still has to advance with the batch
            batch_df.write.format("noop").mode("overwrite").save()
            return
        remove_attempt(spark, root, DATED, query, batch_id)
        batch_df = batch_df.persist()
        spans = spans_of(batch_df)
        days = sorted(dt.date.fromisoformat(d) for d in {d for per_day in spans.values() for d in per_day})
        notes = commit_notes(spark, root, CANDLE_JOB)
        repeats = {c: any(overlaps(spans[c], note.get(c)) for note in notes.values()) for c in SPAN_COLUMNS}
        # candles of one micro-batch are unique per key (they come from a group-by on it);
        # each row carries its numbers as computed beside those to be stored
        computed = [F.col(c).alias(f"_{c}") for c in STORED_NUMBERS]
        new = to_stored_candles(batch_df.select("*", *computed))
        if repeats["window_start"]:
            have = read_table(spark, root, "candles", to_stored_candles(batch_df).schema, CANDLE_JOB, True, days)
            low, high = (F.timestamp_micros(F.lit(f(s[k] for s in spans["window_start"].values()))) for f, k in ((min, 0), (max, 1)))
            new = new.join(have.filter(F.col("window_start").between(low, high)).select(*CANDLE_KEYS), CANDLE_KEYS, "left_anti")
        new = new.persist()
        fits = fits_stored(STORED_NUMBERS)
        as_computed = [F.col(f"_{c}").alias(c) if c in STORED_NUMBERS else F.col(c) for c in batch_df.columns]
        good, bad = new.agg(F.count_if(fits), F.count_if(~fits)).first()
        if good:
            write_dated_batch(new.filter(fits).select(batch_df.columns), f"{root}/candles", query, batch_id, "window_start", good)
            found = derive_alerts(new.filter(fits).select(as_computed), threshold)
            storable = fits_stored(ALERT_NUMBERS)
            alerts = dedupe_first(to_stored_alerts(found).filter(storable), ALERT_KEYS, "message")
            if repeats["window_end"]:
                known = read_table(spark, root, "alerts", alerts.schema, CANDLE_JOB, True, days).select(*ALERT_KEYS)
                alerts = alerts.join(known, ALERT_KEYS, "left_anti")
            write_dated_batch(alerts, f"{root}/alerts", query, batch_id, "ts", good)
            lost = found.filter(to_stored_price("price").isNull() | to_stored_pct("pct_change").isNull())
            if not lost.isEmpty():
                write_dated_batch(lost, f"{root}/rejected_alerts", query, batch_id, "ts", good)
        if bad:
            write_dated_batch(new.filter(~fits).select(as_computed), f"{root}/rejects", query, batch_id, "window_start", bad)
        note = {c: joined(notes.get(query, {}).get(c), spans[c]) for c in SPAN_COLUMNS}
        note["days"] = sorted(spans["window_start"])  # the folders of this very batch
        mark_committed(spark, root, CANDLE_JOB, query, batch_id, note)
        forget_attempt(spark, root, query, batch_id)
        for df in (new, batch_df):
            df.unpersist()

    return write


def dead_letter_sink(table_root: str, metric: str = "malformed_dropped",
                     kafka_options: dict | None = None, query_id: str | None = None) -> Callable[[DataFrame, int], None]:
    """K3 + K4: dead letters (original payload, NULL key) and one ledger row per
    batch and metric, in one commit, so a replayed batch is counted once.

    With ``kafka_options`` (bootstrap servers, ``topic``) the dead letters are also
    published to a dead-letter topic (needs the connector). A topic append is not
    idempotent: a replayed batch publishes its letters again, while the batch-keyed
    table stays exact.
    """
    root = table_root.rstrip("/")

    def write(batch_df: DataFrame, batch_id: int) -> None:
        spark = batch_df.sparkSession
        query = query_id or query_id_of(spark)
        job = f"{MALFORMED_JOB}-{metric}"
        if committed(spark, root, job).get(query, -1) >= batch_id:
            return
        dead = batch_df.select(F.lit(None).cast("string").alias("key"), F.col("raw_json").alias("value")).persist()
        count = dead.count()
        if count:  # like the reference, nothing is written for a clean batch
            write_batch(dead, f"{root}/dead_letters/{job}", query, batch_id)
            if kafka_options:
                w = dead.write.format("kafka")
                for k, v in kafka_options.items():
                    w = w.option(k, v)
                w.save()
            ledger = spark.range(1).select(
                F.lit(metric).alias("metric"), F.lit(count).cast("long").alias("value"),
                F.current_timestamp().alias("updated_at"),
            )
            write_batch(ledger.coalesce(1), f"{root}/metrics/{job}", query, batch_id)
        mark_committed(spark, root, job, query, batch_id)
        dead.unpersist()

    return write


def read_by_job(spark: SparkSession, root: str, table: str, schema: StructType) -> DataFrame:
    """Committed rows of a table that each malformed-type job keeps in a folder of its own."""
    folder, fs = _fs_path(spark, f"{root.rstrip('/')}/{table}")
    out = spark.createDataFrame([], StructType(list(schema.fields) + _batch_fields(False)))
    for status in fs.listStatus(folder) if fs.exists(folder) else []:
        job = status.getPath().getName()
        out = out.unionByName(read_table(spark, root, f"{table}/{job}", schema, job))
    return out


def publish_keyed(df: DataFrame, key_col: str = "symbol", kafka_options: dict | None = None,
                  path: str | None = None, partitions: int | None = None, order_col: str = "ts",
                  bucket: str = "1 hour") -> None:
    """K5: publish ``(key, value=to_json(row))``.

    To Kafka when options are given (needs the connector; rows of one key come from
    several tasks, so consumers order by the row's time). To files otherwise: the folder is
    overwritten, so a retry leaves no copies; hash-partitioned on
    ``(key, time bucket of order_col)`` and sorted by ``(key, order_col)`` within
    files, so per-key order holds inside every bucket and a hot key is spread over
    its buckets instead of landing in one task (no sampling pass over the input).
    Rows without a time are published too, in a bucket of their own.
    """
    bucket_us = int(pd.Timedelta(bucket).total_seconds() * 1_000_000)
    out = df.select(
        F.col(key_col).cast("string").alias("key"),
        trade_json(*df.columns).alias("value"),
        F.col(order_col).alias("_order"),
        F.floor(F.unix_micros(F.col(order_col).cast("timestamp")) / F.lit(bucket_us)).alias("_bucket"),
    )
    if kafka_options:
        w = out.select("key", "value").write.format("kafka")
        for k, v in kafka_options.items():
            w = w.option(k, v)
        w.save()
        return
    if path is None:
        raise ValueError("either kafka_options or path is needed")
    keys = [F.col("key"), F.col("_bucket")]
    parts = out.repartition(partitions, *keys) if partitions else out.repartition(*keys)
    parts.sortWithinPartitions("key", "_order").select("key", "value").write.mode("overwrite").parquet(path)


def tick_sink(table_root: str, query_id: str | None = None, keep_minutes: int | None = None) -> Callable[[DataFrame, int], None]:
    """K6: the tick samples of a batch, committed once: a retry of the batch leaves no copies.

    With ``keep_minutes`` (P10 in storage) ticks older than that, counted back from the
    newest tick stored, are not written, and batches that hold none younger are dropped
    with the commit: what stays is at most one batch's span older than the limit.
    """
    root = table_root.rstrip("/")

    def write(batch_df: DataFrame, batch_id: int) -> None:
        spark = batch_df.sparkSession
        query = query_id or query_id_of(spark)
        if committed(spark, root, TICK_JOB).get(query, -1) >= batch_id:
            batch_df.write.format("noop").mode("overwrite").save()
            return
        remove_attempt(spark, root, ["ticks"], query, batch_id)
        batch_df = batch_df.persist()
        rows, newest = batch_df.agg(F.count("*"), F.max(F.unix_micros("ts"))).first()
        held = commit_notes(spark, root, TICK_JOB).get(query, {}).get("newest", {})  # batch -> its newest tick
        gone: list[str] = []
        if rows:
            held = held | {str(batch_id): newest}
            if keep_minutes is not None:
                limit = max(v for v in held.values() if v is not None) - keep_minutes * 60_000_000
                batch_df = batch_df.filter(F.unix_micros("ts") >= limit)
                gone = [b for b, t in held.items() if t is None or t < limit]
                held = {b: t for b, t in held.items() if b not in gone}
            write_dated_batch(batch_df, f"{root}/ticks", query, batch_id, "ts", rows)
        mark_committed(spark, root, TICK_JOB, query, batch_id, {"newest": held if keep_minutes is not None else {}})
        for old in gone:
            pattern, fs = _fs_path(spark, f"{root}/ticks/date=*/query_id={query}/batch_id={old}")
            for status in fs.globStatus(pattern) or []:
                fs.delete(status.getPath(), True)
        forget_attempt(spark, root, query, batch_id)
        batch_df.unpersist()

    return write


def late_sink(table_root: str, width: str, delay: str, query_id: str | None = None) -> Callable[[DataFrame, int], None]:
    """The trades of a batch whose window an earlier batch has closed, with the watermark that closed it.

    The rule is the stream's own: a batch closes the windows that end by the newest time of
    all batches before it minus ``delay``, to the millisecond; a trade of the very batch that
    closes its window still counts, a later one is late. The newest times are kept in the
    commit note, so a restart goes on from there. Where the candle query runs a batch without
    data (nothing came for a while), it closes windows one batch earlier than is assumed here.
    """
    root = table_root.rstrip("/")
    delay_us = int(pd.Timedelta(delay).total_seconds() * 1_000_000)

    def write(batch_df: DataFrame, batch_id: int) -> None:
        spark = batch_df.sparkSession
        query = query_id or query_id_of(spark)
        if committed(spark, root, LATE_JOB).get(query, -1) >= batch_id:
            return
        note = commit_notes(spark, root, LATE_JOB).get(query, {})
        seen = note.get("closing")  # newest time of all batches but the last one
        trades = batch_df.persist()
        newest = trades.agg(F.max(F.unix_micros("ts"))).first()[0]
        if seen is not None:
            watermark = (seen - delay_us) // 1000 * 1000
            placed = trades.filter("ts is not null").withColumn("w", F.window("ts", width))
            late = placed.filter(F.unix_micros("w.end") <= watermark).select(
                "symbol", "price", "size", "side", "trade_id", "ts", F.col("w.start").alias("window_start"),
                F.col("w.end").alias("window_end"), F.timestamp_micros(F.lit(watermark)).alias("watermark"))
            write_batch(late, f"{root}/late_rows", query, batch_id)
        known = [t for t in (note.get("newest"), newest) if t is not None]
        mark_committed(spark, root, LATE_JOB, query, batch_id, {"closing": note.get("newest"), "newest": max(known, default=None)})
        trades.unpersist()

    return write


def expire_partitions(spark: SparkSession, path: str, keep_from_date: str) -> list[str]:
    """K6/P10 retention at the table level: drop ``date=`` partitions older than
    ``keep_from_date`` (YYYY-MM-DD). Only directory names are listed, no data read."""
    p, fs = _fs_path(spark, path)
    if not fs.exists(p):
        return []
    dropped = []
    for status in fs.listStatus(p):
        name = status.getPath().getName()
        if status.isDirectory() and name.startswith("date=") and name[5:] < keep_from_date:
            fs.delete(status.getPath(), True)
            dropped.append(name)
    return dropped


def lenient_trade_repair(dead: DataFrame) -> DataFrame:
    """A repair for dead-letter replay: numbers sent as quoted strings are accepted."""
    lenient = "symbol string, price string, size string, side string, trade_id string, ts string"
    d = dead.select(F.col("value").alias("raw_json"), F.from_json("value", lenient).alias("d"))
    return d.select(
        "raw_json",
        F.col("d.symbol").alias("symbol"),
        strict_double(F.col("d.price")).alias("price"),
        strict_double(F.col("d.size")).alias("size"),
        F.col("d.side").alias("side"),
        F.col("d.trade_id").try_cast("long").alias("trade_id"),
        parse_ts(F.col("d.ts")).alias("ts"),
    )


def replay_dead_letters(dead: DataFrame, repair: Callable[[DataFrame], DataFrame] | None = None) -> tuple[DataFrame, DataFrame]:
    """K7: re-parse stored dead letters; return (recovered valid trades, still malformed).

    Without ``repair`` the standard parser is used (recovers nothing unless the
    parser changed); recovered rows are unioned into the trade input by the caller.
    """
    parsed = repair(dead) if repair else parse_trades(dead, value_col="value")
    return split_trades(parsed)
