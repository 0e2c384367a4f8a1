"""Compaction of batch-keyed tables (K1, K2, K6): few sorted files instead of a folder per batch.

A round rewrites the committed batches since the last round, hour by hour, into
``<table>_compact/date=<day>/hour=<h>/gen=<generation>`` and then switches all readers
with one marker file, ``_compactions/<job>/<number>``, which names the generation of each
hour and the last batch of each query that these files hold. Until the marker is there
readers take the batches, afterwards the files; they never see both or neither. An hour
that gets more rows later is rewritten together with what it had.

What a marker made superfluous (batch folders, older generations) is deleted at the start
of the next round, so a reader that had planned before the switch has a round's time to
end. A round that stopped before its marker left only files that nobody reads; the next
round deletes them. One job compacts a table at a time; of two at once the one whose
marker is second fails and changes nothing.

Where two queries inserted the same key at once, the compacted row stays, else the one of
the lowest batch number (then query id): the first writer.

Files of an hour: rows / ``rows_per_file``, spread by symbol and sorted by (symbol, time).
A stream with rounds every hour thus has 24 folders a day and table plus the batches of two rounds.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from barforge.operators.sinks import (
    ROWS_PER_FILE,
    _fs_path,
    batch_rows,
    committed,
    compacted_rows,
    latest_compaction,
    path_exists,
    read_text,
    up_to,
    write_once,
    write_text,
)


@dataclass(frozen=True)
class TableSpec:
    """What compaction has to know about a table; without ``keys`` all rows are kept."""

    schema: StructType
    time_col: str
    keys: tuple[str, ...] = ()


def compact(spark: SparkSession, table_root: str, job: str, tables: dict[str, TableSpec], rows_per_file: int = ROWS_PER_FILE) -> int | None:
    """One round over all tables of a job; the number of its marker, or None if no batch was committed since the last."""
    root = table_root.rstrip("/")
    old = latest_compaction(spark, root, job)
    clean_up(spark, root, job, list(tables), old)
    upto = committed(spark, root, job)
    if all(old["tables"].get(t, {}).get("upto", {}) == upto for t in tables):
        return None
    number = old["number"] + 1
    gen = f"{number}-{uuid.uuid4().hex[:8]}"
    write_text(spark, f"{root}/_compactions/{job}/attempts/{gen}", "")
    now = dict(old["tables"])
    for table, spec in tables.items():
        had = now.get(table, {"upto": {}, "hours": {}})
        now[table] = {"upto": upto, "hours": had["hours"] | _rewrite(spark, root, table, spec, had, upto, gen, rows_per_file)}
    if not write_once(spark, f"{root}/_compactions/{job}/{number}", json.dumps({"number": number, "tables": now})):
        raise RuntimeError(f"another compaction of {job} was first")
    _delete(spark, f"{root}/_compactions/{job}/attempts/{gen}")
    return number


def _rewrite(spark: SparkSession, root: str, table: str, spec: TableSpec, had: dict, upto: dict, gen: str, rows_per_file: int) -> dict:
    """Write the hours that batches since the last round touched; hour -> [generation, rows]."""
    fresh = batch_rows(spark, root, table, spec.schema, True, up_to(upto) & ~up_to(had["upto"]))
    counts = fresh.groupBy(F.col("date").cast("string").alias("day"), F.hour(spec.time_col).alias("hour")).count().collect()
    if not counts:
        return {}
    hours = had["hours"]
    touched = {f"{r.day}/{r.hour}": r["count"] + hours.get(f"{r.day}/{r.hour}", ["", 0])[1] for r in counts}
    kept = compacted_rows(spark, root, table, spec.schema, {k: v for k, v in hours.items() if k in touched})
    rows = first_writer(kept.withColumn("_new", F.lit(False)).unionByName(fresh.withColumn("_new", F.lit(True))), spec)
    files = -(-max(touched.values()) // rows_per_file)
    placed = rows.withColumns({"hour": F.hour(spec.time_col), "gen": F.lit(gen)})
    spread = F.pmod(F.xxhash64("symbol", F.minute(spec.time_col)), F.lit(files))
    placed = placed.repartition(4 * files, "date", "hour", spread) if files > 1 else placed.repartition("date", "hour")
    (placed.sortWithinPartitions("date", "hour", "symbol", spec.time_col)
     .write.mode("append").partitionBy("date", "hour", "gen").parquet(f"{root}/{table}_compact"))
    return {k: [gen, n] for k, n in touched.items()}


def first_writer(rows: DataFrame, spec: TableSpec) -> DataFrame:
    """One row per key: compacted before new, then by batch number and query."""
    if not spec.keys:
        return rows.drop("_new")
    order = Window.partitionBy(*spec.keys).orderBy("_new", "batch_id", "query_id")
    return rows.withColumn("_rn", F.row_number().over(order)).filter("_rn = 1").drop("_rn", "_new")


def clean_up(spark: SparkSession, root: str, job: str, tables: list[str], current: dict) -> None:
    """Delete what the current marker replaced and what rounds without a marker left."""
    attempts, fs = _fs_path(spark, f"{root}/_compactions/{job}/attempts")
    live = {gen for of_table in current["tables"].values() for gen, _ in of_table["hours"].values()}
    for status in fs.listStatus(attempts) if fs.exists(attempts) else []:
        gen = status.getPath().getName()
        for table in tables if gen not in live else []:
            _delete(spark, f"{root}/{table}_compact/date=*/hour=*/gen={gen}")
        fs.delete(status.getPath(), False)
    before = _marker(spark, root, job, current["number"] - 1)
    for table in tables:
        now = current["tables"].get(table, {"upto": {}, "hours": {}})
        pattern, _ = _fs_path(spark, f"{root}/{table}/date=*/query_id=*/batch_id=*")
        for status in fs.globStatus(pattern) or []:
            batch, query = status.getPath().getName(), status.getPath().getParent().getName()
            if int(batch.split("=")[1]) <= now["upto"].get(query.split("=", 1)[1], -1):
                fs.delete(status.getPath(), True)
        for key, (gen, _) in before["tables"].get(table, {"hours": {}})["hours"].items():
            if now["hours"].get(key, [None])[0] != gen:
                day, hour = key.split("/")
                _delete(spark, f"{root}/{table}_compact/date={day}/hour={hour}/gen={gen}")
    _delete(spark, f"{root}/_compactions/{job}/{current['number'] - 2}")


def _marker(spark: SparkSession, root: str, job: str, number: int) -> dict:
    path = f"{root}/_compactions/{job}/{number}"
    return json.loads(read_text(spark, path)) if path_exists(spark, path) else {"tables": {}}


def _delete(spark: SparkSession, pattern: str) -> None:
    p, fs = _fs_path(spark, pattern)
    for status in fs.globStatus(p) or []:
        fs.delete(status.getPath(), True)
