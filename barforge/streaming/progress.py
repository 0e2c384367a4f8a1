"""Streaming progress as data.

A listener writes each micro-batch's ``StreamingQueryProgress`` as a JSON line to
files below a shared folder, so nothing is lost when Spark drops old records from
``query.recentProgress``. Read back, each becomes one row: query label, batch id,
input rows, input and processed rates, trigger duration, watermark and late rows
dropped; the analytics over them run as DataFrame aggregations.
"""

from __future__ import annotations

import json
import threading

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener

from barforge.functions.exprs import clean_number
from barforge.operators.sinks import write_text

# Fixed: the progress fields kept, as (JSON path, output column).
PROGRESS_FIELDS = [
    ("$.batchId", "batch_id"),
    ("$.numInputRows", "input_rows"),
    ("$.inputRowsPerSecond", "input_rate"),
    ("$.processedRowsPerSecond", "processed_rate"),
    ("$.durationMs.triggerExecution", "trigger_ms"),
    ("$.eventTime.watermark", "watermark"),
    ("$.timestamp", "progress_ts"),
]


def _as_json(p) -> str:
    text = getattr(p, "json", None)
    if isinstance(text, str):
        return text
    return json.dumps(p, default=str)


class ProgressListener(StreamingQueryListener):
    """Appends progress records below ``folder``, ``every`` of them to a file.

    A file's name holds the query's run and the first batch in it. What is not yet
    written when the driver is lost is at most ``every`` - 1 records of each query.
    """

    def __init__(self, spark: SparkSession, folder: str, every: int = 12):
        self.spark, self.folder, self.every = spark, folder.rstrip("/"), every
        self.held: dict[str, list[tuple[int, str]]] = {}
        self.ended: set[str] = set()
        self.changed = threading.Condition()

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        run = str(event.progress.runId)
        with self.changed:
            self.held.setdefault(run, []).append((event.progress.batchId, _as_json(event.progress)))
            if len(self.held[run]) >= self.every:
                self._write(run)

    def onQueryTerminated(self, event) -> None:
        with self.changed:
            self._write(str(event.runId))
            self.ended.add(str(event.runId))
            self.changed.notify_all()

    def _write(self, run: str) -> None:
        if records := self.held.pop(run, []):
            write_text(self.spark, f"{self.folder}/{run}-{records[0][0]}.json", "\n".join(text for _, text in records) + "\n")

    def wait(self, runs: list[str], timeout_s: float = 60) -> None:
        """Until all records of runs that have ended are written; the end is the last event of a run."""
        with self.changed:
            if not self.changed.wait_for(lambda: self.ended.issuperset(runs), timeout_s):
                raise TimeoutError(f"no end reported for {sorted(set(runs) - self.ended)}")


def last_progress(spark: SparkSession, names: dict | None = None) -> list[tuple[str, str]]:
    """Poll form: the latest progress of each active query (``names``: id -> label)."""
    names = names or {}
    out = []
    for q in spark.streams.active:
        p = q.lastProgress
        if p:
            out.append((names.get(q.id, "query"), _as_json(p)))
    return out


def stored_progress(spark: SparkSession, folder: str, labels: dict[str, str]) -> DataFrame:
    """What a :class:`ProgressListener` wrote, as typed rows; ``labels``: query id -> label."""
    names = F.create_map(*[F.lit(x) for pair in labels.items() for x in pair])
    lines = spark.read.text(folder)
    return progress_rows(lines.select(names[F.get_json_object("value", "$.id")].alias("query"), F.col("value").alias("progress")))


def progress_frame(spark: SparkSession, records: list[tuple[str, str]]) -> DataFrame:
    """(label, progress JSON) records as typed rows."""
    return progress_rows(spark.createDataFrame(records, "query string, progress string"))


def progress_rows(raw: DataFrame) -> DataFrame:
    """Progress JSON -> typed rows; NULL/NaN/unparseable numbers become 0.0."""
    cols = [F.col("query")]
    for path, name in PROGRESS_FIELDS:
        v = F.get_json_object("progress", path)
        if name in ("batch_id", "input_rows"):
            cols.append(v.try_cast("long").alias(name))
        elif name in ("watermark", "progress_ts"):
            cols.append(F.try_to_timestamp(v).alias(name))
        else:
            cols.append(clean_number(v).alias(name))
    dropped = F.aggregate(
        F.from_json(F.get_json_object("progress", "$.stateOperators"), "array<struct<numRowsDroppedByWatermark: long>>"),
        F.lit(0).cast("long"),
        lambda acc, x: acc + F.coalesce(x["numRowsDroppedByWatermark"], F.lit(0).cast("long")),
    )
    cols.append(F.coalesce(dropped, F.lit(0).cast("long")).alias("late_rows_dropped"))
    return raw.select(*cols)


def progress_summary(progress: DataFrame) -> DataFrame:
    """Per query: batches, batches with data, input rows, late rows dropped, and
    trigger-duration / processed-rate statistics (panels 2-3 of the reference)."""
    return progress.groupBy("query").agg(
        F.count(F.lit(1)).alias("batches"),
        F.count_if(F.col("input_rows") > 0).alias("batches_with_data"),
        F.sum("input_rows").alias("input_rows"),
        F.sum("late_rows_dropped").alias("late_rows_dropped"),
        F.avg("trigger_ms").alias("avg_trigger_ms"),
        F.max("trigger_ms").alias("max_trigger_ms"),
        F.percentile_approx("trigger_ms", 0.95).alias("p95_trigger_ms"),
        F.max("processed_rate").alias("max_processed_rate"),
        F.max_by("processed_rate", "batch_id").alias("last_processed_rate"),
    )
