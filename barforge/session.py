"""Session defaults and the shared scratch folder.

Everything in this library is computed in UTC: windows are aligned to the epoch
and formatted as UTC wall-clock text, so the session time zone is pinned.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


def build_session(
    master: str | None = None,
    app_name: str = "barforge",
    shuffle_partitions: int | None = None,
    extra: dict | None = None,
    initial_shuffle_partitions: int | None = None,
) -> SparkSession:
    """Session with the settings every job here assumes.

    On a cluster leave ``master`` unset. AQE can merge small shuffle partitions but
    cannot split a plain aggregation's partitions, so for large inputs give
    ``initial_shuffle_partitions`` about input bytes / 128 MB (e.g. ~800k for
    100 TB, capped by what the cluster schedules well) and let AQE coalesce down to
    ~128 MB partitions. ``shuffle_partitions`` also fixes the number of state
    partitions of a new streaming checkpoint.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = {
        "spark.sql.session.timeZone": "UTC",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        # Partition sizing: scan splits and post-shuffle partitions of ~128 MB fit
        # comfortably in executor memory; AQE merges smaller ones and splits skew.
        "spark.sql.files.maxPartitionBytes": "128m",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
    }
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    if initial_shuffle_partitions:
        conf["spark.sql.adaptive.coalescePartitions.initialPartitionNum"] = str(initial_shuffle_partitions)
    conf.update(extra or {})
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    ensure_utc(spark)
    return spark


def ensure_utc(spark: SparkSession) -> SparkSession:
    """Pin the session time zone to UTC (a runtime SQL conf, safe to set any time)."""
    if spark.conf.get("spark.sql.session.timeZone", None) != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """Folder shared by all executors: the cluster's ``spark.checkpoint.dir``.

    Only when nothing is configured (local runs, tests) do we create one; on a
    cluster an unset checkpoint dir is an error, since a machine-local folder
    would not survive the loss of an executor.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        root = spark.sparkContext.getCheckpointDir()
    if not root:
        master = spark.sparkContext.master
        if not master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
        root = tempfile.mkdtemp(prefix="barforge-")
        spark.sparkContext.setCheckpointDir(root)
    return root.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique name below the shared folder; whoever writes there makes the folder."""
    return f"{shared_dir(spark)}/barforge/{name}-{uuid.uuid4().hex[:12]}"
