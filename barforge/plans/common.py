"""Helpers shared by the named queries: fixed parameters and output-edge casts."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import TimestampType

# Fixed parameters of the registered queries over the driver tables
# (events span 2024-01-01 .. 2024-01-30, UTC).
AS_OF = dt.datetime(2024, 1, 31, 0, 0, 0)
AS_OF_SQL = "TIMESTAMP '2024-01-31 00:00:00'"
AS_OF_BACKDATED = dt.datetime(2024, 1, 15, 0, 30, 0)  # inside the data: later rows must stay out
SYMBOLS = ["click", "error", "purchase", "signup", "view", "refund"]  # 'refund' has no trades
ALERT_THRESHOLD = 0.3
ALERT_THRESHOLD_WIDE = 50.0
CHART_WINDOW = "1 hour"
CHART_STEP_MIN = 60
LOOKBACK_MIN = 7 * 24 * 60
KPI_LOOKBACK_MIN = 24 * 60
LATEST_N = 200
ALERT_LIMIT = 12
TICK_KEPT_MIN = 24 * 60


def as_of_col(as_of: dt.datetime = AS_OF):
    """``as_of`` as a TIMESTAMP read in the (UTC) session time zone."""
    return F.lit(as_of.strftime("%Y-%m-%d %H:%M:%S")).cast("timestamp")


def ntz(df: DataFrame) -> DataFrame:
    """Cast every TIMESTAMP column to TIMESTAMP_NTZ (UTC wall clock) at the output edge."""
    cols = [
        F.col(f.name).cast("timestamp_ntz").alias(f.name) if isinstance(f.dataType, TimestampType) else F.col(f.name)
        for f in df.schema.fields
    ]
    return df.select(*cols)
