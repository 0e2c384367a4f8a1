"""barforge: trade-stream candle analytics expressed as Spark DataFrame jobs.

Layout:
  schema       the one trade StructType, required fields, stored decimals
  session      session defaults (UTC, AQE) and the shared scratch folder
  sources/     trade/feed readers (batch + stream), stored-table readers, test views
  functions/   Column expressions (percent change, formats, validity predicates)
  operators/   candles, alerts, indicators, serving read-side, rates, quality, sinks
  streaming/   Structured Streaming jobs and progress analytics
  plans/       named queries over the driver tables and their DuckDB oracles
"""

__version__ = "0.1.0"
