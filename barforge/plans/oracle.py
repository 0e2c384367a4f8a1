"""DuckDB SQL for each named query in ``barforge.plans.catalog``.

Written independently of the Spark code: the same definitions, stated in SQL
over the same parquet views. Column names equal the Spark aliases.
"""

from __future__ import annotations

# Trades derived from events (same fixed mapping as the Spark test view).
TRADES = """
trades AS (
  SELECT event_type AS symbol, value AS price,
         TRY_CAST(json_extract_string(props, '$.k') AS DOUBLE) AS size,
         CASE WHEN event_id % 2 = 0 THEN 'buy' ELSE 'sell' END AS side,
         event_id AS trade_id, ts
  FROM events)
"""


def candles_cte(window: str, source: str = "trades", name: str = "candles") -> str:
    return f"""
{name} AS (
  SELECT symbol,
         time_bucket(INTERVAL '{window}', ts) AS window_start,
         time_bucket(INTERVAL '{window}', ts) + INTERVAL '{window}' AS window_end,
         arg_min(price, {{'t': ts, 'i': trade_id}}) AS open,
         max(price) AS high, min(price) AS low,
         arg_max(price, {{'t': ts, 'i': trade_id}}) AS close,
         sum(size) AS volume
  FROM {source} WHERE ts IS NOT NULL GROUP BY ALL)
"""


def ohlcv(window: str) -> str:
    return f"WITH {TRADES}, {candles_cte(window)} SELECT * FROM candles"


TS_TEXT = "strftime(ts, '%Y-%m-%dT%H:%M:%S.%fZ')"

# Trade JSON text: same concatenation rule as the Spark test view.
MESSAGES = f"""
msg_parts AS (
  SELECT event_id, ts, event_id % 17 AS r,
         '{{"symbol":"' || event_type || '",'
         || CASE event_id % 17 WHEN 1 THEN ''
                 WHEN 3 THEN '"price":"' || CAST(value AS VARCHAR) || '",'
                 ELSE '"price":' || CAST(value AS VARCHAR) || ',' END
         || '"size":' || CASE WHEN event_id % 17 = 6 THEN '-' ELSE '' END
         || CAST(TRY_CAST(json_extract_string(props, '$.k') AS DOUBLE) AS VARCHAR)
         || ',"side":"' || CASE WHEN event_id % 17 = 5 THEN 'hold'
                                WHEN event_id % 2 = 0 THEN 'buy' ELSE 'sell' END
         || '","trade_id":' || CAST(event_id AS VARCHAR)
         || ',"ts":"' || CASE WHEN event_id % 17 = 2 THEN 'not-a-time' ELSE {TS_TEXT} END || '"'
         || CASE WHEN event_id % 17 = 4 THEN ',"venue":"x"' ELSE '' END
         || '}}' AS full_text
  FROM events),
messages AS (
  SELECT event_id, CASE WHEN r = 0 THEN substr(full_text, 1, 30) ELSE full_text END AS raw_json
  FROM msg_parts),
parsed AS (
  SELECT raw_json, event_id,
         CASE WHEN json_valid(raw_json) AND json_type(raw_json) = 'OBJECT' THEN 1 ELSE 0 END AS is_obj,
         CASE WHEN json_valid(raw_json) AND json_type(raw_json, '$.symbol') = 'VARCHAR'
              THEN json_extract_string(raw_json, '$.symbol') END AS symbol,
         CASE WHEN json_valid(raw_json) AND json_type(raw_json, '$.price') IN ('DOUBLE', 'BIGINT', 'UBIGINT')
              THEN CAST(json_extract(raw_json, '$.price') AS DOUBLE) END AS price,
         CASE WHEN json_valid(raw_json) AND json_type(raw_json, '$.size') IN ('DOUBLE', 'BIGINT', 'UBIGINT')
              THEN CAST(json_extract(raw_json, '$.size') AS DOUBLE) END AS size,
         CASE WHEN json_valid(raw_json) AND json_type(raw_json, '$.side') = 'VARCHAR'
              THEN json_extract_string(raw_json, '$.side') END AS side,
         CASE WHEN json_valid(raw_json) AND json_type(raw_json, '$.trade_id') IN ('BIGINT', 'UBIGINT')
              THEN CAST(json_extract(raw_json, '$.trade_id') AS BIGINT) END AS trade_id,
         CASE WHEN json_valid(raw_json) AND json_type(raw_json, '$.ts') = 'VARCHAR'
              THEN json_extract_string(raw_json, '$.ts') END AS ts_text
  FROM messages),
typed AS (
  SELECT *, timezone('UTC', TRY_CAST(ts_text AS TIMESTAMPTZ)) AS ts FROM parsed),
valid AS (
  SELECT * FROM typed
  WHERE symbol IS NOT NULL AND price IS NOT NULL AND size IS NOT NULL AND side IS NOT NULL
    AND trade_id IS NOT NULL AND ts IS NOT NULL)
"""

MALFORMED = """
malformed AS (
  SELECT * FROM typed
  WHERE NOT (symbol IS NOT NULL AND price IS NOT NULL AND size IS NOT NULL AND side IS NOT NULL
    AND trade_id IS NOT NULL AND ts IS NOT NULL))
"""

VIOLATIONS = """
violations AS (
  SELECT 'json:not_an_object' AS violation FROM typed WHERE is_obj = 0
  UNION ALL
  SELECT CASE WHEN json_exists(raw_json, '$.' || f) THEN 'type:' ELSE 'required:' END || f
  FROM (SELECT raw_json, is_obj, unnest(['symbol', 'price', 'size', 'side', 'trade_id', 'ts']) AS f,
               unnest([symbol IS NULL, price IS NULL, size IS NULL, side IS NULL,
                       trade_id IS NULL, ts_text IS NULL]) AS missing
        FROM typed) x
  WHERE is_obj = 1 AND missing
  UNION ALL
  SELECT 'range:price' FROM typed WHERE price IS NOT NULL AND (isnan(price) OR price <= 0)
  UNION ALL
  SELECT 'range:size' FROM typed WHERE size IS NOT NULL AND (isnan(size) OR size <= 0)
  UNION ALL
  SELECT 'enum:side' FROM typed WHERE side IS NOT NULL AND side NOT IN ('buy', 'sell')
  UNION ALL
  SELECT 'range:trade_id' FROM typed WHERE trade_id < 0
  UNION ALL
  SELECT 'format:ts' FROM typed
  WHERE ts_text IS NOT NULL
    AND (NOT regexp_matches(ts_text, '^\\d{4}-\\d{2}-\\d{2}[Tt ]\\d{2}:\\d{2}:\\d{2}(\\.\\d+)?([Zz]|[+-]\\d{2}:\\d{2})$')
         OR ts IS NULL)
  UNION ALL
  SELECT 'extra:' || k FROM (SELECT unnest(json_keys(raw_json)) AS k FROM typed WHERE is_obj = 1) e
  WHERE k NOT IN ('symbol', 'price', 'size', 'side', 'trade_id', 'ts'))
"""

FEED = f"""
feed_raw AS (
  SELECT event_id,
    CASE event_id % 11
      WHEN 0 THEN '{{"type":"heartbeat","product_id":"' || event_type || '","sequence":' || CAST(event_id AS VARCHAR) || '}}'
      WHEN 2 THEN '{{"type":"error","message":"rate limited"}}'
      WHEN 3 THEN '{{"type":"subscriptions","channels":["matches","heartbeat"]}}'
      WHEN 4 THEN 'not json ' || CAST(event_id AS VARCHAR)
      ELSE '{{"type":"' || CASE WHEN event_id % 11 = 1 THEN 'last_match' ELSE 'match' END
           || '","trade_id":' || CAST(event_id AS VARCHAR)
           || ',"maker_order_id":"m","taker_order_id":"t","side":"'
           || CASE WHEN event_id % 2 = 0 THEN 'buy' ELSE 'sell' END || '",'
           || CASE event_id % 13 WHEN 1 THEN ''
                   WHEN 2 THEN '"size":"' || json_extract_string(props, '$.k') || 'e-08",'
                   ELSE '"size":"' || json_extract_string(props, '$.k') || '",' END
           || CASE WHEN event_id % 13 = 0 THEN '"price":"not-a-number",'
                   ELSE '"price":"' || CAST(value AS VARCHAR) || '",' END
           || '"product_id":"' || event_type || '","sequence":' || CAST(event_id AS VARCHAR)
           || ',"time":"' || {TS_TEXT} || '"}}'
    END AS raw_json
  FROM events),
feed_json AS (
  SELECT raw_json, CASE WHEN json_valid(raw_json) THEN raw_json END AS j FROM feed_raw),
feed_parsed AS (
  SELECT raw_json,
    coalesce(json_type(j) = 'OBJECT', false) AS decoded,
    json_extract_string(j, '$.type') AS type,
    json_extract_string(j, '$.product_id') AS symbol,
    CASE WHEN regexp_matches(json_extract_string(j, '$.price'), '^\\s*[+-]?([0-9]+\\.?[0-9]*|\\.[0-9]+)([eE][+-]?[0-9]+)?\\s*$')
         THEN TRY_CAST(trim(json_extract_string(j, '$.price')) AS DOUBLE) END AS price,
    CASE WHEN regexp_matches(json_extract_string(j, '$.size'), '^\\s*[+-]?([0-9]+\\.?[0-9]*|\\.[0-9]+)([eE][+-]?[0-9]+)?\\s*$')
         THEN TRY_CAST(trim(json_extract_string(j, '$.size')) AS DOUBLE) END AS size,
    json_extract_string(j, '$.side') AS side,
    TRY_CAST(json_extract_string(j, '$.trade_id') AS BIGINT) AS trade_id,
    json_extract_string(j, '$.time') AS ts
  FROM feed_json),
feed_routed AS (
  SELECT *,
    CASE WHEN NOT decoded THEN 'undecodable'
         WHEN type = 'match' THEN
           CASE WHEN symbol IS NOT NULL AND price IS NOT NULL AND size IS NOT NULL AND side IS NOT NULL
                     AND trade_id IS NOT NULL AND ts IS NOT NULL THEN 'trade' ELSE 'reject' END
         WHEN type IN ('heartbeat', 'subscriptions', 'error') THEN type
         ELSE 'ignored' END AS route
  FROM feed_parsed)
"""

SQL: dict[str, str] = {
    "ohlcv_1m": ohlcv("1 minute"),
    "ohlcv_1h": ohlcv("1 hour"),
    "ohlcv_1d": ohlcv("1 day"),
    "ohlcv_tiebreak": f"""
WITH {TRADES}, hour_trades AS (SELECT symbol, price, size, side, trade_id, date_trunc('hour', ts) AS ts FROM trades),
{candles_cte('1 day', source='hour_trades')}
SELECT * FROM candles""",
    "trades_valid": f"WITH {MESSAGES} SELECT symbol, price, size, side, trade_id, ts FROM valid",
    "trades_split_counts": f"""
WITH {MESSAGES}, {MALFORMED}
SELECT (SELECT count(*) FROM valid) AS valid_rows, (SELECT count(*) FROM malformed) AS malformed_rows""",
    "dead_letters": f"WITH {MESSAGES}, {MALFORMED} SELECT CAST(NULL AS VARCHAR) AS key, raw_json AS value FROM malformed",
    "contract_violations": f"""
WITH {MESSAGES}, {VIOLATIONS}
SELECT violation, count(*) AS messages FROM violations GROUP BY violation""",
    "feed_routes": f"WITH {FEED} SELECT route, count(*) AS messages FROM feed_routed GROUP BY route",
    "feed_trades": f"""
WITH {FEED} SELECT symbol, price, size, side, trade_id, ts FROM feed_routed WHERE route = 'trade'""",
}

# --- alerts, serving, indicators, rates, quality --------------------------------

AS_OF = "TIMESTAMP '2024-01-31 00:00:00'"
AS_OF_BACKDATED = "TIMESTAMP '2024-01-15 00:30:00'"
SYMBOL_LIST = "['click', 'error', 'purchase', 'signup', 'view', 'refund']"
HOURLY = f"{TRADES}, {candles_cte('1 hour')}"


def alerts_sql(threshold: float) -> str:
    return f"""
WITH {HOURLY},
pct AS (SELECT *, CASE WHEN open IS NULL OR open = 0 THEN 0.0 ELSE (close - open) / open * 100.0 END AS pct_change
        FROM candles)
SELECT symbol, window_end AS ts, close AS price, pct_change,
       symbol || ' moved ' || printf('%+.2f', pct_change) || '% in the '
       || strftime(window_start, '%H:%M') || '-' || strftime(window_end, '%H:%M') || ' window' AS message
FROM pct WHERE abs(pct_change) > {threshold}"""


ALERTS_FEED = f"""
WITH a AS ({alerts_sql(0.3)}),
top AS (SELECT * FROM a ORDER BY ts DESC, symbol ASC LIMIT 12)
SELECT symbol, ts,
       CASE WHEN pct_change >= 0 THEN 'up' WHEN pct_change < 0 THEN 'down' END AS direction,
       printf('%+.2f', pct_change) || '%' AS pct_text,
       strftime(ts, '%H:%M') AS time_text,
       '$' || format('{{:,.2f}}', price) AS price_text,
       message
FROM top"""

LATEST_N = f"""
WITH {HOURLY},
r AS (SELECT *, row_number() OVER (PARTITION BY symbol ORDER BY window_start DESC) AS rn FROM candles)
SELECT symbol, window_start, window_end, open, high, low, close, volume FROM r WHERE rn <= {{n}}"""

SLICE_7D = f"{HOURLY}, slice AS (SELECT * FROM candles WHERE window_start BETWEEN {AS_OF} - INTERVAL 10080 MINUTE AND {AS_OF})"
SLICE_24H = f"{HOURLY}, slice AS (SELECT * FROM candles WHERE window_start BETWEEN {AS_OF} - INTERVAL 1440 MINUTE AND {AS_OF})"

RANGE_SUMMARY = f"""
WITH {SLICE_7D},
s AS (SELECT symbol, arg_min(open, window_start) AS first_open, arg_max(close, window_start) AS last_close,
             count(*) AS candles, min(low) AS low, max(high) AS high FROM slice GROUP BY symbol),
m AS (SELECT *, coalesce((last_close - first_open) / nullif(first_open, 0) * 100.0, 0.0) AS move_pct,
             CASE WHEN (high - low) * 0.08 = 0 THEN 1.0 ELSE (high - low) * 0.08 END AS pad FROM s)
SELECT symbol, first_open, last_close, move_pct,
       CASE WHEN move_pct >= 0 THEN 'up' WHEN move_pct < 0 THEN 'down' END AS direction,
       candles, low, high, low - pad AS axis_lo, high + pad AS axis_hi
FROM m"""

KPI = f"""
WITH {SLICE_24H},
syms AS (SELECT unnest({SYMBOL_LIST}) AS symbol),
per AS (SELECT symbol, arg_min(open, window_start) AS first_open, arg_max(close, window_start) AS last_close,
               count(*) AS candles FROM slice GROUP BY symbol),
live AS (SELECT symbol, arg_max(price, {{'t': ts, 'i': trade_id}}) AS live_price FROM trades
         WHERE ts BETWEEN {AS_OF} - INTERVAL 10 MINUTE AND {AS_OF} GROUP BY symbol),
j AS (SELECT syms.symbol, per.first_open, per.last_close, per.candles, live.live_price,
             coalesce(live.live_price, per.last_close) AS px
      FROM syms LEFT JOIN per ON per.symbol = syms.symbol LEFT JOIN live ON live.symbol = syms.symbol),
c AS (SELECT *, CASE WHEN candles >= 2 AND first_open <> 0 THEN (px - first_open) / first_open * 100.0 END AS chg FROM j)
SELECT symbol,
       CASE WHEN candles IS NOT NULL THEN 'ok' ELSE 'no data' END AS status,
       CASE WHEN candles IS NOT NULL THEN px END AS price,
       CASE WHEN candles IS NOT NULL THEN live_price IS NOT NULL END AS is_live,
       first_open, last_close, coalesce(candles, 0) AS candles,
       CASE WHEN candles IS NOT NULL THEN chg END AS change_pct,
       CASE WHEN candles IS NOT NULL THEN coalesce(CASE WHEN chg >= 0 THEN 'up' WHEN chg < 0 THEN 'down' END, 'up') END AS direction
FROM c"""

SPARKLINE = f"""
WITH {SLICE_24H},
v AS (SELECT symbol, window_start, close FROM slice WHERE close IS NOT NULL),
p AS (SELECT symbol, close, count(*) OVER (PARTITION BY symbol) AS n,
             min(close) OVER (PARTITION BY symbol) AS lo, max(close) OVER (PARTITION BY symbol) AS hi,
             row_number() OVER (PARTITION BY symbol ORDER BY window_start) - 1 AS pos FROM v)
SELECT symbol, pos, close AS value,
       2.0 + pos / (n - 1) * 146 AS x,
       33.0 - (close - lo) / (CASE WHEN hi - lo = 0 THEN 1.0 ELSE hi - lo END) * 30 AS y
FROM p WHERE n >= 2"""

STATUS_BASE = f"""
WITH {HOURLY}, {MESSAGES}, {MALFORMED},
agg AS (SELECT (SELECT max(window_end) FROM candles) AS last_candle, (SELECT count(*) FROM malformed) AS malformed_dropped),
a AS (SELECT *, (epoch_us({AS_OF}) - epoch_us(last_candle)) / 1000000.0 AS age_seconds FROM agg),
w AS (SELECT *, CAST(trunc(age_seconds) AS BIGINT) AS whole FROM a),
d AS (SELECT *, CAST(floor(whole / 60) AS BIGINT) AS mins FROM w)
"""

PIPELINE_STATUS = STATUS_BASE + """
SELECT last_candle, age_seconds,
       CASE WHEN age_seconds <= 180 THEN 'Live' WHEN age_seconds <= 360 THEN 'Lagging'
            WHEN age_seconds IS NOT NULL THEN 'Stale' END AS state,
       CASE WHEN mins <> 0 THEN CAST(mins AS VARCHAR) || 'm ' || CAST(whole - mins * 60 AS VARCHAR) || 's'
            ELSE CAST(whole - mins * 60 AS VARCHAR) || 's' END AS age_text,
       malformed_dropped
FROM d"""

METRIC_TOTALS = f"""
WITH {MESSAGES}, {MALFORMED}
SELECT 'malformed_dropped' AS metric, count(*) AS value,
       (SELECT max(e.ts) FROM events e JOIN malformed m ON m.event_id = e.event_id) AS updated_at
FROM malformed"""

ALL_RANGE_GRID = f"""
{HOURLY},
slice AS (SELECT * FROM candles),
bounds AS (SELECT symbol, min(window_start) AS lo, max(window_start) AS hi FROM slice GROUP BY symbol),
grid AS (SELECT symbol, unnest(generate_series(lo, hi, INTERVAL '1 hour')) AS window_start FROM bounds),
g AS (SELECT grid.symbol, grid.window_start, s.window_end, s.open, s.high, s.low, s.close, s.volume
      FROM grid LEFT JOIN slice s ON s.symbol = grid.symbol AND s.window_start = grid.window_start)
"""

MA_COLS = """
       CASE WHEN count(close) OVER w10 = 10 THEN round(avg(close) OVER w10, 8) END AS ma_fast,
       CASE WHEN count(close) OVER w20 = 20 THEN round(avg(close) OVER w20, 8) END AS ma_slow"""
VWAP_COL = """
       CASE WHEN close IS NOT NULL
            THEN round(sum((high + low + close) / 3.0 * volume) OVER wc / nullif(sum(volume) OVER wc, 0), 8) END AS vwap"""
WINDOWS = """
WINDOW w10 AS (PARTITION BY symbol ORDER BY window_start ROWS BETWEEN 9 PRECEDING AND CURRENT ROW),
       w20 AS (PARTITION BY symbol ORDER BY window_start ROWS BETWEEN 19 PRECEDING AND CURRENT ROW),
       wc AS (PARTITION BY symbol ORDER BY window_start ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"""

CHART_SERIES = f"""
WITH {SLICE_7D},
bounds AS (SELECT symbol, min(window_start) AS lo, max(window_start) AS hi FROM slice GROUP BY symbol),
grid AS (SELECT symbol, unnest(generate_series(lo, hi, INTERVAL '1 hour')) AS window_start FROM bounds),
g AS (SELECT grid.symbol, grid.window_start, s.window_end, s.open, s.high, s.low, s.close, s.volume
      FROM grid LEFT JOIN slice s ON s.symbol = grid.symbol AND s.window_start = grid.window_start)
SELECT symbol, window_start, window_end, open, high, low, close, volume, {MA_COLS}, {VWAP_COL},
       CASE WHEN close IS NOT NULL THEN CASE WHEN close - open >= 0 THEN 'up' WHEN close - open < 0 THEN 'down' END END AS direction
FROM g {WINDOWS}"""

THROUGHPUT = f"""
WITH {TRADES},
b AS (SELECT time_bucket(INTERVAL '10 seconds', min(ts)) AS lo, max(ts) AS hi FROM trades),
grid AS (SELECT unnest(generate_series(lo, hi, INTERVAL '10 seconds')) AS window_start FROM b),
syms AS (SELECT unnest({SYMBOL_LIST}) AS symbol),
gs AS (SELECT window_start, symbol FROM grid, syms),
c AS (SELECT time_bucket(INTERVAL '10 seconds', ts) AS window_start, symbol, count(*) AS n FROM trades
      WHERE symbol IN (SELECT symbol FROM syms) GROUP BY ALL),
f AS (SELECT gs.window_start, gs.symbol, coalesce(c.n, 0) AS trades FROM gs
      LEFT JOIN c ON c.window_start = gs.window_start AND c.symbol = gs.symbol)
SELECT window_start, symbol, trades, trades / 10.0 AS rate,
       sum(trades) OVER (PARTITION BY window_start) / 10.0 AS total_rate
FROM f"""


def sliding_sql(source: str, ts: str, keys: str, count_name: str) -> str:
    key_sel = f"{keys}, " if keys else ""
    return f"""
s AS (SELECT {key_sel}time_bucket(INTERVAL '10 seconds', {ts}) - INTERVAL (k * 10) SECOND AS window_start
      FROM {source}, range(6) t(k) WHERE {ts} IS NOT NULL)
SELECT {key_sel}window_start, window_start + INTERVAL 1 MINUTE AS window_end, count(*) AS {count_name},
       count(*) / 60.0 AS rate
FROM s GROUP BY ALL"""


RATE_1M = f"WITH {TRADES}, " + sliding_sql("trades", "ts", "symbol", "trades")
INGESTION_1M = f"WITH {MESSAGES}, m AS (SELECT e.ts AS event_ts FROM messages JOIN events e USING (event_id)), " + sliding_sql(
    "m", "event_ts", "", "messages"
)

COUNTER_RATE = f"""
WITH {TRADES},
per AS (SELECT symbol, CASE WHEN ts >= TIMESTAMP '2024-01-15 00:00:00' THEN 1 ELSE 0 END AS seg,
               time_bucket(INTERVAL '600 seconds', ts) + INTERVAL 600 SECOND AS ts, count(*) AS n
        FROM trades GROUP BY ALL),
samples AS (SELECT symbol, ts, sum(n) OVER (PARTITION BY symbol, seg ORDER BY ts
                   ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS value FROM per),
d AS (SELECT *, coalesce(CASE WHEN value - lag(value) OVER (PARTITION BY symbol ORDER BY ts) < 0 THEN value
                               ELSE value - lag(value) OVER (PARTITION BY symbol ORDER BY ts) END, 0) AS delta
      FROM samples),
r AS (SELECT symbol, ts, value,
             sum(delta) OVER w - first_value(delta) OVER w AS inc,
             epoch(ts) - epoch(min(ts) OVER w) AS span
      FROM d WINDOW w AS (PARTITION BY symbol ORDER BY ts RANGE BETWEEN INTERVAL 3600 SECOND PRECEDING AND CURRENT ROW))
SELECT symbol, ts, CAST(value AS BIGINT) AS value, CAST(inc AS BIGINT) AS increase,
       CASE WHEN span > 0 THEN inc / span END AS rate
FROM r"""

TICKS = f"""
{TRADES},
ticks AS (SELECT symbol, time_bucket(INTERVAL '1 second', ts) AS second,
                 arg_max(ts, {{'t': ts, 'i': trade_id}}) AS tick_ts,
                 arg_max(price, {{'t': ts, 'i': trade_id}}) AS price,
                 arg_max(size, {{'t': ts, 'i': trade_id}}) AS size
          FROM trades GROUP BY ALL)
"""

INSERT_IF_ABSENT = f"""
WITH {HOURLY},
target AS (SELECT * FROM candles WHERE window_start < TIMESTAMP '2024-01-21 00:00:00'),
incoming AS (SELECT symbol, window_start, window_end, open, high, low, close + 1.0 AS close, volume
             FROM candles WHERE window_start >= TIMESTAMP '2024-01-15 00:00:00')
SELECT * FROM target
UNION ALL
SELECT * FROM incoming i
WHERE NOT EXISTS (SELECT 1 FROM target t WHERE t.symbol = i.symbol AND t.window_start = i.window_start)"""

SQL.update({
    "alerts": alerts_sql(0.3),
    "alerts_wide": alerts_sql(50.0),
    "alerts_feed": ALERTS_FEED,
    "latest_price": f"""
WITH {TRADES} SELECT symbol, arg_max(price, {{'t': ts, 'i': trade_id}}) AS price,
                     arg_max(ts, {{'t': ts, 'i': trade_id}}) AS ts FROM trades GROUP BY symbol""",
    "latest_n_candles": LATEST_N.replace("{n}", "200"),
    "lookback_slice": f"WITH {SLICE_7D} SELECT * FROM slice",
    "lookback_backdated": f"""WITH {HOURLY} SELECT * FROM candles
        WHERE window_start BETWEEN {AS_OF_BACKDATED} - INTERVAL 10080 MINUTE AND {AS_OF_BACKDATED}""",
    "range_summary": RANGE_SUMMARY,
    "kpi": KPI,
    "sparkline": SPARKLINE,
    "pipeline_status": PIPELINE_STATUS,
    "metric_totals": METRIC_TOTALS,
    "gap_grid": f"WITH {ALL_RANGE_GRID} SELECT * FROM g",
    "ma_fast_slow": f"WITH {ALL_RANGE_GRID} SELECT symbol, window_start, close, {MA_COLS} FROM g {WINDOWS}",
    "vwap": f"WITH {ALL_RANGE_GRID} SELECT symbol, window_start, close, {VWAP_COL} FROM g {WINDOWS}",
    "chart_series": CHART_SERIES,
    "throughput_10s_zero_filled": THROUGHPUT,
    "rate_1m": RATE_1M,
    "ingestion_rate_1m": INGESTION_1M,
    "counter_rate": COUNTER_RATE,
    "trade_totals": f"WITH {TRADES} SELECT symbol, count(*) AS trades FROM trades GROUP BY symbol",
    "tick_sample_1s": f"WITH {TICKS} SELECT symbol, second, tick_ts AS ts, price, size FROM ticks",
    "tick_retention": f"""WITH {TICKS} SELECT symbol, second, tick_ts AS ts, price, size FROM ticks
WHERE tick_ts >= {AS_OF} - INTERVAL 10 MINUTE""",
    "dup_audit": """SELECT count(*) AS rows, count(DISTINCT (l_orderkey, l_linenumber)) AS distinct_keys,
       count(*) - count(DISTINCT (l_orderkey, l_linenumber)) AS duplicates FROM lineitem""",
    "dup_keys": """SELECT l_orderkey, l_linenumber, count(*) AS copies FROM lineitem
GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1""",
    "candle_constraints": f"""
WITH {HOURLY}
SELECT count(*) AS rows,
       count(*) FILTER (WHERE symbol IS NULL) AS nulls_symbol,
       count(*) FILTER (WHERE window_start IS NULL) AS nulls_window_start,
       count(*) FILTER (WHERE window_end IS NULL) AS nulls_window_end,
       count(*) FILTER (WHERE open IS NULL) AS nulls_open,
       count(*) FILTER (WHERE high IS NULL) AS nulls_high,
       count(*) FILTER (WHERE low IS NULL) AS nulls_low,
       count(*) FILTER (WHERE close IS NULL) AS nulls_close,
       count(*) FILTER (WHERE volume IS NULL) AS nulls_volume,
       count(*) FILTER (WHERE window_end <> window_start + INTERVAL 1 HOUR) AS bad_window_end,
       count(*) FILTER (WHERE low > high) AS low_above_high
FROM candles""",
    "insert_if_absent": INSERT_IF_ABSENT,
})

# --- streaming: closed windows of the batch result ------------------------------

STREAM_CLOSED = f"""
{MESSAGES},
vt AS (SELECT symbol, price, size, side, trade_id, ts FROM valid),
{candles_cte('1 hour', source='vt')},
closed AS (SELECT * FROM candles WHERE window_end <= (SELECT max(ts) FROM vt) - INTERVAL 1 MINUTE)
"""

SQL.update({
    "stream_candles": f"WITH {STREAM_CLOSED} SELECT * FROM closed",
    "stream_restart": f"WITH {STREAM_CLOSED} SELECT * FROM closed",
    "stream_alerts": f"""
WITH {STREAM_CLOSED},
pct AS (SELECT *, CASE WHEN open IS NULL OR open = 0 THEN 0.0 ELSE (close - open) / open * 100.0 END AS p FROM closed)
SELECT symbol, window_end AS ts, CAST(CAST(close AS DECIMAL(20, 8)) AS DOUBLE) AS price,
       CAST(CAST(p AS DECIMAL(10, 4)) AS DOUBLE) AS pct_change,
       symbol || ' moved ' || printf('%+.2f', p) || '% in the '
       || strftime(window_start, '%H:%M') || '-' || strftime(window_end, '%H:%M') || ' window' AS message
FROM pct WHERE abs(p) > 0.3""",
    "stream_dead_letters": f"WITH {MESSAGES}, {MALFORMED} SELECT CAST(NULL AS VARCHAR) AS key, raw_json AS value FROM malformed",
    "stream_malformed_total": f"WITH {MESSAGES}, {MALFORMED} SELECT 'malformed_dropped' AS metric, count(*) AS value FROM malformed",
})

NUM = r"^\s*[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?\s*$"

SQL.update({
    "symbol_candles": f"WITH {HOURLY} SELECT * FROM candles WHERE symbol = 'view' AND window_start >= {AS_OF} - INTERVAL 10080 MINUTE",
    "symbol_candles_all": f"WITH {HOURLY} SELECT * FROM candles WHERE symbol = 'view' ORDER BY window_start DESC LIMIT 2000",
    "dead_letter_replay": f"""
WITH {MESSAGES}, {MALFORMED},
mj AS (SELECT CASE WHEN json_valid(raw_json) THEN raw_json END AS j FROM malformed),
lp AS (SELECT json_extract_string(j, '$.symbol') AS symbol,
              CASE WHEN regexp_matches(json_extract_string(j, '$.price'), '{NUM}')
                   THEN TRY_CAST(trim(json_extract_string(j, '$.price')) AS DOUBLE) END AS price,
              CASE WHEN regexp_matches(json_extract_string(j, '$.size'), '{NUM}')
                   THEN TRY_CAST(trim(json_extract_string(j, '$.size')) AS DOUBLE) END AS size,
              json_extract_string(j, '$.side') AS side,
              TRY_CAST(json_extract_string(j, '$.trade_id') AS BIGINT) AS trade_id,
              timezone('UTC', TRY_CAST(json_extract_string(j, '$.ts') AS TIMESTAMPTZ)) AS ts
       FROM mj)
SELECT * FROM lp
WHERE symbol IS NOT NULL AND price IS NOT NULL AND size IS NOT NULL AND side IS NOT NULL
  AND trade_id IS NOT NULL AND ts IS NOT NULL""",
    "publish_roundtrip": f"WITH {TRADES} SELECT symbol AS key, symbol, price, size, side, trade_id, ts FROM trades",
})

SQL["tick_buffer"] = SQL["tick_retention"]

USER_TRADES = TRADES.replace("SELECT event_type AS symbol", "SELECT CAST(user_id AS VARCHAR) AS symbol")
SQL["ohlcv_1d_users"] = f"WITH {USER_TRADES}, {candles_cte('1 day')} SELECT * FROM candles"

# Both stream queries read every message in time-ordered micro-batches; none is late.
SQL["stream_progress_counts"] = """
SELECT unnest(['candles', 'malformed']) AS query, CAST(greatest(8, ceil(count(*) / 1e6)) AS BIGINT) AS batches_with_data,
       count(*) AS input_rows, CAST(0 AS BIGINT) AS late_rows_dropped FROM events"""
SQL["stream_progress"] = """
SELECT unnest(['candles', 'malformed']) AS query, count(*) AS input_rows, true AS timed, true AS rated, true AS ordered FROM events"""

SQL["sink_new_checkpoint"] = f"""
WITH c AS ({INSERT_IF_ABSENT})
SELECT symbol, window_start, window_end, CAST(CAST(open AS DECIMAL(20, 8)) AS DOUBLE) AS open,
       CAST(CAST(high AS DECIMAL(20, 8)) AS DOUBLE) AS high, CAST(CAST(low AS DECIMAL(20, 8)) AS DOUBLE) AS low,
       CAST(CAST(close AS DECIMAL(20, 8)) AS DOUBLE) AS close, volume
FROM c"""
SQL["stored_rejects"] = f"""
WITH {HOURLY}
SELECT symbol, window_start, window_end, open, high, low, close * 1e30 AS close, volume FROM candles
WHERE symbol = 'view' AND abs(close) * 1e30 >= 1e12"""

EACH_PARTITION = COUNTER_RATE.replace(TRADES, TRADES.replace("SELECT event_type AS symbol", "SELECT CAST(event_id % 6 AS VARCHAR) AS symbol"))
SQL["offset_rate"] = f"""
WITH each AS ({EACH_PARTITION})
SELECT ts, count(*) AS partitions, CAST(sum(increase) AS BIGINT) AS increase, round(sum(rate), 8) AS rate FROM each GROUP BY ts"""

SQL["stream_compacted"] = SQL["stream_restart"]
SQL["stream_dedup"] = SQL["stream_candles"]
SQL["stored_constraints"] = f"""
WITH {STREAM_CLOSED}, {TICKS.replace('trades AS', 'all_trades AS').replace('FROM trades', 'FROM all_trades')},
a AS ({SQL["stream_alerts"]})
SELECT 'candles' AS table, (SELECT count(*) FROM closed) AS rows, CAST(0 AS BIGINT) AS nulls, CAST(0 AS BIGINT) AS duplicates,
       CAST(0 AS BIGINT) AS bad_window_end
UNION ALL SELECT 'alerts', (SELECT count(*) FROM a), 0, 0, 0
UNION ALL SELECT 'ticks', (SELECT count(*) FROM ticks), 0, 0, 0"""

# A message's batch, and the watermark by which the batch before it closed windows.
SQL["stream_late_rows"] = f"""
WITH {MESSAGES},
placed AS (SELECT v.*, (dayofyear(e.ts) - 1) // 4 + CASE WHEN event_id % 50 = 0 THEN 2 ELSE 0 END AS slot
           FROM valid v JOIN events e USING (event_id)),
numbered AS (SELECT DISTINCT (dayofyear(ts) - 1) // 4 + CASE WHEN event_id % 50 = 0 THEN 2 ELSE 0 END AS slot FROM events),
batches AS (SELECT slot, row_number() OVER (ORDER BY slot) - 1 AS batch_id FROM numbered),
newest AS (SELECT slot, max(ts) AS t FROM placed GROUP BY slot),
marks AS (SELECT slot, batch_id, date_trunc('millisecond', max(t) OVER (ORDER BY slot ROWS BETWEEN UNBOUNDED PRECEDING AND 2 PRECEDING)
                                 - INTERVAL 1 MINUTE) AS watermark
          FROM batches LEFT JOIN newest USING (slot)),
windows AS (SELECT *, time_bucket(INTERVAL '1 hour', ts) AS window_start FROM placed JOIN marks USING (slot))
SELECT symbol, trade_id, ts, price, size, window_start, window_start + INTERVAL 1 HOUR AS window_end, watermark, batch_id
FROM windows WHERE window_start + INTERVAL 1 HOUR <= watermark"""

SQL["ohlcv_rollup_1d"] = SQL["ohlcv_1d"]
SQL["replay_corrects_candles"] = f"""
WITH recovered AS ({SQL["dead_letter_replay"]}), {MESSAGES},
vt AS (SELECT symbol, price, size, side, trade_id, ts FROM valid
       UNION ALL SELECT symbol, price, size, side, trade_id, ts FROM recovered),
{candles_cte('1 hour', source='vt')}
SELECT * FROM candles"""
SQL["tick_retention_stored"] = f"""
WITH {TICKS} SELECT symbol, second, tick_ts AS ts, price, size FROM ticks
WHERE tick_ts >= (SELECT max(tick_ts) FROM ticks) - INTERVAL 1440 MINUTE"""

# Throughput of closed intervals: from the first trade to the last closed interval that holds one.
SQL["stream_throughput"] = f"""
WITH {MESSAGES},
closed_trades AS (SELECT symbol, ts FROM valid
                  WHERE time_bucket(INTERVAL '10 seconds', ts) + INTERVAL 10 SECOND <= (SELECT max(ts) FROM valid) - INTERVAL 1 MINUTE),
{THROUGHPUT[THROUGHPUT.index("b AS ("):].replace("FROM trades", "FROM closed_trades")}"""

SQL["stream_indicators"] = f"""
WITH {STREAM_CLOSED},
bounds AS (SELECT symbol, min(window_start) AS lo, max(window_start) AS hi FROM closed GROUP BY symbol),
grid AS (SELECT symbol, unnest(generate_series(lo, hi, INTERVAL '1 hour')) AS window_start FROM bounds),
g AS (SELECT grid.symbol, grid.window_start, c.high, c.low, c.close, c.volume
      FROM grid LEFT JOIN closed c ON c.symbol = grid.symbol AND c.window_start = grid.window_start)
SELECT symbol, window_start, close, {MA_COLS}, {VWAP_COL} FROM g {WINDOWS}"""

SQL["latest_price_kept"] = SQL["latest_price"]
