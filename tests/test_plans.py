"""Physical-plan guards for the scale properties the operators are built for."""

import re

from barforge.plans.catalog import QUERIES

SF = "/root/testdata/sf0.001"


def _plan(spark, name):
    return QUERIES[name](spark, SF)._jdf.queryExecution().executedPlan().toString()


def test_each_message_is_parsed_once(spark):
    for name in ("trades_valid", "dead_letters", "feed_trades", "contract_violations"):
        plan = _plan(spark, name)
        assert plan.count("from_json(") == 1, name


def test_time_series_windows_are_bucketed(spark):
    plan = _plan(spark, "chart_series") + _plan(spark, "ma_fast_slow")
    specs = re.findall(r"windowspecdefinition\(([^)]*\)[^)]*)\)", plan)
    for spec in specs:
        partition_keys = spec.split(" ASC")[0].split(", ")
        ordered_by_bucket = len(partition_keys) == 2 and partition_keys[1].startswith("_hb")
        if ordered_by_bucket and "unboundedpreceding$(), -1" in spec:
            continue  # the prefix over the small per-(symbol, bucket) totals
        assert len(partition_keys) >= 3 and partition_keys[1].startswith(("_bucket", "_hb")), spec


def test_counter_rate_uses_halo_buckets(spark):
    plan = _plan(spark, "counter_rate")
    assert "_bucket" in plan and "RangeFrame, -3600" in plan


def test_top_n_is_limited_before_the_shuffle(spark):
    plan = _plan(spark, "latest_n_candles")
    assert "WindowGroupLimit" in plan and "Partial" in plan


def test_candles_use_partial_hash_aggregation(spark):
    plan = _plan(spark, "ohlcv_1m")
    assert "partial_min_by" in plan and "SortAggregate" not in plan


def test_scan_reads_only_needed_columns(spark):
    read_schema = re.search(r"ReadSchema: struct<([^>]*)>", _plan(spark, "trade_totals")).group(1)
    assert read_schema == "event_type:string"


def test_read_side_opens_stored_tables_only(spark):
    for name in ("latest_price", "alerts_feed", "pipeline_status", "metric_totals", "latest_n_candles"):
        assert "events.parquet" not in _plan(spark, name), name


def test_throughput_and_chart_are_computed_once(spark):
    for name in ("throughput_10s_zero_filled", "vwap", "chart_series"):
        assert "FileScan" not in _plan(spark, name), name  # both branches read the checkpoint


def test_look_back_queries_open_only_their_dates(spark):
    for name in ("lookback_slice", "lookback_backdated", "range_summary", "kpi", "sparkline"):
        assert re.search(r"PartitionFilters: \[isnotnull\(date", _plan(spark, name), re.I), name


def test_tick_retention_bounds_the_trades_scan(spark):
    assert "GreaterThanOrEqual(ts" in _plan(spark, "tick_retention")
