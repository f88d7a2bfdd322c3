"""Plan shape: pruning reaches the scan; hour filters prune partitions."""

import datetime as dt

from pyspark.sql import functions as F

from cursorlake.plans import lake_queries, flows
from cursorlake.sources.tables import read_range, scan_columns
from tests.conftest import SF_SMALL


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_events_scan_prunes_columns(spark):
    plan = _plan(flows.decoded(spark, SF_SMALL, "keydown"))
    assert "ReadSchema: struct<event_id:bigint,ts:timestamp_ntz,user_id:bigint>" in plan


def test_table_range_read_prunes_hours(spark):
    lake = lake_queries.ingested(spark, SF_SMALL, ("keydown",))
    t = lake.read("keydown")
    part = read_range(t, dt.datetime(2024, 1, 3, 10, 30), dt.datetime(2024, 1, 3, 14, 0))
    plan = part._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(ts_hour" in plan
    assert "PushedFilters: [IsNotNull(ts)" in plan
    n = part.count()
    lo, hi = dt.datetime(2024, 1, 3, 10, 30), dt.datetime(2024, 1, 3, 14, 0)
    assert n == t.where((F.col("ts") >= lo) & (F.col("ts") < hi)).count()
    cols = scan_columns(t, "timestamp", "ts")
    assert "ReadSchema: struct<timestamp:bigint,ts:timestamp>" in _plan(cols)
