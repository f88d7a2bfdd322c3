"""Reading event tables (S5 scan_table, S6 scan_columns) with pruning.

A filter on ``ts`` alone does not prune hour partitions: the partition
column is ``ts_hour``. ``read_range`` adds the matching ``ts_hour`` bounds,
so the scan lists only the hours in range (PartitionFilters) and the
``ts`` bounds still reach the Parquet reader (PushedFilters).
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def scan_columns(table: DataFrame, *columns: str) -> DataFrame:
    """Chosen columns only (pruned into the scan's ReadSchema)."""
    return table.select(*columns)


def _instant(t: dt.datetime) -> dt.datetime:
    """The instant in UTC; a time without a zone is taken as UTC, the zone of
    the session."""
    return t.replace(tzinfo=dt.timezone.utc) if t.tzinfo is None else t.astimezone(dt.timezone.utc)


def _hour_floor(t: dt.datetime) -> dt.datetime:
    return t.replace(minute=0, second=0, microsecond=0)


def read_range(table: DataFrame, start: dt.datetime | None = None, end: dt.datetime | None = None) -> DataFrame:
    """Rows with ``start <= ts < end`` (instants; without a zone: UTC)."""
    out = table
    if start is not None:
        start = _instant(start)
        out = out.where((F.col("ts_hour") >= F.lit(_hour_floor(start))) & (F.col("ts") >= F.lit(start)))
    if end is not None:
        end = _instant(end)
        out = out.where((F.col("ts_hour") <= F.lit(_hour_floor(end))) & (F.col("ts") < F.lit(end)))
    return out
