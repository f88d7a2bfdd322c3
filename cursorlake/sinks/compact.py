"""K6: large files for the closed hours of a table that a stream writes.

A live stream writes a file per task, hour and trigger. Its table cannot be
rewritten in place: its readers follow the stream's commit log. So the hours that
are over are written once more, to files of about the target size, into a second
table of the same columns, the closed table, by dynamic partition overwrite.

``read_compacted`` takes each hour from exactly one of the two tables: from the closed
one if both hold the same number of rows of it (by the footers), else from the
stream's. The stream's table only grows, so equal counts mean equal rows. A late row, a
rewrite that failed half way or one under way make the counts differ, and the reader
falls back to the stream's files for that hour until the next rewrite: it sees no row
twice and misses none.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cursorlake.schemas import table_name
from cursorlake.sinks.tables import TARGET_FILE_BYTES, Lakehouse
from cursorlake.sources.footers import _scan, count_by_hour


def closed_name(lake: Lakehouse, kind: str) -> str:
    return f"`{lake.namespace}`.`{table_name(kind)}_closed`"


def _closed_exists(lake: Lakehouse, kind: str) -> bool:
    return lake.spark.catalog.tableExists(f"{lake.namespace}.{table_name(kind)}_closed")


def _closed_counts(lake: Lakehouse, kind: str) -> DataFrame:
    name = closed_name(lake, kind)
    place = lake.spark.sql(f"DESCRIBE TABLE EXTENDED {name}").where("col_name = 'Location'").first()["data_type"]
    return _scan(lake.spark, place, lake.spark.table(name)).groupBy("ts_hour").agg(F.count(F.lit(1)).alias("n"))


def _hours(rows: list, before: dt.datetime | None = None) -> dict[dt.datetime, int]:
    return {r["ts_hour"]: r["n"] for r in rows if r["ts_hour"] is not None and (before is None or r["ts_hour"] < before)}


def stale_hours(lake: Lakehouse, kind: str, before: dt.datetime) -> list[dt.datetime]:
    """The hours that end by ``before`` (UTC) whose rows are not all in the closed
    table. One row per hour reaches the driver."""
    last = before.replace(minute=0, second=0, microsecond=0)
    live = _hours(count_by_hour(lake, kind).collect(), last)
    done = _hours(_closed_counts(lake, kind).collect()) if _closed_exists(lake, kind) else {}
    return sorted(h for h, n in live.items() if done.get(h) != n)


def compact_closed(lake: Lakehouse, kind: str, before: dt.datetime, target_bytes: int = TARGET_FILE_BYTES) -> list[dt.datetime]:
    """Write the stale hours that end by ``before`` (the stream's watermark, or now)
    into the closed table, and return them. REBALANCE by hour lets AQE merge the
    small hours and split the large ones to files of about ``target_bytes``. Repeating
    it, also after a failure, rewrites only hours that are not complete."""
    hours = stale_hours(lake, kind, before)
    if not hours:
        return []
    if not _closed_exists(lake, kind):
        lake.spark.sql(f"CREATE TABLE {closed_name(lake, kind)} LIKE {lake.name(kind)}")
    size = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    before_size = lake.spark.conf.get(size)
    lake.spark.conf.set(size, str(target_bytes))
    try:
        (lake.read(kind).where(F.col("ts_hour").isin(hours)).hint("rebalance", "ts_hour")
         .write.option("partitionOverwriteMode", "dynamic").mode("overwrite").insertInto(closed_name(lake, kind)))
    finally:
        lake.spark.conf.set(size, before_size)
    return hours


def compacted_hours(lake: Lakehouse, kind: str) -> list[dt.datetime]:
    """The hours that the closed table holds in full."""
    if not _closed_exists(lake, kind):
        return []
    live = _hours(count_by_hour(lake, kind).collect())
    return sorted(h for h, n in _hours(_closed_counts(lake, kind).collect()).items() if live.get(h) == n)


def read_compacted(lake: Lakehouse, kind: str) -> DataFrame:
    """The rows of the table, each hour from the closed table or from the stream's."""
    hours = compacted_hours(lake, kind)
    if not hours:
        return lake.read(kind)
    inside = F.col("ts_hour").isin(hours)
    return lake.spark.table(closed_name(lake, kind)).where(inside).unionByName(
        lake.read(kind).where(~inside | F.col("ts_hour").isNull()))
