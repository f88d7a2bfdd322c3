"""O2 newest_n over an hour-partitioned table, bounded by its partitions.

A full top-n reads the time column of the whole table for 50 rows. Here the hours
are walked from the newest one, each step taking twice as many, until those taken
hold n rows by their footers. All rows of older hours are older than these, so
the top n of the hours taken is the table's, whatever order rows arrived in.

Rows without an hour (a stamp that is no event time, and NULL) may sort anywhere,
a stamp far in the future even first. So the NULL hour is always read as well. If
the hours end before n rows are found, the table is read in full.
"""

from __future__ import annotations

import datetime as dt
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cursorlake.operators.reports import newest_n

NO_HOUR = "__HIVE_DEFAULT_PARTITION__"  # fixed value: folder name of a NULL partition


def partition_hours(table: DataFrame, hour_col: str = "ts_hour") -> list[dt.datetime]:
    """The hours of a table's files, newest first, without NULL: from the listing
    that the driver holds of any table it plans, no file is opened."""
    found = set()
    for path in table.inputFiles():
        folder = next((p for p in path.split("/") if p.startswith(f"{hour_col}=")), None)
        if folder is None:
            raise ValueError(f"not partitioned by {hour_col}: {path}")
        found.add(unquote(unquote(folder.split("=", 1)[1])))
    return sorted((dt.datetime.fromisoformat(h) for h in found - {NO_HOUR}), reverse=True)


def from_hour(hour_col: str, oldest: dt.datetime) -> Column:
    """The hour and those after it, and the NULL hour."""
    return (F.col(hour_col) >= F.lit(oldest).cast("timestamp_ntz")) | F.col(hour_col).isNull()


def newest_rows(table: DataFrame, n: int = 50, time_col: str = "timestamp", tie: str | None = "event_id",
                hour_col: str = "ts_hour") -> DataFrame:
    """The newest ``n`` rows by ``time_col`` (epoch milliseconds or the instant that
    ``hour_col`` was floored from), as ``newest_n`` of the whole table."""
    hours, taken = partition_hours(table, hour_col), 1
    while taken < len(hours):
        some = table.where(from_hour(hour_col, hours[taken - 1]))
        if some.where(F.col(hour_col).isNotNull()).count() >= n:
            return newest_n(some, n, time_col, tie)
        taken *= 2
    return newest_n(table, n, time_col, tie)
