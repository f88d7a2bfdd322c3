"""Row counts of event tables from Parquet footers alone (A1, and what O2 and the
rewriting of closed hours need to know).

The v2 Parquet reader answers COUNT, also per partition, from the footers of the
files (``PushedAggregation`` in the plan): no row is read, whatever the table's
size. The two settings that this takes live in a session of its own, which shares
the catalog, so the caller's session keeps its settings.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cursorlake.session import pin_zone
from cursorlake.sinks.tables import Lakehouse


def footer_session(spark: SparkSession) -> SparkSession:
    """A session that reads Parquet by the v2 reader with aggregate push-down."""
    other = spark.newSession()
    pin_zone(other)
    other.conf.set("spark.sql.sources.useV1SourceList", "")
    other.conf.set("spark.sql.parquet.aggregatePushdown", "true")
    return other


def footer_scan(lake: Lakehouse, kind: str) -> DataFrame:
    """The table's files through the v2 reader (a stream's files by its commit log)."""
    return _scan(lake.spark, lake.location(kind), lake.read(kind))


def _scan(spark: SparkSession, location: str, table: DataFrame) -> DataFrame:
    return footer_session(spark).read.schema(table.schema).parquet(location)


def count_rows(lake: Lakehouse, kind: str) -> DataFrame:
    """A1: ``SELECT COUNT(*)`` (n) from the footers."""
    return footer_scan(lake, kind).agg(F.count(F.lit(1)).alias("n"))


def count_by_hour(lake: Lakehouse, kind: str) -> DataFrame:
    """(ts_hour, n) per hour partition, from the footers; a NULL hour is one."""
    return footer_scan(lake, kind).groupBy("ts_hour").agg(F.count(F.lit(1)).alias("n"))
