"""The reading side: A1 count_events, A2 events_per_minute, O1 newest_first,
O2 newest_n, O3 sample_rows.

The reference pulls the whole table into one pandas frame and sorts and
resamples it there. Here each report is a Spark plan: counts aggregate
partially on every partition before the shuffle, the top-n is a
``TakeOrderedAndProject`` (per-partition top-n, then a merge of n rows per
partition), and only the final rows reach the driver.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cursorlake.functions.time import LOCAL_ZONE, epoch_ms_to_ts, minute_bucket, wallclock


def count_events(df: DataFrame) -> DataFrame:
    """A1: ``SELECT COUNT(*)`` (the scan reads no columns)."""
    return df.agg(F.count(F.lit(1)).alias("n"))


def _instant(df: DataFrame, col: str) -> Column:
    dtype = df.schema[col].dataType.simpleString()
    if dtype == "bigint":
        return epoch_ms_to_ts(col)
    if dtype == "timestamp_ntz":
        return F.col(col).cast("timestamp")  # UTC wall clock, session pinned to UTC
    return F.col(col)


def events_per_minute(df: DataFrame, time_col: str = "timestamp",
                      zone: str | None = LOCAL_ZONE) -> DataFrame:
    """A2: rows per minute of ``time_col``, with a 0 row for every empty minute
    between the first and the last; no input, no rows. Minutes are those of UTC
    and are shown in local time last, so where clocks change an hour that is
    repeated shows twice and one that is skipped not at all.

    Plan: (1) count per minute -- partial aggregation, then one shuffle of
    at most one row per minute and partition; (2) the minute spine is built
    from the counts' min and max, one row per day exploded to its minutes,
    so no task ever holds more than a day (1,440 rows) of spine before the
    shuffle; (3) a left equi-join of spine and counts on the minute. Both
    join sides grow with the time span, not with the event count; the
    counts are reused from step (1) (one exchange, reused).
    """
    # rows without a time have no bin; the explicit filter also keeps both
    # uses of ``counts`` identical (the join would infer it on one side
    # only), so their exchange is computed once and reused
    counts = (df.select(minute_bucket(_instant(df, time_col)).alias("minute"))
                .where(F.col("minute").isNotNull())
                .groupBy("minute").agg(F.count(F.lit(1)).alias("n")))
    # min/max over the counts, written so that they read ``n``: min/max of a
    # grouping key would otherwise be rewritten to run over the raw rows,
    # computing the whole input a second time instead of reusing the counts.
    present = F.when(F.col("n") > 0, F.col("minute"))
    bounds = counts.agg(F.min(present).alias("lo"), F.max(present).alias("hi"))
    day = F.col("day")
    days = bounds.where(F.col("lo").isNotNull()).select(
        "lo", "hi",
        F.explode(F.sequence(F.date_trunc("DAY", F.col("lo")).cast("timestamp_ntz"),
                             F.date_trunc("DAY", F.col("hi")).cast("timestamp_ntz"),
                             F.expr("INTERVAL 1 DAY"))).alias("day"))
    spine = (days.repartition("day")
                 .select(F.explode(F.sequence(
                     F.greatest(day, F.col("lo")),
                     F.least(day + F.expr("INTERVAL 1439 MINUTES"), F.col("hi")),
                     F.expr("INTERVAL 1 MINUTE"))).alias("minute")))
    return (spine.join(counts, "minute", "left")
                 .select(wallclock(F.col("minute").cast("timestamp"), zone).alias("minute"),
                         F.coalesce(F.col("n"), F.lit(0)).cast("long").alias("n")))


def newest_first(df: DataFrame, time_col: str = "timestamp", tie: str | None = "event_id") -> DataFrame:
    """O1: all rows, newest first (a tie-break makes the order total)."""
    keys = [F.col(time_col).desc()] + ([F.col(tie).asc()] if tie and tie in df.columns else [])
    return df.orderBy(*keys)


def newest_n(df: DataFrame, n: int = 50, time_col: str = "timestamp",
             tie: str | None = "event_id") -> DataFrame:
    """O2: the newest ``n`` rows (TakeOrderedAndProject, no full sort)."""
    return newest_first(df, time_col, tie).limit(n)


def sample_rows(df: DataFrame, n: int = 5) -> DataFrame:
    """O3: any ``n`` rows, no order (``LIMIT n``)."""
    return df.limit(n)
