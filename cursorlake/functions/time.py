"""Event-time column functions (P3 epoch_ms_to_ts, P4 floor_hour, P5 to_local_time).

All are built-in expressions, so they stay inside whole-stage codegen.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed value: the zone the dashboard and the streaming job present time in.
LOCAL_ZONE = "Asia/Seoul"

# Years 1 to 9999: beyond them a number is no epoch-ms event time (micro- and
# nanosecond stamps fall here), and the conversion would overflow.
MS_RANGE = (-62135596800000, 253402300799999)


def is_event_ms(ms: Column) -> Column:
    """Whether epoch milliseconds lie in the range of event times."""
    return ms.between(*MS_RANGE)


def epoch_ms_to_ts(ms: Column | str) -> Column:
    """Epoch milliseconds -> TIMESTAMP (an instant, microsecond precision);
    NULL outside MS_RANGE."""
    c = F.col(ms) if isinstance(ms, str) else ms
    return F.when(is_event_ms(c), F.timestamp_millis(c))


def floor_hour(ts: Column | str) -> Column:
    """Truncate an instant to its hour (whole-hour zones make this zone-free)."""
    return F.date_trunc("HOUR", F.col(ts) if isinstance(ts, str) else ts)


def with_event_time(df: DataFrame, ms_col: str = "timestamp") -> DataFrame:
    """Add ``ts`` (P3) and ``ts_hour`` (P4) from an epoch-ms column."""
    return (df.withColumn("ts", epoch_ms_to_ts(ms_col))
              .withColumn("ts_hour", floor_hour("ts")))


def wallclock(ts: Column | str, zone: str | None = None) -> Column:
    """Instant -> TIMESTAMP_NTZ wall clock in ``zone`` (UTC when None).

    With the session pinned to UTC the cast alone gives the UTC wall clock;
    ``from_utc_timestamp`` shifts first when another zone is asked for.
    """
    c = F.col(ts) if isinstance(ts, str) else ts
    if zone and zone != "UTC":
        c = F.from_utc_timestamp(c, zone)
    return c.cast("timestamp_ntz")


def to_local_time(df: DataFrame, zone: str = LOCAL_ZONE,
                  columns: tuple[str, ...] = ("timestamp", "ts", "ts_hour")) -> DataFrame:
    """P5: present ``timestamp`` (epoch ms or NTZ), ``ts`` and ``ts_hour`` in
    local wall-clock time; each only if present. For display, never storage.
    """
    present = set(df.columns)
    out = df
    for name in columns:
        if name not in present:
            continue
        dtype = df.schema[name].dataType.simpleString()
        if dtype == "bigint":
            src = epoch_ms_to_ts(name)
        elif dtype == "timestamp_ntz":
            # loader tables keep UTC wall clock; reinterpret as an instant
            src = F.to_utc_timestamp(F.col(name).cast("timestamp"), "UTC")
        else:
            src = F.col(name)
        out = out.withColumn(name, wallclock(src, zone))
    return out


def minute_bucket(ts: Column) -> Column:
    """Minute of an instant, as UTC wall clock."""
    return F.date_trunc("MINUTE", ts).cast("timestamp_ntz")
