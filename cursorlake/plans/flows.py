"""Reusable lazy flows from the given tables to decoded event rows.

``messages`` -> K1 routing -> one topic -> S3 decode -> P1/P2 projection ->
P3/P4 event time. Nothing here writes; the flows are plain DataFrames that
the streaming and table layers reuse.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cursorlake.functions.decode import decode_lenient
from cursorlake.functions.payload import route_to_topic
from cursorlake.functions.time import with_event_time, wallclock
from cursorlake.operators.project import project
from cursorlake.schemas import table_name
from cursorlake.session import pin_zone
from cursorlake.sources.events import (EXTRA_FIELDS, is_mouse, load_events, load_table, payload_messages,
                                       with_dirty)


def spread(spark: SparkSession) -> int:
    """One partition per core: the given ``events`` are one small file."""
    return spark.sparkContext.defaultParallelism


def messages(spark: SparkSession, sf_dir: str, where: Column | None = None) -> DataFrame:
    """(event_id, user_id, value): one JSON payload per given event
    (``where`` selects events, e.g. one delivery of a time-split stream)."""
    pin_zone(spark)
    events = load_events(spark, sf_dir, spread(spark))
    if where is not None:
        events = events.where(where)
    return payload_messages(events)


def routed(spark: SparkSession, sf_dir: str, where: Column | None = None) -> DataFrame:
    """K1 over the payloads: (event_id, user_id, topic, key, value)."""
    return route_to_topic(messages(spark, sf_dir, where), keep=("event_id", "user_id"))


def time_split(spark: SparkSession, sf_dir: str) -> tuple[Column, Column]:
    """Predicates for the earlier and the later half of the events' time
    span (two deliveries of one stream). Only min/max reach the driver."""
    lo, hi = load_table(spark, sf_dir, "events").agg(F.min("ts"), F.max("ts")).first()
    mid = lo + (hi - lo) / 2
    ts = F.col("ts")
    return ts < F.lit(mid), ts >= F.lit(mid)


def topic_messages(spark: SparkSession, sf_dir: str, kind: str, dirty: bool = False) -> DataFrame:
    """The ``value`` column of one topic, as a consumer would see it; ``dirty``
    mixes in messages that are malformed or oddly typed.

    Every derived payload carries ``stream = kind``, so K1 sends exactly the
    payloads of that kind to ``<kind>_events`` (checked by the
    ``route_to_topic`` query); selecting them by kind here keeps the batch
    flow from parsing each message twice.
    """
    pin_zone(spark)
    events = load_events(spark, sf_dir, spread(spark))
    eid = F.col("event_id")
    part = is_mouse(eid) if kind == "mouse" else ~is_mouse(eid)
    sent = payload_messages(events.where(part))
    return (with_dirty(sent) if dirty else sent).select("value")


def both_kinds(of_kind) -> DataFrame:
    """``of_kind(kind)`` for mouse and keydown in one frame, with ``kind`` first;
    columns that one kind lacks are NULL."""
    parts = [of_kind(k).select(F.lit(k).alias("kind"), "*") for k in ("mouse", "keydown")]
    return parts[0].unionByName(parts[1], allowMissingColumns=True)


def as_text(df: DataFrame) -> DataFrame:
    """Every column as text: how engines hand over NULLs among integers differs."""
    return df.select(*[F.col(c).cast("string").alias(c) for c in df.columns])


def decoded(spark: SparkSession, sf_dir: str, kind: str, event_time: bool = True,
            columns: tuple[str, ...] | None = None, dirty: bool = False) -> DataFrame:
    """Decoded rows of one kind with the extra key columns (user_id, event_id);
    ``columns`` limits decoding to the fields a query reads."""
    rows = decode_lenient(topic_messages(spark, sf_dir, kind, dirty), kind, extra=EXTRA_FIELDS, columns=columns)
    if columns is None:
        rows = project(rows, kind, "payload", EXTRA_FIELDS)
    return with_event_time(rows) if event_time else rows


def presentable(df: DataFrame) -> DataFrame:
    """Instants -> UTC wall clock (TIMESTAMP_NTZ) for comparison with SQL."""
    out = df
    for f in df.schema.fields:
        if f.dataType.simpleString() == "timestamp":
            out = out.withColumn(f.name, wallclock(f.name))
    return out
