"""K5 append_microbatch: the loader path as a Structured Streaming job.

The reference's loader polls a topic, coerces each message with Python's
rules (P6/P7), and appends a batch as soon as 100 rows are waiting or 5 s have
passed; it re-reads the topic from the start after a restart. Here:

* on Kafka the same rule is ``minOffsetsPerTrigger`` with ``maxTriggerDelay``;
  a large ``maxOffsetsPerTrigger`` bounds a batch. The source decides when a batch
  starts, so the query has no interval of its own (``flush_interval``): one of 5 s
  would keep 100 rows waiting for its next tick. A file topic has no such rule and
  keeps the interval. The cut of batches is not visible in the result;
* one stream writes loaded rows and quarantined messages (those the reference
  would crash on, with their reasons) into one table, partitioned by status and
  hour. The file sink commits a batch as a whole and once, also after a failure
  or in another process; the checkpoint makes a restart resume, not re-read.
"""

from __future__ import annotations

import logging

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from cursorlake.functions.coerce import coerce_defaults, enforce_non_null, split_status
from cursorlake.functions.time import floor_hour
from cursorlake.schemas import schema_for_kind, table_name
from cursorlake.sinks.tables import Lakehouse
from cursorlake.sources.topic import MAX_ROWS, read_topic
from cursorlake.streaming.counts import received, written
from cursorlake.streaming.ingest import cluster_by_time

log = logging.getLogger(__name__)

FLUSH_ROWS = 100              # fixed value: rows that start a batch
FLUSH_INTERVAL = "5 seconds"  # fixed value: the longest wait for them


def flush_interval(fmt: str) -> str:
    """The trigger interval that leaves the flush rule to the source, if it has one."""
    return "0 seconds" if fmt == "kafka" else FLUSH_INTERVAL


def loaded_rows(coerced: DataFrame, kind: str, extra=None) -> DataFrame:
    names = schema_for_kind(kind, "loader", extra).names
    return enforce_non_null(split_status(coerced, "ok", names), kind, extra)


def quarantined_rows(coerced: DataFrame) -> DataFrame:
    return split_status(coerced, "quarantine", ["value", "reasons"])


def table_rows(source: DataFrame, kind: str, extra=None) -> DataFrame:
    """Rows of the loader table: the columns of a loaded row, or the message
    and its reasons; status and hour."""
    coerced = coerce_defaults(source, kind, extra=extra)
    good = F.col("status") == "ok"
    names = schema_for_kind(kind, "loader", extra).names
    kept = coerced.select(*[F.when(good, F.col(n)).alias(n) for n in names],
                          F.when(~good, F.col("value")).alias("value"), F.when(~good, F.col("reasons")).alias("reasons"),
                          "status")
    return kept.withColumn("ts_hour", floor_hour("timestamp").cast("timestamp_ntz"))


def loaded(lake: Lakehouse, kind: str, extra=None) -> DataFrame:
    """The loaded rows of a loader table, non-null."""
    return enforce_non_null(lake.read(kind).where("status = 'ok'"), kind, extra)


def quarantined(lake: Lakehouse, kind: str) -> DataFrame:
    """The messages kept aside, with their reasons."""
    return lake.read(kind).where("status = 'quarantine'").select("value", "reasons")


def start_loader(lake: Lakehouse, kind: str, source: DataFrame, extra=None,
                 available_now: bool = False, interval: str = FLUSH_INTERVAL) -> StreamingQuery:
    """Start the loader for one kind (the table is created if absent)."""
    lake.create_if_absent(kind, "loader", extra)
    checkpoint = lake.checkpoint("loader", kind)
    lake.check_writable(kind, checkpoint)
    source = received(cluster_by_time(source) if available_now else source)
    good = F.col("status") == "ok"
    rows = written(table_rows(source, kind, extra), "timestamp", loaded=good, quarantined=~good)
    writer = (rows.writeStream.format(lake.fmt)
              .partitionBy("status", "ts_hour")
              .option("checkpointLocation", checkpoint).option("compression", "zstd").outputMode("append"))
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime=interval)
    return writer.toTable(lake.name(kind))


def load_topics(lake: Lakehouse, kinds=("mouse", "keydown"), fmt: str = "text", topic_root: str | None = None,
                servers: str | None = None, extra=None, available_now: bool = False, min_rows: int = FLUSH_ROWS,
                max_delay: str = FLUSH_INTERVAL, max_rows: int = MAX_ROWS, require_table: bool = True,
                **source) -> dict[str, StreamingQuery]:
    """One loader per topic; a kind whose table is absent is skipped."""
    out = {}
    for kind in kinds:
        if require_table and not lake.exists(kind):
            log.warning("table %s does not exist; topic %s skipped", lake.name(kind), table_name(kind))
            continue
        src = read_topic(lake.spark, table_name(kind), fmt, root=topic_root, servers=servers, min_rows=min_rows,
                         max_delay=max_delay, max_rows=max_rows, **source)
        out[kind] = start_loader(lake, kind, src, extra, available_now=available_now, interval=flush_interval(fmt))
    return out
