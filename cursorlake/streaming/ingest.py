"""Continuous ingest: topic -> decode -> event time -> hour-partitioned table
(K3 ingest_mouse, K4 ingest_keydown, W1 event_time_watermark,
W2 checkpointed_ingest, W4 multi_topic_ingest, K10 missing_table_skip).

One Structured Streaming query per event kind. The checkpoint plus the file
sink's commit log give exactly-once output: a restarted query resumes after
the last committed batch, and a batch that is replayed after a failure
overwrites nothing and adds nothing twice.

A stream may start in a new process: its checkpoint belongs to the table. If the
table's log is ahead of it, the start fails rather than skip rows.

Distribution: a live query writes straight from the source partitions,
with no shuffle. A hash shuffle by ``ts_hour`` (the streaming job's
setting) would send the live hour -- nearly every row of a micro-batch --
to one task; without it every task writes its own file for the hours it
holds. A catch-up run (``available_now``) holds many hours per batch and is
range-partitioned by time first (``cluster_by_time``) so that files stay
few and large; the topic bounds its batches (``max_rows`` or ``max_files``).
``rows_per_file`` caps file size (128 MB at ~400 B per row).
"""

from __future__ import annotations

import logging

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from cursorlake.functions.decode import decode_lenient
from cursorlake.functions.time import with_event_time
from cursorlake.operators.project import project
from cursorlake.sinks.tables import Lakehouse
from cursorlake.sources.topic import read_topic
from cursorlake.schemas import table_name
from cursorlake.streaming.counts import received, written

log = logging.getLogger(__name__)

WATERMARK_DELAY = "3 seconds"     # fixed value: allowed lateness
CHECKPOINT_INTERVAL = "30 seconds"  # fixed value: commit cadence of the live job
ROWS_PER_FILE = 128 * 1024 * 1024 // 400


def ingest_frame(source: DataFrame, kind: str, extra=None, watermark: str = WATERMARK_DELAY) -> DataFrame:
    """The per-row part of the ingest, usable on a batch or a stream."""
    rows = decode_lenient(source, kind, extra=extra)
    rows = project(with_event_time(project(rows, kind, "payload", extra)), kind, "sink", extra)
    # Declared for event time; the query is stateless, so no row is dropped.
    return rows.withWatermark("ts", watermark)


def cluster_by_time(rows: DataFrame, partitions: int | None = None) -> DataFrame:
    """Range-partition a catch-up batch of raw messages by their time stamp: a
    long backlog is cut into ``partitions`` contiguous time slices, so each task
    writes a few hours (not every task every hour) and a hot hour is still
    split over several tasks. The messages are moved before they are decoded:
    finding the ranges reads one field, and decoding happens once. Live
    micro-batches skip this (no shuffle)."""
    n = partitions or int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return rows.repartitionByRange(n, F.get_json_object("value", "$.timestamp").try_cast("bigint"))


def start_ingest(lake: Lakehouse, kind: str, source: DataFrame, extra=None,
                 available_now: bool = False, interval: str = CHECKPOINT_INTERVAL,
                 rows_per_file: int | None = ROWS_PER_FILE, query_name: str | None = None,
                 watermark: str = WATERMARK_DELAY) -> StreamingQuery:
    """K3/K4 + W2: start the ingest of one kind into ``lake``'s table."""
    lake.create_if_absent(kind, "sink", extra)
    checkpoint = lake.checkpoint("ingest", kind)
    lake.check_writable(kind, checkpoint)
    source = received(cluster_by_time(source) if available_now else source)
    rows = written(ingest_frame(source, kind, extra, watermark), "ts")
    writer = (rows.writeStream.format(lake.fmt)
              .partitionBy("ts_hour")
              .option("checkpointLocation", checkpoint)
              .option("compression", "zstd")
              .outputMode("append"))
    if rows_per_file:
        writer = writer.option("maxRecordsPerFile", str(rows_per_file))
    if query_name:
        writer = writer.queryName(query_name)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime=interval)
    return writer.toTable(lake.name(kind))


def ingest_topics(lake: Lakehouse, kinds=("mouse", "keydown"), fmt: str = "text",
                  topic_root: str | None = None, servers: str | None = None, extra=None,
                  available_now: bool = False, require_table: bool = False, **source) -> dict[str, StreamingQuery]:
    """One independent query per topic. With ``require_table`` a kind
    whose table is absent is skipped with a warning (K10). ``source`` goes to
    ``read_topic``."""
    queries = {}
    for kind in kinds:
        if require_table and not lake.exists(kind):
            log.warning("table %s does not exist; topic %s skipped", lake.name(kind), table_name(kind))
            continue
        src = read_topic(lake.spark, table_name(kind), fmt, root=topic_root, servers=servers, **source)
        queries[kind] = start_ingest(lake, kind, src, extra, available_now=available_now)
    return queries


def await_all(queries: dict[str, StreamingQuery] | list[StreamingQuery], poll_seconds: float = 1.0) -> None:
    """Wait until every query has ended; if one fails, stop the others and
    raise its error (available-now runs end by themselves)."""
    waiting = list(queries.values() if isinstance(queries, dict) else queries)
    while waiting:
        for q in list(waiting):
            try:
                ended = q.awaitTermination(poll_seconds)
            except Exception:
                for other in waiting:
                    if other.isActive:
                        other.stop()
                raise
            if ended:
                waiting.remove(q)
