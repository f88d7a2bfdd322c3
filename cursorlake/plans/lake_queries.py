"""Registered queries that write: topics, streaming ingest, tables, DDL and
inspection. Each call works in fresh folders under the shared root and a
namespace of its own, runs its streams with ``availableNow`` and returns a
batch DataFrame over what was written.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cursorlake.operators.project import project
from cursorlake.plans import flows
from cursorlake.plans.registry import register
from cursorlake.schemas import table_name
from cursorlake.session import work_dir
from cursorlake.sinks.compact import compact_closed, read_compacted
from cursorlake.sinks.tables import Lakehouse
from cursorlake.sinks.topic import write_topics
from cursorlake.sources import files
from cursorlake.sources.footers import count_by_hour
from cursorlake.sources.newest import newest_rows
from cursorlake.sources.events import EXTRA_FIELDS, is_mouse
from cursorlake.sources.tables import scan_columns as _scan_columns
from cursorlake.sources.topic import read_topic
from cursorlake.streaming.ingest import await_all, ingest_topics, start_ingest
from cursorlake.streaming.supervise import supervise


def new_lake(spark: SparkSession) -> Lakehouse:
    """A namespace of its own for one query."""
    return Lakehouse(spark, namespace=f"user_events_{uuid.uuid4().hex[:10]}")


def drop_topics(spark: SparkSession, sf_dir: str, root: str, where=None, kinds=("mouse", "keydown")) -> None:
    """K1 end to end: route the derived payloads of ``kinds`` and append them to
    the file topics (one delivery)."""
    wanted = flows.routed(spark, sf_dir, where)
    if len(kinds) == 1:
        wanted = wanted.where(is_mouse(F.col("event_id")) if kinds[0] == "mouse" else ~is_mouse(F.col("event_id")))
    write_topics(wanted, "text", root)


def ingested(spark: SparkSession, sf_dir: str, kinds=("mouse", "keydown")) -> Lakehouse:
    lake = new_lake(spark)
    topics = work_dir(spark, "topics")
    drop_topics(spark, sf_dir, topics, kinds=kinds)
    await_all(ingest_topics(lake, kinds, topic_root=topics, extra=EXTRA_FIELDS, available_now=True))
    return lake


def _counts(lake: Lakehouse, kinds) -> DataFrame:
    parts = [lake.read(k).agg(F.count(F.lit(1)).alias("n")).select(F.lit(table_name(k)).alias("table"), "n")
             for k in kinds if lake.exists(k)]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


# --- S1 / S2 -----------------------------------------------------------------

@register("source_topic")
def source_topic(spark, sf_dir):
    """The mouse topic read as a stream; which messages arrived."""
    topics, out = work_dir(spark, "topics"), work_dir(spark, "raw")
    drop_topics(spark, sf_dir, topics, kinds=("mouse",))
    q = (read_topic(spark, "mouse_events", root=topics)
         .writeStream.format("parquet").option("checkpointLocation", out + "/_cp")
         .trigger(availableNow=True).start(out + "/data"))
    await_all([q])
    raw = spark.read.parquet(out + "/data")
    return raw.select(F.get_json_object("value", "$.event_id").cast("long").alias("event_id"))


# --- K3 / K4 / K6 / W4 ----------------------------------------------------------

@register("ingest_mouse")
def ingest_mouse(spark, sf_dir):
    """K3: mouse topic -> mouse_events table (read back)."""
    return flows.presentable(ingested(spark, sf_dir, ("mouse",)).read("mouse"))


@register("ingest_keydown")
def ingest_keydown(spark, sf_dir):
    """K4: keydown topic -> keydown_events table (read back)."""
    return flows.presentable(ingested(spark, sf_dir, ("keydown",)).read("keydown"))


@register("multi_topic_ingest")
def multi_topic_ingest(spark, sf_dir):
    """One query per topic, both run; rows per table."""
    return _counts(ingested(spark, sf_dir), ("mouse", "keydown"))


@register("partitioned_table")
def partitioned_table(spark, sf_dir):
    """K6: mouse rows appended as a batch, dealt out by hour; rows per hour
    partition."""
    lake = new_lake(spark)
    lake.create_if_absent("mouse", "sink", EXTRA_FIELDS)
    lake.append_batch(project(flows.decoded(spark, sf_dir, "mouse"), "mouse", "sink", EXTRA_FIELDS), "mouse")
    return flows.presentable(lake.read("mouse").groupBy("ts_hour").agg(F.count(F.lit(1)).alias("n")))


@register("supervised_ingest")
def supervised_ingest(spark, sf_dir):
    """W4, independent topics: the keydown query fails at its first start and in its
    first batch, and is started again; rows per table."""
    lake, topics = new_lake(spark), work_dir(spark, "topics")
    drop_topics(spark, sf_dir, topics)
    starts = {"mouse": 0, "keydown": 0}

    def starter(kind):
        def start():
            starts[kind] += 1
            if kind == "keydown" and starts[kind] == 1:
                raise ConnectionError("no broker")
            source = read_topic(spark, table_name(kind), root=topics)
            if kind == "keydown" and starts[kind] == 2:
                source = source.select(F.when(F.length("value") > 0, F.raise_error(F.lit("broken batch"))).otherwise(F.col("value")).alias("value"))
            return start_ingest(lake, kind, source, EXTRA_FIELDS, available_now=True)
        return start

    supervise({kind: starter(kind) for kind in starts}, shortest=0.1)
    return _counts(lake, ("mouse", "keydown"))


# --- W1 / W2: late rows and restarts -------------------------------------------

def _two_deliveries(spark, sf_dir, kind, first, second) -> Lakehouse:
    lake = new_lake(spark)
    topics = work_dir(spark, "topics")
    for part in (first, second, None):
        if part is not None:
            drop_topics(spark, sf_dir, topics, part, kinds=(kind,))
        # each run finds the namespace's place and the table's checkpoint anew,
        # as another process would; the last one must add nothing
        again = Lakehouse(spark, namespace=lake.namespace)
        await_all(ingest_topics(again, (kind,), topic_root=topics, extra=EXTRA_FIELDS, available_now=True))
    return lake


@register("event_time_watermark")
def event_time_watermark(spark, sf_dir):
    """The later half arrives first; the earlier half is then hours
    behind the watermark and must still be written."""
    early, late = flows.time_split(spark, sf_dir)
    lake = _two_deliveries(spark, sf_dir, "keydown", late, early)
    return flows.presentable(lake.read("keydown").select("event_id", "timestamp", "ts", "ts_hour"))


@register("checkpointed_ingest")
def checkpointed_ingest(spark, sf_dir):
    """Run, stop, deliver more, run again, run once more with nothing
    new: every message is in the table exactly once."""
    early, late = flows.time_split(spark, sf_dir)
    lake = _two_deliveries(spark, sf_dir, "mouse", early, late)
    return flows.presentable(lake.read("mouse").select("event_id", "user_id", "timestamp", "ts"))


# --- S5 / S6 / S7 / S9 / S10 / S11 / F2 -------------------------------------------

@register("scan_table")
def scan_table(spark, sf_dir):
    """Full scan of the keydown table through SQL."""
    lake = ingested(spark, sf_dir, ("keydown",))
    return flows.presentable(spark.sql(f"SELECT * FROM {lake.name('keydown')}"))


@register("scan_columns")
def scan_columns(spark, sf_dir):
    """``timestamp, ts`` of the mouse table."""
    lake = ingested(spark, sf_dir, ("mouse",))
    return flows.presentable(_scan_columns(lake.read("mouse"), "timestamp", "ts"))


@register("table_files")
def table_files(spark, sf_dir):
    """The data files of the mouse table, summed up by hour: the names and
    number of files depend on the writer, their rows do not."""
    lake = ingested(spark, sf_dir, ("mouse",))
    found = files.table_files(lake.read("mouse"))
    hour = F.regexp_extract(F.url_decode(F.url_decode("file_path")), r"ts_hour=([^/]*)/", 1).cast("timestamp_ntz")
    return found.groupBy(hour.alias("ts_hour")).agg(F.sum("rows").alias("n"), F.min(F.col("file_size") > 0).alias("has_bytes"))


@register("latest_file")
def latest_file(spark, sf_dir):
    """The newest data file of the mouse table: how many, and whether it
    is one of the table's files."""
    lake = ingested(spark, sf_dir, ("mouse",))
    newest = files.latest_file(spark, lake.location("mouse"), "data")
    known = files.table_files(lake.read("mouse")).select("file_path", F.lit(1).alias("known"))
    name = F.element_at(F.split(F.col("path"), "/"), -1)
    return newest.join(known, name == F.element_at(F.split("file_path", "/"), -1), "left").agg(
        F.count(F.lit(1)).alias("n"), F.count("known").alias("n_known"))


@register("file_name_filter")
def file_name_filter(spark, sf_dir):
    """files of the mouse table by the explorer's rules, with their rows."""
    lake = ingested(spark, sf_dir, ("mouse",))
    listing = files.list_files(spark, lake.location("mouse"))
    kind = F.lit(None).cast("string")
    for name in reversed(list(files.FILE_RULES)):
        kind = F.when(files.file_name_filter(F.col("path"), name), F.lit(name)).otherwise(kind)
    rows = files.table_files(lake.read("mouse")).select(F.element_at(F.split("file_path", "/"), -1).alias("name"), "rows")
    found = listing.select(F.element_at(F.split("path", "/"), -1).alias("name"), kind.alias("kind")).where("kind IS NOT NULL")
    return found.join(rows, "name", "left").groupBy("kind").agg(F.sum("rows").alias("n"))


@register("scan_parquet_file")
def scan_parquet_file(spark, sf_dir):
    """Head of the newest data file of the keydown table: how many rows
    came and how many are events."""
    lake = ingested(spark, sf_dir, ("keydown",))
    newest = files.latest_file(spark, lake.location("keydown"), "data").first()
    head = files.scan_parquet_file(spark, newest["path"], 1)
    known = lake.read("keydown").select("event_id", F.lit(1).alias("known"))
    return head.join(known, "event_id", "left").agg(F.count(F.lit(1)).alias("n"), F.count("known").alias("n_events"))


@register("list_tables")
def list_tables(spark, sf_dir):
    """Tables of the namespace after ingesting both topics."""
    lake = ingested(spark, sf_dir)
    return files.list_tables(spark, lake.namespace).select("table")


# --- O2 / A1 / K6 over the table's partitions and footers ---------------------------

@register("newest_n_table")
def newest_n_table(spark, sf_dir):
    """O2: the newest 50 rows of the mouse table, from its newest hours only."""
    lake = ingested(spark, sf_dir, ("mouse",))
    return flows.presentable(newest_rows(lake.read("mouse"), 50).select("event_id", "timestamp", "ts", "ts_hour"))


@register("count_from_footers")
def count_from_footers(spark, sf_dir):
    """A1: rows per hour of the mouse table, from the footers of its files."""
    return count_by_hour(ingested(spark, sf_dir, ("mouse",)), "mouse")


@register("compact_closed_hours")
def compact_closed_hours(spark, sf_dir):
    """K6 for a streamed table: the first half is written anew by hour, then the
    second half and rows that are late for the first arrive; each row is read once,
    before and after the late hours are written again."""
    early, late = flows.time_split(spark, sf_dir)
    lake, topics = new_lake(spark), work_dir(spark, "topics")
    behind = F.col("event_id") % 50 == 0
    newest = []
    for part in (early & ~behind, late | (early & behind)):
        drop_topics(spark, sf_dir, topics, part, kinds=("mouse",))
        await_all(ingest_topics(lake, ("mouse",), topic_root=topics, extra=EXTRA_FIELDS, available_now=True))
        newest.append(lake.read("mouse").agg(F.max("ts_hour")).first()[0])
        if len(newest) == 1:
            compact_closed(lake, "mouse", newest[0])
    before = read_compacted(lake, "mouse").agg(F.count(F.lit(1)).alias("n"), F.countDistinct("event_id").alias("d")).first()
    compact_closed(lake, "mouse", newest[1])
    return flows.presentable(read_compacted(lake, "mouse").select(
        "event_id", "timestamp", "ts_hour", F.lit(before["n"]).cast("long").alias("n_before"), F.lit(before["d"]).cast("long").alias("events_before")))


# --- K7 / K8 / K9 / K10 --------------------------------------------------------------

@register("create_namespace")
def create_namespace(spark, sf_dir):
    """K7: creating the namespace again is a no-op; the data stays."""
    lake = ingested(spark, sf_dir, ("keydown",))
    lake.create_namespace()
    return _counts(lake, ("keydown",))


@register("create_if_absent")
def create_if_absent(spark, sf_dir):
    """K9: CREATE TABLE IF NOT EXISTS leaves an existing table untouched."""
    lake = ingested(spark, sf_dir, ("mouse",))
    lake.create_if_absent("mouse", "sink", EXTRA_FIELDS)
    return _counts(lake, ("mouse",))


@register("recreate_table")
def recreate_table(spark, sf_dir):
    """K8: ingest, drop and create, then ingest again: one copy."""
    lake = new_lake(spark)
    topics = work_dir(spark, "topics")
    drop_topics(spark, sf_dir, topics, kinds=("keydown",))
    for again in (False, True):
        if again:
            lake.recreate_table("keydown", "sink", EXTRA_FIELDS)
        await_all([start_ingest(lake, "keydown", read_topic(spark, "keydown_events", root=topics),
                                EXTRA_FIELDS, available_now=True)])
    return _counts(lake, ("keydown",))


@register("missing_table_skip")
def missing_table_skip(spark, sf_dir):
    """Only the mouse table exists; the keydown topic is skipped."""
    lake = new_lake(spark)
    lake.create_if_absent("mouse", "sink", EXTRA_FIELDS)
    topics = work_dir(spark, "topics")
    drop_topics(spark, sf_dir, topics)
    await_all(ingest_topics(lake, ("mouse", "keydown"), topic_root=topics, extra=EXTRA_FIELDS,
                            available_now=True, require_table=True))
    return _counts(lake, ("mouse", "keydown"))


# --- W5 on a stream ------------------------------------------------------------------

@register("active_shape_stream")
def active_shape_stream(spark, sf_dir):
    """W5 streaming: two deliveries in time order; the active shape per user
    is carried across micro-batches in the state store."""
    from cursorlake.functions.decode import decode_lenient
    from cursorlake.streaming.active_shape import active_shape_stream as _stream
    early, late = flows.time_split(spark, sf_dir)
    topics, out = work_dir(spark, "topics"), work_dir(spark, "active")
    for part in (early, late):
        drop_topics(spark, sf_dir, topics, part, kinds=("mouse",))
        src = read_topic(spark, "mouse_events", root=topics)
        rows = decode_lenient(src, "mouse", extra=EXTRA_FIELDS).select(
            "user_id", "event_id", "timestamp", "event_type",
            F.get_json_object("shape", "$.id").alias("shape_id"))
        q = (_stream(rows).writeStream.format("parquet").outputMode("append")
             .option("checkpointLocation", out + "/_cp").trigger(availableNow=True).start(out + "/data"))
        await_all([q])
    return spark.read.parquet(out + "/data")


def _closing_tick(spark, sf_dir, topics, ahead_ms) -> None:
    """One more message, of the newest mouse event, ``ahead_ms`` later: it moves the
    watermark past all events and is itself not answered."""
    newest = flows.load_table(spark, sf_dir, "events").where(is_mouse(F.col("event_id"))).agg(F.max_by("event_id", "ts")).first()[0]
    stamp = F.get_json_object("value", "$.timestamp").cast("long")
    tick = flows.routed(spark, sf_dir, F.col("event_id") == newest).withColumn("stamp", stamp)
    write_topics(tick.withColumn("value", F.replace("value", F.col("stamp").cast("string"),
                                                    (F.col("stamp") + ahead_ms).cast("string"))), "text", topics)


@register("active_shape_in_order")
def active_shape_in_order(spark, sf_dir):
    """W5 streaming in event-time order: the second delivery brings every fifth event of
    the hour before it, late but within the watermark's delay. The answer is that of
    the batch form."""
    from cursorlake.functions.decode import decode_lenient
    from cursorlake.streaming.active_shape_ordered import active_shape_in_order as _stream
    early, late = flows.time_split(spark, sf_dir)
    cut = flows.load_table(spark, sf_dir, "events").where(early).agg(F.max("ts")).first()[0]
    held = early & (F.col("event_id") % 5 == 0) & (F.col("ts") > F.lit(cut) - F.expr("INTERVAL 1 HOUR"))
    topics, out = work_dir(spark, "topics"), work_dir(spark, "active")
    for part in (early & ~held, late | held, None):
        if part is None:
            _closing_tick(spark, sf_dir, topics, 4 * 3_600_000)
        else:
            drop_topics(spark, sf_dir, topics, part, kinds=("mouse",))
        rows = decode_lenient(read_topic(spark, "mouse_events", root=topics), "mouse", extra=EXTRA_FIELDS).select(
            "user_id", "event_id", "timestamp", "event_type", F.get_json_object("shape", "$.id").alias("shape_id"))
        q = (_stream(rows, delay="2 hours", slice_ms=3_600_000).writeStream.format("parquet").outputMode("append")
             .option("checkpointLocation", out + "/_cp").trigger(availableNow=True).start(out + "/data"))
        await_all([q])
    return spark.read.parquet(out + "/data")
