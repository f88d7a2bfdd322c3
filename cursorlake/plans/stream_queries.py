"""Registered queries of the streaming router (K1), the stream's hit test against a
changing table of shapes (J1 / J2 / F3) and the counts of batches (W1, F1, K5). Each works
in fresh folders under the shared root.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from cursorlake.functions.decode import decode_lenient
from cursorlake.functions.payload import route_to_topic
from cursorlake.functions.shapes import TEST_SHAPES
from cursorlake.operators.hit_test import shapes_frame
from cursorlake.plans import flows
from cursorlake.plans.lake_queries import drop_topics, new_lake
from cursorlake.plans.registry import POINTER, register
from cursorlake.session import work_dir
from cursorlake.sinks.topic import stream_topics
from cursorlake.sources.events import EXTRA_FIELDS
from cursorlake.sources.topic import read_topic
from cursorlake.streaming.counts import BatchCounts
from cursorlake.streaming.hit_test import read_hits, start_hit_test
from cursorlake.streaming.ingest import await_all, start_ingest
from cursorlake.streaming.loader import start_loader


@register("route_stream")
def route_stream(spark, sf_dir):
    """K1 as a stream: two deliveries; the second run breaks off in its batch and is
    started again, the last finds nothing new. Messages per event and topic."""
    early, late = flows.time_split(spark, sf_dir)
    inbox, root, checkpoint = work_dir(spark, "inbox"), work_dir(spark, "topics"), work_dir(spark, "router")

    def run(broken=False):
        sent = spark.readStream.schema("value string").parquet(inbox)
        if broken:
            stop = F.raise_error(F.lit("broken batch")).cast("string")
            sent = sent.select(F.when(F.xxhash64("value") % 100 == 0, stop).otherwise(F.col("value")).alias("value"))
        await_all([stream_topics(route_to_topic(sent), checkpoint, root=root, available_now=True)])

    flows.messages(spark, sf_dir, early).select("value").write.mode("append").parquet(inbox)
    run()
    flows.messages(spark, sf_dir, late).select("value").write.mode("append").parquet(inbox)
    try:
        run(broken=True)
    except Exception as e:
        if "broken batch" not in str(e):
            raise
    run()
    run()
    event = F.get_json_object("value", "$.event_id").cast("long")
    return spark.read.text(root).groupBy(event.alias("event_id"), "topic").agg(F.count(F.lit(1)).alias("n"))


def _hits(spark, sf_dir, order, hits, most):
    """Two deliveries; before the second one every shape gets another label."""
    topics, out, table = work_dir(spark, "topics"), work_dir(spark, "hits"), work_dir(spark, "shapes")
    shapes = shapes_frame(spark, TEST_SHAPES)
    for n, part in enumerate(flows.time_split(spark, sf_dir)):
        drop_topics(spark, sf_dir, topics, part, kinds=("mouse",))
        shapes.withColumn("label", F.concat("label", F.lit(f" {n}"))).write.mode("overwrite").parquet(table)
        rows = decode_lenient(read_topic(spark, "mouse_events", root=topics), "mouse", extra=EXTRA_FIELDS, columns=POINTER)
        await_all([start_hit_test(rows, lambda s: s.read.parquet(table), out + "/data", out + "/_cp", order=order,
                                  hits=hits, most=most, available_now=True)])
    return read_hits(spark, out + "/data")


@register("hit_test_stream")
def hit_test_stream(spark, sf_dir):
    """J1 on a stream, shapes as conditions; misses kept."""
    return _hits(spark, sf_dir, "last", False, 64).select(
        "event_id", F.col("shape.id").alias("shape_id"), F.col("shape.label").alias("shape_label"))


@register("hit_test_first_stream")
def hit_test_first_stream(spark, sf_dir):
    """J2 / F3 on a stream, shapes joined by grid cells; misses dropped."""
    return _hits(spark, sf_dir, "first", True, 0).select(
        "event_id", F.col("shape.id").alias("shape_id"), F.col("shape.label").alias("shape_label"))


@register("batch_counts")
def batch_counts(spark, sf_dir):
    """What the ingest and the loader of each kind received, wrote and left
    out, malformed messages among the input."""
    lake, loads, counts = new_lake(spark), new_lake(spark), BatchCounts()
    spark.streams.addListener(counts)
    rows = []
    try:
        for kind in ("mouse", "keydown"):
            inbox = work_dir(spark, "inbox")
            flows.topic_messages(spark, sf_dir, kind, dirty=True).write.parquet(inbox)
            sent = spark.readStream.schema("value string").parquet(inbox)
            runs = [start_ingest(lake, kind, sent, EXTRA_FIELDS, available_now=True),
                    start_loader(loads, kind, sent, EXTRA_FIELDS, available_now=True)]
            await_all(runs)
            if not all([counts.ended(q) for q in runs]):
                raise TimeoutError("reports of an ended query did not arrive")
            ingest, loader = map(counts.totals, runs)
            rows.append((kind, *(ingest.get(c, 0) for c in ("messages", "rows", "unparsable")),
                         *(loader.get(c, 0) for c in ("messages", "loaded", "quarantined"))))
    finally:
        spark.streams.removeListener(counts)
    return spark.createDataFrame(rows, "kind string, n_messages long, n_rows long, n_unparsable long, "
                                       "n_seen long, n_loaded long, n_quarantined long")
