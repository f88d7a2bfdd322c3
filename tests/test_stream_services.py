"""K1 as a stream, hit tests against a changing table of shapes, counts per batch."""

import random

import pytest
from pyspark.sql import functions as F

from cursorlake.functions.payload import route_to_topic
from cursorlake.functions.shapes import Shape
from cursorlake.operators.hit_test import hit_test, hit_test_grid, shapes_frame
from cursorlake.session import work_dir
from cursorlake.sinks.tables import Lakehouse
from cursorlake.sinks.topic import stream_topics, write_topics
from cursorlake.sources.topic import read_topic
from cursorlake.streaming.counts import BatchCounts, received, written
from cursorlake.streaming.hit_test import hit_test_table, read_hits, start_hit_test
from cursorlake.streaming.ingest import await_all, start_ingest


def _drop(spark, inbox, values):
    spark.createDataFrame([(v,) for v in values], "value string").coalesce(1).write.mode("append").parquet(inbox)


# --- K1 --------------------------------------------------------------------------

def _route(spark, inbox, root, checkpoint, fail=None):
    sent = spark.readStream.schema("value string").parquet(inbox)
    if fail:
        stop = F.raise_error(F.lit("broken batch")).cast("string")
        sent = sent.select(F.when(F.col("value") == fail, stop).otherwise(F.col("value")).alias("value"))
    await_all([stream_topics(route_to_topic(sent), checkpoint, root=root, available_now=True)])


def test_router_delivers_once_across_failures(spark):
    d = work_dir(spark, "router")
    inbox, root, checkpoint = d + "/in", d + "/topics", d + "/cp"
    first = ['{"stream":"mouse","n":1}', '{"stream":"keydown","n":2}', '{"n":3}']
    second = ['{"stream":"mouse","n":4}', '{"stream":"mouse","n":5}']
    _drop(spark, inbox, first)
    _route(spark, inbox, root, checkpoint)
    _drop(spark, inbox, second)
    with pytest.raises(Exception, match="broken batch"):
        _route(spark, inbox, root, checkpoint, fail=second[1])
    for _ in range(2):
        _route(spark, inbox, root, checkpoint)
    out = d + "/out"
    for topic, want in (("mouse_events", [first[0], *second]), ("keydown_events", [first[1]]), ("unknown_events", [first[2]])):
        q = (read_topic(spark, topic, root=root).writeStream.format("parquet").option("checkpointLocation", f"{out}/cp-{topic}")
             .trigger(availableNow=True).start(f"{out}/{topic}"))
        await_all([q])
        assert sorted(r.value for r in spark.read.parquet(f"{out}/{topic}").collect()) == sorted(want)


def test_router_refuses_lost_checkpoint_and_mixed_writers(spark):
    d = work_dir(spark, "router")
    _drop(spark, d + "/in", ['{"stream":"mouse"}'])
    _route(spark, d + "/in", d + "/topics", d + "/cp")
    with pytest.raises(RuntimeError, match="checkpoint"):
        _route(spark, d + "/in", d + "/topics", d + "/other")
    with pytest.raises(RuntimeError, match="written by a stream"):
        write_topics(route_to_topic(spark.createDataFrame([('{"stream":"mouse"}',)], "value string")), root=d + "/topics")


def test_committed_topic_skips_files_of_a_broken_batch(spark):
    """A file that no commit names is not a message."""
    d = work_dir(spark, "router")
    _drop(spark, d + "/in", ['{"stream":"mouse","n":1}'])
    _route(spark, d + "/in", d + "/topics", d + "/cp")
    spark.createDataFrame([('{"stream":"mouse","n":9}',)], "value string").write.mode("append").text(d + "/topics/topic=mouse_events")
    q = (read_topic(spark, "mouse_events", root=d + "/topics").writeStream.format("parquet")
         .option("checkpointLocation", d + "/cp-out").trigger(availableNow=True).start(d + "/out"))
    await_all([q])
    assert [r.value for r in spark.read.parquet(d + "/out").collect()] == ['{"stream":"mouse","n":1}']


# --- J1 / J2 -----------------------------------------------------------------------

def _shapes(seed, n):
    r = random.Random(seed)
    out = []
    for i in range(n):
        kind = r.choice(["rect", "circle", "triangle", "star"])
        p = [r.randrange(0, 300) for _ in range(2)] + [r.randrange(0, 80) for _ in range(2)]
        if kind == "circle":
            p = p[:3]
        if kind == "triangle":
            p = [r.randrange(0, 300) for _ in range(6)]
        out.append(Shape(f"s{i:03d}", kind, r.randrange(4), *p, label=f"l{i}"))
    return out


EVENTS = "event_id long, canvasX double, canvasY double"


def _events(seed, n):
    r = random.Random(seed)
    return [(i, None if i % 17 == 0 else float(r.randrange(400)), float(r.randrange(400))) for i in range(n)]


def _answers(df):
    return sorted((r.event_id, r["shape"].id if r["shape"] else None) for r in df.select("event_id", "shape").collect())


@pytest.mark.parametrize("order", ["last", "first"])
def test_fixed_shapes_on_a_stream_equal_batch(spark, order):
    d, shapes, rows = work_dir(spark, "hits"), _shapes(1, 30), _events(2, 300)
    spark.createDataFrame(rows, EVENTS).write.parquet(d + "/in")
    q = (hit_test(spark.readStream.schema(EVENTS).parquet(d + "/in"), shapes, order=order).writeStream.format("parquet")
         .option("checkpointLocation", d + "/cp").trigger(availableNow=True).start(d + "/out"))
    await_all([q])
    assert _answers(spark.read.parquet(d + "/out")) == _answers(hit_test(spark.createDataFrame(rows, EVENTS), shapes, order=order))


@pytest.mark.parametrize("order", ["last", "first"])
@pytest.mark.parametrize("most", [0, 64])
def test_changed_shapes_take_effect(spark, order, most):
    """Both forms, two deliveries with other shapes each, then no shapes at all."""
    d = work_dir(spark, "hits")
    want = []
    for n, shapes in enumerate((_shapes(3, 20), _shapes(4, 25), [])):
        rows = [(i + 1000 * n, x, y) for i, x, y in _events(n, 150)]
        spark.createDataFrame(rows, EVENTS).coalesce(1).write.mode("append").parquet(d + "/in")
        shapes_frame(spark, shapes).write.mode("overwrite").parquet(d + "/shapes")
        await_all([start_hit_test(spark.readStream.schema(EVENTS).parquet(d + "/in"), lambda s: s.read.parquet(d + "/shapes"),
                                  d + "/out", d + "/cp", order=order, most=most, available_now=True)])
        want += _answers(hit_test(spark.createDataFrame(rows, EVENTS), shapes, order=order))
    assert _answers(read_hits(spark, d + "/out")) == sorted(want)


def test_table_forms_agree_without_positions(spark):
    """Equal z are ordered by id; a null z goes to the grid form."""
    rows = spark.createDataFrame(_events(5, 300), EVENTS)
    for shapes in (shapes_frame(spark, _shapes(6, 40)).drop("position"),
                   shapes_frame(spark, _shapes(7, 20)).withColumn("z", F.when(F.col("z") > 0, F.col("z")))):
        assert _answers(hit_test_table(rows, shapes)) == _answers(hit_test_grid(rows, shapes))


# --- counts ------------------------------------------------------------------------

@pytest.fixture
def counts(spark):
    heard = BatchCounts()
    spark.streams.addListener(heard)
    yield heard
    spark.streams.removeListener(heard)


def test_ingest_counts_per_batch(spark, counts):
    lake, inbox = Lakehouse(spark, namespace="counted"), work_dir(spark, "inbox")
    lake.drop()
    good = '{"key":"a","timestamp":%d}'
    deliveries = [[good % 1704067200000, "no json", "[1]", good % 1704067260000], [good % 1704067100000], ["", "{"]]
    for part in deliveries:
        _drop(spark, inbox, part)
        q = start_ingest(lake, "keydown", spark.readStream.schema("value string").parquet(inbox), available_now=True)
        await_all([q])
        assert counts.ended(q)
    got = [b for b in counts.batches(q) if b.counts["messages"]]
    assert [(b.counts["messages"], b.counts["rows"], b.counts["unparsable"]) for b in got] == [(4, 2, 2), (1, 1, 0), (2, 0, 2)]
    assert got[1].earliest == got[1].latest and got[1].latest < got[0].earliest
    assert got[2].earliest is None
    assert {k: counts.totals(q)[k] for k in ("messages", "rows", "unparsable", "behind")} == \
        {"messages": 7, "rows": 3, "unparsable": 4, "behind": 0}
    lake.drop()


def test_rows_behind_the_watermark_are_counted(spark, counts):
    """A stateful query drops a row that is behind: it is received, and counted so."""
    d = work_dir(spark, "behind")
    for ms in ([0, 600_000], [1_200_000], [5_000]):
        spark.createDataFrame([(m,) for m in ms], "ms long").coalesce(1).write.mode("append").parquet(d + "/in")
        rows = received(spark.readStream.schema("ms long").parquet(d + "/in")).select(F.timestamp_millis("ms").alias("ts"))
        late = written(rows.withWatermark("ts", "1 minute"), "ts").groupBy(F.window("ts", "1 minute")).count()
        q = (late.writeStream.format("parquet").option("checkpointLocation", d + "/cp").outputMode("append")
             .trigger(availableNow=True).start(d + "/out"))
        await_all([q])
        assert counts.ended(q)
    totals = counts.totals(q)
    assert (totals["messages"], totals["rows"], totals["behind"]) == (4, 4, 1)
