"""Streaming fixtures: late rows are kept, restarts neither skip nor repeat rows,
bad stamps and failed queries."""

import json
import os
import time

import pytest
from pyspark.sql import functions as F

from cursorlake.plans.lake_queries import new_lake
from cursorlake.sinks.tables import Lakehouse
from cursorlake.session import work_dir
from cursorlake.sources import files
from cursorlake.sources.topic import read_topic, topic_path
from cursorlake.streaming.ingest import await_all, start_ingest
from cursorlake.streaming.active_shape import active_shape_stream
from cursorlake.streaming.loader import loaded, quarantined, start_loader


def _keydown(ts):
    return json.dumps({"stream": "keydown", "key": "A", "code": "KeyA", "altKey": False, "ctrlKey": False,
                       "shiftKey": False, "metaKey": False, "timestamp": ts, "type": "keydown"})


def _drop(root, name, stamps):
    d = topic_path(root, "keydown_events")
    os.makedirs(d, exist_ok=True)
    with open(f"{d}/{name}.txt", "w") as f:
        f.write("\n".join(_keydown(t) for t in stamps) + "\n")


def test_late_rows_are_written(spark):
    topics = work_dir(spark, "topics")
    _drop(topics, "f1", [1704070800000, 1704074400000])
    time.sleep(1.1)  # distinct modification times: file 1 is the first batch
    _drop(topics, "f2", [1704067200000, 1704074401000])
    lake = new_lake(spark)
    src = read_topic(spark, "keydown_events", root=topics, max_files=1)
    q = start_ingest(lake, "keydown", src, available_now=True)
    await_all([q])
    assert len([p for p in q.recentProgress if p["numInputRows"] > 0]) == 2
    t = lake.read("keydown")
    assert t.count() == 4
    assert t.select("ts_hour").distinct().count() == 3


def test_late_rows_and_poison(spark):
    """Stamps that are no event time neither stop the ingest nor the loader."""
    topics = work_dir(spark, "topics")
    _drop(topics, "f1", [1704067200000, 1704067200123456789, 1704067200123456, 2**63 - 1])
    lake, loads = new_lake(spark), new_lake(spark)
    await_all([start_ingest(lake, "keydown", read_topic(spark, "keydown_events", root=topics), available_now=True)])
    assert lake.read("keydown").count() == 4 and lake.read("keydown").where("ts IS NULL").count() == 3
    await_all([start_loader(loads, "keydown", read_topic(spark, "keydown_events", root=topics), available_now=True)])
    assert (loaded(loads, "keydown").count(), quarantined(loads, "keydown").count()) == (1, 3)


@pytest.mark.parametrize("start,rows", [(start_ingest, lambda lake: lake.read("keydown")),
                                        (start_loader, lambda lake: loaded(lake, "keydown"))])
def test_restart_in_a_new_object(spark, start, rows):
    """Another Lakehouse on the namespace resumes; recreating the table starts
    anew, over more batches than the sink's log keeps apart."""
    topics = work_dir(spark, "topics")
    first = new_lake(spark)
    n = 0
    for i in range(12):
        _drop(topics, f"f{i}", [1704067200000 + 10 * i + k for k in range(i % 3 + 1)])
        n += i % 3 + 1
        lake = Lakehouse(spark, namespace=first.namespace)
        assert lake.root.removeprefix("file:") == first.root.removeprefix("file:")
        await_all([start(lake, "keydown", read_topic(spark, "keydown_events", root=topics), available_now=True)])
        assert rows(lake).count() == n
    family = "loader" if start is start_loader else "sink"
    lake.recreate_table("keydown", family)
    for again in range(2):
        await_all([start(Lakehouse(spark, namespace=first.namespace), "keydown",
                         read_topic(spark, "keydown_events", root=topics), available_now=True)])
        assert rows(lake).count() == n
    first.drop()


def test_lost_checkpoint_fails_loudly(spark):
    topics = work_dir(spark, "topics")
    _drop(topics, "f1", [1704067200000])
    lake = new_lake(spark)
    src = read_topic(spark, "keydown_events", root=topics)
    await_all([start_ingest(lake, "keydown", src, available_now=True)])
    with pytest.raises(RuntimeError, match="committed"):
        lake.check_writable("keydown", work_dir(spark, "other-checkpoint"))


def test_await_all_raises(spark):
    bad = spark.readStream.format("rate").load().select(F.raise_error(F.lit("broken")).alias("x"))
    good = spark.readStream.format("rate").load()
    start = lambda df: df.writeStream.format("noop").option("checkpointLocation", work_dir(spark, "cp")).start()
    queries = [start(good), start(bad)]
    with pytest.raises(Exception, match="broken"):
        await_all(queries)
    assert not queries[0].isActive


def test_stream_w5_any_key(spark):
    """A text key, a NULL key and further columns; a cleared shape leaves no
    state."""
    schema = "who string, event_id long, timestamp long, event_type string, shape_id string, note string"
    d = work_dir(spark, "w5")
    rows = [("a", 1, 1, "mousedown", "s1", "x"), ("a", 2, 2, "mousemove", None, "y"), (None, 3, 1, "mousedown", "s2", "z"),
            (None, 4, 2, "mousemove", None, "z"), ("a", 5, 3, "mouseup", None, "w"), ("a", 6, 4, "mousemove", None, None)]
    spark.createDataFrame(rows, schema).coalesce(1).write.json(d + "/in")
    out = active_shape_stream(spark.readStream.schema(schema).json(d + "/in"), key="who")
    await_all([out.writeStream.format("parquet").option("checkpointLocation", d + "/cp").trigger(availableNow=True)
               .start(d + "/out")])
    got = {r.event_id: (r.who, r.note, r.active_shape) for r in spark.read.parquet(d + "/out").collect()}
    assert got == {1: ("a", "x", "s1"), 2: ("a", "y", "s1"), 3: (None, "z", "s2"), 4: (None, "z", "s2"),
                   5: ("a", "w", None), 6: ("a", None, None)}


def test_latest_file_none(spark):
    d = work_dir(spark, "empty")
    os.makedirs(d, exist_ok=True)
    with open(f"{d}/a.txt", "w") as f:
        f.write("x")
    assert files.latest_file(spark, d, "data").count() == 0
    assert files.latest_file(spark, d, "data", glob="*.txt").count() == 0
