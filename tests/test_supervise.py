"""Topics fail and come back by themselves; K5: when a batch starts."""

import json
import os
import time

import pytest
from pyspark.sql import functions as F

from cursorlake.plans.lake_queries import new_lake
from cursorlake.schemas import table_name
from cursorlake.session import work_dir
from cursorlake.sources.topic import kafka_options, read_topic, topic_path
from cursorlake.streaming.ingest import start_ingest
from cursorlake.streaming.loader import FLUSH_INTERVAL, FLUSH_ROWS, flush_interval
from cursorlake.streaming.supervise import Topic, TopicsFailed, supervise


def _drop(root, topic, name, ids):
    d = topic_path(root, topic)
    os.makedirs(d, exist_ok=True)
    with open(f"{d}/{name}.txt", "w") as f:
        f.writelines(json.dumps({"key": str(i), "timestamp": 1704067200000 + i, "type": topic}) + "\n" for i in ids)


def _failing(source, bad):
    """A source that stops at the messages whose key is ``bad``."""
    key = F.get_json_object("value", "$.key")
    return source.select(F.when(key == bad, F.raise_error(F.lit("broken"))).otherwise(F.col("value")).alias("value"))


def test_failed_topic_resumes_and_the_other_goes_on(spark):
    """The keydown query fails in its second batch, twice; after that all rows are
    in its table once. The mouse query is live all the time and is never restarted."""
    lake, topics = new_lake(spark), work_dir(spark, "topics")
    for i in range(3):
        _drop(topics, "keydown_events", f"f{i}", range(10 * i, 10 * i + 10))
        time.sleep(1.1)
    _drop(topics, "mouse_events", "f0", range(5))
    mouse, starts = [], []

    def start_mouse():
        mouse.append(start_ingest(lake, "mouse", read_topic(spark, "mouse_events", root=topics), interval="1 second"))
        return mouse[-1]

    def start_keydown():
        starts.append(time.monotonic())
        source = read_topic(spark, "keydown_events", root=topics, max_files=1)
        return start_ingest(lake, "keydown", _failing(source, "15") if len(starts) < 3 else source, available_now=True)

    def done():
        ended = lake.exists("keydown") and len(starts) == 3 and lake.read("keydown").count() == 30
        if ended and not os.path.exists(topic_path(topics, "mouse_events") + "/f1.txt"):
            _drop(topics, "mouse_events", "f1", range(5, 9))
        return ended and lake.read("mouse").count() == 9

    errors = supervise({"mouse": start_mouse, "keydown": start_keydown}, shortest=0.5, stop=done)
    assert [len(errors[k]) for k in ("mouse", "keydown")] == [0, 2] and len(mouse) == 1 and not mouse[0].isActive
    assert sorted(int(r.key) for r in lake.read("keydown").collect()) == list(range(30))
    lake.drop()


def test_given_up_topic_is_named(spark):
    lake, topics = new_lake(spark), work_dir(spark, "topics")
    _drop(topics, "mouse_events", "f0", range(5))
    tried = []

    def broken():
        tried.append(1)
        raise ConnectionError("no broker")

    good = lambda: start_ingest(lake, "mouse", read_topic(spark, "mouse_events", root=topics), available_now=True)
    with pytest.raises(TopicsFailed, match="keydown: no broker") as error:
        supervise({"keydown": broken, "mouse": good}, max_failures=3, shortest=0.05)
    assert len(tried) == 3 and list(error.value.errors) == ["keydown"]
    assert lake.read("mouse").count() == 5 and table_name("mouse") == "mouse_events"
    lake.drop()


def test_pauses_double_up_to_the_longest():
    topic = Topic(lambda: None)
    got = []
    for topic.in_a_row in range(1, 9):
        got.append(topic.pause(1.0, 60.0))
    assert got == [1, 2, 4, 8, 16, 32, 60, 60]


def test_flush_rule_is_the_sources(spark):
    """On Kafka: 100 rows or 5 s, whichever is first, and no interval besides; a file
    topic has the interval only."""
    options = kafka_options("keydown_events", "broker:9092", min_rows=FLUSH_ROWS, max_delay=FLUSH_INTERVAL)
    assert (options["minOffsetsPerTrigger"], options["maxTriggerDelay"], flush_interval("kafka")) == ("100", "5 seconds", "0 seconds")
    assert flush_interval("text") == "5 seconds"
    rate = spark.readStream.format("rate").load().writeStream.format("noop").option("checkpointLocation", work_dir(spark, "cp"))
    q = rate.trigger(processingTime=flush_interval("kafka")).start()  # an interval that Spark takes: as soon as there are rows
    q.stop()
