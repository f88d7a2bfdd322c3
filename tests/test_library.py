"""Rules without data of their own: sources, schemas, file names, folders, zones."""

import datetime as dt
import os
import time

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cursorlake import schemas, session
from cursorlake.sources import files, topic
from cursorlake.sources.tables import read_range


def test_kafka_options():
    """Flush rule, consumer group, start position and fetch tuning."""
    opts = topic.kafka_options("mouse_events", "b:9092", "latest", "g1", min_rows=100, max_delay="5 seconds",
                               extra={"failOnDataLoss": "false"})
    assert opts == {"kafka.bootstrap.servers": "b:9092", "subscribe": "mouse_events", "startingOffsets": "latest",
                    "maxOffsetsPerTrigger": str(topic.MAX_ROWS), "kafka.fetch.min.bytes": "1048576",
                    "kafka.fetch.max.wait.ms": "100", "kafka.max.partition.fetch.bytes": "8388608",
                    "kafka.group.id": "g1", "failOnDataLoss": "false", "minOffsetsPerTrigger": "100",
                    "maxTriggerDelay": "5 seconds"}


def test_file_topic_rejects_other_starts(spark):
    with pytest.raises(ValueError):
        topic.read_topic(spark, "mouse_events", root="/nowhere", starting="latest")
    with pytest.raises(ValueError):
        topic.read_topic(spark, "mouse_events")


def test_schema_for_kind():
    """Families, extra columns, unknown names."""
    sink = schemas.schema_for_kind("mouse")
    assert len(sink.names) == 22 and sink.names[-2:] == ["ts", "ts_hour"] and sink["timestamp"].dataType == T.LongType()
    assert len(schemas.schema_for_kind("keydown").names) == 10
    loader = schemas.schema_for_kind("mouse", "loader")
    assert len(loader.names) == 21 and not any(f.nullable for f in loader.fields)
    assert loader["timestamp"].dataType == T.TimestampNTZType()
    assert schemas.schema_for_kind("keydown", "payload", [("user_id", T.LongType())]).names[-1] == "user_id"
    for kind, family in (("wheel", "sink"), ("mouse", "other")):
        with pytest.raises(KeyError):
            schemas.schema_for_kind(kind, family)


def test_file_rules(spark):
    """F2 on hand-named files, S9 on ties and order."""
    names = {"00001-x.metadata.json": "metadata", "snap-1-x.avro": "manifest_list", "x-m0.avro": "manifest",
             "part-0.parquet": "data", "notes.txt": None, "snap-2.json": None, "x-m1.avro": None}
    df = spark.createDataFrame([(n,) for n in names], "path string")
    for kind in files.FILE_RULES:
        got = {r.path for r in df.where(files.file_name_filter(F.col("path"), kind)).collect()}
        assert got == {n for n, k in names.items() if k == kind}
    root = session.work_dir(spark, "files")
    os.makedirs(root)
    for i, n in enumerate(("b.parquet", "a.parquet", "c.txt")):
        with open(f"{root}/{n}", "w") as f:
            f.write("x")
        os.utime(f"{root}/{n}", (time.time() + i, time.time() + i))
    assert files.latest_file(spark, root, "data").first().path.endswith("a.parquet")


def test_shared_root_needs_a_folder_on_a_cluster():
    assert session.is_one_process("local") and session.is_one_process("local[8]")
    assert not any(map(session.is_one_process, ("local-cluster[2,1,1024]", "yarn", "spark://h:7077", "k8s://h")))


@pytest.mark.parametrize("zone", ["UTC", "Asia/Seoul"])
def test_read_range_zones(spark, zone):
    """Naive bounds are UTC whatever the machine's zone; offsets of half hours
    keep their rows."""
    before = os.environ.get("TZ")
    os.environ["TZ"] = zone
    time.tzset()
    try:
        t = spark.sql("SELECT timestamp '2024-01-01 10:10:00' AS ts UNION ALL SELECT timestamp '2024-01-01 10:40:00'") \
            .withColumn("ts_hour", F.date_trunc("HOUR", "ts"))
        naive = read_range(t, dt.datetime(2024, 1, 1, 10, 5), dt.datetime(2024, 1, 1, 10, 41))
        assert naive.count() == 2
        india = dt.timezone(dt.timedelta(hours=5, minutes=30))
        assert read_range(t, dt.datetime(2024, 1, 1, 15, 35, tzinfo=india), dt.datetime(2024, 1, 1, 16, 5, tzinfo=india)).count() == 1
    finally:
        os.environ.pop("TZ") if before is None else os.environ.update(TZ=before)
        time.tzset()


def test_minutes_where_clocks_change(spark):
    """Berlin, 2024-10-27: the hour from 2 to 3 comes twice and stays apart;
    2024-03-31: it is skipped and adds no empty minutes."""
    from cursorlake.operators.reports import events_per_minute
    autumn = spark.sql("SELECT timestamp '2024-10-27 00:30:00' AS ts UNION ALL SELECT timestamp '2024-10-27 01:30:00'")
    got = [r for r in events_per_minute(autumn, "ts", "Europe/Berlin").collect() if r.n]
    assert [(str(r.minute), r.n) for r in got] == [("2024-10-27 02:30:00", 1)] * 2
    spring = spark.sql("SELECT timestamp '2024-03-31 00:59:00' AS ts UNION ALL SELECT timestamp '2024-03-31 01:00:00'")
    assert [str(r.minute) for r in events_per_minute(spring, "ts", "Europe/Berlin").orderBy("minute").collect()] == [
        "2024-03-31 01:59:00", "2024-03-31 03:00:00"]


def test_drop_namespace(spark):
    from cursorlake.plans.lake_queries import new_lake
    lake = new_lake(spark)
    lake.create_if_absent("mouse")
    assert lake.exists("mouse")
    lake.drop()
    assert not spark.catalog.databaseExists(lake.namespace)
