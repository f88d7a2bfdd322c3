"""Newest rows by partitions, counts from footers, closed hours in large files."""

import datetime as dt
import json
import os

from pyspark.sql import functions as F

from cursorlake.operators.reports import newest_n
from cursorlake.plans.lake_queries import new_lake
from cursorlake.session import work_dir
from cursorlake.sinks import compact
from cursorlake.sources.footers import count_by_hour, count_rows
from cursorlake.sources.newest import newest_rows, partition_hours
from cursorlake.sources.topic import read_topic, topic_path
from cursorlake.streaming.ingest import await_all, start_ingest

HOUR = 3_600_000
T0 = 1704067200000  # 2024-01-01 00:00 UTC


def _drop(root, name, stamps):
    d = topic_path(root, "keydown_events")
    os.makedirs(d, exist_ok=True)
    with open(f"{d}/{name}.txt", "w") as f:
        for t in stamps:
            f.write(json.dumps({"stream": "keydown", "key": str(t), "code": "KeyA", "altKey": False, "ctrlKey": False,
                                "shiftKey": False, "metaKey": False, "timestamp": t, "type": "keydown"}) + "\n")


def _deliver(lake, topics, deliveries):
    for i, stamps in enumerate(deliveries):
        _drop(topics, f"f{len(os.listdir(topics)) if os.path.isdir(topics) else 0}-{i}-{stamps[0]}", stamps)
        await_all([start_ingest(lake, "keydown", read_topic(lake.spark, "keydown_events", root=topics), available_now=True)])


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def _files(df):
    """The number of files that hold the rows."""
    return df.select(F.input_file_name()).distinct().count()


def test_newest_rows_read_the_newest_hours(spark):
    """Late rows, rows without an hour (also far in the future), and fewer rows than
    asked for: always the full sort's rows."""
    lake, topics = new_lake(spark), work_dir(spark, "topics")
    stamps = [T0 + h * HOUR + k * 1000 for h in range(20) for k in range(10)]
    _deliver(lake, topics, [stamps[100:], stamps[:100], [2**63 - 1, 1704067200123456789, T0 + 19 * HOUR + 5]])
    table = lake.read("keydown")
    assert len(partition_hours(table)) == 20 and partition_hours(table)[0] == dt.datetime(2024, 1, 1, 19)
    for n in (1, 10, 11, 12, 25, 50, 150, 202, 500):
        want = [r.timestamp for r in newest_n(table, n, tie="key").collect()]
        assert [r.timestamp for r in newest_rows(table, n, tie="key").collect()] == want and len(want) == min(n, 203)
        by_instant = [r.ts for r in newest_rows(table, n, "ts", "key").collect()]
        assert by_instant == [r.ts for r in newest_n(table, n, "ts", "key").collect()]
    few = newest_rows(table, 25, tie="key")
    filters = _plan(few).split("PartitionFilters: [")[1].split("]")[0]
    assert "2024-01-01 16:00:00" in filters and "isnull(ts_hour" in filters  # 1, 2, then 4 hours tried
    lake.drop()


def test_newest_rows_of_an_empty_table(spark):
    lake = new_lake(spark)
    lake.create_if_absent("keydown")
    assert newest_rows(lake.read("keydown")).count() == 0
    lake.drop()


def test_counts_come_from_footers(spark):
    lake, topics = new_lake(spark), work_dir(spark, "topics")
    _deliver(lake, topics, [[T0, T0 + 1, T0 + HOUR], [T0 + 2, 2**63 - 1]])
    n, by_hour = count_rows(lake, "keydown"), count_by_hour(lake, "keydown")
    assert n.first()["n"] == lake.read("keydown").count() == 5
    assert "PushedAggregation: [COUNT(*)]" in _plan(n) and "PushedAggregation: [COUNT(*)]" in _plan(by_hour)
    assert {r.ts_hour: r.n for r in by_hour.collect()} == {
        dt.datetime(2024, 1, 1, 0): 3, dt.datetime(2024, 1, 1, 1): 1, None: 1}
    assert spark.conf.get("spark.sql.parquet.aggregatePushdown") == "false"  # the caller's setting stays
    lake.drop()


def test_closed_hours_in_few_files(spark):
    """Twelve triggers into one hour end as one file; late rows, a second run and the
    open hour are read once each."""
    lake, topics = new_lake(spark), work_dir(spark, "topics")
    _deliver(lake, topics, [[T0 + i, T0 + i + 100, T0 + HOUR + i] for i in range(12)])

    def check(hours):
        rows = compact.read_compacted(lake, "keydown")
        assert sorted(map(str, rows.collect())) == sorted(map(str, lake.read("keydown").collect()))
        assert compact.compacted_hours(lake, "keydown") == hours
        return rows

    first, second = dt.datetime(2024, 1, 1, 0), dt.datetime(2024, 1, 1, 1)
    check([])
    assert compact.compact_closed(lake, "keydown", dt.datetime(2024, 1, 1, 1, 59)) == [first]
    assert compact.compact_closed(lake, "keydown", dt.datetime(2024, 1, 1, 1, 59)) == []
    rows = check([first])
    of_first = rows.where(F.col("ts_hour") == F.lit(first).cast("timestamp_ntz"))
    assert _files(of_first) == 1 and of_first.count() == 24
    assert _files(lake.read("keydown").where(F.col("ts_hour") == F.lit(first).cast("timestamp_ntz"))) >= 12
    _deliver(lake, topics, [[T0 + 999, 2**63 - 1, T0 + HOUR + 999]])
    check([])  # the hour's late row is read, from the stream's files
    assert compact.compact_closed(lake, "keydown", dt.datetime(2024, 1, 1, 2)) == [first, second]
    rows = check([first, second])
    assert rows.count() == 39 and _files(rows.where("ts_hour IS NOT NULL")) == 2
    lake.drop()


def test_large_hours_are_split(spark):
    """Files near the target size: an hour above it is split."""
    lake, topics = new_lake(spark), work_dir(spark, "topics")
    _deliver(lake, topics, [[T0 + i for i in range(k, 30_000, 3)] for k in range(3)])
    compact.compact_closed(lake, "keydown", dt.datetime(2024, 1, 2), target_bytes=100_000)
    closed = compact.read_compacted(lake, "keydown")
    assert closed.count() == 30_000 and 2 <= _files(closed) <= 30
    lake.drop()
