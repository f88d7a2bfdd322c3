"""S1 source_topic, S2 source_options: a topic of JSON messages as a stream.

Production reads Kafka (``format="kafka"``; needs the Spark Kafka package on
the cluster's classpath -- it is not in this install, so that branch is not
exercised by the tests here). The test double reads the text files that
``sinks.topic.write_topics`` drops under ``<root>/topic=<name>/``: the same
stream of ``value`` strings, with files in the role of offsets. Topics that
``sinks.topic.stream_topics`` writes are read through its commit log, so that files of
a batch that broke off are never seen.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cursorlake.sinks.tables import last_batch

# Consumer fetch tuning for small events (pass-through options).
FETCH_OPTIONS = {
    "kafka.fetch.min.bytes": "1048576",
    "kafka.fetch.max.wait.ms": "100",
    "kafka.max.partition.fetch.bytes": "8388608",
}


# An upper bound for one micro-batch, so that a long backlog is read in steps.
MAX_ROWS = 10_000_000
MAX_FILES = 10_000


def source_options(group_id: str | None = None, extra: dict[str, str] | None = None) -> dict[str, str]:
    """The Kafka source options (fetch tuning, consumer group)."""
    opts = dict(FETCH_OPTIONS)
    if group_id:
        opts["kafka.group.id"] = group_id
    opts.update(extra or {})
    return opts


def kafka_options(topic: str, servers: str, starting: str = "earliest", group_id: str | None = None,
                  min_rows: int | None = None, max_delay: str | None = None, max_rows: int = MAX_ROWS,
                  extra: dict[str, str] | None = None) -> dict[str, str]:
    """Every option of the Kafka reader. A batch starts as soon as ``min_rows``
    wait or ``max_delay`` has passed, and never exceeds ``max_rows``."""
    opts = {"kafka.bootstrap.servers": servers, "subscribe": topic, "startingOffsets": starting,
            "maxOffsetsPerTrigger": str(max_rows), **source_options(group_id, extra)}
    if min_rows is not None:
        opts["minOffsetsPerTrigger"] = str(min_rows)
    if max_delay is not None:
        opts["maxTriggerDelay"] = max_delay
    return opts


def topic_path(root: str, topic: str) -> str:
    return f"{root.rstrip('/')}/topic={topic}"


def read_topic(spark: SparkSession, topic: str, fmt: str = "text", root: str | None = None,
               starting: str = "earliest", servers: str | None = None, group_id: str | None = None,
               min_rows: int | None = None, max_delay: str | None = None, max_rows: int = MAX_ROWS,
               max_files: int = MAX_FILES, options: dict[str, str] | None = None,
               committed: bool | None = None) -> DataFrame:
    """The topic's messages as a streaming DataFrame with one ``value``
    string column. The row bounds apply to Kafka, ``max_files`` to the test
    double, which always starts from its first file. ``committed`` says that a stream
    writes the topics; left out, the folder is asked for a commit log (a reader that
    starts before the writer's first batch must say it)."""
    if fmt == "kafka":
        reader = spark.readStream.format("kafka").options(**kafka_options(
            topic, servers, starting, group_id, min_rows, max_delay, max_rows, options))
        return reader.load().selectExpr("CAST(value AS STRING) AS value")
    if root is None:
        raise ValueError("a file topic needs its root folder")
    if starting != "earliest":
        raise ValueError("a file topic starts from its first file")
    reader = spark.readStream.format("text").option("maxFilesPerTrigger", str(max_files)).options(**(options or {}))
    if committed is None:
        committed = last_batch(spark, f"{root}/_spark_metadata") >= 0
    if committed:  # the topic is a partition: other topics' files are not read
        return reader.load(root).where(F.col("topic") == topic).select("value")
    return reader.load(topic_path(root, topic))
