"""K1 sink side: write routed payloads to their topics.

``route_to_topic`` (functions.payload) computes (topic, key, value); this
module delivers them -- to Kafka with the ``topic`` column selecting the
topic per row, or, as the test double, to text files partitioned by topic.

``write_topics`` appends one batch: tried again after a failure it delivers twice.
``stream_topics`` is the router as a service: a checkpointed query. Its file sink
commits a batch as a whole and once, and ``read_topic`` then reads the committed files
only, so a consumer sees each message once, whatever failed in between. On Kafka,
delivery is at least once, as the Spark sink does not write transactions. A folder has
one of the two kinds of writer.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from cursorlake.sinks.tables import last_batch

INTERVAL = "1 second"


def write_topics(routed: DataFrame, fmt: str = "text", root: str | None = None,
                 servers: str | None = None) -> None:
    """Append one batch of routed messages to their topics."""
    if fmt == "kafka":
        (routed.select("topic", "key", "value").write.format("kafka")
               .option("kafka.bootstrap.servers", servers).save())
        return
    if root is None:
        raise ValueError("a file topic needs its root folder")
    if last_batch(routed.sparkSession, f"{root}/_spark_metadata") >= 0:
        raise RuntimeError(f"{root} is written by a stream, whose readers would not see this batch")
    routed.select("topic", "value").write.mode("append").partitionBy("topic").text(root)


def stream_topics(routed: DataFrame, checkpoint: str, fmt: str = "text", root: str | None = None,
                  servers: str | None = None, available_now: bool = False,
                  interval: str = INTERVAL) -> StreamingQuery:
    """Start the router over a stream of routed messages (topic, key, value). No
    shuffle: each task writes its own file per topic. A start from a checkpoint that is
    behind the folder's log fails, as its batches would be taken for committed ones."""
    if fmt == "kafka":
        writer = routed.select("topic", "key", "value").writeStream.format("kafka").option("kafka.bootstrap.servers", servers)
    elif root is None:
        raise ValueError("a file topic needs its root folder")
    else:
        spark = routed.sparkSession
        done, planned = last_batch(spark, f"{root}/_spark_metadata"), last_batch(spark, f"{checkpoint}/offsets")
        if done > planned:
            raise RuntimeError(f"{root} has batch {done} committed, but checkpoint {checkpoint} knows only {planned}")
        writer = routed.select("topic", "value").writeStream.format("text").partitionBy("topic").option("path", root)
    writer = writer.outputMode("append").option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime=interval)).start()
