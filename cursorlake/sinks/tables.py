"""Event tables in a catalog namespace.

Tables are managed tables in a database, partitioned by ``ts_hour`` and
zstd-compressed; ``fmt`` names the format (Parquet by default; another one if its
package is on the class path). Only one stream writes a table: the Parquet file
sink keeps a commit log in ``_spark_metadata`` and readers (``spark.table``) list
files through it, so a half-written micro-batch is never visible and a replay
never duplicates.

A namespace has one root for good, and each table a generation (a table
property, new with each creation) that is part of its streams' checkpoint paths.
So a second process resumes where the first one stopped, and a table that is
dropped and created again starts with a checkpoint of its own.
"""

from __future__ import annotations

import re
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cursorlake.schemas import schema_for_kind, table_name
from cursorlake.session import shared_root

NAMESPACE = "user_events"
GENERATION = "generation"
TARGET_FILE_BYTES = 128 * 1024 * 1024  # fixed value: target data file size


def _ddl_columns(schema: T.StructType) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)


class Lakehouse:
    """A namespace of event tables. ``root`` is where a new namespace lives
    (default: under the shared folder); one that exists keeps its place."""

    def __init__(self, spark: SparkSession, root: str | None = None, namespace: str = NAMESPACE, fmt: str = "parquet"):
        self.spark, self.namespace, self.fmt = spark, namespace, fmt
        self.root = self._known_root() or (root or f"{shared_root(spark)}/cursorlake/lake").rstrip("/")

    def _known_root(self) -> str | None:
        """The root of the namespace if the catalog has it."""
        if not self.spark.catalog.databaseExists(self.namespace):
            return None
        place = self.spark.catalog.getDatabase(self.namespace).locationUri.rstrip("/")
        return place.removesuffix(f"/{self.namespace}.db")

    # K7
    def create_namespace(self) -> None:
        self.spark.sql(f"CREATE DATABASE IF NOT EXISTS `{self.namespace}` "
                       f"LOCATION '{self.root}/{self.namespace}.db'")

    def name(self, kind: str) -> str:
        return f"`{self.namespace}`.`{table_name(kind)}`"

    def exists(self, kind: str) -> bool:
        """K10's check: is the table there?"""
        return self.spark.catalog.tableExists(f"{self.namespace}.{table_name(kind)}")

    def _create(self, kind: str, family: str, extra, if_absent: bool) -> None:
        schema = schema_for_kind(kind, family, extra)
        part = "ts_hour"
        if family == "loader":  # loaded rows and quarantined messages, side by side
            schema = T.StructType([T.StructField(f.name, f.dataType) for f in schema.fields])
            schema = schema.add("value", T.StringType()).add("reasons", T.ArrayType(T.StringType()))
            schema = schema.add("status", T.StringType()).add("ts_hour", T.TimestampNTZType())
            part = "status, ts_hour"
        guard = "IF NOT EXISTS " if if_absent else ""
        self.spark.sql(f"CREATE TABLE {guard}{self.name(kind)} ({_ddl_columns(schema)}) "
                       f"USING {self.fmt} PARTITIONED BY ({part}) OPTIONS ('compression' = 'zstd') "
                       f"TBLPROPERTIES ('{GENERATION}' = '{uuid.uuid4().hex[:12]}', 'family' = '{family}')")

    # K9
    def create_if_absent(self, kind: str, family: str = "sink", extra=None) -> None:
        self.create_namespace()
        self._create(kind, family, extra, True)

    # K8
    def recreate_table(self, kind: str, family: str = "sink", extra=None) -> None:
        """Drop (with its data: the table is managed) and create again; streams
        into the new table start with a new checkpoint."""
        self.create_namespace()
        self.spark.sql(f"DROP TABLE IF EXISTS {self.name(kind)}")
        self._create(kind, family, extra, False)

    def drop(self) -> None:
        """Drop the namespace with its tables and data."""
        self.spark.sql(f"DROP DATABASE IF EXISTS `{self.namespace}` CASCADE")

    def read(self, kind: str) -> DataFrame:
        """The whole table (files listed through the sink's commit log)."""
        return self.spark.table(self.name(kind))

    def location(self, kind: str) -> str:
        rows = self.spark.sql(f"DESCRIBE TABLE EXTENDED {self.name(kind)}").where(
            "col_name = 'Location'").select("data_type").collect()
        return rows[0][0]

    def generation(self, kind: str) -> str:
        rows = self.spark.sql(f"SHOW TBLPROPERTIES {self.name(kind)}").where(F.col("key") == GENERATION).collect()
        return rows[0]["value"] if rows else "0"

    def checkpoint(self, role: str, kind: str) -> str:
        """Checkpoint of the stream ``role`` into the present table of ``kind``."""
        return f"{self.root}/_checkpoints/{self.namespace}/{role}_{kind}-{self.generation(kind)}"

    def check_writable(self, kind: str, checkpoint: str) -> None:
        """Fail if the table's commit log is ahead of the checkpoint: a stream
        started from it would take new batches for committed ones and skip them."""
        done = last_batch(self.spark, f"{self.location(kind)}/_spark_metadata")
        planned = last_batch(self.spark, f"{checkpoint}/offsets")
        if done > planned:
            raise RuntimeError(f"{self.name(kind)} has batch {done} committed, but checkpoint {checkpoint} knows only "
                               f"{planned}: another writer's table, or a lost checkpoint")

    # K6 (batch form)
    def append_batch(self, df: DataFrame, kind: str, hours: str = "ts_hour") -> None:
        """Batch append to a table that no stream writes, with hash distribution
        by hour: REBALANCE lets AQE split a hot hour into files of about
        TARGET_FILE_BYTES instead of one task per hour."""
        size = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
        before = self.spark.conf.get(size)
        self.spark.conf.set(size, str(TARGET_FILE_BYTES))
        try:
            df.hint("rebalance", hours).write.mode("append").insertInto(self.name(kind))
        finally:
            self.spark.conf.set(size, before)


def last_batch(spark: SparkSession, log: str) -> int:
    """The largest batch number in a stream's log folder, -1 without one."""
    path = spark._jvm.org.apache.hadoop.fs.Path(log)
    fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(path):
        return -1
    names = [s.getPath().getName() for s in fs.listStatus(path)]
    return max((int(m[0]) for n in names if (m := re.match(r"\d+", n))), default=-1)
