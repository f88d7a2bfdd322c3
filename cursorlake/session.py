"""Spark session settings and the shared work folder.

Every data path that a job writes (streaming checkpoints, topic drops, tables)
lives under the folder the cluster names in ``spark.checkpoint.dir``. That
folder is shared by all executors, so a lost executor's work can be redone by
another one. Only when the setting is absent (local tests) do we create one.
"""

from __future__ import annotations

import functools
import tempfile
import uuid

from pyspark.sql import SparkSession

# Session zone is pinned to UTC for writing and reading: Parquet partition
# paths hold timestamps as local text, so a zone change between writer and
# reader would move every hour partition. Local time appears only when a
# report asks for it (functions.time.to_local_time).
SESSION_ZONE = "UTC"

DEFAULT_CONF = {
    "spark.sql.session.timeZone": SESSION_ZONE,
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.parquet.compression.codec": "zstd",
    "spark.ui.enabled": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # state of streaming operators on local disk and in checkpoints, not on the heap
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}

# A message that repeats a key keeps the last value, as JSON readers do.
LENIENT_JSON = ("spark.sql.variant.allowDuplicateKeys", "true")


def build_session(master: str | None = None, app_name: str = "cursorlake",
                  conf: dict[str, str] | None = None) -> SparkSession:
    """Create (or get) a session with the library's defaults."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**DEFAULT_CONF, **(conf or {})}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    pin_zone(spark)
    return spark


def pin_zone(spark: SparkSession) -> None:
    """Pin the session zone and the JSON rule; expressions bind both at analysis."""
    spark.conf.set("spark.sql.session.timeZone", SESSION_ZONE)
    spark.conf.set(*LENIENT_JSON)


def is_one_process(master: str) -> bool:
    """Whether driver and executors are one process (local, local[n])."""
    return master == "local" or master.startswith("local[")


def shared_root(spark: SparkSession) -> str:
    """The cluster's shared folder (``spark.checkpoint.dir``).

    Read from the session; only when unset, and only in a single process (as in
    local tests), is a folder created and registered as the checkpoint dir.
    """
    sc = spark.sparkContext
    root = sc.getConf().get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not root:
        if not is_one_process(sc.master):
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
        root = tempfile.mkdtemp(prefix="cursorlake-")
        sc.setCheckpointDir(root)
    return root.rstrip("/")


def work_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared root, unique per call."""
    return f"{shared_root(spark)}/cursorlake/{name}-{uuid.uuid4().hex[:12]}"


def cached_columns(fn):
    """Memoize a builder of unresolved Column expressions.

    Built expressions are plain trees in the JVM, reusable by any DataFrame;
    building them again costs one py4j round trip per node (thousands for
    the decode and coercion rules). Keyed by the gateway and the (hashable)
    arguments.
    """
    cache: dict = {}

    @functools.wraps(fn)
    def wrapper(*args):
        from pyspark import SparkContext
        key = (id(SparkContext._gateway), args)
        if key not in cache:
            cache[key] = fn(*args)
        return cache[key]
    return wrapper
