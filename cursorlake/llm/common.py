"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from cursorlake.session import shared_root, work_dir  # noqa: F401  (re-exported)

# Rows per Arrow batch while whole texts go through Python: texts may hold
# 100,000 words, so a batch stays small enough for a worker of a few 100 MB.
TEXT_BATCH_ROWS = 512


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_batches(spark: SparkSession, rows: int = TEXT_BATCH_ROWS) -> None:
    """Bound the Arrow batches of the Python stages planned from now on."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` under the shared folder and read it back.

    Cuts the lineage at files that every executor sees, so a lost executor
    costs only its running tasks.
    """
    path = work_dir(df.sparkSession, name)
    df.write.parquet(path)
    _written.append(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


_written: list[str] = []


def written() -> int:
    """How many tables :func:`staged` has written so far."""
    return len(_written)


def drop_staged(spark: SparkSession, since: int, keep: int = 1) -> None:
    """Delete the tables staged since that many, but the last ``keep``: what a
    finished step has left behind. DataFrames that read them become invalid."""
    last = len(_written) - keep
    for path in _written[since:last]:
        at = spark._jvm.org.apache.hadoop.fs.Path(path)
        at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)
    del _written[since:last]


def dealt_by_bytes(places: DataFrame, size: str, task_bytes: int, *keys: str) -> DataFrame:
    """Deal rows that name pieces of files over tasks that read about ``task_bytes``
    each. The count is explicit, as the rows are so small that adaptive execution
    would put them, and with them all the reading, into one task."""
    whole = places.agg(F.coalesce(F.sum(size), F.lit(0))).first()[0]
    return places.repartition(max(1, -(-int(whole) // task_bytes)), *keys)


def unit_hash(*cols: Column) -> Column:
    """A deterministic number in [0, 1) per row, from the row's own values."""
    return F.shiftrightunsigned(F.xxhash64(*cols), 11) / F.lit(float(1 << 53))


def bounded_sample(df: DataFrame, key: list[Column], bound: int) -> DataFrame:
    """About ``bound`` rows chosen by a hash of ``key`` (all rows if fewer).

    The share is ``bound / count``: no sort, no single task, the same rows on
    every run.
    """
    n = df.count()
    return df if n <= bound else df.where(unit_hash(*key) < bound / n)


def frames(columns: dict[str, Iterable]) -> Iterator[pd.DataFrame]:
    """One output batch of a mapInPandas function, if it has rows."""
    out = pd.DataFrame(columns)
    if len(out):
        yield out


def per_worker(kind: str, key: object, make: Callable[[], object]) -> object:
    """An object that all tasks of a Python worker process share: the last one
    of its kind, made anew when ``key`` changes."""
    import pyspark
    kept = pyspark.__dict__.setdefault("_kept_by_worker", {})
    if kind not in kept or kept[kind][0] != key:
        kept[kind] = (key, make())
    return kept[kind][1]


def forget_worker() -> None:
    """Drop what :func:`per_worker` keeps in this worker for the tasks of other stages."""
    import pyspark
    pyspark.__dict__.pop("_kept_by_worker", None)


def release_memory() -> None:
    """Give free memory back to the system. Arrow and the C library would keep what one
    batch took for as long as the worker lives, beside what later stages take."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def lean(batches: Iterator) -> Iterator:
    """The batches of a task that uses no object of :func:`per_worker`; free memory
    goes back after each."""
    forget_worker()
    for b in batches:
        yield b
        del b
        release_memory()
    release_memory()


def held_out(id_col: str, modulus: int) -> Column:
    """crc32 of the id's decimal text leaves remainder 0 (a null id: as '')."""
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")) % modulus == 0


def mix64(x: np.ndarray) -> np.ndarray:
    """Finalizer of a 64-bit hash: spreads every input bit (uint64, wraps)."""
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))
