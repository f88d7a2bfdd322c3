"""W5 active_shape on a stream, in event-time order.

``active_shape`` answers from rows in order of time; a stream brings them late. Here
rows wait in the state store until the watermark has passed the time slice that they
fall into. Then the slice is sorted and folded, starting from the key's active shape,
so a row that is late by less than the watermark's delay gets the answer of the batch
form. Rows behind the watermark are dropped by Spark and counted in the query's
progress (``numRowsDroppedByWatermark``).

State per key: the active shape (none after a clear), and the waiting rows in blocks.
While few rows of a key wait (``FEW_ROWS``), those of an input batch are one block, whatever
slices they fall into, so a key with rare rows costs a few calls to the state per batch
and not some for each row. Beyond that, rows are written to state by slices: a key that
holds most rows is never held whole, only its few rows and one slice (a minute) at a
time. Rows of a key are folded in order, whichever timer fires first. Rows without an
event time are not kept waiting: they see, and set, the state of their arrival.

Integer columns with NULLs are doubles inside pandas, as in every pandas function of
Spark: exact up to 2^53.
"""

from __future__ import annotations

import itertools
import pickle
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from cursorlake.functions.time import epoch_ms_to_ts
from cursorlake.operators.active_shape import CLEAR, markers
from cursorlake.streaming.ingest import WATERMARK_DELAY

SLICE_MS = 60_000
FEW_ROWS = 5_000  # of a key, held in blocks of several slices
OUT_ROWS = 10_000  # per frame
PROVIDER = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def use_rocksdb(spark: SparkSession) -> None:
    """State with several variables and timers needs the RocksDB store (the library's
    own sessions have it by default)."""
    spark.conf.set(PROVIDER, ROCKSDB)


def _null(value) -> bool:
    return value is None or value != value


class ActiveShape(StatefulProcessor):
    """Rows are tuples of the input's columns, marker, key, time and time in ms. A
    waiting one is kept with its turn, the number of the block it came in."""

    def __init__(self, columns: list[str], order: list[str], out: str, slice_ms: int, few_rows: int = FEW_ROWS):
        self.columns, self.out, self.slice_ms, self.few_rows = columns, out, slice_ms, few_rows
        self.order = [columns.index(c) for c in order]

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.active = handle.getValueState("active", "shape string")
        self.held = handle.getValueState("held", "few long, turn long")  # rows in blocks of several slices; blocks so far
        self.blocks = handle.getMapState("blocks", "slice long", "n int")  # by the first slice
        self.waiting = handle.getMapState("waiting", "slice long, block int", "rows binary")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        for pdf in rows:
            timeless, timed = [], []
            for row in pdf.itertuples(index=False, name=None):
                (timeless if _null(row[-1]) else timed).append(row)
            if timeless:
                yield from self._folded([(0, row) for row in timeless])
            if timed:
                few, turn = self.held.get() or (0, 0)
                wide = few + len(timed) <= self.few_rows
                for part in [timed] if wide else self._slices(timed):
                    self._keep([(turn, row) for row in part], wide)
                self.held.update((few + len(timed) if wide else few, turn + 1))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        over = timerValues.getCurrentWatermarkInMs() // self.slice_ms  # slices below it are complete
        ready = sorted((k[0], v[0]) for k, v in self.blocks.iterator() if k[0] < over)
        waiting, read = [], 0
        for number, n in ready:
            complete, waiting = self._split(waiting, number)  # no later block holds rows before its first slice
            yield from self._folded(complete)
            for i in range(n):
                wide, rows = pickle.loads(self.waiting.getValue((number, i))[0])
                waiting += rows
                read += len(rows) if wide else 0
                self.waiting.removeKey((number, i))
            self.blocks.removeKey((number,))
        complete, waiting = self._split(waiting, over)
        yield from self._folded(complete)
        if waiting:
            self._keep(waiting, True)
        if read:
            few, turn = self.held.get()
            self.held.update((few - read + len(waiting), turn))

    def _slice(self, row: tuple) -> int:
        return int(row[-1]) // self.slice_ms

    def _slices(self, rows: list[tuple]) -> list[list[tuple]]:
        rows = sorted(rows, key=self._slice)
        return [list(part) for _, part in itertools.groupby(rows, key=self._slice)]

    def _split(self, waiting: list[tuple], number: int) -> tuple[list[tuple], list[tuple]]:
        """The waiting rows of slices below that one, and the others."""
        parts = ([], [])
        for kept in waiting:
            parts[self._slice(kept[1]) >= number].append(kept)
        return parts

    def _keep(self, waiting: list[tuple], wide: bool) -> None:
        """One more block; a timer wakes it when its first slice is over."""
        number = min(self._slice(row) for _, row in waiting)
        n = (self.blocks.getValue((number,)) or (0,))[0]
        self.waiting.updateValue((number, n), (pickle.dumps((wide, waiting), pickle.HIGHEST_PROTOCOL),))
        self.blocks.updateValue((number,), (n + 1,))
        if not n:
            self.handle.registerTimer((number + 1) * self.slice_ms)

    def _folded(self, rows: list[tuple]) -> Iterator[pd.DataFrame]:
        """The rows in order with the active shape after each; the last one's is kept."""
        if not rows:
            return
        rows.sort(key=lambda r: (*[(False, 0) if _null(r[1][i]) else (True, r[1][i]) for i in self.order], r[0]))
        before = shape = (self.active.get() or (None,))[0]
        n, out = len(self.columns), []
        for _, row in rows:
            mark = row[n]
            if not _null(mark):
                shape = None if mark == CLEAR else mark
            out.append((*row[:n], shape))
        if shape is None and before is not None:
            self.active.clear()
        elif shape != before:
            self.active.update((shape,))
        for at in range(0, len(out), OUT_ROWS):
            yield pd.DataFrame.from_records(out[at: at + OUT_ROWS], columns=[*self.columns, self.out])

    def close(self) -> None:
        pass


def active_shape_in_order(events: DataFrame, key: str = "user_id", order: tuple[str, ...] = ("timestamp", "event_id"),
                          event_type: str = "event_type", shape_id: str = "shape_id", out: str = "active_shape",
                          delay: str = WATERMARK_DELAY, slice_ms: int = SLICE_MS) -> DataFrame:
    """The columns of the stream ``events`` and ``out``; append mode, one row out per row
    in, once the watermark (``delay`` behind the latest time) has passed its slice.
    ``order[0]`` must be epoch milliseconds. The key may have any type."""
    use_rocksdb(events.sparkSession)
    time = epoch_ms_to_ts(order[0])
    rows = (events.withColumn("__marker", markers(events, event_type, shape_id)).withColumn("__key", F.col(key))
            .withColumn("__time", time).withColumn("__ms", F.when(F.col("__time").isNotNull(), F.col(order[0])))
            .withWatermark("__time", delay))
    schema = T.StructType([*events.schema.fields, T.StructField(out, T.StringType())])
    return rows.groupBy("__key").transformWithStateInPandas(
        ActiveShape(events.columns, list(order), out, slice_ms), schema, "append", "EventTime")
