"""W5 active_shape on a stream: per-key state across micro-batches.

``applyInPandasWithState`` keeps one value per key (the active shape id) and
forgets it when the shape is cleared, so state holds only keys with an active
shape. Each micro-batch hands a key's new rows over in Arrow batches; they are
sorted by the order columns and folded with vectorised pandas: a carry-forward
of the markers, seeded with the stored state. State lives in the session's state
store (RocksDB by the library's defaults) and is checkpointed with the query, so a
restart continues from the last committed batch.

Rows are folded in time order within a micro-batch and in arrival order across
batches: a row that arrives late sees the state of its arrival, unlike in the
batch form. All rows of one key of a batch are in one Python worker, so the
source's bound on a batch (``max_rows``, ``max_files``) is what bounds it.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.state import GroupStateTimeout

from cursorlake.operators.active_shape import CLEAR, markers

STATE_SCHEMA = "active string"


def _fold(columns: list[str], order: list[str], out: str) -> Callable:
    def fold(key, pdfs: Iterator[pd.DataFrame], state) -> Iterator[pd.DataFrame]:
        prev = state.get[0] if state.exists else None
        parts = [p for p in pdfs if len(p)]
        if not parts:
            return
        pdf = pd.concat(parts, ignore_index=True).sort_values(order, kind="stable")
        mk = pdf["__marker"].copy()
        if prev is not None and pd.isna(mk.iloc[0]):
            mk.iloc[0] = prev
        carried = mk.ffill()
        last = carried.iloc[-1]
        if pd.notna(last) and last != CLEAR:
            state.update((last,))
        elif state.exists:
            state.remove()
        yield pdf[columns].assign(**{out: carried.where(carried.notna() & (carried != CLEAR), None)})
    return fold


def active_shape_stream(events: DataFrame, key: str = "user_id", order: tuple[str, ...] = ("timestamp", "event_id"),
                        event_type: str = "event_type", shape_id: str = "shape_id",
                        out: str = "active_shape") -> DataFrame:
    """Streaming W5: the columns of ``events`` and ``out``; output mode append,
    one output row per input row. The key may have any type."""
    rows = events.withColumn("__marker", markers(events, event_type, shape_id)).withColumn("__key", F.col(key))
    schema = T.StructType([*events.schema.fields, T.StructField(out, T.StringType())])
    return rows.groupBy("__key").applyInPandasWithState(
        _fold(events.columns, list(order), out), schema, STATE_SCHEMA, "append", GroupStateTimeout.NoTimeout)
