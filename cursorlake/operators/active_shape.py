"""W5 active_shape, batch form: the shape a user is dragging.

An ordered fold per key: ``mousedown`` on a shape makes it active, a
``mouseup`` on no shape clears it, anything else leaves it unchanged. The
state after each event is the last non-null "marker" so far (shape id, or
'' for a clear) -- a carry-forward, which is associative, so it is computed
as a two-level scan instead of one window over a whole key:

1. rows are shuffled once by (key, time chunk) and a window inside each chunk
   carries markers forward locally; a hot key is spread over its chunks;
2. the last row of every chunk is taken from the same shuffled rows (as a whole
   row, so that both uses of the exchange read the same columns and share it);
3. a window over the small chunk table per key carries the markers across
   chunks (one row per chunk, not per event);
4. each row takes its local marker, else the carried one, by a join on
   (key, chunk), for which the rows already lie right.

A NULL key is a key like any other, as in a window: key and chunk are compared
inside a struct, where NULL equals NULL.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

CLEAR = ""


def markers(df: DataFrame, event_type: str = "event_type", shape_id: str = "shape_id"):
    """Marker column: hit id on mousedown, '' on mouseup off any shape."""
    et, sid = F.col(event_type), F.col(shape_id)
    return (F.when((et == "mousedown") & sid.isNotNull(), sid)
             .when((et == "mouseup") & sid.isNull(), F.lit(CLEAR)))


def active_shape(df: DataFrame, key: str = "user_id", order: tuple[str, ...] = ("timestamp", "event_id"),
                 event_type: str = "event_type", shape_id: str = "shape_id",
                 chunk_ms: int = 3_600_000, out: str = "active_shape") -> DataFrame:
    """Add ``out``: the active shape id after each event (NULL when none).

    ``order[0]`` must be epoch milliseconds; it also defines the chunks.
    """
    t = order[0]
    chunk = F.floor(F.col(t) / F.lit(chunk_ms)).cast("long")
    names = [f"`{c}`" for c in df.columns]
    rows = (df.withColumn("__mk", markers(df, event_type, shape_id))
              .withColumn("__part", F.struct(F.col(key).alias("key"), chunk.alias("chunk"))))
    w_local = (Window.partitionBy("__part").orderBy(*order)
               .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    local = rows.withColumn("__local", F.last("__mk", ignorenulls=True).over(w_local))
    last_row = F.max_by(F.struct("__local", *names), F.struct(*order))
    per_chunk = local.groupBy("__part").agg(last_row.alias("__end"))
    w_carry = (Window.partitionBy("__part.key").orderBy("__part.chunk")
               .rowsBetween(Window.unboundedPreceding, -1))
    carry = per_chunk.select("__part", F.last("__end.__local", ignorenulls=True).over(w_carry).alias("__carry"))
    state = F.coalesce(F.col("__local"), F.col("__carry"))
    return (local.join(carry, ["__part"], "left")
                 .withColumn(out, F.when(state != CLEAR, state))
                 .drop("__mk", "__part", "__local", "__carry"))


def active_shape_single_window(df: DataFrame, key: str = "user_id",
                               order: tuple[str, ...] = ("timestamp", "event_id"),
                               event_type: str = "event_type", shape_id: str = "shape_id",
                               out: str = "active_shape") -> DataFrame:
    """Reference form (one window per key) -- for tests of the scan above."""
    w = Window.partitionBy(key).orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    state = F.last(markers(df, event_type, shape_id), ignorenulls=True).over(w)
    return df.withColumn(out, F.when(state != CLEAR, state))
