"""J1 hit_test / J2 hit_test_first on a stream, against a table of shapes that may change.

A fixed list of shapes needs nothing special: ``operators.hit_test.hit_test`` is a narrow
projection and runs on a stream as it is. Shapes that users draw and move live in a
table. A plain stream-static join would list that table's files once, at the start of
the query; here each micro-batch reads the table anew, so a change takes effect with
the next batch, and picks the form by the table's size:

* up to MAX_CASE_SHAPES shapes come to the driver and become conditions, no shuffle;
* more are joined by grid cells, as in a batch.

Each batch is written to a folder of its own, replaced as a whole when the batch is
tried again (then with the shapes of that time), so every event has one answer.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from cursorlake.functions.shapes import Shape
from cursorlake.operators.hit_test import MAX_CASE_SHAPES, hit_test, hit_test_grid, hits_only

FIELDS = ("id", "kind", "z", "a", "b", "c", "d", "e", "f", "label", "color")
INTERVAL = "1 second"


def hit_test_table(df: DataFrame, shapes: DataFrame, x: str = "canvasX", y: str = "canvasY", order: str = "last",
                   out: str = "shape", most: int = MAX_CASE_SHAPES) -> DataFrame:
    """J1 / J2 of a batch against a table of shapes (the columns of ``hit_test_grid``),
    as conditions if it holds at most ``most`` rows, else by grid cells."""
    found = shapes.limit(most + 1).collect()
    if len(found) > most or any(s["z"] is None for s in found):
        return hit_test_grid(df, shapes, x, y, order, out)
    place = "position" in shapes.columns
    found.sort(key=lambda s: ((s["position"] is not None, s["position"] or 0) if place else (), s["id"] is not None, s["id"] or ""))
    return hit_test(df, [Shape(*(s[c] for c in FIELDS)) for s in found], x, y, order, out)


def start_hit_test(events: DataFrame, read_shapes: Callable[[SparkSession], DataFrame], path: str, checkpoint: str,
                   x: str = "canvasX", y: str = "canvasY", order: str = "last", out: str = "shape",
                   hits: bool = False, most: int = MAX_CASE_SHAPES, available_now: bool = False,
                   interval: str = INTERVAL) -> StreamingQuery:
    """Start the hit test of a stream of events. ``read_shapes`` is called for every
    batch; ``hits`` keeps only events on a shape (F3). Read with :func:`read_hits`."""
    def batch(rows: DataFrame, batch_id: int) -> None:
        got = hit_test_table(rows, read_shapes(rows.sparkSession), x, y, order, out, most)
        (hits_only(got, out) if hits else got).write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")

    writer = events.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime=interval)).start()


def read_hits(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path).drop("batch_id")
