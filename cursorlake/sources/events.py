"""Browser payloads derived from the driver's ``events`` table.

The reference receives mouse and keydown payloads from a page; the given
tables hold generic events instead. Each event row is mapped to one payload
with integer arithmetic on ``event_id`` (so that Spark and a SQL oracle give
identical values): 70 % mouse, 30 % keydown, the pointer hit-tested against
a canvas of shapes exactly as the page does before sending. ``user_id`` and
``event_id`` ride along as extra payload fields (keys for W5, tie-breaks for
the newest-first listings).

Everything is one projection over the scan: no shuffle, no Python.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cursorlake.functions.payload import payload_json
from cursorlake.session import cached_columns
from cursorlake.functions.shapes import TEST_SHAPES
from cursorlake.operators.hit_test import hit_shape
from cursorlake.functions.payload import shape_summary

# Mouse event types (item q % 10 + 1) and keys (item q % 5 + 1).
MOUSE_TYPES = ["mousemove", "click", "dblclick", "contextmenu", "mousedown",
               "mouseup", "mouseover", "mouseout", "mouseenter", "mouseleave"]
KEYS = ["A", "B", "C", "Enter", "Escape"]
CODES = ["KeyA", "KeyB", "KeyC", "Enter", "Escape"]

EXTRA_FIELDS = [("user_id", T.LongType()), ("event_id", T.LongType())]

EVENT_COLUMNS = ("event_id", "ts", "user_id")


def load_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def load_events(spark: SparkSession, sf_dir: str, partitions: int | None = None) -> DataFrame:
    """The columns of ``events`` that payloads use (pruned at the scan).
    ``partitions`` deals the rows out evenly, for a file that cannot be split."""
    events = load_table(spark, sf_dir, "events").select(*EVENT_COLUMNS)
    return events.repartition(partitions) if partitions else events


def _pick(items: list[str], idx: Column) -> Column:
    return F.element_at(F.array(*[F.lit(i) for i in items]), (idx + 1).cast("int"))


def epoch_ms(ts: Column) -> Column:
    """Epoch ms of the table's wall-clock UTC ``ts`` (NTZ; session pinned to UTC)."""
    return F.floor(F.unix_micros(ts.cast("timestamp")) / 1000).cast("long")


def is_mouse(eid: Column) -> Column:
    return eid % 10 < 7


def mouse_columns(eid: Column, ts: Column, shapes=TEST_SHAPES) -> dict[str, Column]:
    """Mouse payload fields (page order), keyed by field name."""
    q = F.floor(eid / 10)
    etype = _pick(MOUSE_TYPES, q % 10)
    cx = ((eid * 137) % 400).cast("double")
    cy = ((eid * 71 + eid % 13) % 400).cast("double")
    hit = hit_shape(cx, cy, shapes, "last")
    return {
        "shape": shape_summary(hit),
        "stream": F.lit("mouse"),
        "event_type": etype,
        "canvasX": cx, "canvasY": cy,
        "clientX": (cx.cast("int") + 8), "clientY": (cy.cast("int") + 16),
        "pageX": (cx.cast("int") + 8), "pageY": (cy.cast("int") + 16),
        "screenX": ((eid * 31) % 1920).cast("int"), "screenY": ((eid * 17) % 1080).cast("int"),
        "movementX": (eid % 11 - 5).cast("double"), "movementY": (eid % 7 - 3).cast("double"),
        "button": F.when(etype == "contextmenu", 2).otherwise(0),
        "buttons": F.when(etype == "mousedown", 1).otherwise(0),
        "ctrlKey": eid % 89 < 9, "altKey": eid % 97 < 10,
        "shiftKey": eid % 83 < 8, "metaKey": eid % 79 < 8,
        "timestamp": epoch_ms(ts),
        "isTrusted": F.lit(True),
    }


def keydown_columns(eid: Column, ts: Column) -> dict[str, Column]:
    """Keydown payload fields (page order), keyed by field name."""
    q = F.floor(eid / 10)
    return {
        "stream": F.lit("keydown"),
        "key": _pick(KEYS, q % 5), "code": _pick(CODES, q % 5),
        "altKey": eid % 97 < 10, "ctrlKey": eid % 89 < 9,
        "shiftKey": eid % 83 < 8, "metaKey": eid % 79 < 8,
        "timestamp": epoch_ms(ts),
        "type": F.lit("keydown"),
    }


def _struct(cols: dict[str, Column], eid: Column, uid: Column) -> Column:
    return F.struct(*[c.alias(n) for n, c in cols.items()], uid.alias("user_id"), eid.alias("event_id"))


# Messages as producers really send them: one event in DIRTY_EVERY is replaced
# by the next of these texts, with its id in place of @.
DIRTY_EVERY = 97
DIRTY_MESSAGES = (
    '{"clientX":"12","altKey":"false","timestamp":"1704067200123","shape":null,"event_id":@}',
    '{"clientX":3.9,"altKey":0,"timestamp":"x","shape":[],"event_id":@}',
    '{}',
    'not json',
    '',
    '[1]',
    '{"clientX":99999999999,"canvasX":"","altKey":null,"event_id":@}',
    '{"clientX":1,"event_id":@} x',
    '{"clientX":"3.9","event_id":@}',
    '{"clientX":" 12 ","altKey":{},"event_id":@}',
    '{"clientX":NaN,"event_id":@}',
    '{"altKey":"abc","event_id":@}',
    '{"clientX":1,"event_id":@}\n',
    '{"clientX":1,"event_id":@} {"clientX":2}',
    '{"clientX":1,"clientX":2,"event_id":@}',
    '{"timestamp":1704067200123456789,"event_id":@}',
    '{"timestamp":1704067200123456,"event_id":@}',
    '{"timestamp":9223372036854775807,"event_id":@}',
)


def is_dirty(eid: Column) -> Column:
    return eid % DIRTY_EVERY == 0


def with_dirty(messages: DataFrame) -> DataFrame:
    """``messages`` (event_id, value) with every DIRTY_EVERY-th text replaced."""
    eid = F.col("event_id")
    form = F.element_at(F.array(*[F.lit(m) for m in DIRTY_MESSAGES]),
                        (F.floor(eid / DIRTY_EVERY) % len(DIRTY_MESSAGES) + 1).cast("int"))
    text = F.replace(form, F.lit("@"), eid.cast("string"))
    return messages.withColumn("value", F.when(is_dirty(eid), text).otherwise(F.col("value")))


@cached_columns
def _message_value(shapes: tuple) -> Column:
    eid, uid, ts = F.col("event_id"), F.col("user_id"), F.col("ts")
    mouse = payload_json(_struct(mouse_columns(eid, ts, shapes), eid, uid))
    key = payload_json(_struct(keydown_columns(eid, ts), eid, uid))
    return F.when(is_mouse(eid), mouse).otherwise(key).alias("value")


def payload_messages(events: DataFrame, shapes=TEST_SHAPES) -> DataFrame:
    """One JSON message per event: (event_id, user_id, value)."""
    return events.select("event_id", "user_id", _message_value(tuple(shapes)))
