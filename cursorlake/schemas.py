"""Event schemas, one registry keyed by event kind (P14 ``schema_for_kind``).

Two families exist, because the two ingest paths store different columns:

* ``SINK`` -- the streaming job's tables: payload columns plus ``ts`` (event
  time) and ``ts_hour`` (partition key), epoch-ms ``timestamp`` kept as BIGINT.
* ``LOADER`` -- the micro-batch loader's tables: payload columns with
  ``timestamp`` as a wall-clock TIMESTAMP_NTZ, no ``ts``/``ts_hour``, every
  column non-null.
"""

from __future__ import annotations

from pyspark.sql import types as T

B, I, L, D, S = T.BooleanType(), T.IntegerType(), T.LongType(), T.DoubleType(), T.StringType()
TS, NTZ = T.TimestampType(), T.TimestampNTZType()

# Column names, types and order of the event tables.
MOUSE_PAYLOAD = [
    ("shape", S), ("event_type", S), ("altKey", B), ("ctrlKey", B), ("metaKey", B),
    ("shiftKey", B), ("button", I), ("buttons", I), ("clientX", I), ("clientY", I),
    ("pageX", I), ("pageY", I), ("screenX", I), ("screenY", I), ("timestamp", L),
    ("canvasX", D), ("canvasY", D), ("movementX", D), ("movementY", D), ("isTrusted", B),
]
KEYDOWN_PAYLOAD = [
    ("altKey", B), ("ctrlKey", B), ("metaKey", B), ("shiftKey", B), ("key", S),
    ("code", S), ("timestamp", L), ("type", S),
]
MOUSE_LOADER = [
    ("altKey", B), ("ctrlKey", B), ("metaKey", B), ("shiftKey", B), ("button", I),
    ("buttons", I), ("clientX", I), ("clientY", I), ("pageX", I), ("pageY", I),
    ("screenX", I), ("screenY", I), ("timestamp", NTZ), ("event_type", S),
    ("canvasId", S), ("canvasX", D), ("canvasY", D), ("movementX", D), ("movementY", D),
    ("isTrusted", B), ("shape", S),
]
KEYDOWN_LOADER = [
    ("altKey", B), ("ctrlKey", B), ("metaKey", B), ("shiftKey", B), ("key", S),
    ("code", S), ("timestamp", NTZ), ("type", S),
]
EVENT_TIME = [("ts", TS), ("ts_hour", TS)]

KINDS = ("mouse", "keydown")
PAYLOAD = {"mouse": MOUSE_PAYLOAD, "keydown": KEYDOWN_PAYLOAD}
LOADER = {"mouse": MOUSE_LOADER, "keydown": KEYDOWN_LOADER}


def _struct(fields, nullable=True) -> T.StructType:
    return T.StructType([T.StructField(n, t, nullable) for n, t in fields])


def schema_for_kind(kind: str, family: str = "sink",
                    extra: list[tuple[str, T.DataType]] | None = None) -> T.StructType:
    """Schema of ``kind`` in ``family`` (``payload``, ``sink`` or ``loader``).

    ``extra`` appends caller columns (e.g. a user key) that the projection
    keeps in addition to the declared ones.
    """
    if kind not in KINDS:
        raise KeyError(f"unknown event kind {kind!r}; known: {KINDS}")
    extra = list(extra or [])
    if family == "payload":
        return _struct(PAYLOAD[kind] + extra)
    if family == "sink":
        return _struct(PAYLOAD[kind] + extra + EVENT_TIME)
    if family == "loader":
        return _struct(LOADER[kind] + extra, nullable=False)
    raise KeyError(f"unknown schema family {family!r}")


def table_name(kind: str) -> str:
    return f"{kind}_events"

