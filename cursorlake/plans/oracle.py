"""SQL oracle text (DuckDB dialect) for the registered queries.

Each statement recomputes its answer straight from the ``events`` view with
plain SQL -- the payload mapping, a theta join against a VALUES table of
shapes with ``row_number`` for the hit test, window functions for W5 -- so it
checks the Spark plans independently of how they are built.
"""

from __future__ import annotations

from cursorlake.functions.shapes import TEST_SHAPES
from cursorlake.sources.events import CODES, DIRTY_EVERY, DIRTY_MESSAGES, KEYS, MOUSE_TYPES


def _lit(v) -> str:
    if v is None:
        return "NULL"
    if isinstance(v, str):
        return "'" + v.replace("'", "''") + "'"
    return repr(float(v))


def _shapes_values(shapes=TEST_SHAPES) -> str:
    rows = []
    for s in shapes:
        vals = [s.id, s.kind, None, s.a, s.b, s.c, s.d, s.e, s.f, s.label, s.color]
        cells = [_lit(v) if i != 2 else str(int(s.z)) for i, v in enumerate(vals)]
        cells[3:9] = [f"CAST({c} AS DOUBLE)" for c in cells[3:9]]
        rows.append("(" + ", ".join(cells) + ")")
    return ("shapes(id, kind, z, a, b, c, d, e, f, label, color) AS (VALUES "
            + ", ".join(rows) + ")")


def _list(items) -> str:
    return "[" + ", ".join(_lit(i) for i in items) + "]"


_AREA = "abs(({ax}*({by}-{cy}) + {bx}*({cy}-{ay}) + {cx}*({ay}-{by}))/2)"


def _area(ax, ay, bx, by, cx, cy) -> str:
    return _AREA.format(ax=ax, ay=ay, bx=bx, by=by, cx=cx, cy=cy)


def _contains(x: str, y: str) -> str:
    tri = (f"abs({_area('s.a', 's.b', 's.c', 's.d', 's.e', 's.f')} - "
           f"({_area(x, y, 's.c', 's.d', 's.e', 's.f')} + {_area('s.a', 's.b', x, y, 's.e', 's.f')} + "
           f"{_area('s.a', 's.b', 's.c', 's.d', x, y)})) < 0.5")
    return (f"CASE s.kind WHEN 'rect' THEN {x} >= s.a AND {x} <= s.a + s.c AND {y} >= s.b AND {y} <= s.b + s.d "
            f"WHEN 'circle' THEN sqrt(({x}-s.a)*({x}-s.a) + ({y}-s.b)*({y}-s.b)) <= s.c "
            f"WHEN 'triangle' THEN {tri} ELSE false END")


def ctes(order: str = "last") -> str:
    """Common CTEs: ``mouse`` and ``keydown`` payload rows (decoded form),
    with the hit shape for mouse; ``order`` = last / first hit."""
    z_order = "DESC" if order == "last" else "ASC"
    return f"""
{_shapes_values()},
base AS (
  SELECT event_id, user_id, epoch_us(ts) // 1000 AS ms, event_id // 10 AS q FROM events),
mouse0 AS (
  SELECT event_id, user_id, ms, q,
    list_extract({_list(MOUSE_TYPES)}, CAST(q % 10 AS INTEGER) + 1) AS event_type,
    CAST((event_id * 137) % 400 AS DOUBLE) AS canvasX,
    CAST((event_id * 71 + event_id % 13) % 400 AS DOUBLE) AS canvasY
  FROM base WHERE event_id % 10 < 7),
hits AS (
  SELECT m.event_id, s.id, s.kind, s.label, s.color,
         row_number() OVER (PARTITION BY m.event_id ORDER BY s.z {z_order}) AS rn
  FROM mouse0 m JOIN shapes s ON ({_contains('m.canvasX', 'm.canvasY')})),
mouse AS (
  SELECT
    CASE WHEN h.id IS NULL THEN NULL ELSE
      to_json(struct_pack(id := h.id, type := h.kind, label := h.label, color := h.color))::VARCHAR END AS shape,
    h.id AS shape_id,
    CASE WHEN h.id IS NULL THEN NULL ELSE
      struct_pack(id := h.id, type := h.kind, label := h.label, color := h.color) END AS shape_obj,
    m.event_type,
    (m.event_id % 97 < 10) AS altKey, (m.event_id % 89 < 9) AS ctrlKey,
    (m.event_id % 79 < 8) AS metaKey, (m.event_id % 83 < 8) AS shiftKey,
    CAST(CASE WHEN m.event_type = 'contextmenu' THEN 2 ELSE 0 END AS INTEGER) AS button,
    CAST(CASE WHEN m.event_type = 'mousedown' THEN 1 ELSE 0 END AS INTEGER) AS buttons,
    CAST(m.canvasX AS INTEGER) + 8 AS clientX, CAST(m.canvasY AS INTEGER) + 16 AS clientY,
    CAST(m.canvasX AS INTEGER) + 8 AS pageX, CAST(m.canvasY AS INTEGER) + 16 AS pageY,
    CAST((m.event_id * 31) % 1920 AS INTEGER) AS screenX,
    CAST((m.event_id * 17) % 1080 AS INTEGER) AS screenY,
    m.ms AS "timestamp",
    m.canvasX, m.canvasY,
    CAST(m.event_id % 11 - 5 AS DOUBLE) AS movementX,
    CAST(m.event_id % 7 - 3 AS DOUBLE) AS movementY,
    true AS isTrusted,
    m.user_id, m.event_id,
    epoch_ms(m.ms) AS ts,
    date_trunc('hour', epoch_ms(m.ms)) AS ts_hour
  FROM mouse0 m LEFT JOIN hits h ON h.event_id = m.event_id AND h.rn = 1),
keydown AS (
  SELECT
    (event_id % 97 < 10) AS altKey, (event_id % 89 < 9) AS ctrlKey,
    (event_id % 79 < 8) AS metaKey, (event_id % 83 < 8) AS shiftKey,
    list_extract({_list(KEYS)}, CAST(q % 5 AS INTEGER) + 1) AS "key",
    list_extract({_list(CODES)}, CAST(q % 5 AS INTEGER) + 1) AS code,
    ms AS "timestamp", 'keydown' AS "type",
    user_id, event_id,
    epoch_ms(ms) AS ts,
    date_trunc('hour', epoch_ms(ms)) AS ts_hour
  FROM base WHERE event_id % 10 >= 7)
"""


MOUSE_COLS = ("shape, event_type, altKey, ctrlKey, metaKey, shiftKey, button, buttons, clientX, clientY, "
              "pageX, pageY, screenX, screenY, \"timestamp\", canvasX, canvasY, movementX, movementY, "
              "isTrusted")
KEYDOWN_COLS = 'altKey, ctrlKey, metaKey, shiftKey, "key", code, "timestamp", "type"'


def with_ctes(body: str, order: str = "last") -> str:
    return "WITH " + ctes(order).strip() + "\n" + body


# What becomes of each of DIRTY_MESSAGES, written down by hand. Lenient decode:
# (clientX, altKey, timestamp, shape, event_id is there), or None if dropped.
LENIENT = [
    ("12", "false", "1704067200123", "NULL", "true"),
    ("3", "false", "NULL", "'[]'", "true"),
    ("NULL", "NULL", "NULL", "NULL", "false"),
    None,
    None,
    None,
    ("NULL", "NULL", "NULL", "NULL", "true"),
    ("1", "NULL", "NULL", "NULL", "true"),
    ("NULL", "NULL", "NULL", "NULL", "true"),
    ("12", "NULL", "NULL", "NULL", "true"),
    None,
    ("NULL", "NULL", "NULL", "NULL", "true"),
    ("1", "NULL", "NULL", "NULL", "true"),
    ("1", "NULL", "NULL", "NULL", "true"),
    ("2", "NULL", "NULL", "NULL", "true"),
    ("NULL", "NULL", "1704067200123456789", "NULL", "true"),
    ("NULL", "NULL", "1704067200123456", "NULL", "true"),
    ("NULL", "NULL", "9223372036854775807", "NULL", "true"),
]
# Loader: (clientX, altKey, timestamp, shape, event_id is there), or None if kept
# aside; the seventh cannot be loaded as a mouse event only, for its clientX.
LOADER = [
    ("12", "true", "1704067200123", "''", "true"),
    ("3", "false", "0", "'[]'", "true"),
    ("0", "false", "0", "''", "false"),
    None,
    None,
    None,
    ("NULL", "false", "0", "''", "true"),
    None,
    ("0", "false", "0", "''", "true"),
    ("12", "true", "0", "''", "true"),
    None,
    ("0", "true", "0", "''", "true"),
    ("1", "false", "0", "''", "true"),
    None,
    ("2", "false", "0", "''", "true"),
    None,
    None,
    None,
]
# Payload rules: broken ones as (mouse, keydown).
BROKEN = [(1, 3), (3, 4), (2, 4), (3, 5), (3, 5), (3, 5), (3, 4), (3, 5), (3, 4), (3, 5), (3, 5), (3, 5), (2, 4), (3, 5),
          (2, 4), (1, 3), (1, 3), (1, 3)]


def _forms(name: str, columns: str, rows: list) -> str:
    cells = ", ".join(f"({i}, {', '.join(r)})" for i, r in enumerate(rows) if r is not None)
    return f"{name}(form, {columns}) AS (VALUES {cells})"


def dirty_ctes() -> str:
    """``mouse_all`` and ``keydown_all`` (lenient), ``mouse_loaded`` and
    ``keydown_loaded`` (loader), ``dirty`` and ``broken``."""
    every, n = DIRTY_EVERY, len(DIRTY_MESSAGES)
    texts = [(str(len(m.encode()) - ("@" in m)), str("@" in m).lower()) for m in DIRTY_MESSAGES]
    clean = f"event_id % {every} <> 0"
    ident = "CASE WHEN has_id THEN event_id END"
    ts = "CASE WHEN ms <= 253402300799999 THEN epoch_ms(least(ms, 253402300799999)) END"
    lenient = f"""altKey, CAST(ms AS BIGINT) AS "timestamp", {ident} AS event_id, {ts} AS ts,
    date_trunc('hour', {ts}) AS ts_hour FROM dirty JOIN lenient USING (form)"""
    stamp = 'epoch_ms("timestamp") AS "timestamp"'
    loaded = f"""altKey, false AS ctrlKey, false AS metaKey, false AS shiftKey, epoch_ms(ms) AS "timestamp",
    CAST(0 AS BIGINT) AS user_id, coalesce({ident}, 0) AS event_id FROM dirty JOIN loader USING (form)"""
    return f""",
dirty AS (
  SELECT event_id, event_id % 10 < 7 AS of_mouse, (event_id // {every}) % {n} AS form
  FROM base WHERE event_id % {every} = 0),
{_forms("texts", "size, has_id", texts)},
{_forms("lenient", "clientX, altKey, ms, shape, has_id", LENIENT)},
{_forms("loader", "clientX, altKey, ms, shape, has_id", LOADER)},
{_forms("broken", "of_mouse_n, of_keydown_n", [(str(a), str(b)) for a, b in BROKEN])},
mouse_all AS (
  SELECT {MOUSE_COLS}, user_id, event_id, ts, ts_hour FROM mouse WHERE {clean}
  UNION ALL BY NAME
  SELECT shape, clientX, {lenient} WHERE of_mouse),
keydown_all AS (
  SELECT {KEYDOWN_COLS}, user_id, event_id, ts, ts_hour FROM keydown WHERE {clean}
  UNION ALL BY NAME
  SELECT {lenient} WHERE NOT of_mouse),
mouse_loaded AS (
  SELECT altKey, ctrlKey, metaKey, shiftKey, button, buttons, clientX, clientY, pageX, pageY, screenX, screenY, {stamp},
         event_type, '' AS canvasId, canvasX, canvasY, movementX, movementY, isTrusted, coalesce(shape, '') AS shape,
         user_id, event_id FROM mouse WHERE {clean}
  UNION ALL BY NAME
  SELECT 0 AS button, 0 AS buttons, clientX, 0 AS clientY, 0 AS pageX, 0 AS pageY, 0 AS screenX, 0 AS screenY,
         '' AS event_type, '' AS canvasId, 0.0 AS canvasX, 0.0 AS canvasY, 0.0 AS movementX, 0.0 AS movementY,
         false AS isTrusted, shape, {loaded} WHERE of_mouse AND clientX IS NOT NULL),
keydown_loaded AS (
  SELECT altKey, ctrlKey, metaKey, shiftKey, "key", code, {stamp}, "type", user_id, event_id FROM keydown WHERE {clean}
  UNION ALL BY NAME
  SELECT '' AS "key", '' AS code, '' AS "type", {loaded} WHERE NOT of_mouse),
kept_aside AS (
  SELECT CASE WHEN of_mouse THEN 'mouse' ELSE 'keydown' END AS kind FROM dirty LEFT JOIN loader USING (form)
  WHERE has_id IS NULL OR (of_mouse AND clientX IS NULL))
"""


def both_kinds(of_mouse: str, of_keydown: str) -> str:
    return f"SELECT 'mouse' AS kind, * FROM ({of_mouse}) UNION ALL BY NAME SELECT 'keydown' AS kind, * FROM ({of_keydown})"
