"""Oracle SQL per registered query name (DuckDB dialect)."""

from __future__ import annotations

from cursorlake.plans.oracle import KEYDOWN_COLS, MOUSE_COLS, both_kinds, dirty_ctes, with_ctes

ORACLE: dict[str, str] = {}


def _register(name: str, body: str, order: str = "last") -> None:
    ORACLE[name] = with_ctes(body.strip(), order)


def _register_dirty(name: str, body: str, text: bool = True) -> None:
    """Over messages with malformed ones among them; every column as text."""
    _register(name, dirty_ctes() + (f"SELECT COLUMNS(*)::VARCHAR FROM ({body})" if text else body))


# S3 / S4 / F1
_register_dirty("decode_lenient", both_kinds("SELECT * FROM mouse_all", "SELECT * FROM keydown_all"))
_register_dirty("decode_strict", both_kinds(f"SELECT {MOUSE_COLS}, user_id, event_id FROM mouse",
                                            f"SELECT {KEYDOWN_COLS}, user_id, event_id FROM keydown"))
_register_dirty("drop_unparsable", """
SELECT CASE WHEN b.event_id % 10 < 7 THEN 'mouse' ELSE 'keydown' END AS kind, count(*) AS n_messages,
       count(*) - count(CASE WHEN d.form IN (3, 4, 5, 10) THEN 1 END) AS n_objects
FROM base b LEFT JOIN dirty d USING (event_id) GROUP BY 1""", text=False)

# P1..P12
_register("project_mouse", f"SELECT {MOUSE_COLS} FROM mouse")
_register("project_keydown", f"SELECT {KEYDOWN_COLS} FROM keydown")
_register_dirty("epoch_ms_to_ts", 'SELECT event_id, "timestamp", ts FROM mouse_all '
                                  'UNION ALL SELECT event_id, "timestamp", ts FROM keydown_all')
_register_dirty("floor_hour", "SELECT event_id, ts_hour FROM mouse_all UNION ALL SELECT event_id, ts_hour FROM keydown_all")
_register("to_local_time", """
SELECT altKey, ctrlKey, metaKey, shiftKey, "key", code,
       epoch_ms("timestamp") + INTERVAL 9 HOUR AS "timestamp", "type", user_id, event_id,
       ts + INTERVAL 9 HOUR AS ts, ts_hour + INTERVAL 9 HOUR AS ts_hour
FROM keydown""")
_register("nested_to_json_text", "SELECT event_id, shape FROM mouse")
_register("event_kind_of_topic", """
SELECT event_id,
       CASE WHEN event_id % 10 < 7 THEN 'mouse_events' ELSE 'keydown_events' END AS topic,
       CASE WHEN event_id % 10 < 7 THEN 'mouse' ELSE 'keydown' END AS kind
FROM base""")
_register("shape_summary", """
SELECT m.event_id, m.shape_id AS shape_id, s.kind AS shape_type, s.label AS shape_label, s.color AS shape_color
FROM mouse m LEFT JOIN shapes s ON s.id = m.shape_id""")
# K1 / K2
_register("route_to_topic", """
SELECT event_id, CASE WHEN event_id % 10 < 7 THEN 'mouse_events' ELSE 'keydown_events' END AS topic,
       CAST(NULL AS VARCHAR) AS "key"
FROM base""")

# J1 / J2 / F3
_register("hit_test", "SELECT event_id, canvasX, canvasY, shape_id FROM mouse")
_register("hit_test_first", "SELECT event_id, shape_id FROM mouse WHERE shape_id IS NOT NULL", order="first")
_register("hits_only", """
SELECT m.event_id, m.shape_id, s.kind AS shape_type
FROM mouse m JOIN shapes s ON s.id = m.shape_id""")

# A1 / A2
_register("count_events", "SELECT count(*) AS n FROM mouse")
_register("events_per_minute", """
, c AS (
  SELECT date_trunc('minute', epoch_ms("timestamp") + INTERVAL 9 HOUR) AS minute, count(*) AS n
  FROM mouse GROUP BY 1),
b AS (SELECT min(minute) AS lo, max(minute) AS hi FROM c)
SELECT g.minute AS minute, CAST(coalesce(c.n, 0) AS BIGINT) AS n
FROM b, generate_series(b.lo, b.hi, INTERVAL 1 MINUTE) AS g(minute)
LEFT JOIN c ON c.minute = g.minute""")

# O1 / O2
_register("newest_first", f"""
SELECT {KEYDOWN_COLS}, user_id, event_id, ts, ts_hour FROM keydown
ORDER BY "timestamp" DESC, event_id""")
_register("newest_n", f"""
SELECT {MOUSE_COLS}, user_id, event_id, ts, ts_hour FROM mouse
ORDER BY "timestamp" DESC, event_id LIMIT 50""")

# W5
_register("active_shape", """
, mk AS (
  SELECT user_id, event_id, "timestamp", event_type, shape_id,
         CASE WHEN event_type = 'mousedown' AND shape_id IS NOT NULL THEN shape_id
              WHEN event_type = 'mouseup' AND shape_id IS NULL THEN '' END AS marker
  FROM mouse),
st AS (
  SELECT *, last_value(marker IGNORE NULLS) OVER (
           PARTITION BY user_id ORDER BY "timestamp", event_id
           ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS state
  FROM mk)
SELECT user_id, event_id, "timestamp", event_type, shape_id, NULLIF(state, '') AS active_shape FROM st""")

# S1 / K3 / K4 / W4 / K6 / W1 / W2
_register("source_topic", "SELECT event_id FROM base WHERE event_id % 10 < 7")
_register("ingest_mouse", f"SELECT {MOUSE_COLS}, user_id, event_id, ts, ts_hour FROM mouse")
_register("ingest_keydown", f"SELECT {KEYDOWN_COLS}, user_id, event_id, ts, ts_hour FROM keydown")
_register("multi_topic_ingest", """
SELECT 'mouse_events' AS "table", count(*) AS n FROM mouse
UNION ALL SELECT 'keydown_events' AS "table", count(*) AS n FROM keydown""")
_register("partitioned_table", "SELECT ts_hour, count(*) AS n FROM mouse GROUP BY ts_hour")
_register("event_time_watermark", 'SELECT event_id, "timestamp", ts, ts_hour FROM keydown')
_register("checkpointed_ingest", 'SELECT event_id, user_id, "timestamp", ts FROM mouse')

# S5 / S6 / S11
_register("scan_table", f"SELECT {KEYDOWN_COLS}, user_id, event_id, ts, ts_hour FROM keydown")
_register("scan_columns", 'SELECT "timestamp", ts FROM mouse')
_register("list_tables", """
SELECT "table" FROM (VALUES ('mouse_events'), ('keydown_events')) AS t("table")
WHERE EXISTS (SELECT 1 FROM base)""")

# K7 / K8 / K9 / K10
_register("create_namespace", "SELECT 'keydown_events' AS \"table\", count(*) AS n FROM keydown")
_register("create_if_absent", "SELECT 'mouse_events' AS \"table\", count(*) AS n FROM mouse")
_register("recreate_table", "SELECT 'keydown_events' AS \"table\", count(*) AS n FROM keydown")
_register("missing_table_skip", "SELECT 'mouse_events' AS \"table\", count(*) AS n FROM mouse")

# P6 / P7 / K5 (loader semantics: typed defaults, UTC wall-clock timestamp)
_LOADER_MOUSE = """
SELECT altKey, ctrlKey, metaKey, shiftKey, button, buttons, clientX, clientY, pageX, pageY,
       screenX, screenY, epoch_ms("timestamp") AS "timestamp", event_type, '' AS canvasId,
       canvasX, canvasY, movementX, movementY, isTrusted, coalesce(shape, '') AS shape,
       user_id, event_id"""
_OK = "SELECT *, 'ok' AS status, 0 AS n_reasons FROM "
_register_dirty("coerce_defaults", both_kinds(_OK + "mouse_loaded", _OK + "keydown_loaded") + """
UNION ALL BY NAME SELECT kind, 'quarantine' AS status, 1 AS n_reasons FROM kept_aside""")
_register_dirty("enforce_non_null", both_kinds("SELECT * FROM mouse_loaded", "SELECT * FROM keydown_loaded"))
_register("append_microbatch", _LOADER_MOUSE + " FROM mouse")

ORACLE["active_shape_stream"] = ORACLE["active_shape"]

# P13
_register_dirty("validate_payload", both_kinds(
    """SELECT altKey, ctrlKey, metaKey, shiftKey, "timestamp", event_type AS "type", 'valid' AS status, 0 AS n_reasons
    FROM mouse WHERE event_id NOT IN (SELECT event_id FROM dirty)""",
    """SELECT altKey, ctrlKey, metaKey, shiftKey, "timestamp", "type", "key", code, 'keydown' AS event_type,
    'valid' AS status, 0 AS n_reasons FROM keydown WHERE event_id NOT IN (SELECT event_id FROM dirty)""") + """
UNION ALL BY NAME
SELECT CASE WHEN of_mouse THEN 'mouse' ELSE 'keydown' END AS kind, 'rejected' AS status,
       CASE WHEN of_mouse THEN of_mouse_n ELSE of_keydown_n END AS n_reasons FROM dirty JOIN broken USING (form)""")

# The same compact JSON text (field order as the page sends it)
_JSON = """
SELECT event_id, to_json(struct_pack(
  shape := shape_obj, stream := 'mouse', event_type := event_type, canvasX := canvasX, canvasY := canvasY,
  clientX := clientX, clientY := clientY, pageX := pageX, pageY := pageY, screenX := screenX,
  screenY := screenY, movementX := movementX, movementY := movementY, button := button,
  buttons := buttons, ctrlKey := ctrlKey, altKey := altKey, shiftKey := shiftKey, metaKey := metaKey,
  "timestamp" := "timestamp", isTrusted := isTrusted, user_id := user_id, event_id := event_id))::VARCHAR AS value
FROM mouse
UNION ALL
SELECT event_id, to_json(struct_pack(
  stream := 'keydown', "key" := "key", code := code, altKey := altKey, ctrlKey := ctrlKey,
  shiftKey := shiftKey, metaKey := metaKey, "timestamp" := "timestamp", "type" := "type",
  user_id := user_id, event_id := event_id))::VARCHAR AS value
FROM keydown"""
_register("payload_json", _JSON)

# The size of that text, or of the malformed one
_register_dirty("payload_bytes", f""", json_text AS ({_JSON})
SELECT CASE WHEN event_id % 10 < 7 THEN 'mouse' ELSE 'keydown' END AS kind, octet_length(value::BLOB) AS n_bytes
FROM json_text WHERE event_id NOT IN (SELECT event_id FROM dirty)
UNION ALL
SELECT CASE WHEN of_mouse THEN 'mouse' ELSE 'keydown' END AS kind,
       size + CASE WHEN has_id THEN length(CAST(event_id AS VARCHAR)) ELSE 0 END AS n_bytes
FROM dirty JOIN texts USING (form)""", text=False)

# K2: the acknowledgement carries the payload
_register("ack_records", f""", json_text AS ({_JSON})
SELECT event_id, 'queued' AS status,
       CASE WHEN event_id % 10 < 7 THEN 'mouse' ELSE 'keydown' END AS "type",
       CASE WHEN event_id % 10 < 7 THEN 'mouse_events' ELSE 'keydown_events' END AS topic, value AS received
FROM json_text""")

# What holds whatever rows and files there are
_register("sample_rows", "SELECT least(5, count(*)) AS n, least(5, count(*)) AS n_events FROM mouse")
_register("scan_parquet_file", "SELECT least(1, count(*)) AS n, least(1, count(*)) AS n_events FROM keydown")
_register("latest_file", "SELECT least(1, count(*)) AS n, least(1, count(*)) AS n_known FROM mouse")
_register("table_files", "SELECT ts_hour, count(*) AS n, true AS has_bytes FROM mouse GROUP BY ts_hour")
_register("file_name_filter", "SELECT 'data' AS kind, count(*) AS n FROM mouse HAVING count(*) > 0")

# O2 / A1 / K6 over a streamed table
_register("newest_n_table", 'SELECT event_id, "timestamp", ts, ts_hour FROM mouse ORDER BY "timestamp" DESC, event_id LIMIT 50')
_register("count_from_footers", "SELECT ts_hour, count(*) AS n FROM mouse GROUP BY ts_hour")
_register("compact_closed_hours", """
SELECT event_id, "timestamp", ts_hour, (SELECT count(*) FROM mouse) AS n_before,
       (SELECT count(DISTINCT event_id) FROM mouse) AS events_before
FROM mouse""")

# The answers of the plain forms
ORACLE["supervised_ingest"] = ORACLE["multi_topic_ingest"]
ORACLE["active_shape_in_order"] = ORACLE["active_shape"]

# K1 / J1 / J2 on streams; shapes are labelled anew between the two halves of the time span
_register("route_stream", """
SELECT event_id, CASE WHEN event_id % 10 < 7 THEN 'mouse_events' ELSE 'keydown_events' END AS topic,
       CAST(1 AS BIGINT) AS n
FROM base""")
_LABELLED = """
, middle AS (SELECT min(ts) + (max(ts) - min(ts)) / 2 AS mid FROM events),
halves AS (SELECT event_id, CASE WHEN ts < (SELECT mid FROM middle) THEN ' 0' ELSE ' 1' END AS half FROM events)
SELECT event_id, shape_id, label || half AS shape_label
FROM mouse LEFT JOIN (SELECT id AS shape_id, label FROM shapes) USING (shape_id) JOIN halves USING (event_id)"""
_register("hit_test_stream", _LABELLED)
_register("hit_test_first_stream", _LABELLED + " WHERE shape_id IS NOT NULL", order="first")

# Counts of batches
_register_dirty("batch_counts", " UNION ALL ".join(f"""
SELECT '{kind}' AS kind, (SELECT count(*) FROM base WHERE {of_kind}) AS n_messages,
       (SELECT count(*) FROM {kind}_all) AS n_rows,
       (SELECT count(*) FROM base WHERE {of_kind}) - (SELECT count(*) FROM {kind}_all) AS n_unparsable,
       (SELECT count(*) FROM base WHERE {of_kind}) AS n_seen,
       (SELECT count(*) FROM {kind}_loaded) AS n_loaded,
       (SELECT count(*) FROM kept_aside WHERE kind = '{kind}') AS n_quarantined"""
                                                   for kind, of_kind in (("mouse", "event_id % 10 < 7"),
                                                                         ("keydown", "event_id % 10 >= 7"))), text=False)
