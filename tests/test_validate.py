"""Rule outcomes on hand-written payloads."""

from cursorlake.functions.validate import validate_payload

CASES = [
    ('{"key":"A","code":"KeyA","timestamp":1,"type":"keydown"}', "keydown", []),
    ('{"key":"A","code":"KeyA","timestamp":"12","type":"keydown","altKey":"yes"}', "keydown", []),
    ('{"key":"A","timestamp":1.5,"type":"keydown"}', "keydown",
     ["timestamp: required integer", "code: required string"]),
    ('{"code":"KeyA","key":"A","type":3,"timestamp":2,"ctrlKey":"maybe"}', "keydown",
     ["ctrlKey: not a boolean", "type: required string"]),
    ('{"event_type":"click","timestamp":5,"altKey":true}', "mouse", []),
    ('{"timestamp":5}', "mouse", ["type: required string"]),
    ('{"event_type":"click","timestamp":true,"clientX":"abc","canvasX":[],"isTrusted":"maybe","canvasId":7}', "mouse",
     ["clientX: not an integer", "canvasX: not a number", "isTrusted: not a boolean", "canvasId: not a string"]),
    ('{"event_type":"click","timestamp":1,"clientX":"12","pageX":true,"canvasX":"1.5","button":null,"shape":{"id":"s1"}}', "mouse", []),
    ('{"event_type":"click","timestamp":1} x', "mouse", ["not a JSON object"]),
    ('{"key":"A","code":"KeyA","timestamp":1,"type":"keydown","event_type":5}', "keydown", ["event_type: not a string"]),
    ('[1]', "mouse", ["not a JSON object", "timestamp: required integer", "type: required string"]),
]


def test_rules(spark):
    for msg, kind, want in CASES:
        df = spark.createDataFrame([(msg,)], "value string")
        r = validate_payload(df, kind).first()
        assert sorted(r.reasons) == sorted(want), (msg, r.reasons)
        assert r.status == ("valid" if not want else "rejected")
    r = validate_payload(spark.createDataFrame([(CASES[1][0],)], "value string"), "keydown").first()
    assert (r.altKey, r.timestamp, r.event_type) == (True, 12, "keydown")
    r = validate_payload(spark.createDataFrame([('{"event_type":"x","timestamp":1,"altKey":null}',)], "value string"), "mouse").first()
    assert r.altKey is None and r.status == "valid"
