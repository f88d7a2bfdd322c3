"""The chunked scan equals one window per key, for any chunk size."""

from pyspark.sql import functions as F

from cursorlake.operators.active_shape import active_shape, active_shape_single_window
from cursorlake.plans import flows
from tests.conftest import SF_MID


def _rows(spark):
    return flows.decoded(spark, SF_MID, "mouse").select(
        "user_id", "event_id", "timestamp", "event_type", F.get_json_object("shape", "$.id").alias("shape_id"))


def test_chunked_equals_window(spark):
    rows = _rows(spark).cache()
    ref = {r.event_id: r.active_shape for r in active_shape_single_window(rows).collect()}
    assert any(v is not None for v in ref.values())
    for chunk_ms in (60_000, 3_600_000, 86_400_000 * 40):
        got = {r.event_id: r.active_shape for r in active_shape(rows, chunk_ms=chunk_ms).collect()}
        assert got == ref, chunk_ms


def test_hot_key(spark):
    """Every row under one key: still equal (the key is split by chunk)."""
    rows = _rows(spark).withColumn("user_id", F.lit(1).cast("long")).cache()
    ref = {r.event_id: r.active_shape for r in active_shape_single_window(rows).collect()}
    got = {r.event_id: r.active_shape for r in active_shape(rows, chunk_ms=600_000).collect()}
    assert got == ref


def test_null_and_text_keys(spark):
    rows = [("u", 1, 0, "mousedown", "s1"), (None, 2, 0, "mousedown", "s2"), (None, 3, 100, "mousemove", None),
            ("u", 4, 250, "mousemove", None), (None, 5, 300, "mouseup", None), (None, 6, 900, "mousemove", None), ("u", 7, None, "x", None)]
    df = spark.createDataFrame(rows, "who string, event_id long, timestamp long, event_type string, shape_id string")
    got = {r.event_id: r.active_shape for r in active_shape(df, key="who", chunk_ms=100).collect()}
    ref = {r.event_id: r.active_shape for r in active_shape_single_window(df, key="who").collect()}
    assert got == ref == {1: "s1", 2: "s2", 3: "s2", 4: "s1", 5: None, 6: None, 7: None}


def test_input_is_decoded_once(spark):
    """The plan that ran has one decode and one exchange of rows; the other
    exchanges carry a row per chunk."""
    from cursorlake.plans import all_queries
    df = all_queries()["active_shape"](spark, SF_MID)
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString()
    final = plan[plan.index("== Final Plan =="): plan.index("== Initial Plan ==")]
    assert final.count("Generate inline") == 1
    assert final.count("ReusedExchange") == 1
