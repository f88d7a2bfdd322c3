"""The registered queries: name -> (spark, sf_dir) -> DataFrame.

Names follow the operator inventory. Every query starts from the given
tables (``events``) and runs over all of it; results carry instants as UTC
wall clock (TIMESTAMP_NTZ) so that they compare with SQL engines.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cursorlake.functions import payload as P
from cursorlake.functions.decode import decode_strict, drop_unparsable
from cursorlake.functions.shapes import TEST_SHAPES
from cursorlake.functions.time import to_local_time
from cursorlake.operators import reports
from cursorlake.operators.active_shape import active_shape as _active_shape
from cursorlake.operators.hit_test import hit_test as _hit_test, hit_test_first as _hit_test_first, hits_only
from cursorlake.operators.project import project
from cursorlake.plans import flows
from cursorlake.sources.events import EXTRA_FIELDS

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def register(name: str):
    def deco(fn: Query) -> Query:
        QUERIES[name] = fn
        return fn
    return deco


def _mouse(spark, sf_dir):
    return flows.decoded(spark, sf_dir, "mouse")


def _keydown(spark, sf_dir):
    return flows.decoded(spark, sf_dir, "keydown")


# --- S3 / S4 / F1: decoding ---------------------------------------------------

@register("decode_lenient")
def decode_lenient(spark, sf_dir):
    """S3 + P3/P4: all messages, malformed ones among them, decoded leniently,
    with event time."""
    rows = flows.both_kinds(lambda k: flows.decoded(spark, sf_dir, k, dirty=True))
    return flows.as_text(flows.presentable(rows))


@register("decode_strict")
def decode_strict_q(spark, sf_dir):
    """All messages decoded with FAILFAST (input is well formed)."""
    return flows.as_text(flows.both_kinds(
        lambda k: decode_strict(flows.topic_messages(spark, sf_dir, k), k, extra=EXTRA_FIELDS)))


@register("drop_unparsable")
def drop_unparsable_q(spark, sf_dir):
    """messages in and JSON objects kept, per kind, malformed ones among
    them."""
    def counts(kind):
        msgs = flows.topic_messages(spark, sf_dir, kind, dirty=True)
        n = F.count(F.lit(1))
        return msgs.agg(n.alias("n_messages")).crossJoin(drop_unparsable(msgs).agg(n.alias("n_objects")))  # 1 x 1 rows
    return flows.both_kinds(counts)


# --- P1..P12: projections and scalar functions --------------------------------

@register("project_mouse")
def project_mouse(spark, sf_dir):
    """The 20 declared mouse columns."""
    return project(flows.decoded(spark, sf_dir, "mouse", event_time=False), "mouse", "payload")


@register("project_keydown")
def project_keydown(spark, sf_dir):
    """The 8 declared keydown columns."""
    return project(flows.decoded(spark, sf_dir, "keydown", event_time=False), "keydown", "payload")


def _stamps(spark, sf_dir):
    """(event_id, timestamp, ts, ts_hour) of both kinds, read as two fields."""
    rows = flows.both_kinds(lambda k: flows.decoded(spark, sf_dir, k, columns=("event_id", "timestamp"), dirty=True))
    return flows.as_text(flows.presentable(rows.drop("kind")))


@register("epoch_ms_to_ts")
def epoch_ms_to_ts(spark, sf_dir):
    """Epoch ms -> event time, for both kinds; NULL for other stamps."""
    return _stamps(spark, sf_dir).select("event_id", "timestamp", "ts")


@register("floor_hour")
def floor_hour(spark, sf_dir):
    """Hour partition key per event."""
    return _stamps(spark, sf_dir).select("event_id", "ts_hour")


@register("to_local_time")
def to_local_time_q(spark, sf_dir):
    """P5: keydown rows with timestamp, ts, ts_hour in Asia/Seoul wall clock."""
    return to_local_time(_keydown(spark, sf_dir))


@register("nested_to_json_text")
def nested_to_json_text(spark, sf_dir):
    """The nested ``shape`` object arrives as JSON text (key order kept)."""
    return flows.decoded(spark, sf_dir, "mouse", False, columns=("event_id", "shape"))


@register("event_kind_of_topic")
def event_kind_of_topic(spark, sf_dir):
    """Topic -> event kind for every routed message."""
    r = flows.routed(spark, sf_dir)
    return r.select("event_id", "topic", P.event_kind_of_topic("topic").alias("kind"))


@register("shape_summary")
def shape_summary(spark, sf_dir):
    """P10: the decoded shape summary's fields (NULL when no hit)."""
    m = flows.decoded(spark, sf_dir, "mouse", False, columns=("event_id", "shape"))
    return m.select("event_id", *[F.get_json_object("shape", f"$.{k}").alias(f"shape_{k}")
                                  for k in ("id", "type", "label", "color")])


@register("payload_json")
def payload_json(spark, sf_dir):
    """Compact JSON text of each payload."""
    return flows.messages(spark, sf_dir).select("event_id", "value")


@register("payload_bytes")
def payload_bytes(spark, sf_dir):
    """UTF-8 size of each payload's JSON text, malformed ones among them."""
    return flows.both_kinds(lambda k: flows.topic_messages(spark, sf_dir, k, dirty=True).select(
        P.payload_bytes(F.col("value")).alias("n_bytes")))


# --- K1 / K2: routing and acknowledgement ------------------------------------

@register("route_to_topic")
def route_to_topic(spark, sf_dir):
    """K1: topic per message (key NULL)."""
    return flows.routed(spark, sf_dir).select("event_id", "topic", "key")


@register("ack_records")
def ack_records(spark, sf_dir):
    """K2: acknowledgement per accepted payload."""
    acks = P.ack_records(flows.messages(spark, sf_dir), keep=("event_id",))
    return acks.select("event_id", "status", "type", "topic", "received")


# --- J1 / J2 / F3: hit testing -------------------------------------------------

POINTER = ("event_id", "user_id", "event_type", "timestamp", "canvasX", "canvasY")


def _pointer(spark, sf_dir):
    return flows.decoded(spark, sf_dir, "mouse", event_time=False, columns=POINTER)


@register("hit_test")
def hit_test(spark, sf_dir):
    """Top-most shape under each pointer position; misses kept."""
    hit = _hit_test(_pointer(spark, sf_dir), TEST_SHAPES, order="last", out="hit")
    return hit.select("event_id", "canvasX", "canvasY", F.col("hit.id").alias("shape_id"))


@register("hit_test_first")
def hit_test_first(spark, sf_dir):
    """First shape in draw order; misses dropped."""
    hit = _hit_test_first(_pointer(spark, sf_dir), TEST_SHAPES, out="hit")
    return hit.select("event_id", F.col("hit.id").alias("shape_id"))


@register("hits_only")
def hits_only_q(spark, sf_dir):
    """events on a shape (top-most hit)."""
    hit = hits_only(_hit_test(_pointer(spark, sf_dir), TEST_SHAPES, out="hit"), "hit")
    return hit.select("event_id", F.col("hit.id").alias("shape_id"), F.col("hit.type").alias("shape_type"))


# --- A1 / A2: aggregations ----------------------------------------------------

@register("count_events")
def count_events(spark, sf_dir):
    """A1: COUNT(*) of the mouse stream."""
    return reports.count_events(flows.decoded(spark, sf_dir, "mouse", False, columns=("timestamp",)))


@register("events_per_minute")
def events_per_minute(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A2 over the decoded mouse stream, in local (Asia/Seoul) minutes."""
    return reports.events_per_minute(flows.decoded(spark, sf_dir, "mouse", False, columns=("timestamp",)))


# --- O1 / O2 / O3: sorts and limits -------------------------------------------

@register("newest_first")
def newest_first(spark, sf_dir):
    """O1: every keydown row, newest first (event_id breaks ties)."""
    return flows.presentable(reports.newest_first(_keydown(spark, sf_dir)))


@register("newest_n")
def newest_n(spark, sf_dir):
    """O2: the 50 newest mouse rows."""
    return flows.presentable(reports.newest_n(_mouse(spark, sf_dir), 50))


@register("sample_rows")
def sample_rows(spark, sf_dir):
    """O3: LIMIT 5, no order: how many rows came and how many are events."""
    some = reports.sample_rows(_mouse(spark, sf_dir), 5)
    known = flows.messages(spark, sf_dir).select("event_id").withColumn("known", F.lit(1))
    return some.join(known, "event_id", "left").agg(F.count(F.lit(1)).alias("n"), F.count("known").alias("n_events"))


# --- W5: active shape (batch form) --------------------------------------------

@register("active_shape")
def active_shape(spark, sf_dir):
    """The active (dragged) shape per user after every mouse event."""
    m = flows.decoded(spark, sf_dir, "mouse", False,
                      columns=("user_id", "event_id", "timestamp", "event_type", "shape")).select(
        "user_id", "event_id", "timestamp", "event_type", F.get_json_object("shape", "$.id").alias("shape_id"))
    return _active_shape(m)
