"""Payload-side column functions: P9 event_kind_of_topic, P10 shape_summary,
P11 payload_json, P12 payload_bytes, K1 topic routing and K2 acknowledgement.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cursorlake.functions.decode import parsed, _path

TOPIC_SUFFIX = "_events"


def event_kind_of_topic(topic: Column | str) -> Column:
    """``mouse_events`` -> ``mouse`` (every ``_events`` is removed)."""
    t = F.col(topic) if isinstance(topic, str) else topic
    return F.replace(t, F.lit(TOPIC_SUFFIX), F.lit(""))


def shape_summary(hit: Column) -> Column:
    """P10: hit shape -> struct(id, type, label, color); no hit -> NULL."""
    return F.when(hit.isNull(), F.lit(None)).otherwise(F.struct(
        hit.id.alias("id"), hit.kind.alias("type"),
        hit.label.alias("label"), hit.color.alias("color")))


def payload_json(payload: Column) -> Column:
    """Compact JSON text; null fields are written as ``null``."""
    return F.to_json(payload, {"ignoreNullFields": "false"})


def payload_bytes(text: Column) -> Column:
    """UTF-8 byte length of the JSON text, -1 when there is none."""
    return F.coalesce(F.octet_length(text), F.lit(-1))


def stream_name(value: Column | str) -> Column:
    """The ``stream`` field as the router sees it: absent -> ``unknown``;
    JSON null -> ``None``; booleans as ``True``/``False``; else its text."""
    v = parsed(value)
    node = F.try_variant_get(v, _path("stream"), "variant")
    js = F.to_json(node)  # a scalar: cheap; tells JSON true from "true"
    return (F.when(node.isNull(), F.lit("unknown"))
             .when(js == "null", F.lit("None"))
             .when(js == "true", F.lit("True"))
             .when(js == "false", F.lit("False"))
             .otherwise(F.coalesce(F.try_variant_get(node, "$", "string"), js)))


def route_to_topic(df: DataFrame, value: str = "value", keep: tuple[str, ...] = ()) -> DataFrame:
    """K1: (payload) -> (topic, key, value); ``topic`` = stream + ``_events``.
    The key is NULL, so a producer spreads messages over partitions."""
    return df.select(*keep, F.concat(stream_name(value), F.lit(TOPIC_SUFFIX)).alias("topic"),
                     F.lit(None).cast("string").alias("key"), F.col(value).alias("value"))


def ack_records(df: DataFrame, value: str = "value", keep: tuple[str, ...] = ()) -> DataFrame:
    """K2: the acknowledgement for each accepted payload."""
    stream = stream_name(value)
    return df.select(*keep, F.lit("queued").alias("status"), stream.alias("type"),
                     F.concat(stream, F.lit(TOPIC_SUFFIX)).alias("topic"),
                     F.col(value).alias("received"))
