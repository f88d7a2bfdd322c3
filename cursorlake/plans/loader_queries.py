"""Registered queries of the micro-batch loader path."""

from __future__ import annotations

from pyspark.sql import functions as F

from cursorlake.functions.coerce import coerce_defaults as _coerce
from cursorlake.plans import flows
from cursorlake.plans.lake_queries import drop_topics, new_lake
from cursorlake.plans.registry import register
from cursorlake.schemas import schema_for_kind
from cursorlake.session import work_dir
from cursorlake.sources.events import EXTRA_FIELDS
from cursorlake.streaming.ingest import await_all
from cursorlake.streaming.loader import load_topics, loaded, loaded_rows


@register("coerce_defaults")
def coerce_defaults(spark, sf_dir):
    """All messages with the loader's typed defaults, malformed ones among
    them; rows that cannot be loaded have no values."""
    def of_kind(kind):
        names = schema_for_kind(kind, "loader", EXTRA_FIELDS).names
        c = _coerce(flows.topic_messages(spark, sf_dir, kind, dirty=True), kind, extra=EXTRA_FIELDS)
        ok = F.col("status") == "ok"
        return c.select(*[F.when(ok, F.col(n)).alias(n) for n in names], "status", F.size("reasons").alias("n_reasons"))
    return flows.as_text(flows.both_kinds(of_kind))


@register("enforce_non_null")
def enforce_non_null(spark, sf_dir):
    """Loadable rows after the non-null pass, malformed messages among the
    input."""
    return flows.as_text(flows.both_kinds(lambda k: loaded_rows(
        _coerce(flows.topic_messages(spark, sf_dir, k, dirty=True), k, extra=EXTRA_FIELDS), k, EXTRA_FIELDS)))


@register("append_microbatch")
def append_microbatch(spark, sf_dir):
    """K5: the loader as a stream into the mouse loader table; the loaded rows
    are read back."""
    lake = new_lake(spark)
    lake.create_if_absent("mouse", "loader", EXTRA_FIELDS)
    topics = work_dir(spark, "topics")
    drop_topics(spark, sf_dir, topics, kinds=("mouse",))
    await_all(load_topics(lake, ("mouse", "keydown"), topic_root=topics, extra=EXTRA_FIELDS, available_now=True))
    return loaded(lake, "mouse", EXTRA_FIELDS)


@register("validate_payload")
def validate_payload(spark, sf_dir):
    """The declared payload rules over all messages, malformed ones among
    them; normalised fields of the valid ones."""
    from cursorlake.functions.validate import validate_payload as _validate

    def of_kind(kind):
        names = ["altKey", "ctrlKey", "metaKey", "shiftKey", "timestamp", "type"]
        names += ["key", "code", "event_type"] if kind == "keydown" else []
        v = _validate(flows.topic_messages(spark, sf_dir, kind, dirty=True), kind)
        ok = F.col("status") == "valid"
        return v.select(*[F.when(ok, F.col(n)).alias(n) for n in names], "status", F.size("reasons").alias("n_reasons"))
    return flows.as_text(flows.both_kinds(of_kind))
