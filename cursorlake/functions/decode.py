"""JSON message -> typed columns (S3 decode_lenient, S4 decode_strict,
F1 drop_unparsable, P8 nested_to_json_text).

The lenient rule: a message that is not a JSON object is dropped; a field
that is absent or cannot be converted becomes NULL; a field is converted
whenever ``try_variant_get`` can convert it ("12" -> 12, 3.9 -> 3,
"false" -> false); of a repeated key the last value counts. Text fields take
the JSON text of the value, so a nested object or array arrives as its compact
JSON text in original key order.

Nearly every message holds each field in its declared JSON type, and then one
``from_json`` with the declared schema gives the same values. Only a message
that it flags, or whose text fields might be numbers, is parsed to a variant and
read field by field. Everything is a built-in expression.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cursorlake.schemas import schema_for_kind
from cursorlake.session import cached_columns


def _path(name: str) -> str:
    return "$." + name if name.isidentifier() else "$['" + name.replace("'", "\\'") + "']"


def parsed(value: Column | str = "value") -> Column:
    """The message as a variant, NULL when it is not valid JSON."""
    v = F.col(value) if isinstance(value, str) else value
    return F.try_parse_json(v)


def is_object(variant: Column, value: Column | str = "value") -> Column:
    """True when the message parsed and is a JSON object. A parsed message
    is an object exactly when its first non-blank character is ``{``; the
    text test avoids building a type string for the whole message."""
    v = F.col(value) if isinstance(value, str) else value
    return variant.isNotNull() & F.coalesce(F.regexp_like(v, F.lit(r"^[ \t\r\n]*\{")), F.lit(False))


def single_object(value: Column) -> Column:
    """True when the text is one JSON object and white space, nothing else:
    as the first of two elements it leaves an array of exactly two."""
    return F.coalesce(F.regexp_like(value, F.lit(r"^[ \t\r\n]*\{"))
                      & (F.json_array_length(F.concat(F.lit("["), value, F.lit(",0]"))) == 2), F.lit(False))


# Options under which from_json accepts exactly what the variant parser does.
TYPED_OPTIONS = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "__bad",
                 "allowSingleQuotes": "false", "allowNonNumericNumbers": "false"}


def typed(value: Column, fields: list[T.StructField]) -> Column:
    """The message by its declared types; ``__bad`` is set where a field has
    another JSON type or the text is malformed."""
    schema = T.StructType([*fields, T.StructField("__bad", T.StringType())])
    return F.from_json(value, schema, TYPED_OPTIONS)


def is_plain(message: Column, value: Column, fields: list[T.StructField]) -> Column:
    """Whether ``typed`` values can stand: an object, nothing flagged, and no
    text that may have been a number or a flag."""
    ok = message.isNotNull() & message["__bad"].isNull() & F.regexp_like(value, F.lit(r"^[ \t\r\n]*\{"))
    for f in fields:
        if isinstance(f.dataType, T.StringType):
            ok = ok & ~F.coalesce(F.regexp_like(message[f.name], F.lit(r"^(-?[0-9]|true$|false$)")), F.lit(False))
    return F.coalesce(ok, F.lit(False))


def typed_field(message: Column, value: Column, f: T.StructField) -> Column:
    """A field of a plain message; a nested value re-read as compact text."""
    c = message[f.name]
    if isinstance(f.dataType, T.StringType):
        return F.when(c.startswith("{") | c.startswith("["), field_text(value, f.name)).otherwise(c)
    return c


def drop_unparsable(df: DataFrame, value: str = "value") -> DataFrame:
    """keep only messages that parse as a JSON object."""
    return df.where(is_object(parsed(value), value))


def field_text(value: Column | str, name: str) -> Column:
    """A field as text; an object or array becomes its JSON text."""
    v = F.col(value) if isinstance(value, str) else value
    return F.get_json_object(v, _path(name))


def field(variant: Column, value: Column, name: str, dtype: T.DataType) -> Column:
    """One typed field under the lenient rule. Text fields: a scalar's text
    from the variant; a nested value re-read from the message so that its
    JSON text keeps the original key order."""
    path = _path(name)
    if isinstance(dtype, T.StringType):
        node = F.try_variant_get(variant, path, "variant")
        js = F.to_json(node)
        nested = js.startswith("{") | js.startswith("[")
        return (F.when(F.is_variant_null(node), F.lit(None).cast("string"))
                 .when(nested, field_text(value, name))
                 .otherwise(F.try_variant_get(node, "$", "string")))
    return F.try_variant_get(variant, path, dtype.simpleString())


def decode_lenient(df: DataFrame, kind: str, value: str = "value",
                   extra: list[tuple[str, T.DataType]] | None = None,
                   keep: tuple[str, ...] = (), columns: tuple[str, ...] | None = None) -> DataFrame:
    """S3: decode JSON messages of ``kind`` to the payload schema.

    Unknown fields are dropped by the projection (P1/P2); ``extra`` names
    additional payload fields to keep, ``keep`` passes input columns through.
    ``columns`` decodes only those fields (a narrow query reads only what it
    uses; the generator below hides unused fields from column pruning).
    """
    raw = F.col(value)
    # One parse per message, in projections of their own; the 0-or-1-row
    # generator drops non-objects (a filter would be pushed below and parse again).
    cols = tuple(columns) if columns is not None else None
    message, plain, rows = _decoded_rows(kind, value, tuple(extra or ()), cols)
    slow = F.when(~F.col("__plain"), parsed(raw)).alias("__v")
    return (df.select(*keep, raw.alias(value), message.alias("__m"))
              .select("*", plain.alias("__plain")).select("*", slow).select(*keep, rows))


@cached_columns
def _decoded_rows(kind: str, value: str, extra: tuple, columns: tuple | None) -> tuple[Column, Column, Column]:
    schema = schema_for_kind(kind, "payload", list(extra))
    m, v, raw = F.col("__m"), F.col("__v"), F.col(value)
    chosen = [f for f in schema.fields if columns is None or f.name in columns]
    fast = F.struct(*[typed_field(m, raw, f).alias(f.name) for f in chosen])
    slow = F.struct(*[field(v, raw, f.name, f.dataType).alias(f.name) for f in chosen])
    rows = F.when(F.col("__plain"), F.array(fast)).when(is_object(v, raw), F.array(slow))
    return typed(raw, chosen), is_plain(m, raw, chosen), F.inline(rows)


def decode_strict(df: DataFrame, kind: str, value: str = "value",
                  extra: list[tuple[str, T.DataType]] | None = None) -> DataFrame:
    """Decode with ``from_json`` in FAILFAST mode: a message that is not
    exactly one JSON object (also an empty or null one, or one with text after
    it) or a field of the wrong JSON type fails the job instead of being skipped."""
    schema = schema_for_kind(kind, "payload", extra)
    raw = F.col(value)
    message = F.when(single_object(raw), F.from_json(raw, schema, {"mode": "FAILFAST"})).otherwise(
        F.raise_error(F.concat(F.lit("not one JSON object: "), F.coalesce(raw, F.lit("NULL")))))
    return df.select(message.alias("m")).select("m.*")
