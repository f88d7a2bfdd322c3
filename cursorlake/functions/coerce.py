"""P6 coerce_defaults, P7 enforce_non_null: the micro-batch loader's values.

The loader turns every field into a non-null value with Python's rules:
absent / null / "" -> False, 0, 0.0 or ""; ``bool(v)`` (so "false", {} and
[] are true: containers are first turned into JSON text); ``int(v)``
truncates 3.9 to 3, accepts " 12 " and true, and gives 0 for "3.9";
``float(v)`` accepts numeric text, "inf" and "nan". Two cases make the
reference's loader crash (its batch fails): an integer that does not fit the
column, and a non-empty non-text value in a text column. Those rows, messages
that are not exactly one JSON object, and time stamps that are no epoch-ms event
time go to a quarantine with reasons.

All of it is built-in expressions. A message whose fields all have their declared
JSON types (nearly every one) takes them from one typed ``from_json`` with the
defaults for absent fields. Any other is parsed to a variant; the kind of each
field's JSON value is read from ``to_json`` of that field alone (cheap for
scalars), never from a type string of the whole message.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cursorlake.functions.decode import (_path, field_text, is_object, is_plain, parsed, single_object, typed,
                                         typed_field)
from cursorlake.functions.time import MS_RANGE, is_event_ms
from cursorlake.schemas import schema_for_kind
from cursorlake.session import cached_columns

# Python's int()/float() text grammar (ASCII form), whitespace set.
PY_INT_TEXT = r"^[+-]?[0-9]+(_[0-9]+)*$"
PY_FLOAT_TEXT = (r"^[+-]?(([0-9]+(_[0-9]+)*)?\.?[0-9]+(_[0-9]+)*|[0-9]+(_[0-9]+)*\.)"
                 r"([eE][+-]?[0-9]+(_[0-9]+)*)?$|^[+-]?(inf|infinity|nan)$")
WHITESPACE = " \t\n\r\x0b\x0c"
INT_RANGE = {"int": (-(2 ** 31), 2 ** 31 - 1), "bigint": (-(2 ** 63), 2 ** 63 - 1)}


class _Value:
    """One field's JSON value with its Python kind."""

    def __init__(self, node: Column, js: Column, raw: Column, name: str):
        self.name = name
        self.node = node
        self.js = js
        self.raw = raw
        js = self.js
        self.none = self.node.isNull() | (js == "null")
        self.container = js.startswith("{") | js.startswith("[")
        self.text = js.startswith('"')
        self.boolean = js.isin("true", "false")
        self.integer = js.rlike(r"^-?[0-9]+$")
        self.string = F.try_variant_get(self.node, "$", "string")
        self.double = F.try_variant_get(self.node, "$", "double")

    def stripped(self) -> Column:
        return F.trim(self.string, F.lit(WHITESPACE))


def _as_bool(x: _Value) -> Column:
    return (F.when(x.none, F.lit(False))
             .when(x.container, F.lit(True))
             .when(x.text, F.length(x.string) > 0)
             .when(x.boolean, x.js == "true")
             .otherwise(x.double != 0))


def _as_int(x: _Value) -> Column:
    """The integer (bigint) Python's int() gives, NULL when it does not fit
    a bigint (an overflow for int32 and int64 columns alike)."""
    s = x.stripped()
    text_ok = s.rlike(PY_INT_TEXT)
    from_text = F.replace(s, F.lit("_"), F.lit("")).try_cast("bigint")
    d = x.double
    in_long = F.abs(d) < F.lit(9.2e18)
    truncated = F.when(d >= 0, F.floor(d)).otherwise(F.ceil(d)).cast("bigint")
    from_int = F.try_variant_get(x.node, "$", "bigint")
    num = (F.when(x.none | x.container, F.lit(0).cast("bigint"))
            .when(x.boolean, F.when(x.js == "true", 1).otherwise(0).cast("bigint"))
            .when(x.text, F.when(text_ok, from_text).otherwise(F.lit(0).cast("bigint")))
            .when(x.integer, from_int)
            .otherwise(F.when(in_long, truncated)))
    return num


def _int_result(num: Column, name: str, sql_type: str) -> tuple[Column, Column]:
    lo, hi = INT_RANGE[sql_type]
    ok = num.isNotNull() & (num >= F.lit(lo)) & (num <= F.lit(hi))
    error = F.when(~ok, F.lit(f"{name}: integer out of {sql_type} range"))
    return F.when(ok, num.cast(sql_type)), error


def _as_float(x: _Value) -> Column:
    s = x.stripped()
    from_text = F.when(F.lower(s).rlike(PY_FLOAT_TEXT),
                       F.replace(s, F.lit("_"), F.lit("")).try_cast("double"))
    return (F.when(x.none | x.container, F.lit(0.0))
             .when(x.boolean, F.when(x.js == "true", 1.0).otherwise(0.0))
             .when(x.text, F.coalesce(from_text, F.lit(0.0)))
             .otherwise(x.double))


def _as_text(x: _Value) -> tuple[Column, Column]:
    """(value, error) for a string column: falsy -> ''; JSON text for a
    container; a true or non-zero number cannot be stored as text."""
    truthy_scalar = (x.boolean & (x.js == "true")) | (~x.none & ~x.container & ~x.text & ~x.boolean
                                                      & (x.double != 0))
    value = (F.when(x.none, F.lit(""))
              .when(x.container, field_text(x.raw, x.name))
              .when(x.text, x.string)
              .when(~truthy_scalar, F.lit("")))
    error = F.when(truthy_scalar, F.lit(f"{x.name}: non-text value in a text column"))
    return value, error


def coerce_field(node: Column, js: Column, raw: Column, name: str,
                 dtype: T.DataType) -> tuple[Column, Column | None]:
    """(value, error) of one field from its variant node and its JSON text."""
    x = _Value(node, js, raw, name)
    if isinstance(dtype, T.BooleanType):
        return _as_bool(x), None
    if isinstance(dtype, (T.IntegerType, T.LongType, T.TimestampNTZType)):
        return _as_int(x), None
    if isinstance(dtype, T.DoubleType):
        return _as_float(x), None
    return _as_text(x)


def message_errors(v: Column, raw: Column) -> Column:
    """Reasons a message cannot be loaded at all."""
    return (F.when(raw.isNull() | v.isNull(), F.lit("not JSON"))
             .when(~is_object(v, raw), F.lit("not a JSON object"))
             .when(~single_object(raw), F.lit("text after the JSON object")))


def coerce_defaults(df: DataFrame, kind: str, value: str = "value", extra=None,
                    keep: tuple[str, ...] = ()) -> DataFrame:
    """Loader columns for every message, plus ``status`` ('ok' or
    'quarantine') and ``reasons`` (empty when ok).

    Staged projections keep each expression small: the message is parsed
    once, each field's node and its JSON text become columns, and the rules
    read those columns (a deep tree per field would be copied into every
    branch of the rules).
    """
    raw = F.col(value)
    message, plain, nodes, texts, ints, cols, reasons = _coerce_columns(kind, value, tuple(extra or ()))
    slow = F.when(~F.col("__plain"), parsed(raw)).alias("__v")
    staged = (df.select(*keep, raw.alias(value), message.alias("__m"))
                .select("*", plain.alias("__plain")).select("*", slow)
                .select("*", *nodes).select("*", *texts).select("*", *ints))
    return (staged.select(*keep, raw.alias(value), *cols, reasons.alias("reasons"))
                  .withColumn("status", F.when(F.size("reasons") > 0, "quarantine").otherwise("ok")))


def _default(c: Column, dtype: T.DataType) -> Column:
    """The value of a field that has its declared JSON type or is absent."""
    if isinstance(dtype, T.BooleanType):
        return F.coalesce(c, F.lit(False))
    if isinstance(dtype, T.StringType):
        return F.coalesce(c, F.lit(""))
    if isinstance(dtype, T.TimestampNTZType):
        return F.timestamp_millis(F.coalesce(c, F.lit(0).cast("bigint"))).cast("timestamp_ntz")
    return F.coalesce(c, F.lit(0).cast(dtype))


@cached_columns
def _coerce_columns(kind: str, value: str, extra: tuple):
    schema = schema_for_kind(kind, "loader", list(extra))
    raw, m, is_typed = F.col(value), F.col("__m"), F.col("__plain")
    fields = list(enumerate(schema.fields))
    declared = [T.StructField(f.name, T.LongType() if isinstance(f.dataType, T.TimestampNTZType) else f.dataType)
                for f in schema.fields]
    stamps = [f.name for f in schema.fields if isinstance(f.dataType, T.TimestampNTZType)]
    plain = is_plain(m, raw, declared) & single_object(raw)
    for name in stamps:
        plain = plain & F.coalesce(is_event_ms(m[name]), F.lit(True))
    nodes = [F.try_variant_get("__v", _path(f.name), "variant").alias(f"__n{i}") for i, f in fields]
    texts = [F.to_json(f"__n{i}").alias(f"__j{i}") for i, _ in fields]
    cols, ints, errors = [], [], [message_errors(F.col("__v"), raw)]
    for i, f in fields:
        val, err = coerce_field(F.col(f"__n{i}"), F.col(f"__j{i}"), raw, f.name, f.dataType)
        if isinstance(f.dataType, (T.IntegerType, T.LongType, T.TimestampNTZType)):
            # integers get their own stage: the rule is large, the range check small
            ints.append(F.when(~is_typed, val).alias(f"__i{i}"))
            sql_type = "int" if isinstance(f.dataType, T.IntegerType) else "bigint"
            val, err = _int_result(F.col(f"__i{i}"), f.name, sql_type)
            if f.name in stamps:
                err = F.coalesce(err, F.when(~is_event_ms(val), F.lit(f"{f.name}: no epoch-ms event time")))
                val = F.when(val.between(*MS_RANGE), F.timestamp_millis(val)).cast("timestamp_ntz")
        fast = _default(typed_field(m, raw, declared[i]), f.dataType)
        cols.append(F.when(is_typed, fast).otherwise(val).alias(f.name))
        if err is not None:
            errors.append(err)
    reasons = F.when(is_typed, F.array().cast("array<string>")).otherwise(F.array_compact(F.array(*errors)))
    return typed(raw, declared), plain, nodes, texts, ints, cols, reasons


def split_status(coerced: DataFrame, status: str, columns: list[str]) -> DataFrame:
    """Rows of one status. A 0-or-1-row generator instead of a filter, so
    the rules are not pushed below and evaluated a second time."""
    keep = F.struct(*[F.col(c) for c in columns])
    return coerced.select(F.inline(F.when(F.col("status") == status, F.array(keep))))


def enforce_non_null(df: DataFrame, kind: str, extra=None) -> DataFrame:
    """The second pass: null (or '' for numbers) -> 0 / False / '';
    output columns are non-null by construction."""
    schema = schema_for_kind(kind, "loader", extra)
    cols = []
    for f in schema.fields:
        c = F.col(f.name)
        if isinstance(f.dataType, T.BooleanType):
            c = F.coalesce(c, F.lit(False))
        elif isinstance(f.dataType, (T.IntegerType, T.LongType, T.DoubleType)):
            c = F.coalesce(c, F.lit(0).cast(f.dataType))
        elif isinstance(f.dataType, T.TimestampNTZType):
            c = F.coalesce(c, F.lit(0).cast("timestamp").cast("timestamp_ntz"))
        else:
            c = F.coalesce(F.when(c != "", c), F.lit(""))
        cols.append(c.alias(f.name))
    return df.select(*cols)
