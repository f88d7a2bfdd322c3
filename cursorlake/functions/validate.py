"""P13 validate_payload: the declared payload rules, as rule columns.

The reference declares payload models that its HTTP route never applies;
the rules they state are: ``timestamp`` an integer and ``type`` a string,
both required; modifier flags default to false and must be booleans or null
(which stays null); a keydown payload also needs ``key`` and ``code`` strings, and
its ``event_type`` defaults to ``keydown`` and must be a string. Mouse payloads
carry the kind as ``event_type``, so for them ``event_type`` stands in for
``type``; their buttons and positions must be integers, canvas positions and
movements numbers, ``isTrusted`` a boolean and ``canvasId`` a string, each null or
absent at will. ``shape`` is an object on the page and text once stored, so any of
the two is valid.

Every rule is a boolean expression; failed rules are collected with
``array_compact`` and the rows split into valid and rejected by ``status``.
Lax conversions follow the models' library: an integer may come as an
integral number, integer text or a boolean; a number as text or a boolean; a flag
as true/false, 0/1 or one of the usual words.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cursorlake.functions.decode import _path, parsed, single_object
from cursorlake.session import cached_columns

MODIFIERS = ("altKey", "ctrlKey", "metaKey", "shiftKey")
# Words accepted as booleans (lower case).
TRUE_WORDS = ("1", "on", "t", "true", "y", "yes")
FALSE_WORDS = ("0", "f", "false", "n", "no", "off")
# The optional typed fields of a mouse payload.
MOUSE_INTEGERS = ("button", "buttons", "clientX", "clientY", "pageX", "pageY", "screenX", "screenY")
MOUSE_NUMBERS = ("canvasX", "canvasY", "movementX", "movementY")


def _node(name: str) -> tuple[Column, Column]:
    node = F.try_variant_get(F.col("__v"), _path(name), "variant")
    return node, F.to_json(node)


def _absent(js: Column) -> Column:
    return js.isNull() | (js == "null")


def _flag(name: str) -> tuple[Column, Column]:
    """(value, ok): a flag with default false; null stays null."""
    node, js = _node(name)
    word = F.lower(F.trim(F.try_variant_get(node, "$", "string")))
    is_text = js.startswith('"')
    truthy = js.isin("true", "1", "1.0") | (is_text & word.isin(*TRUE_WORDS))
    falsy = js.isin("false", "0", "0.0") | (is_text & word.isin(*FALSE_WORDS))
    ok = _absent(js) | F.coalesce(truthy | falsy, F.lit(False))
    return F.when(js == "null", F.lit(None)).when(truthy, F.lit(True)).otherwise(F.lit(False)), ok


def _integer(name: str) -> tuple[Column, Column]:
    node, js = _node(name)
    is_text = js.startswith('"')
    text = F.trim(F.try_variant_get(node, "$", "string"))
    from_text = F.when(text.rlike(r"^[+-]?[0-9]+$"), text.try_cast("bigint"))
    num = F.try_variant_get(node, "$", "double")
    from_num = F.when(js.rlike(r"^-?[0-9]+$"), F.try_variant_get(node, "$", "bigint")).when(
        ~is_text & (num == F.floor(num)), num.try_cast("bigint"))
    flag = js.isin("true", "false")
    value = F.when(is_text, from_text).when(flag, (js == "true").cast("bigint")).otherwise(from_num)
    return value, value.isNotNull()


def _number(name: str) -> tuple[Column, Column]:
    node, js = _node(name)
    text = F.trim(F.try_variant_get(node, "$", "string")).try_cast("double")
    value = (F.when(js.startswith('"'), text).when(js.isin("true", "false"), (js == "true").cast("double"))
              .when(~js.startswith("{") & ~js.startswith("["), F.try_variant_get(node, "$", "double")))
    return value, value.isNotNull()


def _optional(name: str, rule, what: str) -> Column:
    """The reason if a field is neither absent, null nor valid."""
    _, js = _node(name)
    _, ok = rule(name)
    return F.when(~_absent(js) & ~F.coalesce(ok, F.lit(False)), F.lit(f"{name}: not {what}"))


def _text(name: str) -> tuple[Column, Column]:
    node, js = _node(name)
    value = F.when(js.startswith('"'), F.try_variant_get(node, "$", "string"))
    return value, value.isNotNull()


@cached_columns
def _rules(kind: str, value: str) -> tuple[list[Column], Column]:
    cols, failed = [], [F.when(~single_object(F.col(value)), F.lit("not a JSON object"))]
    for m in MODIFIERS:
        v, ok = _flag(m)
        cols.append(v.alias(m))
        failed.append(F.when(~ok, F.lit(f"{m}: not a boolean")))
    ts, ts_ok = _integer("timestamp")
    cols.append(ts.alias("timestamp"))
    failed.append(F.when(~ts_ok, F.lit("timestamp: required integer")))
    typ, typ_ok = _text("type")
    if kind == "mouse":
        et, et_ok = _text("event_type")
        typ, typ_ok = F.coalesce(typ, et), typ_ok | et_ok
        failed += [_optional(n, _integer, "an integer") for n in MOUSE_INTEGERS]
        failed += [_optional(n, _number, "a number") for n in MOUSE_NUMBERS]
        failed += [_optional("isTrusted", _flag, "a boolean"), _optional("canvasId", _text, "a string")]
    cols.append(typ.alias("type"))
    failed.append(F.when(~typ_ok, F.lit("type: required string")))
    if kind == "keydown":
        for name in ("key", "code"):
            v, ok = _text(name)
            cols.append(v.alias(name))
            failed.append(F.when(~ok, F.lit(f"{name}: required string")))
        et, et_ok = _text("event_type")
        cols.append(F.coalesce(et, F.lit("keydown")).alias("event_type"))
        failed.append(F.when(_node("event_type")[1].isNotNull() & ~et_ok, F.lit("event_type: not a string")))
    return cols, F.array_compact(F.array(*failed))


def validate_payload(df: DataFrame, kind: str, value: str = "value", keep: tuple[str, ...] = ()) -> DataFrame:
    """Rule results per message: normalised fields, ``reasons`` and
    ``status`` ('valid' / 'rejected')."""
    cols, reasons = _rules(kind, value)
    return (df.select(*keep, F.col(value), parsed(value).alias("__v"))
              .select(*keep, *cols, reasons.alias("reasons"))
              .withColumn("status", F.when(F.size("reasons") == 0, "valid").otherwise("rejected")))
