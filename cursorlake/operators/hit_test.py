"""J1 hit_test, J2 hit_test_first, F3 hits_only.

The reference tests a pointer position against every shape and keeps the
top-most (last drawn) hit, or, in its older page, the first hit. Draw order is
``z``, then the position in the list. Three forms give the same answer:

* up to ``MAX_CASE_SHAPES`` shapes compile to a chain of literal conditions, a
  narrow transformation in generated code: no join and no shuffle, so it runs
  per partition at any scale and unchanged on a stream;
* more are a literal array scanned by ``filter``, also narrow;
* a table of shapes, or a list beyond ``MAX_LITERAL_SHAPES``, is joined by grid
  cells (:func:`hit_test_grid`).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cursorlake.functions.payload import shape_summary
from cursorlake.session import shared_root
from cursorlake.functions.shapes import (SHAPE_STRUCT, Shape, contains, contains_shape, shape_literal, shape_struct,
                                         with_hit_box)

MAX_CASE_SHAPES = 64
MAX_LITERAL_SHAPES = 4096


def _pick(hits: Column, order: str) -> Column:
    if order not in ("last", "first"):
        raise ValueError("order must be 'last' or 'first'")
    return F.try_element_at(hits, F.lit(-1 if order == "last" else 1))


def hit_shape(x: Column, y: Column, shapes, order: str = "last") -> Column:
    """The shape struct under (x, y), or NULL; ``order`` = last/first in draw order."""
    shapes = sorted(shapes, key=lambda s: s.z)  # stable: equal z in list order
    if len(shapes) > MAX_CASE_SHAPES:
        return _pick(F.filter(shape_literal(shapes), lambda s: contains(s, x, y)), order)
    out = F.lit(None).cast(SHAPE_STRUCT)
    for s in shapes if order == "last" else reversed(shapes):  # the last one added is asked first
        out = F.when(contains_shape(s, x, y), shape_struct(s)).otherwise(out)
    return out


def hit_test(df: DataFrame, shapes, x: str = "canvasX", y: str = "canvasY",
             order: str = "last", out: str = "shape") -> DataFrame:
    """J1 (order='last') / J2 (order='first'): add ``out`` = shape summary
    struct (id, type, label, color) or NULL. Rows without a hit are kept."""
    shapes = list(shapes)
    if len(shapes) > MAX_LITERAL_SHAPES:
        spark = df.sparkSession
        return hit_test_grid(df, shapes_frame(spark, shapes), x, y, order, out)
    return df.withColumn(out, shape_summary(hit_shape(F.col(x), F.col(y), shapes, order)))


def hits_only(df: DataFrame, out: str = "shape") -> DataFrame:
    """keep only rows on a shape."""
    return df.where(F.col(out).isNotNull())


def hit_test_first(df: DataFrame, shapes, x: str = "canvasX", y: str = "canvasY",
                   out: str = "shape") -> DataFrame:
    """J2 as the old page did it: first hit in draw order, non-hits dropped."""
    return hits_only(hit_test(df, shapes, x, y, "first", out), out)


# --- grid form, for shape sets too large to inline -------------------------

def shapes_frame(spark: SparkSession, shapes) -> DataFrame:
    """Shapes as a DataFrame; ``position`` keeps the list order of equal z."""
    rows = [(s.id, s.kind, int(s.z), *[None if v is None else float(v) for v in
             (s.a, s.b, s.c, s.d, s.e, s.f)], s.label, s.color, i) for i, s in enumerate(shapes)]
    return spark.createDataFrame(rows, "id string, kind string, z int, a double, b double, "
                                       "c double, d double, e double, f double, "
                                       "label string, color string, position long")


# A shape lies in cells of the smallest of these sizes (cell * GROWTH ** level)
# of which its box touches a few; beyond the last level, or without a box, it is
# compared with every event.
GROWTH, LEVELS = 4, 12


def hit_test_grid(df: DataFrame, shapes: DataFrame, x: str = "canvasX", y: str = "canvasY",
                  order: str = "last", out: str = "shape", cell: float = 64.0) -> DataFrame:
    """J1/J2 for a shape table of any size (id, kind, z, a..f, label, color and
    optionally position; without it equal z are ordered by id).

    Each shape goes to the cells its box touches, at the level whose cells are
    as large as the box, so it has at most four cells however large it is. Per
    cell the shapes are gathered in draw order; events look up their cell once
    for each level in use with a left equi-join (small cell tables are broadcast
    by Spark, a hot cell is split by AQE) and test the shapes found.
    """
    place = F.col("position") if "position" in shapes.columns else F.lit(0)
    struct = F.struct(F.col("z"), place.cast("long").alias("position"), *(
        F.col(c) for c in ("id", "kind", "a", "b", "c", "d", "e", "f", "label", "color")))
    known = shapes.where(F.col("kind").isin("rect", "circle", "triangle"))
    boxed = with_hit_box(known).select(struct.alias("s"), "x0", "y0", "x1", "y1")
    side = F.greatest(F.col("x1") - F.col("x0"), F.col("y1") - F.col("y0"), F.lit(cell))
    level = F.ceil(F.log(side / cell) / F.log(F.lit(float(GROWTH)))).cast("int")
    bounded = F.col("x0").isNotNull() & F.col("y0").isNotNull() & F.col("x1").isNotNull() & F.col("y1").isNotNull()
    boxed = boxed.withColumn("level", F.when(bounded & (level <= LEVELS), level).otherwise(LEVELS + 1))
    shared_root(df.sparkSession)
    boxed = boxed.checkpoint()  # read once per level below; a filter on level would repeat the geometry

    xc, yc = F.col(x), F.col(y)
    for n in sorted(r[0] for r in boxed.select("level").distinct().collect()):  # LEVELS + 2 values at most
        part, size = boxed.where(F.col("level") == n), cell * GROWTH ** n
        if n > LEVELS:  # one cell for all
            part, keys = part.withColumn("gx", F.lit(0)).withColumn("gy", F.lit(0)), (F.lit(0), F.lit(0))
        else:
            for axis, low, high in (("gx", "x0", "x1"), ("gy", "y0", "y1")):
                part = part.withColumn(axis, F.explode(F.sequence(F.floor(F.col(low) / size).cast("long"),
                                                                  F.floor(F.col(high) / size).cast("long"))))
            keys = (F.floor(xc / size).cast("long"), F.floor(yc / size).cast("long"))
        cells = part.groupBy(F.col("gx").alias(f"__x{n}"), F.col("gy").alias(f"__y{n}")).agg(
            F.array_sort(F.collect_list("s")).alias(f"__s{n}"))
        df = df.withColumn(f"__x{n}", keys[0].cast("long")).withColumn(f"__y{n}", keys[1].cast("long")) \
            .join(cells.withColumn(f"__x{n}", F.col(f"__x{n}").cast("long")).withColumn(f"__y{n}", F.col(f"__y{n}").cast("long")),
                  [f"__x{n}", f"__y{n}"], "left").drop(f"__x{n}", f"__y{n}")
    found = [c for c in df.columns if c.startswith("__s")]
    if not found:
        return df.withColumn(out, shape_summary(F.lit(None).cast(SHAPE_STRUCT)))
    none = F.array().cast(df.schema[found[0]].dataType)
    hits = [F.filter(F.coalesce(F.col(c), none), lambda s: contains(s, xc, yc)) for c in found]
    best = F.array_sort(F.array_compact(F.array(*[_pick(h, order) for h in hits])))  # one per level
    return df.withColumn(out, shape_summary(_pick(best, order))).drop(*found)


__all__ = ["Shape", "hit_shape", "hit_test", "hit_test_first", "hits_only", "hit_test_grid",
           "shapes_frame", "MAX_LITERAL_SHAPES"]
