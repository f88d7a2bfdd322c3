"""Canvas shapes and the point-in-shape predicates (used by J1 / J2).

A shape set is small and fixed per canvas, so it is compiled into a literal
array of structs: the hit test then is one expression per event, with no join,
no shuffle and no event key, and it runs unchanged on streams.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Shape:
    """One shape. ``kind`` is rect (a=x, b=y, c=w, d=h), circle (a=x, b=y,
    c=r) or triangle (a..f = x1, y1, x2, y2, x3, y3); any other kind is never
    hit. ``z`` is the draw order; of equal ``z`` the later one in its list is
    drawn later."""

    id: str
    kind: str
    z: int
    a: float
    b: float
    c: float
    d: float | None = None
    e: float | None = None
    f: float | None = None
    label: str | None = None
    color: str | None = None


# The demo canvas (draw order s1..s4).
DEMO_SHAPES = (
    Shape("s1", "rect", 1, 50, 50, 100, 100, label="Car", color="#22d3ee"),
    Shape("s2", "circle", 2, 200, 200, 50, label="Person", color="#34d399"),
    Shape("s3", "triangle", 3, 300, 50, 350, 150, 250, 150, label="Yield Sign", color="#fbbf24"),
    Shape("s4", "rect", 4, 100, 300, 120, 80, label="Red Light", color="#a78bfa"),
)

# Two extra shapes for tests; s5 overlaps s1 and s2, s6 overlaps s3,
# so first-hit and last-hit differ. They carry no label or color.
OVERLAP_SHAPES = (
    Shape("s5", "rect", 5, 120, 120, 60, 60),
    Shape("s6", "circle", 6, 320, 120, 30),
)

TEST_SHAPES = DEMO_SHAPES + OVERLAP_SHAPES

# Triangle hit tolerance on the area sum (fixed value).
TRIANGLE_TOLERANCE = 0.5

SHAPE_STRUCT = ("struct<id:string,kind:string,z:int,a:double,b:double,c:double,"
                "d:double,e:double,f:double,label:string,color:string>")


def shape_literal(shapes) -> Column:
    """Array<struct> literal of the shapes in draw order."""
    # sorted() is stable: equal z keep their list order
    items = []
    for s in sorted(shapes, key=lambda s: s.z):
        items.append(F.struct(
            F.lit(s.id).alias("id"), F.lit(s.kind).alias("kind"), F.lit(int(s.z)).alias("z"),
            *[F.lit(None if v is None else float(v)).cast("double").alias(n)
              for n, v in zip("abcdef", (s.a, s.b, s.c, s.d, s.e, s.f))],
            F.lit(s.label).cast("string").alias("label"),
            F.lit(s.color).cast("string").alias("color"),
        ))
    if not items:
        return F.array().cast(f"array<{SHAPE_STRUCT}>")
    return F.array(*items)


def _area(ax, ay, bx, by, cx, cy) -> Column:
    return F.abs((ax * (by - cy) + bx * (cy - ay) + cx * (ay - by)) / 2)


def _in_rect(x, y, a, b, c, d) -> Column:
    return (x >= a) & (x <= a + c) & (y >= b) & (y <= b + d)


def _in_circle(x, y, a, b, c) -> Column:
    dx, dy = x - a, y - b
    return F.sqrt(dx * dx + dy * dy) <= c


def _in_triangle(x, y, a, b, c, d, e, f) -> Column:
    parts = _area(x, y, c, d, e, f) + _area(a, b, x, y, e, f) + _area(a, b, c, d, x, y)
    return F.abs(_area(a, b, c, d, e, f) - parts) < TRIANGLE_TOLERANCE


def contains(s: Column, x: Column, y: Column) -> Column:
    """Point-in-shape test, boundaries inclusive; triangle by area sum."""
    return (F.when(s.kind == "rect", _in_rect(x, y, s.a, s.b, s.c, s.d))
             .when(s.kind == "circle", _in_circle(x, y, s.a, s.b, s.c))
             .when(s.kind == "triangle", _in_triangle(x, y, s.a, s.b, s.c, s.d, s.e, s.f))
             .otherwise(F.lit(False)))


def contains_shape(s: Shape, x: Column, y: Column) -> Column:
    """``contains`` for one known shape: its numbers are literals, so the
    test compiles to straight-line generated code."""
    rule, names = {"rect": (_in_rect, "abcd"), "circle": (_in_circle, "abc"),
                   "triangle": (_in_triangle, "abcdef")}.get(s.kind, (None, ""))
    if rule is None:
        return F.lit(False)
    return rule(x, y, *[F.lit(float(getattr(s, n))) for n in names])


def shape_struct(s: Shape) -> Column:
    """One shape as a struct literal of type SHAPE_STRUCT."""
    return shape_literal([s])[0]


def with_hit_box(shapes: DataFrame) -> DataFrame:
    """Adds (x0, y0, x1, y1), the bounds of every point that the test of a shape
    row (kind, a..f) accepts; NULL for an unknown kind and where there is no
    bound.

    For a triangle the area-sum test with tolerance t accepts points up to
    t / |edge| outside each edge line (the excess equals twice the summed
    negative sub-areas), so the box is that of the triangle whose edges are
    moved out by those amounts. A zero-area triangle accepts a whole line.
    Each step is a projection, so that no expression holds another twice.
    """
    a, b, c, d, e, f, kind = (F.col(n) for n in (*"abcdef", "kind"))
    edges = ((a, b, c, d), (c, d, e, f), (e, f, a, b))
    turn = (c - a) * (f - b) - (e - a) * (d - b)  # twice the signed area
    out = shapes.withColumns({"__turn": turn, **{f"__len{i}": F.hypot(x2 - x1, y2 - y1)
                                                 for i, (x1, y1, x2, y2) in enumerate(edges)}})
    sign = F.when(F.col("__turn") > 0, 1.0).when(F.col("__turn") < 0, -1.0)
    out = out.withColumn("__sign", sign)
    for i, (x1, y1, x2, y2) in enumerate(edges):  # outward normals
        length = F.col(f"__len{i}")
        out = out.withColumns({f"__nx{i}": F.col("__sign") * (y2 - y1) / length,
                               f"__ny{i}": -F.col("__sign") * (x2 - x1) / length})
    out = out.withColumns({f"__c{i}": F.col(f"__nx{i}") * x1 + F.col(f"__ny{i}") * y1 + F.lit(TRIANGLE_TOLERANCE) / F.col(f"__len{i}")
                           for i, (x1, y1, _, _) in enumerate(edges)})
    for i in range(3):  # corners of the moved edges
        (a1, b1, c1), (a2, b2, c2) = ([F.col(f"__{n}{k}") for n in ("nx", "ny", "c")] for k in (i, (i + 1) % 3))
        out = out.withColumn(f"__det{i}", F.nullif(a1 * b2 - a2 * b1, F.lit(0.0)))
        out = out.withColumns({f"__px{i}": (c1 * b2 - c2 * b1) / F.col(f"__det{i}"),
                               f"__py{i}": (a1 * c2 - a2 * c1) / F.col(f"__det{i}")})
    xs, ys = ([F.col(f"__p{n}{i}") for i in range(3)] for n in "xy")
    whole = xs[0].isNotNull() & xs[1].isNotNull() & xs[2].isNotNull()

    def pick(rect: Column, circle: Column, corner: Column) -> Column:
        return F.when(kind == "rect", rect).when(kind == "circle", circle).when((kind == "triangle") & whole, corner)

    out = out.withColumns({"x0": pick(a, a - c, F.least(*xs)), "y0": pick(b, b - c, F.least(*ys)),
                           "x1": pick(a + c, a + c, F.greatest(*xs)), "y1": pick(b + d, b + c, F.greatest(*ys))})
    return out.drop(*[n for n in out.columns if n.startswith("__")])
