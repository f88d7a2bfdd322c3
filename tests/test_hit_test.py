"""Edge points, the three evaluation forms agree, no shuffle."""

from pyspark.sql import functions as F

from cursorlake.functions.shapes import DEMO_SHAPES, TEST_SHAPES, Shape, with_hit_box
from cursorlake.operators.hit_test import hit_test, hit_test_grid, shape_literal, shapes_frame
from cursorlake.operators import hit_test as H


def _points(spark, pts):
    return spark.createDataFrame([(i, float(x), float(y)) for i, (x, y) in enumerate(pts)],
                                 "i int, canvasX double, canvasY double")


def test_edges(spark):
    pts = [(50, 50), (150, 150), (250, 200), (250.01, 200), (300, 50), (300, 49.9), (10, 10)]
    got = {r.i: r.sid for r in hit_test(_points(spark, pts), DEMO_SHAPES)
           .select("i", F.col("shape.id").alias("sid")).collect()}
    assert got[0] == "s1" and got[1] == "s1"          # rect corners are inside
    assert got[2] == "s2" and got[3] is None          # circle edge inclusive
    assert got[4] == "s3"                              # triangle apex
    assert got[6] is None


def test_last_vs_first(spark):
    pts = [(130, 130), (160, 170), (320, 120)]
    df = _points(spark, pts)
    last = {r.i: r.sid for r in hit_test(df, TEST_SHAPES, order="last").select("i", F.col("shape.id").alias("sid")).collect()}
    first = {r.i: r.sid for r in hit_test(df, TEST_SHAPES, order="first").select("i", F.col("shape.id").alias("sid")).collect()}
    assert last == {0: "s5", 1: "s5", 2: "s6"}
    assert first == {0: "s1", 1: "s2", 2: "s3"}


def test_forms_agree(spark):
    grid = [(x * 3.7 % 400, y * 5.3 % 400) for x in range(60) for y in range(60)]
    df = _points(spark, grid)
    case = hit_test(df, TEST_SHAPES).select("i", F.to_json("shape").alias("a"))
    arr = df.select("i", F.to_json(H.shape_summary(H._pick(F.filter(shape_literal(TEST_SHAPES),
                    lambda s: H.contains(s, F.col("canvasX"), F.col("canvasY"))), "last"))).alias("b"))
    cells = hit_test_grid(df, shapes_frame(spark, TEST_SHAPES), cell=50.0).select("i", F.to_json("shape").alias("c"))
    rows = case.join(arr, "i").join(cells, "i").collect()
    assert len(rows) == len(grid)
    assert all(r.a == r.b == r.c for r in rows)


def test_no_exchange(spark):
    df = _points(spark, [(1, 1)])
    plan = hit_test(df, TEST_SHAPES)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan


def test_forms_agree_on_odd_shapes(spark):
    """Ties, slivers, zero-area, huge and unknown shapes: one answer in the
    chain, the array and the grid form, for both orders and any list order."""
    odd = [Shape("a", "rect", 1, 0, 0, 50, 50), Shape("b", "rect", 1, 20, 20, 50, 50), Shape("c", "circle", 1, 40, 40, 20),
           Shape("sliver", "triangle", 2, 70, 0, 1070, 0, 570, 0.01), Shape("thin", "triangle", 2, 0, 0, 40, 1, 0, 2),
           Shape("line", "triangle", 2, 0, 300, 100, 300, 50, 300),
           Shape("huge", "rect", 0, -1e7, -1e7, 1e7 + 60, 1e7 + 60), Shape("star", "star", 9, 0, 0, 100, 100)]
    pts = [(x * 2.5 - 20, y * 2.5 - 10) for x in range(60) for y in range(40)]
    pts += [(30, 0), (30, 0.1), (70 + 999, 0.02), (-500, 300), (1e6, 300), (50, 300.004), (5, 500), (40.2, 1.0), (40.3, 1.0)]
    df = _points(spark, pts)
    x, y = F.col("canvasX"), F.col("canvasY")
    seen = set()
    for shapes in (odd, odd[::-1]):
        far = [Shape(f"far{i}", "rect", 0, 9e8 + i, 9e8, 0.5, 0.5) for i in range(H.MAX_CASE_SHAPES)]  # forces the array form
        for order in ("last", "first"):
            case = df.select("i", H.hit_shape(x, y, shapes, order).id.alias("a"),
                             H.hit_shape(x, y, shapes + far, order).id.alias("b"))
            grid = hit_test_grid(df, shapes_frame(spark, shapes), order=order, cell=16.0).select("i", F.col("shape.id").alias("c"))
            rows = case.join(grid, "i").collect()
            assert len(rows) == len(pts)
            assert [(pts[r.i], r.a, r.b, r.c) for r in rows if not r.a == r.b == r.c] == []
            seen |= {r.a for r in rows}
            both = [r for r in rows if pts[r.i] == (30.0, 40.0)]  # on a, b and c alike
            drawn = [s.id for s in shapes if s.id in "abc"]
            want = drawn[-1] if order == "last" else "huge"
            assert both and all(r.a == want for r in both)
    assert {"a", "b", "c", "sliver", "thin", "line", "huge"} <= seen and "star" not in seen


def test_point_triangle_hits_everywhere(spark):
    """Three equal corners: every area sum is zero, so the test always holds."""
    dot = [Shape("dot", "triangle", 2, 5, 500, 5, 500, 5, 500)]
    df = _points(spark, [(0, 0), (1e6, -7)])
    assert hit_test(df, dot).where("shape.id = 'dot'").count() == 2
    assert hit_test_grid(df, shapes_frame(spark, dot)).where("shape.id = 'dot'").count() == 2


def test_bare_shape_table(spark):
    """A table without position: equal z by id; a sliver's tip is inside."""
    shapes = shapes_frame(spark, [Shape("t", "triangle", 1, 70, 0, 1070, 0, 570, 0.01)]).drop("position")
    got = {r.i: r.s for r in hit_test_grid(_points(spark, [(30, 0), (69, 40)]), shapes).select("i", F.col("shape.id").alias("s")).collect()}
    assert got == {0: "t", 1: None}
    assert hit_test_grid(_points(spark, [(1, 1)]), shapes.limit(0)).first().shape is None


def test_many_shapes(spark):
    """More shapes than a literal may hold go through the grid."""
    shapes = [Shape(f"r{i}", "rect", i, i * 3.0, 0, 2, 2) for i in range(H.MAX_LITERAL_SHAPES + 1)]
    got = hit_test(_points(spark, [(3 * 4000 + 1, 1), (2.5, 1)]), shapes).select("i", F.col("shape.id").alias("s")).collect()
    assert {r.i: r.s for r in got} == {0: "r4000", 1: None}


def test_triangle_box_contains_tolerance_band(spark):
    """Points just outside the triangle that still hit lie inside its box."""
    tri = Shape("t", "triangle", 1, 0, 0, 40, 1, 0, 2)   # thin: long edges, sharp corner
    x0, y0, x1, y1 = with_hit_box(shapes_frame(spark, [tri])).select("x0", "y0", "x1", "y1").first()
    w, h = x1 - x0, y1 - y0
    pts = [(x0 - w / 2 + 2 * w * i / 80, y0 - h / 2 + 2 * h * j / 80) for i in range(81) for j in range(81)]
    df = _points(spark, pts)
    hits = hit_test(df, [tri]).where("shape IS NOT NULL").select("canvasX", "canvasY").collect()
    assert len(hits) > 100
    assert all(x0 <= r.canvasX <= x1 and y0 <= r.canvasY <= y1 for r in hits)
    # the band beyond the sharp apex (40, 1): hit up to x ~ 40.25, inside the box
    apex = {r.i: r.hit for r in hit_test(_points(spark, [(40.2, 1.0), (40.3, 1.0)]), [tri])
            .select("i", F.col("shape.id").alias("hit")).collect()}
    assert apex == {0: "t", 1: None} and x1 >= 40.2
