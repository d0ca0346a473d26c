"""Slanted shapes, long features and polygons with holes against plain arithmetic."""

import math
import random

import pytest
from pyspark.sql import functions as F

from mainstay.operators import proximity as X

EDGE = "id long, x1 double, y1 double, x2 double, y2 double"
LINE = "feature_id long, x1 double, y1 double, x2 double, y2 double"
POINT = "feature_id long, x double, y double"


def point_distance(px, py, e):
    x1, y1, x2, y2 = e
    dx, dy = x2 - x1, y2 - y1
    square = dx * dx + dy * dy
    t = 0.0 if square == 0 else max(0.0, min(1.0, ((px - x1) * dx + (py - y1) * dy) / square))
    return math.hypot(px - x1 - t * dx, py - y1 - t * dy)


def crosses(a, b):
    def side(p, q, r):
        v = (q[0] - p[0]) * (r[1] - p[1]) - (q[1] - p[1]) * (r[0] - p[0])
        return (v > 0) - (v < 0)

    def on(p, q, r):
        return min(p[0], q[0]) <= r[0] <= max(p[0], q[0]) and min(p[1], q[1]) <= r[1] <= max(p[1], q[1])

    p1, p2, q1, q2 = (a[0], a[1]), (a[2], a[3]), (b[0], b[1]), (b[2], b[3])
    s = side(p1, p2, q1), side(p1, p2, q2), side(q1, q2, p1), side(q1, q2, p2)
    if s[0] != s[1] and s[2] != s[3]:
        return True
    return any(v == 0 and on(*t) for v, t in zip(s, ((p1, p2, q1), (p1, p2, q2), (q1, q2, p1), (q1, q2, p2))))


def line_distance(a, b):
    if crosses(a, b):
        return 0.0
    return min(point_distance(a[0], a[1], b), point_distance(a[2], a[3], b), point_distance(b[0], b[1], a), point_distance(b[2], b[3], a))


@pytest.fixture(scope="module")
def shapes():
    rng = random.Random(7)

    def edge(reach):
        x, y = rng.randint(-500, 900), rng.randint(-500, 900)
        return (float(x), float(y), float(x + rng.randint(-reach, reach)), float(y + rng.randint(-reach, reach)))

    segs = [edge(40) for _ in range(80)] + [(0.0, 0.0, 0.0, 0.0), (-400.0, -400.0, 800.0, 700.0)]
    lines = [edge(300) for _ in range(60)] + [(0.0, 0.0, 100.0, 0.0), (100.0, 0.0, 100.0, 200.0)]
    points = [(float(rng.randint(-500, 900)), float(rng.randint(-500, 900))) for _ in range(150)] + [(20.0, 20.0)] * 5 + [(0.0, 25.0)]
    return segs, lines, points


def test_points_within(spark, shapes):
    segs, _, points = shapes
    seg = spark.createDataFrame([(i, *e) for i, e in enumerate(segs)], EDGE)
    pts = spark.createDataFrame([(i, *p) for i, p in enumerate(points)], POINT)
    expected = {}
    for i, e in enumerate(segs):
        near = [d for d in (point_distance(*p, e) for p in points) if d <= 25.0]
        if near:
            expected[i] = (len(near), round(min(near), 6))
    found = {r.id: (r.near, round(r.nearest, 6)) for r in X.count_within(seg, pts, 25.0).collect()}
    assert found == expected
    assert found[80][0] >= 1  # the point exactly at the distance


def test_lines_near_and_crossing(spark, shapes):
    segs, lines, _ = shapes
    seg = spark.createDataFrame([(i, *e) for i, e in enumerate(segs)], EDGE)
    feats = spark.createDataFrame([(i, *e) for i, e in enumerate(lines)], LINE)
    for d in (0.0, 60.0, 250.0):
        expected = sorted((i, j, round(line_distance(a, b), 6)) for i, a in enumerate(segs) for j, b in enumerate(lines) if line_distance(a, b) <= d)
        found = sorted((r.id, r.feature_id, round(r.distance, 6)) for r in X.line_pairs(seg, feats, d).collect())
        assert found == expected


def ring(*corners):
    return [{"x": float(x), "y": float(y)} for x, y in [*corners, corners[0]]]


def test_polygons_with_holes_and_islands(spark):
    square = ring((0, 0), (300, 0), (300, 300), (0, 300))
    hole = ring((100, 100), (200, 100), (200, 200), (100, 200))
    triangle = ring((1000, 0), (1400, 0), (1000, 400))
    schema = "feature_id long, parts array<array<struct<x:double,y:double>>>"
    areas = spark.createDataFrame([(1, [square, hole]), (2, [triangle]), (3, [square])], schema)
    seg = spark.createDataFrame(
        [
            (1, -50.0, 150.0, 350.0, 150.0), (2, 110.0, 150.0, 190.0, 150.0), (3, 20.0, 20.0, 40.0, 20.0),
            (4, 900.0, 100.0, 1500.0, 100.0), (5, 300.0, 300.0, 400.0, 400.0), (6, 500.0, 500.0, 600.0, 500.0),
            (7, 1200.0, 200.0, 1300.0, 300.0),
        ], EDGE,
    )
    found = {(r.id, r.feature_id): round(r.length_inside, 6) for r in X.polygon_pairs(seg, areas).collect()}
    assert found == {
        (1, 1): 200.0, (1, 3): 300.0, (2, 3): 80.0, (3, 1): 20.0, (3, 3): 20.0, (4, 2): 300.0,
        (5, 1): 0.0, (5, 3): 0.0, (7, 2): 0.0,
    }
    counts = {r.id: r.n for r in X.area_counts(seg, areas, "n").collect()}
    assert counts == {1: 2, 2: 1, 3: 2, 4: 1, 5: 2, 6: 0, 7: 1}
    starts = spark.createDataFrame([(1, 150.0, 150.0), (2, 50.0, 50.0), (3, 0.0, 0.0), (4, 700.0, 50.0)], "id long, x double, y double")
    assert sorted(r.id for r in X.start_point_in(starts, areas.filter("feature_id = 1")).collect()) == [2, 3]


def test_slopes_without_length_or_elevation(spark):
    rows = [(1, 0.0, 10.0, 8.0, 5.0, 6.0), (2, 100.0, None, 8.0, 5.0, 6.0), (3, 100.0, 10.0, 8.0, 5.0, 6.0)]
    df = spark.createDataFrame(rows, "id long, length double, frm_elev double, to_elev double, frm_depth double, to_depth double")
    found = {r.id: (r.gslope, r.xpipslope) for r in X.slopes(df).collect()}
    assert found[1] == (None, None) and found[2] == (None, None)
    assert found[3] == pytest.approx((0.01, 0.02))


def test_pairs_that_share_a_node_are_dropped(spark):
    seg = spark.createDataFrame([(1, 0.0, 0.0, 10.0, 0.0)], EDGE)
    nodes = spark.createDataFrame([(1, " A1", "b2")], "id long, usnode string, dsnode string")
    sewers = spark.createDataFrame(
        [(1, 5.0, -5.0, 5.0, 5.0, 8.0, "a1 ", "x"), (2, 5.0, -5.0, 5.0, 5.0, 10.0, None, "y"), (3, 0.0, 4.0, 10.0, 4.0, 12.0, "q", "r")],
        LINE + ", pipesize double, us_node string, ds_node string",
    )
    r = X.sewer_crossings(seg, nodes, sewers).first()
    assert (r.xsewer, r.xswrmaxd, r.xswrmind, r.psewer, r.pswrmaxd, r.pft2swr) == (1, 10.0, 10.0, 1, 12.0, 4.0)


def test_wide_table_has_all_columns(spark):
    base = spark.createDataFrame([(1, 5)], "id long, compkey long")
    layer = spark.createDataFrame([(1, 3)], "id long, xhyd long")
    out = X.crossing_table(base, [layer], X.WIDE_COLUMNS)
    assert out.columns == X.WIDE_COLUMNS and len(out.columns) == 82
    assert out.first().xhyd == 3


def test_border_with_very_many_corners(spark):
    """A circle of 100,000 corners against its chords."""
    n, r = 100_000, 5000.0
    corners = [(r * math.cos(2 * math.pi * k / n), r * math.sin(2 * math.pi * k / n)) for k in range(n)]
    schema = "feature_id long, parts array<array<struct<x:double,y:double>>>"
    area = spark.createDataFrame([(1, [[*corners, corners[0]]])], schema)
    rng = random.Random(8)
    segs = [(k, *(rng.uniform(-7000, 7000) for _ in range(2))) for k in range(200)]
    segs = [(k, x, y, x + rng.uniform(-900, 900), y + rng.uniform(-900, 900)) for k, x, y in segs]
    found = {row.id: row.length_inside for row in X.polygon_pairs(spark.createDataFrame(segs, EDGE), area).collect()}
    for k, x1, y1, x2, y2 in segs:
        dx, dy = x2 - x1, y2 - y1
        a, b, c = dx * dx + dy * dy, 2 * (x1 * dx + y1 * dy), x1 * x1 + y1 * y1 - r * r
        inside = 0.0
        if b * b > 4 * a * c:
            ends = [(-b + s * math.sqrt(b * b - 4 * a * c)) / (2 * a) for s in (-1, 1)]
            inside = max(0.0, min(1.0, ends[1]) - max(0.0, ends[0])) * math.sqrt(a)
        assert found.get(k, 0.0) == pytest.approx(inside, abs=0.02)
    starts = spark.createDataFrame([(k, x, y) for k, x, y, _, _ in segs], "id long, x double, y double")
    inside = {row.id for row in X.start_point_in(starts, area).collect()}
    assert inside == {k for k, x, y, _, _ in segs if math.hypot(x, y) < r}


def plain_inside(px, py, rings):
    odd = False
    for ring_ in rings:
        for (ax, ay), (bx, by) in zip(ring_, ring_[1:]):
            if (ay > py) != (by > py) and px < ax + (py - ay) * (bx - ax) / (by - ay):
                odd = not odd
    return odd


@pytest.mark.parametrize("corners", [5, 60, 900])
def test_cells_of_ragged_polygons(spark, corners):
    """Ragged rings with a hole, some corners on the lines between cells, against a ray over all edges."""
    rng = random.Random(corners)

    def ragged(x, y, least, most):
        ways = sorted(rng.uniform(0, 2 * math.pi) for _ in range(corners))
        around = [(x + rng.uniform(least, most) * math.cos(w), y + rng.uniform(least, most) * math.sin(w)) for w in ways]
        snapped = [(round(a / 8) * 8.0, round(b / 8) * 8.0) if rng.random() < 0.4 else (a, b) for a, b in around]
        return [*snapped, snapped[0]]

    rings = [ragged(7_650_000.0, 680_000.0, 800, 2000), ragged(7_650_000.0, 680_000.0, 100, 600)]
    schema = "feature_id long, parts array<array<struct<x:double,y:double>>>"
    area = spark.createDataFrame([(1, rings)], schema)
    places = [(7_650_000 + rng.uniform(-2200, 2200), 680_000 + rng.uniform(-2200, 2200)) for _ in range(800)]
    places += [(7_650_000.0 + 8 * rng.randint(-250, 250), 680_000.0 + 8 * rng.randint(-250, 250)) for _ in range(800)]
    starts = spark.createDataFrame([(k, *p) for k, p in enumerate(places)], "id long, x double, y double")
    found = {row.id for row in X.start_point_in(starts, area).collect()}
    edges = [(*a, *b) for r in rings for a, b in zip(r, r[1:])]
    for k, (x, y) in enumerate(places):
        if not any(point_distance(x, y, e) == 0 for e in edges):
            assert (k in found) == plain_inside(x, y, rings)

    segs = [(k, x, y, x + rng.uniform(-300, 300), y + rng.choice([0.0, rng.uniform(-300, 300)])) for k, (x, y) in enumerate(places[:60])]
    lengths = {row.id: row.length_inside for row in X.polygon_pairs(spark.createDataFrame(segs, EDGE), area).collect()}
    for k, x1, y1, x2, y2 in segs:
        cuts = [0.0, 1.0]
        for ax, ay, bx, by in edges:
            cross = (x2 - x1) * (by - ay) - (y2 - y1) * (bx - ax)
            if cross:
                t = ((ax - x1) * (by - ay) - (ay - y1) * (bx - ax)) / cross
                u = ((ax - x1) * (y2 - y1) - (ay - y1) * (x2 - x1)) / cross
                cuts += [t] if 0 < t < 1 and 0 <= u <= 1 else []
        cuts.sort()
        middles = [((a + b) / 2, b - a) for a, b in zip(cuts, cuts[1:])]
        share = sum(d for m, d in middles if plain_inside(x1 + m * (x2 - x1), y1 + m * (y2 - y1), rings))
        assert lengths.get(k, 0.0) == pytest.approx(share * math.hypot(x2 - x1, y2 - y1), abs=1e-4)


def test_million_corners_in_one_row_of_cells(spark, tmp_path):
    """A comb of 250,000 teeth, 100 ft high: every second half foot is a tooth."""
    teeth = 250_000
    top = F.transform(F.sequence(F.col("id"), F.col("id") + 4 * teeth - 1), lambda k: F.struct(
        (F.floor(k / 4) + F.when(k % 4 >= 2, 0.5).otherwise(0.0)).cast("double").alias("x"),
        F.when((k % 4 == 1) | (k % 4 == 2), 100.0).otherwise(10.0).alias("y"),
    ))
    foot = F.array(*[F.struct(F.lit(x).alias("x"), F.lit(y).alias("y")) for x, y in ((float(teeth), 0.0), (0.0, 0.0), (0.0, 10.0))])
    area = spark.range(1).select(F.col("id").alias("feature_id"), F.array(F.concat(top, foot)).alias("parts"))
    area.write.parquet(f"{tmp_path}/comb")
    area = spark.read.parquet(f"{tmp_path}/comb")
    segs = [(k, 1000.0 * k + 0.25, 50.0, 1000.0 * k + 20.25, 50.0) for k in range(240)] + [(900, 10.75, 50.0, 10.75, 5.0)]
    found = {row.id: row.length_inside for row in X.polygon_pairs(spark.createDataFrame(segs, EDGE), area).collect()}
    assert found == pytest.approx({k: 10.0 for k in range(240)} | {900: 5.0})
    starts = spark.createDataFrame([(k, k + 0.25 + 0.5 * (k % 2), 60.0) for k in range(0, 250_000, 777)], "id long, x double, y double")
    assert {row.id for row in X.start_point_in(starts, area).collect()} == {k for k in range(0, 250_000, 777) if k % 2 == 0}


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_features_are_never_broadcast(spark):
    segs = spark.createDataFrame([(1, 0.0, 0.0, 10.0, 0.0)], EDGE)
    points = spark.createDataFrame([(1, 5.0, 3.0)], POINT)
    lines = spark.createDataFrame([(1, 5.0, -5.0, 5.0, 5.0)], LINE)
    corner = lambda x, y: F.struct(F.lit(x).alias("x"), F.lit(y).alias("y"))
    ring = F.array(*[corner(*c) for c in ((0.0, -5.0), (9.0, -5.0), (9.0, 5.0), (0.0, 5.0), (0.0, -5.0))])
    areas = spark.range(1).select(F.col("id").alias("feature_id"), F.array(ring).alias("parts"))
    found = [X.point_pairs(segs, points, 5.0), X.line_pairs(segs, lines, 5.0), X.polygon_pairs(segs, areas)]
    for pairs in found:
        assert "BroadcastHashJoin" not in _plan(pairs)
        assert pairs.count() == 1


def test_segments_out_of_reach_are_left_out(spark):
    segs = spark.createDataFrame([(1, 0.0, 0.0, 10.0, 0.0), (2, 0.0, 15.0, 10.0, 15.0), (3, 0.0, 900.0, 10.0, 900.0)], EDGE)
    points = spark.createDataFrame([(1, 5.0, 10.0)], POINT)
    assert sorted(r.id for r in X.within_reach(segs, points, 10.0).collect()) == [1, 2]
    assert sorted(r.id for r in X.point_pairs(segs, points, 10.0).collect()) == [1, 2]
    assert X.within_reach(segs, points.limit(0), 10.0).count() == 0
