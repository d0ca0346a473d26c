"""Planar geometry as Column arithmetic."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def point_segment_distance(px: Column, py: Column, x1: Column, y1: Column, x2: Column, y2: Column) -> Column:
    """Distance from a point to a line piece."""
    dx, dy = x2 - x1, y2 - y1
    square = dx * dx + dy * dy
    along = ((px - x1) * dx + (py - y1) * dy) / F.nullif(square, F.lit(0.0))
    t = F.greatest(F.lit(0.0), F.least(F.lit(1.0), F.coalesce(along, F.lit(0.0))))
    ex, ey = px - (x1 + t * dx), py - (y1 + t * dy)
    return F.sqrt(ex * ex + ey * ey)


def _side(ax: Column, ay: Column, bx: Column, by: Column, px: Column, py: Column) -> Column:
    return F.signum((bx - ax) * (py - ay) - (by - ay) * (px - ax))


def _in_box(ax: Column, ay: Column, bx: Column, by: Column, px: Column, py: Column) -> Column:
    return (
        (px >= F.least(ax, bx)) & (px <= F.greatest(ax, bx)) & (py >= F.least(ay, by)) & (py <= F.greatest(ay, by))
    )


def pieces_cross(a: tuple[Column, ...], b: tuple[Column, ...]) -> Column:
    """True where two line pieces share a point; touching counts."""
    ax1, ay1, ax2, ay2 = a
    bx1, by1, bx2, by2 = b
    s1, s2 = _side(ax1, ay1, ax2, ay2, bx1, by1), _side(ax1, ay1, ax2, ay2, bx2, by2)
    s3, s4 = _side(bx1, by1, bx2, by2, ax1, ay1), _side(bx1, by1, bx2, by2, ax2, ay2)
    return (
        ((s1 != s2) & (s3 != s4))
        | ((s1 == 0) & _in_box(ax1, ay1, ax2, ay2, bx1, by1))
        | ((s2 == 0) & _in_box(ax1, ay1, ax2, ay2, bx2, by2))
        | ((s3 == 0) & _in_box(bx1, by1, bx2, by2, ax1, ay1))
        | ((s4 == 0) & _in_box(bx1, by1, bx2, by2, ax2, ay2))
    )


def pieces_distance(a: tuple[Column, ...], b: tuple[Column, ...]) -> Column:
    """Distance of two line pieces, 0 where they meet."""
    ends = [
        point_segment_distance(a[0], a[1], *b), point_segment_distance(a[2], a[3], *b),
        point_segment_distance(b[0], b[1], *a), point_segment_distance(b[2], b[3], *a),
    ]
    return F.when(pieces_cross(a, b), 0.0).otherwise(F.least(*ends))


def _pairs(values: Column) -> Column:
    """Neighbours of an array as (a, b)."""
    n = F.size(values) - 1
    return F.zip_with(
        F.slice(values, F.lit(1), n), F.slice(values, F.lit(2), n),
        lambda a, b: F.struct(a.alias("a"), b.alias("b")),
    )


def polygon_edges(parts: Column) -> Column:
    """Edges of all closed rings of a polygon."""

    def edge(p: Column) -> Column:
        names = {"x1": p["a"]["x"], "y1": p["a"]["y"], "x2": p["b"]["x"], "y2": p["b"]["y"]}
        return F.struct(*[v.alias(n) for n, v in names.items()])

    return F.flatten(F.transform(parts, lambda ring: F.transform(_pairs(ring), edge)))


def crossed_right(e: Column, px: Column, py: Column) -> Column:
    """True where a ray from the point to the right crosses the edge.

    An odd number of crossed edges is inside: holes and islands need no special case.
    """
    spans = (e["y1"] > py) != (e["y2"] > py)
    at = e["x1"] + (py - e["y1"]) * (e["x2"] - e["x1"]) / F.nullif(e["y2"] - e["y1"], F.lit(0.0))
    return spans & (px < at)


def on_border(e: Column, px: Column, py: Column) -> Column:
    side = (e["x2"] - e["x1"]) * (py - e["y1"]) - (e["y2"] - e["y1"]) * (px - e["x1"])
    return (side == 0) & _in_box(e["x1"], e["y1"], e["x2"], e["y2"], px, py)


def piece_meets_border(x1: Column, y1: Column, x2: Column, y2: Column, edges: Column) -> Column:
    """A line piece that crosses or touches one of the edges."""
    return F.exists(edges, lambda e: pieces_cross((x1, y1, x2, y2), (e["x1"], e["y1"], e["x2"], e["y2"])))


def cut_stops(
    x1: Column, y1: Column, x2: Column, y2: Column, edges: Column, start: Column, end: Column
) -> Column:
    """Where a line piece meets edges, as shares of its way, with the two shares it is asked between."""
    dx, dy = x2 - x1, y2 - y1

    def cut(e: Column) -> Column:
        ex, ey = e["x2"] - e["x1"], e["y2"] - e["y1"]
        cross = F.nullif(dx * ey - dy * ex, F.lit(0.0))
        t = ((e["x1"] - x1) * ey - (e["y1"] - y1) * ex) / cross
        u = ((e["x1"] - x1) * dy - (e["y1"] - y1) * dx) / cross
        return F.when((t > start) & (t < end) & (u >= 0) & (u <= 1), t)

    cuts = F.array_compact(F.transform(edges, cut))
    return F.array_sort(F.array_distinct(F.concat(F.array(start, end), cuts)))


def length_inside(
    x1: Column, y1: Column, x2: Column, y2: Column, stops: Column, inside: Callable[[Column, Column], Column]
) -> Column:
    """Length of a line piece inside a polygon: its parts between ``stops`` whose middle lies ``inside`` add up.

    ``stops`` is read several times, so it should be a column, not an expression.
    """
    dx, dy = x2 - x1, y2 - y1

    def counted(p: Column) -> Column:
        middle = (p["a"] + p["b"]) / 2.0
        return F.when(inside(x1 + middle * dx, y1 + middle * dy), p["b"] - p["a"]).otherwise(0.0)

    share = F.aggregate(F.transform(_pairs(stops), counted), F.lit(0.0), lambda acc, v: acc + v)
    return share * F.sqrt(dx * dx + dy * dy)
