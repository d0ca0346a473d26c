"""Polygons as grids of cells that know whether they lie inside.

Each polygon has a grid of its own, as fine as its border asks for: about one cell for every eight corners. A cell keeps
the edges that pass it, and whether its lower right corner lies inside. The corner's answer is a running sum
along a row of cells: the edges that cross the row's lower line further right. So a question about a place reads the
few edges of one cell, however many corners the border has, and a cell without edges is inside or outside as a whole.

The way from the place to the corner of its cell stays in the cell, so edges elsewhere can't change the answer; what an
edge changes on that way is counted by the same comparisons as a ray to the right, so no digits are lost.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from mainstay.functions.geometry import crossed_right, on_border, polygon_edges

CORNERS_PER_CELL = 8.0
# Cells don't get smaller than this, so that a segment never takes very many of them.
LEAST_CELL = 4.0
# An edge also counts in a cell that it misses by less than this, far more than rounding moves a place.
SLACK = 1e-6
CELL = ["__pid", "__cx", "__cy"]


def _extent(parts: Column) -> tuple[Column, Column, Column, Column]:
    corners = F.flatten(parts)
    xs, ys = F.transform(corners, lambda p: p["x"]), F.transform(corners, lambda p: p["y"])
    return F.array_min(xs), F.array_min(ys), F.array_max(xs), F.array_max(ys)


def cell_size(parts: Column) -> Column:
    """A power of two, so that places divide by it exactly; rows and columns of the grid are as few as the corners."""
    low_x, low_y, high_x, high_y = _extent(parts)
    wide, high = high_x - low_x, high_y - low_y
    per_corner = CORNERS_PER_CELL / F.greatest(F.size(F.flatten(parts)), F.lit(1))
    size = F.greatest(F.sqrt(wide * high * per_corner), wide * per_corner, high * per_corner, F.lit(LEAST_CELL))
    return F.pow(F.lit(2.0), F.ceil(F.log2(size)))


def _steps(low: Column, high: Column, size: Column) -> Column:
    return F.sequence(F.floor(low / size), F.floor(high / size))


def _edge_cells(e: Column, size: Column) -> Column:
    """Cells that an edge passes, column by column, then row by row."""
    low, high = F.least(e["x1"], e["x2"]) - SLACK, F.greatest(e["x1"], e["x2"]) + SLACK
    dx, dy = F.nullif(e["x2"] - e["x1"], F.lit(0.0)), e["y2"] - e["y1"]

    def rows(cx: Column) -> Column:
        def height(x: Column, default: float) -> Column:
            share = F.coalesce((x - e["x1"]) / dx, F.lit(default))
            return e["y1"] + F.greatest(F.lit(0.0), F.least(F.lit(1.0), share)) * dy

        ends = height(cx * size - SLACK, 0.0), height((cx + 1) * size + SLACK, 1.0)
        ys = _steps(F.least(*ends) - SLACK, F.greatest(*ends) + SLACK, size)
        return F.transform(ys, lambda cy: F.struct(cx.alias("cx"), cy.alias("cy"), e.alias("e"), F.lit(0).alias("n")))

    return F.flatten(F.transform(_steps(low, high, size), rows))


def _line_cells(e: Column, size: Column) -> Column:
    """One entry for each lower line of a row of cells that an edge crosses, at the cell where it does."""

    def entry(cy: Column) -> Column:
        y = cy * size
        at = e["x1"] + (y - e["y1"]) * (e["x2"] - e["x1"]) / F.nullif(e["y2"] - e["y1"], F.lit(0.0))
        # A crossing on the line between two cells belongs to the left one: it isn't right of that one's corner.
        cx = F.ceil(at / size) - 1
        return F.struct(cx.alias("cx"), cy.alias("cy"), F.lit(None).cast("struct<x1:double,y1:double,x2:double,y2:double>").alias("e"), F.lit(1).alias("n"))

    lines = _steps(F.least(e["y1"], e["y2"]), F.greatest(e["y1"], e["y2"]), size)
    spans = F.filter(lines, lambda cy: (e["y1"] > cy * size) != (e["y2"] > cy * size))
    return F.transform(spans, entry)


def area_cells(areas: DataFrame) -> DataFrame:
    """(__pid, __cx, __cy, __edges, __odd): the cells of all polygons (__pid, __size, parts) that aren't outside as a whole.

    __edges are the edges that pass the cell, none in cells that are inside as a whole. __odd tells whether the number of
    edges elsewhere that a ray from the cell's lower right corner crosses is odd. There are as many cells as corners, at
    most, and a few for each polygon.
    """
    edges = areas.select("__pid", "__size", F.explode(polygon_edges(F.col("parts"))).alias("e"))
    size = F.col("__size")
    found = F.concat(_edge_cells(F.col("e"), size), _line_cells(F.col("e"), size))
    border = edges.select("__pid", "__size", F.explode(found).alias("c")).select("__pid", "__size", "c.cx", "c.cy", "c.e", "c.n")
    # The outline is measured once, before it is spread: above the explode it would be measured for every column.
    names = ["__low_x", "__low_y", "__high_x", "__high_y"]
    bounds = areas.select("__pid", "__size", *[v.alias(n) for n, v in zip(names, _extent(F.col("parts")))])
    grid = (
        bounds.withColumn("cx", F.explode(_steps(F.col("__low_x"), F.col("__high_x"), size)))
        .select("__pid", "__size", "cx", F.explode(_steps(F.col("__low_y"), F.col("__high_y"), size)).alias("cy"))
    )
    cells = border.unionByName(grid, allowMissingColumns=True).groupBy("__pid", "__size", "cx", "cy").agg(
        F.collect_list("e").alias("__edges"), F.coalesce(F.sum("n"), F.lit(0)).alias("__n")
    )
    right = Window.partitionBy("__pid", "cy").orderBy(F.desc("cx")).rowsBetween(Window.unboundedPreceding, -1)
    corner = (F.col("cx") + 1) * size, F.col("cy") * size
    own = F.size(F.filter("__edges", lambda e: crossed_right(e, *corner)))
    counted = cells.withColumn("__right", F.coalesce(F.sum("__n").over(right), F.lit(0))).select(
        "__pid", F.col("cx").alias("__cx"), F.col("cy").alias("__cy"), "__edges", ((F.col("__right") + own) % 2 == 1).alias("__odd")
    )
    return counted.filter(F.col("__odd") | (F.size("__edges") > 0))


def piece_cells(pieces: DataFrame) -> DataFrame:
    """Pieces (x1, y1, x2, y2, __size) with the cells along their course, and from which share of their way to which each.

    The shares of a piece cover its way once; a piece on the line between two cells belongs to one of them.
    """
    size, x1, y1 = F.col("__size"), F.col("x1"), F.col("y1")
    dx, dy = F.col("x2") - x1, F.col("y2") - y1

    def between(cell: Column, start: Column, way: Column) -> tuple[Column, Column]:
        ends = [(c * size - start) / F.nullif(way, F.lit(0.0)) for c in (cell, cell + 1)]
        inner = [F.greatest(F.lit(0.0), F.least(F.lit(1.0), e)) for e in (F.least(*ends), F.greatest(*ends))]
        return F.when(way == 0, 0.0).otherwise(inner[0]), F.when(way == 0, 1.0).otherwise(inner[1])

    start, end = between(F.col("__cx"), x1, dx)
    columns = pieces.withColumn("__cx", F.explode(_steps(F.least("x1", "x2"), F.greatest("x1", "x2"), size))).withColumns(
        {"__from": start, "__to": end}
    )
    ends = y1 + F.col("__from") * dy, F.when(F.col("__to") == 1, F.col("y2")).otherwise(y1 + F.col("__to") * dy)
    rows = columns.withColumn("__cy", F.explode(_steps(F.least(*ends), F.greatest(*ends), size)))
    start, end = between(F.col("__cy"), y1, dy)
    return rows.withColumns({"__from": F.greatest("__from", start), "__to": F.least("__to", end)})


def place_cells(places: DataFrame) -> DataFrame:
    """Places (x, y, __size) with their cell."""
    return places.withColumns({"__cx": F.floor(F.col("x") / F.col("__size")), "__cy": F.floor(F.col("y") / F.col("__size"))})


def inside_cell(px: Column, py: Column) -> Column:
    """Whether a place in the cell of the row is inside the polygon or on its border."""
    corner_x, corner_y = (F.col("__cx") + 1) * F.col("__size"), F.col("__cy") * F.col("__size")

    def passed(x: Column, y: Column) -> Column:
        return (x > corner_x) & ((y > py) != (y > corner_y))

    def changes(e: Column) -> Column:
        return crossed_right(e, px, py) != (passed(e["x1"], e["y1"]) != passed(e["x2"], e["y2"]))

    edges = F.col("__edges")
    odd = F.size(F.filter(edges, changes)) % 2 == 1
    return (odd != F.col("__odd")) | F.exists(edges, lambda e: on_border(e, px, py))
