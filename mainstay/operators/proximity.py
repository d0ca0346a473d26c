"""What lies near, across or around each segment.

Every spatial join is an equi-join on grid cells followed by an exact test. A pair
is kept only in the first cell that both boxes share, so nothing has to be made
distinct afterwards. The features are grown by the search distance, not the segments,
which are many more; segments out of reach of all features are left out. Places that several features share are merged into one row
with a weight before the join. Both sides of a cell join are plain shuffles, so Spark
splits a crowded cell at run time.

Segments are edges (id, x1, y1, x2, y2); points are (feature_id, x, y); lines are
edges with a feature_id; polygons are (feature_id, parts), an array of closed rings
of (x, y) corners: outer borders, islands and holes alike.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mainstay.functions.geometry import cut_stops, length_inside, piece_meets_border, pieces_distance, point_segment_distance
from mainstay.operators.coverage import CELL, area_cells, cell_size, inside_cell, piece_cells, place_cells
from mainstay.operators.skew import HotKeys, attach
from mainstay.operators.tables import shares_node

MIN_CELL = 100.0
LONG_EDGE = 1000.0
_BOX = ["__bx1", "__by1", "__bx2", "__by2"]
_CELLS = ["__cx", "__cy"]


def extent(edges: DataFrame) -> DataFrame:
    """One row: the box around all segments."""
    return edges.agg(
        F.min(F.least("x1", "x2")).alias("min_x"), F.min(F.least("y1", "y2")).alias("min_y"),
        F.max(F.greatest("x1", "x2")).alias("max_x"), F.max(F.greatest("y1", "y2")).alias("max_y"),
    )


def _box_columns(df: DataFrame) -> list[Column]:
    if "x1" in df.columns:
        return [F.least("x1", "x2"), F.least("y1", "y2"), F.greatest("x1", "x2"), F.greatest("y1", "y2")]
    if "parts" in df.columns:
        corners = F.flatten("parts")
        xs, ys = F.transform(corners, lambda p: p["x"]), F.transform(corners, lambda p: p["y"])
        return [F.array_min(xs), F.array_min(ys), F.array_max(xs), F.array_max(ys)]
    return [F.col("x"), F.col("y"), F.col("x"), F.col("y")]


def with_box(df: DataFrame, grow: float = 0.0) -> DataFrame:
    low_x, low_y, high_x, high_y = _box_columns(df)
    return (
        df.withColumn("__bx1", low_x - grow).withColumn("__by1", low_y - grow)
        .withColumn("__bx2", high_x + grow).withColumn("__by2", high_y + grow)
    )


def near_extent(features: DataFrame, ext: DataFrame, d: float = 0.0) -> DataFrame:
    """Features whose box meets the extent grown by ``d``."""
    boxed = with_box(features)
    box = ext.select(F.struct("min_x", "min_y", "max_x", "max_y")).scalar()
    meets = (
        (F.col("__bx2") >= box["min_x"] - d) & (F.col("__bx1") <= box["max_x"] + d)
        & (F.col("__by2") >= box["min_y"] - d) & (F.col("__by1") <= box["max_y"] + d)
    )
    return boxed.filter(meets).select(*features.columns)


def _reach(features: DataFrame, grow: float | Column = 0.0) -> Column:
    """The box around all features, each grown by its own distance; a foot more, so that rounding loses nothing."""
    boxed = with_box(features, grow)
    ends = [F.min("__bx1"), F.min("__by1"), F.max("__bx2"), F.max("__by2")]
    return boxed.agg(F.struct(*[e.alias(n) for e, n in zip(ends, _BOX)])).scalar()


def _meets(box: Column) -> Column:
    """Whether the box of the row comes within a foot of the given one."""
    return (
        (F.col("__bx2") >= box["__bx1"] - 1.0) & (F.col("__bx1") <= box["__bx2"] + 1.0)
        & (F.col("__by2") >= box["__by1"] - 1.0) & (F.col("__by1") <= box["__by2"] + 1.0)
    )


def within_reach(seg: DataFrame, features: DataFrame, grow: float | Column = 0.0) -> DataFrame:
    """Segments whose box meets the one around all features: the others have no pair, and are put into no cells."""
    return with_box(seg).filter(_meets(_reach(features, grow))).drop(*_BOX)


def split_edges(edges: DataFrame, max_length: float) -> DataFrame:
    """Cut long edges into equal pieces, so that the box of each stays small."""
    dx, dy = F.col("x2") - F.col("x1"), F.col("y2") - F.col("y1")
    n = F.greatest(F.lit(1.0), F.ceil(F.greatest(F.abs(dx), F.abs(dy)) / max_length))
    cut = edges.withColumn("__n", n).withColumn("__k", F.explode(F.sequence(F.lit(0), (n - 1).cast("int"))))

    def at(start: str, end: str, k: Column) -> Column:
        # The last stop is the end itself, so neighbours share their corner exactly.
        inner = F.col(start) + (F.col(end) - F.col(start)) * k / F.col("__n")
        return F.when(k == F.col("__n"), F.col(end)).otherwise(inner)

    k = F.col("__k")
    corners = [at("x1", "x2", k), at("y1", "y2", k), at("x1", "x2", k + 1), at("y1", "y2", k + 1)]
    names = ["x1", "y1", "x2", "y2"]
    others = [c for c in edges.columns if c not in names]
    return cut.select(*others, *[c.alias(n) for c, n in zip(corners, names)])


def _box_cells(df: DataFrame, size: Column | float, prefix: str) -> DataFrame:
    """One row per grid cell that the box of a row covers, with its first cell."""
    cells = [F.floor(F.col(b) / size) for b in _BOX]
    return (
        df.withColumns({f"__{prefix}x": cells[0], f"__{prefix}y": cells[1]})
        .withColumn("__cx", F.explode(F.sequence(cells[0], cells[2])))
        .withColumn("__cy", F.explode(F.sequence(cells[1], cells[3])))
        .drop(*_BOX)
    )


def _in_cells(df: DataFrame, size: float | Column, prefix: str, grow: float | Column = 0.0) -> DataFrame:
    """Cells of points or edges. A long edge takes those along its course and keeps its own ends.

    The exact test later sees the whole edge, so cutting it for the cells costs no digits.
    """
    if "x1" not in df.columns:
        return _box_cells(with_box(df, grow), size, prefix)
    dx, dy = F.col("x2") - F.col("x1"), F.col("y2") - F.col("y1")
    n = F.greatest(F.lit(1.0), F.ceil(F.greatest(F.abs(dx), F.abs(dy)) / size))
    k = F.col("__k")
    pieces = df.withColumn("__n", n).withColumn("__k", F.explode(F.sequence(F.lit(0), (F.col("__n") - 1).cast("int"))))
    ax, ay = F.col("x1") + dx * k / F.col("__n"), F.col("y1") + dy * k / F.col("__n")
    bx, by = F.col("x1") + dx * (k + 1) / F.col("__n"), F.col("y1") + dy * (k + 1) / F.col("__n")
    slack = grow + 1e-6
    boxed = pieces.withColumns({
        "__bx1": F.least(ax, bx) - slack, "__by1": F.least(ay, by) - slack,
        "__bx2": F.greatest(ax, bx) + slack, "__by2": F.greatest(ay, by) + slack,
    }).drop("__n", "__k")
    return _box_cells(boxed, size, prefix)


def _first_shared_cell() -> Column:
    return (F.col("__cx") == F.greatest("__sx", "__fx")) & (F.col("__cy") == F.greatest("__sy", "__fy"))


def _cell_join(seg_cells: DataFrame, feat_cells: DataFrame, keys: list[str]) -> DataFrame:
    """Join on cells. Both sides are plain shuffles, so Spark splits a crowded cell at run time.

    The hint keeps the features out of a broadcast: Spark's estimate knows neither cells nor corners, and takes millions
    of them for a few megabytes, all of which the driver would hold.
    """
    return seg_cells.join(feat_cells.hint("merge"), keys).filter(_first_shared_cell()).drop(*keys, "__sx", "__sy", "__fx", "__fy")


def _merged_points(points: DataFrame, extra: Sequence[str]) -> DataFrame:
    return points.groupBy("x", "y", *extra).agg(F.count(F.lit(1)).alias("weight"))


def point_pairs(seg: DataFrame, points: DataFrame, d: float, extra: Sequence[str] = ()) -> DataFrame:
    """Segment and place pairs at a distance of at most ``d``: id, extra columns, weight, distance."""
    size = max(d, MIN_CELL)
    places = _in_cells(_merged_points(points, extra), size, "f", d)
    pieces = _in_cells(within_reach(seg.select("id", "x1", "y1", "x2", "y2"), points, d), size, "s")
    distance = point_segment_distance(*[F.col(c) for c in ("x", "y", "x1", "y1", "x2", "y2")])
    near = _cell_join(pieces, places, _CELLS).withColumn("distance", distance).filter(F.col("distance") <= d)
    return near.groupBy("id", "x", "y", *extra).agg(
        F.max("weight").alias("weight"), F.min("distance").alias("distance")
    )


def line_pairs(seg: DataFrame, lines: DataFrame, d: float, extra: Sequence[str] = ()) -> DataFrame:
    """Segment and line-feature pairs at a distance of at most ``d``: id, feature_id, extra, distance."""
    size = max(d, MIN_CELL)
    ends = ["x1", "y1", "x2", "y2"]
    edges = _in_cells(lines.select("feature_id", *extra, *ends), size, "f", d)
    edges = edges.withColumnsRenamed({c: f"f_{c}" for c in ends})
    pieces = _in_cells(within_reach(seg.select("id", *ends), lines, d), size, "s")
    a, b = tuple(F.col(c) for c in ends), tuple(F.col(f"f_{c}") for c in ends)
    pairs = _cell_join(pieces, edges, _CELLS)
    near = pairs.withColumn("distance", pieces_distance(a, b)).filter(F.col("distance") <= d)
    return near.groupBy("id", "feature_id", *extra).agg(F.min("distance").alias("distance"))


def _levels(polygons: DataFrame) -> DataFrame:
    """One row with the grid levels in use; at most one per power of two."""
    level = F.ceil(F.log2(F.greatest(F.col("__bx2") - F.col("__bx1"), F.col("__by2") - F.col("__by1"), F.lit(MIN_CELL)) / MIN_CELL))
    return polygons.withColumn("__level", level.cast("int"))


def _at_level(df: DataFrame, prefix: str) -> DataFrame:
    return _box_cells(df, MIN_CELL * F.pow(F.lit(2.0), F.col("__level")), prefix)


def _numbered(polygons: DataFrame, extra: Sequence[str] = ()) -> DataFrame:
    """Polygons with a key and a cell size of their own, as one feature may have several; equal rows count once."""
    key = F.xxhash64("feature_id", *extra, "parts")
    numbered = polygons.select(key.alias("__pid"), "feature_id", *extra, "parts").dropDuplicates(["__pid"])
    return numbered.withColumn("__size", cell_size(F.col("parts")))


def polygon_candidates(boxes: DataFrame, polygons: DataFrame) -> DataFrame:
    """Pairs whose boxes share a cell of the grid that fits the polygon's size; without the outlines.

    A polygon is kept in the few cells of its own level, however large it is; the
    other side is sent to the levels in use whose polygons it can meet at all.
    """
    leveled = _levels(with_box(polygons)).drop("parts")
    ends = [F.min("__bx1"), F.min("__by1"), F.max("__bx2"), F.max("__by2")]
    around = leveled.groupBy("__level").agg(*[e.alias(n) for e, n in zip(ends, _BOX)])
    used = around.agg(F.collect_list(F.struct("__level", *_BOX))).scalar()
    reached = boxes.withColumn("__used", F.explode(used)).filter(_meets(F.col("__used")))
    left = _at_level(reached.withColumn("__level", F.col("__used.__level")).drop("__used"), "s")
    kept = leveled.withColumns({f"__p{b[3:]}": F.col(b) for b in _BOX})
    pairs = _cell_join(left, _at_level(kept, "f"), ["__level", *_CELLS])
    # Most pairs of a cell do not even overlap in their boxes: drop those before the exact test.
    low_x, low_y, high_x, high_y = _box_columns(boxes)
    overlap = (
        (high_x >= F.col("__px1")) & (low_x <= F.col("__px2")) & (high_y >= F.col("__py1")) & (low_y <= F.col("__py2"))
    )
    return pairs.filter(overlap).drop("__px1", "__py1", "__px2", "__py2")


def polygon_pairs(seg: DataFrame, polygons: DataFrame, extra: Sequence[str] = ()) -> DataFrame:
    """Segment and polygon pairs that meet, with the length inside: id, feature_id, extra, length_inside.

    A piece meets the polygon's own cells along its course; each cell answers for the part of the way inside it.
    """
    areas = _numbered(polygons, extra)
    boxes = with_box(split_edges(seg.select("id", "x1", "y1", "x2", "y2"), LONG_EDGE))
    piece, edges = [F.col(c) for c in ("x1", "y1", "x2", "y2")], F.col("__edges")
    pairs = piece_cells(polygon_candidates(boxes, areas))
    local = pairs.join(area_cells(areas).hint("merge"), CELL)
    x1, y1 = piece[:2]
    first = (F.col("__cx") == F.floor(x1 / F.col("__size"))) & (F.col("__cy") == F.floor(y1 / F.col("__size")))
    length = length_inside(*piece, F.col("__stops"), inside_cell)
    found = local.withColumn("__stops", cut_stops(*piece, edges, F.col("__from"), F.col("__to"))).select(
        "id", "feature_id", *extra, ((first & inside_cell(x1, y1)) | piece_meets_border(*piece, edges)).alias("__met"),
        F.when(F.col("__from") < F.col("__to"), length).otherwise(0.0).alias("__inside"),
    )
    sums = found.groupBy("id", "feature_id", *extra).agg(F.max("__met").alias("__met"), F.sum("__inside").alias("length_inside"))
    return sums.filter("__met").drop("__met")


def start_point_in(starts: DataFrame, polygons: DataFrame, extra: Sequence[str] = ()) -> DataFrame:
    """Ids whose start point (x, y) lies in any polygon, with the polygon's ``extra`` columns."""
    areas = _numbered(polygons, extra)
    pairs = place_cells(polygon_candidates(with_box(starts.select("id", "x", "y")), areas))
    local = pairs.join(area_cells(areas).hint("merge"), CELL)
    return local.filter(inside_cell(F.col("x"), F.col("y"))).select("id", *extra).distinct()


def count_within(seg: DataFrame, points: DataFrame, d: float, extra: Sequence[str] = ()) -> DataFrame:
    """Number of points within ``d`` and the nearest of them, per segment; none gives no row."""
    return point_pairs(seg, points, d, extra).groupBy("id", *extra).agg(
        F.sum("weight").alias("near"), F.min("distance").alias("nearest")
    )


def count_crossing(seg: DataFrame, lines: DataFrame, extra: Sequence[str] = ()) -> DataFrame:
    """Number of line features that cross or touch each segment."""
    return line_pairs(seg, lines, 0.0, extra).groupBy("id", *extra).agg(F.count(F.lit(1)).alias("crossing"))


def nearest_distance(pairs: DataFrame) -> DataFrame:
    return pairs.groupBy("id").agg(F.min("distance").alias("nearest"))


def hydrants(seg: DataFrame, points: DataFrame, d: float = 25.0) -> DataFrame:
    return count_within(seg, points, d).select("id", F.col("near").alias("xhyd"), F.col("nearest").alias("xft2hyd"))


# Building layers and the columns they fill.
BUILDING_LAYERS = {"fire": "fire", "police": "pol", "hospital": "hosp", "school": "schl"}


def public_buildings(seg: DataFrame, points: DataFrame, d: float = 250.0) -> DataFrame:
    """Count and nearest distance of the four building layers, from one join over all of them."""
    found = point_pairs(seg, points.filter(F.col("layer").isin(*BUILDING_LAYERS)), d, ["layer"])
    aggs = []
    for layer, name in BUILDING_LAYERS.items():
        own = F.col("layer") == layer
        aggs.append(F.sum(F.when(own, F.col("weight"))).alias(f"x{name}"))
        aggs.append(F.min(F.when(own, F.col("distance"))).alias(f"xft2{name}"))
    return found.groupBy("id").agg(*aggs)


# Search distance in feet of each utility layer.
UTILITY_DISTANCES = {"gas": 10.0, "fiber": 10.0, "lrt": 25.0, "rail": 25.0, "emt": 50.0}


def utility_layers(seg: DataFrame, lines: DataFrame, distances: dict[str, float] = UTILITY_DISTANCES) -> DataFrame:
    """Crossing count, near count and nearest distance per utility layer, from one join over all layers."""
    found = line_pairs(seg, lines.filter(F.col("layer").isin(*distances)), max(distances.values()), ["layer"])
    aggs = []
    for name, d in distances.items():
        own = (F.col("layer") == name) & (F.col("distance") <= d)
        aggs.append(F.sum(F.when(own & (F.col("distance") == 0), 1)).alias(f"x{name}"))
        aggs.append(F.sum(F.when(own, 1)).alias(f"p{name}"))
        aggs.append(F.min(F.when(own, F.col("distance"))).alias(f"pft2{name}"))
    return found.groupBy("id").agg(*aggs)


def area_counts(seg: DataFrame, polygons: DataFrame, into: str) -> DataFrame:
    """Number of areas each segment meets, 0 if none."""
    counts = polygon_pairs(seg, polygons).groupBy("id").agg(F.count(F.lit(1)).alias(into))
    ids = seg.select("id").distinct()
    return ids.join(counts, "id", "left").fillna(0, [into])


def contaminated(seg: DataFrame, polygons: DataFrame) -> DataFrame:
    """Number of sites each segment meets and its length inside them."""
    return polygon_pairs(seg, polygons).groupBy("id").agg(
        F.count(F.lit(1)).alias("xecsi"), F.sum("length_inside").alias("xecsilen")
    )


def zones(seg: DataFrame, polygons: DataFrame, name: str) -> DataFrame:
    """Number of zones, length inside, and area (a line has none)."""
    return polygon_pairs(seg, polygons).groupBy("id").agg(
        F.count(F.lit(1)).alias(f"xezon{name}"), F.sum("length_inside").alias(f"xftezon{name}"),
        F.lit(0.0).alias(f"xezarea{name}"),
    )


# Area layers and what they fill: a count, the length inside, or a flag.
AREA_COUNTS = {"hard": "hardarea", "poverty": "poverty"}
AREA_ZONES = {"zone_c": "c", "zone_p": "p"}


def area_layers(seg: DataFrame, polygons: DataFrame) -> DataFrame:
    """Counts, lengths and flags of all area layers (column ``layer``), from one join over them.

    Counts of hard and poverty areas are 0 where none is met; the other columns stay NULL.
    """
    found = polygon_pairs(seg, polygons, ["layer"])
    own = lambda layer: F.col("layer") == layer
    number = lambda layer: F.sum(F.when(own(layer), 1))
    length = lambda layer: F.sum(F.when(own(layer), F.col("length_inside")))
    aggs = [number(layer).alias(name) for layer, name in AREA_COUNTS.items()]
    aggs += [number("contaminated").alias("xecsi"), length("contaminated").alias("xecsilen")]
    for layer, name in AREA_ZONES.items():
        aggs += [
            number(layer).alias(f"xezon{name}"), length(layer).alias(f"xftezon{name}"),
            F.max(F.when(own(layer), 0.0)).alias(f"xezarea{name}"),
        ]
    aggs.append(F.max(F.when(own("residential"), 1)).alias("xsfr"))
    sums = found.groupBy("id").agg(*aggs)
    return seg.select("id").distinct().join(sums, "id", "left").fillna(0, list(AREA_COUNTS.values()))


def residential(seg: DataFrame, polygons: DataFrame) -> DataFrame:
    return polygon_pairs(seg, polygons).select("id").distinct().withColumn("xsfr", F.lit(1))


def intersections(seg: DataFrame, points: DataFrame, d: float = 30.0) -> DataFrame:
    """Street legs at intersections nearby, and the nearest intersection."""
    found = point_pairs(seg, points, d, ["count_streets"])
    return found.groupBy("id").agg(
        F.sum(F.col("count_streets") * F.col("weight")).alias("uxclx"), F.min("distance").alias("uxft2clx")
    )


def street_class(seg: DataFrame, streets: DataFrame, names: DataFrame, d: float = 30.0) -> DataFrame:
    """Lowest street code nearby, its flag, class text and the distance to the nearest street."""
    found = line_pairs(seg, streets, d, ["value"]).groupBy("id").agg(
        F.min("value").alias("pstrttyp"), F.min("distance").alias("pft2strt")
    )
    coded = F.col("pstrttyp") > 0
    texts = names.groupBy("value").agg(F.min("type").alias("pstrttext")).withColumnRenamed("value", "pstrttyp")
    return found.join(texts, "pstrttyp", "left").select(
        "id", "pstrttyp", F.when(coded, 1).alias("pstrt"), F.when(coded, F.col("pstrttext")).alias("pstrttext"),
        F.when(coded, F.col("pft2strt")).alias("pft2strt"),
    )


# Street classes and the columns that count their crossings.
STREET_CROSSINGS = {"S": "xstrt", "A": "xart", "M": "xmjart", "F": "xfrwy"}


def street_crossings(seg: DataFrame, streets: DataFrame) -> DataFrame:
    """Street crossings by class in one aggregation; a class without a crossing stays NULL."""
    found = line_pairs(seg, streets, 0.0, ["type"])
    aggs = [F.sum(F.when(F.col("type") == t, 1)).alias(n) for t, n in STREET_CROSSINGS.items()]
    return found.groupBy("id").agg(*aggs).filter(F.coalesce(*STREET_CROSSINGS.values()).isNotNull())


def _six_measures(pairs: DataFrame, size: str, cross: str, size_prefix: str, near: str) -> DataFrame:
    touching, apart = F.col("distance") == 0, F.col("distance") > 0
    return pairs.groupBy("id").agg(
        F.sum(F.when(touching, 1)).alias(f"x{cross}"),
        F.max(F.when(touching, F.col(size))).alias(f"{size_prefix}maxd"),
        F.min(F.when(touching, F.col(size))).alias(f"{size_prefix}mind"),
        F.sum(F.when(apart, 1)).alias(f"p{cross}"),
        F.max(F.when(apart, F.col(size))).alias(f"p{near}maxd"),
        F.min(F.when(apart, F.col("distance"))).alias(f"pft2{near}"),
    )


def sewer_pairs(seg: DataFrame, nodes: DataFrame, sewers: DataFrame, d: float = 12.0) -> DataFrame:
    """Sewers nearby that do not meet the segment's pipe in a node.

    ``nodes`` gives (id, usnode, dsnode) of the segments.
    """
    found = line_pairs(seg, sewers, d, ["pipesize", "us_node", "ds_node"])
    own = nodes.select("id", F.col("usnode").alias("__us"), F.col("dsnode").alias("__ds"))
    joined = found.join(own, "id", "left")
    meets = shares_node(F.col("__us"), F.col("__ds"), F.col("us_node"), F.col("ds_node"))
    return joined.filter(~meets).drop("__us", "__ds")


def sewer_crossings(seg: DataFrame, nodes: DataFrame, sewers: DataFrame, d: float = 12.0) -> DataFrame:
    """Crossing and parallel sewers: counts, sizes and the nearest."""
    return _six_measures(sewer_pairs(seg, nodes, sewers, d), "pipesize", "sewer", "xswr", "swr")


def water_crossings(seg: DataFrame, mains: DataFrame, d: float = 12.0, abandoned: str = "ABN") -> DataFrame:
    """The same six measures for water mains in use; a main of unknown status does not count."""
    used = mains.filter(F.lower("status") != abandoned.lower())
    return _six_measures(line_pairs(seg, used, d, ["mainsize"]), "mainsize", "wtr", "xw", "wtr")


def buildings(seg: DataFrame, polygons: DataFrame) -> DataFrame:
    """Number of buildings a segment meets (0 if none) and the nearest of them: 0 where one is met."""
    counts = area_counts(seg, polygons, "xbldg")
    return counts.withColumn("xft2bldg", F.when(F.col("xbldg") > 0, 0.0))


def slopes(pipes: DataFrame) -> DataFrame:
    """Depths, ground slope and pipe slope from end elevations; no slope for a pipe without length."""
    length = F.nullif(F.col("length"), F.lit(0.0))
    ground = (F.col("frm_elev") + F.col("frm_depth")) - (F.col("to_elev") + F.col("to_depth"))
    return pipes.select(
        "id", F.col("frm_depth").alias("udepth"), F.col("to_depth").alias("ddepth"),
        (ground / length).alias("gslope"), ((F.col("frm_elev") - F.col("to_elev")) / length).alias("xpipslope"),
    )


def lateral_count(pipes: DataFrame, laterals: DataFrame, hot: HotKeys | None = None) -> DataFrame:
    """Laterals of the pipe on each of its rows; NULL if none."""
    counts = laterals.groupBy("compkey").agg(F.count(F.lit(1)).alias("lateralcount"))
    return attach(pipes.select("id", "compkey"), counts, "compkey", "left", hot)


# Columns of the wide result table.
WIDE_COLUMNS = """
id globalid us_node_id ds_node_id compkey
xwtr xwmind xwmaxd pwtr pwtrmaxd pft2wtr
xsewer xswrmind xswrmaxd psewer pswrmaxd pft2swr
xstrt xart xmjart xfrwy pstrt pstrttyp pstrttext pft2strt ptraffic
uxclx uxft2clx dxclx dxft2clx
xfiber pfiber pft2fiber xgas pgas pft2gas xrail prail pft2rail xlrt plrt pft2lrt xemt pemt pft2emt
xezonc xezonp xftezonc xftezonp xezareac xezareap
uxms4 uxuic udepth ddepth xpipslope gslope
xecsi xft2ecsi xecsilen xecsivol
xschl xft2schl xhosp xft2hosp xpol xft2pol xfire xft2fire
xbldg xft2bldg xhyd xft2hyd
hardarea length parentlength diamwidth height cutno poverty xsfr lateralcount
""".split()


def crossing_table(base: DataFrame, layers: list[DataFrame], columns: list[str] | None = None) -> DataFrame:
    """Wide table: one row per segment with the results of all layers.

    Every layer has one row per id, so Spark shuffles each by id once and no row is
    multiplied.
    """
    wide = reduce(lambda acc, layer: acc.join(layer, "id", "left"), layers, base)
    if columns is None:
        return wide
    known = set(wide.columns)
    return wide.select(*[F.col(c) if c in known else F.lit(None).cast("double").alias(c) for c in columns])
