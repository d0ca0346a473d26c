"""All point and line layers around all segments, by one join.

Every feature brings its layer and its own search distance, and is put into the cells that its box, grown by that
distance, covers; a segment is put into the cells of its own box once, for all layers. What is found is brought
together by segment once: repeated pairs are merged and all measures are aggregated where the rows are.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mainstay.functions.geometry import pieces_distance, point_segment_distance
from mainstay.operators import proximity as X
from mainstay.operators.lookups import code_map
from mainstay.operators.reach import may_match
from mainstay.operators.tables import shares_node

_ENDS = ["x1", "y1", "x2", "y2"]
# What tells features of a layer apart, and what their measures read. A point has its place, a line its number.
_FEATURE = ["layer", "feature_id", "x", "y", "label", "value", "us_node", "ds_node"]
_LEVEL = "__level"
LONG_FEATURE = 400.0
_ATTRIBUTES = {"label": "string", "value": "double", "us_node": "string", "ds_node": "string"}


def _attributes(given: dict[str, str]) -> list[Column]:
    return [(F.col(given[n]) if n in given else F.lit(None)).cast(kind).alias(n) for n, kind in _ATTRIBUTES.items()]


def point_layer(points: DataFrame, layer: str, d: float, **attributes: str) -> DataFrame:
    """Points of a layer; those of one place and equal attributes are one row with a weight."""
    named = points.select("x", "y", *_attributes(attributes)).groupBy("x", "y", *_ATTRIBUTES).agg(F.count(F.lit(1)).alias("weight"))
    ends = [F.col(c).alias(n) for c, n in zip(("x", "y", "x", "y"), _ENDS)]
    return named.select(
        F.lit(layer).alias("layer"), F.lit(None).cast("string").alias("feature_id"), "x", "y", *_ATTRIBUTES, *ends,
        F.lit(float(d)).alias("d"), "weight",
    )


def line_layer(lines: DataFrame, layer: str, d: float | Column, **attributes: str) -> DataFrame:
    """Edges of the line features of a layer."""
    place = [F.lit(None).cast("double").alias(n) for n in ("x", "y")]
    distance = (d if isinstance(d, Column) else F.lit(float(d))).alias("d")
    return lines.select(
        F.lit(layer).alias("layer"), F.col("feature_id").cast("string").alias("feature_id"), *place, *_attributes(attributes),
        *[F.col(c).cast("double").alias(c) for c in _ENDS], distance, F.lit(1).cast("long").alias("weight"),
    )


def _level() -> Column:
    """The lowest level whose cells, ``MIN_CELL`` doubled so often, are at least as wide as the distance and the feature.

    A feature that is longer than ``LONG_FEATURE`` counts as so long: it is put into cells piece by piece.
    """
    extent = F.greatest(F.abs(F.col("x2") - F.col("x1")), F.abs(F.col("y2") - F.col("y1")))
    wide = F.greatest(F.col("d"), F.least(extent, F.lit(LONG_FEATURE)), F.lit(X.MIN_CELL))
    return F.ceil(F.log2(wide / X.MIN_CELL)).cast("int")


def _boxes_meet() -> Column:
    """Whether the boxes of segment and feature come within the distance, and a little more: a cheap test before the exact one."""
    far = F.col("d") + 1e-6 * (F.lit(1.0) + F.abs("f_x1") + F.abs("f_y1"))
    return reduce(lambda a, b: a & b, [
        (F.least(f"f_{c}1", f"f_{c}2") - far <= F.greatest(f"{c}1", f"{c}2"))
        & (F.greatest(f"f_{c}1", f"f_{c}2") + far >= F.least(f"{c}1", f"{c}2"))
        for c in ("x", "y")
    ])


def in_reach(seg: DataFrame, layers: Sequence[DataFrame]) -> DataFrame:
    """Segments that may be near any feature of the layers."""
    return X.within_reach(seg.select("id", *_ENDS), reduce(DataFrame.unionByName, layers), F.col("d"))


def near_features(seg: DataFrame, layers: Sequence[DataFrame]) -> DataFrame:
    """Pairs of segment and feature within the feature's distance, each once: id, the feature's columns, weight, distance.

    A feature lies on the level whose cells are about as wide as its distance and its own box, so neither makes many rows of it;
    segments come to the levels in use. The rows come partitioned by id.
    """
    features = reduce(DataFrame.unionByName, layers).withColumn(_LEVEL, _level())
    levels = features.agg(F.sort_array(F.collect_set(_LEVEL))).scalar()
    width = X.MIN_CELL * F.pow(F.lit(2.0), F.col(_LEVEL))
    cells = X._in_cells(features, width, "f", F.col("d")).withColumnsRenamed({c: f"f_{c}" for c in _ENDS})
    reached = in_reach(seg, layers).withColumn(_LEVEL, F.explode(levels))
    pieces = X._in_cells(reached, width, "s")
    ends, other = tuple(F.col(c) for c in _ENDS), tuple(F.col(f"f_{c}") for c in _ENDS)
    distance = F.when(F.col("x").isNotNull(), point_segment_distance(F.col("x"), F.col("y"), *ends)).otherwise(
        pieces_distance(ends, other)
    )
    candidates = X._cell_join(pieces, cells, [_LEVEL, *X._CELLS]).filter(_boxes_meet())
    near = candidates.withColumn("distance", distance).filter(F.col("distance") <= F.col("d"))
    pairs = near.select("id", *_FEATURE, "weight", "distance").repartition("id")
    return pairs.groupBy("id", *_FEATURE).agg(F.max("weight").alias("weight"), F.min("distance").alias("distance"))


def _of(layer: str, value: Column | str, extra: Column | None = None) -> Column:
    own = F.col("layer") == layer
    return F.when(own if extra is None else own & extra, F.col(value) if isinstance(value, str) else value)


def _six(layer: str, kind: str, cross: str, size_prefix: str, near: str) -> list[Column]:
    """Counts, sizes and the nearest of the features that touch a segment and of those beside it."""
    size, touching, apart = F.col("value").cast(kind), F.col("distance") == 0, F.col("distance") > 0
    return [
        F.sum(_of(layer, F.lit(1), touching)).alias(f"x{cross}"), F.max(_of(layer, size, touching)).alias(f"{size_prefix}maxd"),
        F.min(_of(layer, size, touching)).alias(f"{size_prefix}mind"), F.sum(_of(layer, F.lit(1), apart)).alias(f"p{cross}"),
        F.max(_of(layer, size, apart)).alias(f"p{near}maxd"), F.min(_of(layer, "distance", apart)).alias(f"pft2{near}"),
    ]


def point_and_line_layers(
    seg: DataFrame, nodes: DataFrame | None = None, hydrants: DataFrame | None = None, points: DataFrame | None = None,
    lines: DataFrame | None = None, streets: DataFrame | None = None, street_names: DataFrame | None = None,
    intersections: DataFrame | None = None, sewers: DataFrame | None = None, mains: DataFrame | None = None,
    hydrant_feet: float = 25.0, building_feet: float = 250.0, intersection_feet: float = 30.0, street_feet: float = 30.0,
    pipe_feet: float = 12.0,
) -> DataFrame | None:
    """Measures of all given layers, one row per segment that has any; None without layers.

    The measures are those of the functions for single layers in ``proximity``.
    """
    layers: list[DataFrame] = []
    aggs: list[Column] = []
    if hydrants is not None:
        layers.append(point_layer(hydrants, "hydrant", hydrant_feet))
        aggs += [F.sum(_of("hydrant", "weight")).alias("xhyd"), F.min(_of("hydrant", "distance")).alias("xft2hyd")]
    if points is not None:
        public = points.filter(F.col("layer").isin(*X.BUILDING_LAYERS))
        layers.append(point_layer(public, "building", building_feet, label="layer"))
        for label, name in X.BUILDING_LAYERS.items():
            own = F.col("label") == label
            aggs += [F.sum(_of("building", "weight", own)).alias(f"x{name}"), F.min(_of("building", "distance", own)).alias(f"xft2{name}")]
    if lines is not None:
        feet = F.element_at(F.create_map(*[F.lit(v) for pair in X.UTILITY_DISTANCES.items() for v in pair]), F.col("layer"))
        layers.append(line_layer(lines.filter(F.col("layer").isin(*X.UTILITY_DISTANCES)), "utility", feet, label="layer"))
        for name in X.UTILITY_DISTANCES:
            own = F.col("label") == name
            aggs += [
                F.sum(_of("utility", F.lit(1), own & (F.col("distance") == 0))).alias(f"x{name}"),
                F.sum(_of("utility", F.lit(1), own)).alias(f"p{name}"), F.min(_of("utility", "distance", own)).alias(f"pft2{name}"),
            ]
    if streets is not None:
        layers.append(line_layer(streets, "crossing", 0.0, label="type"))
        aggs += [F.sum(_of("crossing", F.lit(1), F.col("label") == t)).alias(n) for t, n in X.STREET_CROSSINGS.items()]
    if streets is not None and street_names is not None:
        layers.append(line_layer(streets, "street", street_feet, value="value"))
        code = F.min(_of("street", F.col("value").cast(streets.schema["value"].dataType)))
        aggs += [code.alias("pstrttyp"), F.min(_of("street", "distance")).alias("pft2strt")]
    if intersections is not None:
        layers.append(point_layer(intersections, "intersection", intersection_feet, value="count_streets"))
        legs = F.col("value").cast(intersections.schema["count_streets"].dataType) * F.col("weight")
        aggs += [F.sum(_of("intersection", legs)).alias("uxclx"), F.min(_of("intersection", "distance")).alias("uxft2clx")]
    if sewers is not None:
        layers.append(line_layer(sewers, "sewer", pipe_feet, value="pipesize", us_node="us_node", ds_node="ds_node"))
        aggs += _six("sewer", sewers.schema["pipesize"].dataType.simpleString(), "sewer", "xswr", "swr")
    if mains is not None:
        used = mains.filter(F.lower("status") != "abn")
        layers.append(line_layer(used, "main", pipe_feet, value="mainsize"))
        aggs += _six("main", mains.schema["mainsize"].dataType.simpleString(), "wtr", "xw", "wtr")
    if not layers:
        return None
    pairs = near_features(seg, layers)
    if sewers is not None:
        # Nodes of segments that no feature is near aren't shuffled.
        reached = may_match(nodes, in_reach(seg, layers), "id")
        own = reached.select("id", F.col("usnode").alias("__us"), F.col("dsnode").alias("__ds"))
        meets = shares_node(F.col("__us"), F.col("__ds"), F.col("us_node"), F.col("ds_node"))
        pairs = pairs.join(own, "id", "left").filter((F.col("layer") != "sewer") | ~meets).drop("__us", "__ds")
    found = pairs.groupBy("id").agg(*aggs)
    if streets is None or street_names is None:
        return found
    names = code_map(street_names.groupBy("value").agg(F.min("type").alias("type")), "value", "type")
    coded = F.col("pstrttyp") > 0
    return found.withColumn("__names", names).select(
        *[c for c in found.columns if c != "pft2strt"], F.when(coded, 1).alias("pstrt"),
        F.when(coded, F.try_element_at("__names", "pstrttyp")).alias("pstrttext"), F.when(coded, F.col("pft2strt")).alias("pft2strt"),
    )
