"""The proximity run: all feature layers around all segments, one wide row per segment."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mainstay.operators import proximity as X
from mainstay.operators.layers import point_and_line_layers
from mainstay.operators.reach import may_match


@dataclass(frozen=True)
class Features:
    """Feature tables; a layer that is None leaves its columns NULL.

    ``points`` holds hydrants and public buildings, ``lines`` utilities, ``areas`` all area layers, each by ``layer``.
    ``starts_in`` maps a flag column (uxuic, uxms4) to the areas that set it.
    """

    hydrants: DataFrame | None = None
    points: DataFrame | None = None
    lines: DataFrame | None = None
    streets: DataFrame | None = None
    street_names: DataFrame | None = None
    intersections: DataFrame | None = None
    sewers: DataFrame | None = None
    mains: DataFrame | None = None
    areas: DataFrame | None = None
    starts_in: dict[str, DataFrame] | None = None
    elevations: DataFrame | None = None
    laterals: DataFrame | None = None


# Search distances in feet.
HYDRANT_FEET, BUILDING_FEET, INTERSECTION_FEET, STREET_FEET, PIPE_FEET = 25.0, 250.0, 30.0, 30.0, 12.0


def crossing_run(base: DataFrame, edges: DataFrame, f: Features) -> DataFrame:
    """One row per row of ``base`` with the 82 columns of the result table.

    ``base`` brings id, compkey, us_node_id, ds_node_id and what else of the table it has; ``edges`` the segments' ends
    (id, x1, y1, x2, y2). All point and line layers share one cell join, the areas a second and the start points a third; each
    result has one row per id.
    """
    nodes = base.select("id", F.col("us_node_id").alias("usnode"), F.col("ds_node_id").alias("dsnode"))
    near = point_and_line_layers(
        edges, nodes, f.hydrants, f.points, f.lines, f.streets, f.street_names, f.intersections, f.sewers, f.mains,
        HYDRANT_FEET, BUILDING_FEET, INTERSECTION_FEET, STREET_FEET, PIPE_FEET,
    )
    layers = [] if near is None else [near]
    if f.areas is not None:
        layers.append(X.area_layers(edges, f.areas))
    starts = edges.select("id", F.col("x1").alias("x"), F.col("y1").alias("y"))
    if f.starts_in:
        flagged = [areas.select("feature_id", "parts", F.lit(flag).alias("flag")) for flag, areas in f.starts_in.items()]
        inside = X.start_point_in(starts, reduce(DataFrame.unionByName, flagged), ["flag"])
        layers.append(inside.groupBy("id").agg(*[F.max(F.when(F.col("flag") == n, 1)).alias(n) for n in f.starts_in]))
    if f.elevations is not None:
        layers.append(X.slopes(f.elevations))
    if f.laterals is not None:
        # Rows of pipes without laterals have no count, as if they were not in the layer.
        layers.append(X.lateral_count(may_match(base, f.laterals, "compkey"), f.laterals).drop("compkey"))
    return X.crossing_table(base, layers, X.WIDE_COLUMNS)
