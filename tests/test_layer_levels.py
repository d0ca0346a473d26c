"""Features of all distances and lengths share one join without many rows for the far or long ones."""

import random
import re

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from mainstay.operators import layers as Y
from mainstay.operators import proximity as X

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def shapes(spark):
    r = random.Random(5)

    def place():
        return r.uniform(-1500, 1500), r.uniform(-1500, 1500)

    ends = "x1 double, y1 double, x2 double, y2 double"
    seg = [(i, x, y, x + r.uniform(-400, 400), y + r.uniform(-60, 60)) for i in range(80) for x, y in [place()]]
    long = [(i, x, y, x + dx, y + dy) for i, (dx, dy) in enumerate([(0, 0), (30, 90), (380, -20), (0, 399), (401, 0), (2900, -2600)] * 10) for x, y in [place()]]
    points = [place() for _ in range(120)]
    return (
        spark.createDataFrame(seg, f"id long, {ends}"), spark.createDataFrame(long, f"feature_id long, {ends}"),
        spark.createDataFrame(points + points[:9], "x double, y double"),
    )


def test_pairs_are_those_of_the_single_layers(shapes):
    seg, lines, points = shapes
    near = {"a": 250.0, "b": 25.0}
    beside = {"c": 0.0, "d": 50.0, "e": 700.0}
    layers = [Y.point_layer(points, n, d) for n, d in near.items()] + [Y.line_layer(lines, n, d) for n, d in beside.items()]
    found = Y.near_features(seg, layers).select("layer", "id", "x", "y", "feature_id", "weight", F.round("distance", 6))
    for name, d in near.items():
        plain = X.point_pairs(seg, points, d).select("id", "x", "y", "weight", F.round("distance", 6))
        mine = found.filter(F.col("layer") == name).drop("layer", "feature_id")
        assert sorted(map(tuple, mine.collect())) == sorted(map(tuple, plain.collect())) and plain.count()
    for name, d in beside.items():
        plain = X.line_pairs(seg, lines, d).select("id", F.col("feature_id").cast("string"), F.round("distance", 6))
        mine = found.filter(F.col("layer") == name).select("id", "feature_id", "round(distance, 6)")
        assert sorted(map(tuple, mine.collect())) == sorted(map(tuple, plain.collect())) and plain.count()


def test_a_far_or_long_feature_makes_few_rows(shapes, spark, monkeypatch):
    seg, _, _ = shapes
    made = []
    join = X._cell_join
    monkeypatch.setattr(X, "_cell_join", lambda a, b, keys: made.append(b) or join(a, b, keys))
    far = spark.createDataFrame([(7.0, 9.0)], "x double, y double")
    line = spark.createDataFrame([(1, 5.0, 5.0, 85.0, 305.0)], "feature_id long, x1 double, y1 double, x2 double, y2 double")
    Y.near_features(seg, [Y.point_layer(far, "a", 250.0)])
    Y.near_features(seg, [Y.line_layer(line, "b", 10.0)])
    assert [df.count() <= 4 for df in made] == [True, True]


def test_the_crossing_table_scans_the_lines_of_orders_once(spark):
    # The segments are written while the query is built; what is left reads the copy, and nothing joins the base to itself.
    plan = entry.queries()["x21_crossing_table"](spark, FOLDER)._jdf.queryExecution().optimizedPlan().toString()
    assert not re.findall(r"Relation \[l_orderkey", plan)
