"""A subset run renews its own pipes in the standing table and nothing else."""

import os

import pytest
from pyspark.sql import functions as F

from mainstay.sources import standing as S

SCHEMA = "id long, compkey long, score double"
WHOLE = "id < 1000"


def table(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def content(spark, path):
    return sorted((tuple(r) for r in S.read_standing(spark, path).select("id", "compkey", "score").collect()), key=str)


def files(path):
    return {os.path.join(folder, f): os.stat(os.path.join(folder, f)).st_mtime_ns for folder, _, names in os.walk(path) for f in names if f.endswith(".parquet")}


@pytest.fixture
def standing(spark, tmp_path):
    path = f"{tmp_path}/out"
    rows = [(k, k, 1.0) for k in range(1, 41)] + [(1000 * k + c, k, 2.0) for k in range(1, 41) for c in (1, 2)] + [(999, None, 3.0)]
    S.publish(table(spark, rows), path, WHOLE, buckets=8)
    return path, rows


def test_only_the_pipes_of_the_subset_change(spark, standing):
    path, rows = standing
    before = files(path)
    new = table(spark, [(7, 7, 9.0), (7001, 7, 9.0), (8, 8, 9.0)])  # 7002 is gone; pipe 8 isn't in the subset
    S.renew(new, spark.createDataFrame([(7,), (7,), (None,)], "compkey long"), path, WHOLE)
    expected = [r for r in rows if r[1] != 7] + [(7, 7, 9.0), (7001, 7, 9.0)]
    assert content(spark, path) == sorted(expected, key=str)
    after = files(path)
    untouched = {f for f in before if before[f] == after.get(f)}
    folders = {os.path.dirname(f) for f in set(before) - untouched}
    assert len({f.rsplit("=", 1)[1] for f in folders}) == 1  # one bucket of pipes was written again


def test_pipes_without_rows_leave_and_new_pipes_come(spark, standing):
    path, rows = standing
    every = spark.createDataFrame([(k,) for k in range(1, 41)], "compkey long")
    S.renew(table(spark, []), every, path, WHOLE)
    assert content(spark, path) == [(999, None, 3.0)]
    S.renew(table(spark, [(50, 50, 5.0)]), spark.createDataFrame([(50,)], "compkey long"), path, WHOLE)
    assert content(spark, path) == sorted([(999, None, 3.0), (50, 50, 5.0)], key=str)


def test_empty_subset_and_empty_table(spark, standing, tmp_path):
    path, rows = standing
    none = spark.createDataFrame([], "compkey long")
    S.renew(table(spark, [(1, 1, 0.0)]), none, path, WHOLE)
    assert content(spark, path) == sorted(rows, key=str)
    empty = f"{tmp_path}/empty"
    S.publish(table(spark, []), empty, WHOLE)
    assert S.read_standing(spark, empty, table(spark, []).schema).count() == 0
    S.renew(table(spark, [(1, 1, 0.0)]), spark.createDataFrame([(1,)], "compkey int"), empty, WHOLE)
    assert content(spark, empty) == [(1, 1, 0.0)]


def test_clashing_columns_are_refused(spark, tmp_path):
    with pytest.raises(ValueError, match="pipe_bucket"):
        S.publish(table(spark, []).withColumn("pipe_bucket", F.lit(1)), f"{tmp_path}/x", WHOLE)
