"""Hot keys: same results with and without splitting, and the plans that do it."""

from pyspark.sql import functions as F

from mainstay.operators import tables as T
from mainstay.operators.skew import attach, hot_keys


def skewed(spark, n=6000):
    key = F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id") % 500).cast("long")
    return spark.range(n).select("id", key.alias("compkey"), (F.col("id") % 50).alias("day"))


def test_hot_keys_are_found_and_bounded(spark):
    hot = hot_keys(skewed(spark), ["compkey"], parts=60)
    rows = [r.asDict() for r in hot.table.collect()]
    assert [r["compkey"] for r in rows] == [7]
    assert rows[0]["__salts"] >= 20
    assert hot_keys(skewed(spark).filter("compkey <> 7"), ["compkey"], parts=60).table.count() == 0
    # However fine the parts, there are fewer hot keys than parts.
    assert hot_keys(skewed(spark), ["compkey"], parts=400).table.count() < 400


def test_attach_gives_the_same_rows(spark):
    rows = skewed(spark)
    other = spark.range(0, 500, 7).select(F.col("id").alias("compkey"), (F.col("id") * 2).alias("v"))
    for parts in (60, 100_000):
        hot = hot_keys(rows, ["compkey"], parts=parts)
        for how in ("left", "inner", "left_semi", "left_anti"):
            plain = sorted(map(str, rows.join(other, ["compkey"], how).collect()))
            assert sorted(map(str, attach(rows, other, "compkey", how, hot).collect())) == plain


def test_salted_join_spreads_the_hot_key(spark):
    from mainstay.operators.skew import salt_rows

    hot = hot_keys(skewed(spark), ["compkey"], parts=60)
    salts = salt_rows(skewed(spark), hot).filter("compkey = 7").select("__salt").distinct().count()
    assert salts >= 15
    equal = spark.range(0, 6000, 1, 8).select(F.lit(7).cast("long").alias("compkey"))
    spread = salt_rows(equal, hot_keys(equal, ["compkey"], parts=60)).select("__salt").distinct().count()
    assert spread >= 4


def test_rows_at_max_agrees_in_all_forms(spark):
    rows = skewed(spark).withColumn("day", F.when(F.col("compkey") == 3, None).otherwise(F.col("day")))
    hot = hot_keys(rows, ["compkey"], parts=100_000)
    for keep in (False, True):
        results = [sorted(r.id for r in T.rows_at_max(rows, ["compkey"], "day", h, keep).collect()) for h in (None, hot)]
        assert results[0] == results[1]
        assert any(r in results[0] for r in (3, 503)) == keep


def test_building_a_query_starts_no_job(spark):
    import __spark_entry__ as entry

    tracker, sc = spark.sparkContext.statusTracker(), spark.sparkContext
    for name in ("d4_latest_observations", "d7_apply_scores", "k19_direct_cost", "x2_count_within", "x9_contaminated"):
        sc.setJobGroup(f"build-{name}", name)
        entry.queries()[name](spark, "/root/testdata/sf0.001")
        assert not tracker.getJobIdsForGroup(f"build-{name}"), name
    sc.setLocalProperty("spark.jobGroup.id", None)


def test_give_to_only_serves_takers(spark):
    rows = spark.createDataFrame([(1, 5, 0), (2, 5, 1), (3, 5, 2), (4, 6, 0)], "id long, compkey long, cutno int")
    values = spark.createDataFrame([(5, 9.0)], "compkey long, v double")
    found = {r.id: r.v for r in T.give_to(rows, values, F.col("cutno") == 1).collect()}
    assert found == {1: None, 2: 9.0, 3: None, 4: None}
    # Negative keys can't meet the rows that take nothing.
    below = spark.createDataFrame([(-2, 7.0), (-3, 8.0)], "compkey long, v double")
    assert {r.v for r in T.give_to(rows, below, F.col("cutno") == 1).collect()} == {None}


def test_accumulated_layers_add_in_any_order(spark):
    base = spark.range(4)
    layers = [spark.createDataFrame(r, "id long, consequence double") for r in ([(0, 1.5), (0, 2.0)], [(1, 4.0)], [(0, 8.0)])]
    one = {r.id: r.cost for r in T.accumulate_layers(base, layers).collect()}
    two = {r.id: r.cost for r in T.accumulate_layers(base, layers[::-1]).collect()}
    assert one == two == {0: 11.5, 1: 4.0, 2: None, 3: None}


def test_no_nested_loop_but_for_one_row_tables(spark):
    import __spark_entry__ as entry

    for name in ("d6_linear_defect_scores", "d19_stamp_material", "x16_sewer_crossings", "k19_direct_cost"):
        plan = entry.queries()[name](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
        assert "CartesianProduct" not in plan and "NestedLoop" not in plan
        assert "PythonUDF" not in plan and "ArrowEval" not in plan
