"""The steps of a full run: none plans the chain before it again, and the short ways give what the long ones do."""

import datetime as dt

from pyspark.sql import functions as F

from mainstay.checks.registry_run import RULES, inputs
from mainstay.checks.views import Inputs
from mainstay.operators import condition as C
from mainstay.operators import tables as T
from mainstay.operators.intervals import overlap_join
from mainstay.operators.skew import attach, hot_keys, settled
from mainstay.plans.full_run import run_all
from mainstay.session import cut_lineage


def test_no_step_of_a_run_plans_the_chain_before_it_again(spark):
    joins = []

    def cut(df):
        joins.append(df._jdf.queryExecution().optimizedPlan().toString().count("Join "))
        return cut_lineage(df)

    run_all(inputs(Inputs(spark, "/root/testdata/sf0.001")), dt.date(2024, 1, 20), RULES, cut)
    assert max(joins) <= 40, joins


def test_settled_hot_keys_join_alike(spark):
    few = spark.createDataFrame([(k % 50, k) for k in range(500)], "compkey long, id long")
    crowded = few.unionByName(spark.range(1000, 2000).select(F.lit(7).cast("long").alias("compkey"), "id"))
    none = settled(hot_keys(few, ["compkey"], parts=20), cut_lineage)
    some = settled(hot_keys(crowded, ["compkey"], parts=20), cut_lineage, none)
    assert none.table is None and [r.compkey for r in some.table.collect()] == [7]
    values = spark.createDataFrame([(k, float(k)) for k in range(40)], "compkey long, v double")
    for rows, hot in ((few, none), (crowded, some)):
        found, plain = (sorted(map(str, attach(rows, values, "compkey", "left", h).collect())) for h in (hot, None))
        assert found == plain
    seg = few.selectExpr("id", "compkey", "id * 1.0D AS fm", "id + 5.0D AS to_")
    spans = crowded.selectExpr("compkey", "id * 1.0D AS distfrom", "id + 60.0D AS distto")
    found, plain = (sorted(map(str, overlap_join(seg, spans, hot=h).collect())) for h in (some, None))
    assert found == plain and found


def test_give_to_of_the_takers_alone(spark):
    rows = spark.createDataFrame([(1, 5, 0), (2, 5, 1), (3, 5, 2), (4, 6, 1), (5, None, 1), (6, 5, None)], "id long, compkey long, cutno int")
    values = spark.createDataFrame([(5, 9.0)], "compkey long, v double")
    split, joined = (sorted(map(str, T.give_to(rows, values, F.col("cutno") == 1, split=s).collect())) for s in (True, False))
    assert split == joined and "v=9.0" in split[1]


def test_segments_without_a_band_may_stay(spark):
    seg = spark.createDataFrame([(1, "a", 50.0), (2, "A", 500.0), (3, "x", 50.0), (4, None, 50.0)], "id long, material string, total_score double")
    crosswalk = spark.createDataFrame([("a", "k")], "category string, curve string")
    bands = spark.createDataFrame([("k", 0.0, 100.0, 7.5)], "curve string, score_lower_bound double, score_upper_bound double, yearstofailure double")
    assert {r.id: r.years for r in C.remaining_years(seg, crosswalk, bands).collect()} == {1: 7}
    assert {r.id: r.years for r in C.remaining_years(seg, crosswalk, bands, keep=True).collect()} == {1: 7, 2: None, 3: None, 4: None}
