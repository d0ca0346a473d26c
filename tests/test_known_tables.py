"""Short rate tables as trees give what the arrays give; the filter by key never drops a partner."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from mainstay.checks.registry_run import RULES, inputs
from mainstay.checks.views import Inputs
from mainstay.operators import decision as D
from mainstay.operators.lookups import KNOWN_ROWS, Known, ceiling_lookup, floor_lookup, known
from mainstay.operators.reach import may_match
from mainstay.operators.tables import carried, unpacked
from mainstay.plans.full_run import run_all
from mainstay.session import cut_lineage


def _rows(df):
    return sorted(map(str, df.collect()))


@pytest.mark.parametrize("bounds", [[], [4.0], [4.0, 8.0, 8.0, 12.0, None, 20.0], [float("nan"), 3.0]])
def test_trees_and_arrays_agree_with_one_bound(spark, bounds):
    table = spark.createDataFrame([(b, None if i == 1 else i * 10.0, f"r{i}") for i, b in enumerate(bounds)], "bound double, price double, name string")
    values = spark.createDataFrame([(x,) for x in (None, -1.0, 3.9, 4.0, 4.1, 8.0, 11.0, 12.0, 20.0, 21.0, float("nan"))], "v double")
    tree = known(table)
    assert isinstance(tree, Known)
    outs = {"price": "p", "name": "n"}
    for defaults in (None, {"price": -5.0}):
        assert _rows(ceiling_lookup(values, "v", tree, "bound", outs, defaults)) == _rows(ceiling_lookup(values, "v", table, "bound", outs, defaults))
        for strict in (True, False):
            found, plain = (_rows(floor_lookup(values, ["v"], t, ["bound"], outs, defaults, strict)) for t in (tree, table))
            assert found == plain


def test_trees_and_arrays_agree_with_two_bounds(spark):
    rows = [(6, 0.0, 1.0), (6, 10.0, 1.2), (6, 20.0, 1.5), (24, 5.0, 1.1), (24, 15.0, 1.6), (42, 10.0, 2.0), (42, None, 9.0), (None, 1.0, 8.0)]
    table = spark.createDataFrame(rows, "size int, depth double, factor double")
    grid = [(a, b) for a in (None, 5, 6, 23, 24, 41, 42, 99) for b in (None, -1.0, 0.0, 4.0, 5.0, 9.0, 10.0, 15.0, 30.0)]
    values = spark.createDataFrame(grid, "a int, b double")
    for strict in (True, False):
        found, plain = (
            _rows(floor_lookup(values, ["a", "b"], t, ["size", "depth"], {"factor": "f"}, {"factor": 0.0}, strict)) for t in (known(table), table)
        )
        assert found == plain


def test_long_tables_stay_tables(spark):
    table = spark.range(KNOWN_ROWS + 1).select(F.col("id").cast("double").alias("bound"), F.lit(1.0).alias("price"))
    assert known(table) is table


def test_a_run_looks_short_tables_up_in_compiled_code(spark):
    plans = {}

    def cut(df):
        plans[tuple(df.columns)] = df._jdf.queryExecution().optimizedPlan().toString()
        return cut_lineage(df)

    run_all(inputs(Inputs(spark, "/root/testdata/sf0.001")), dt.date(2024, 1, 20), RULES, cut)
    jobs = [p for names, p in plans.items() if "capitalnonmobilization" in names and "basetime" in names]
    sites = [p for names, p in plans.items() if "trench_width" in names]
    assert jobs and sites and not any("lambdafunction" in p for p in jobs + sites)


def test_filter_by_key_keeps_every_partner(spark):
    rows = spark.range(5000).selectExpr("CAST(IF(id = 7, NULL, id) AS INT) AS compkey", "id")
    few = spark.createDataFrame([(3,), (4999,), (None,), (70000,)], "compkey long")
    kept = may_match(rows, few, "compkey")
    assert {3, 4999} <= {r.compkey for r in kept.collect()} and kept.count() < 50
    assert may_match(rows, few.limit(0), "compkey").count() == 0
    texts = rows.selectExpr("CAST(compkey AS STRING) AS compkey", "id")
    assert may_match(texts, few, "compkey").count() == 4999
    assert rows.join(few, "compkey").count() == kept.join(few, "compkey").count() == 2


def test_carried_columns_come_back(spark):
    df = spark.createDataFrame([(1, "a", None, 2.0), (2, None, 5, None)], "id long, t string, k int, v double")
    assert unpacked(carried(df, ["id", "v"]), df.columns).collect() == df.collect()


def test_consequence_of_segments_is_not_shuffled_again(spark):
    v = Inputs(spark, "/root/testdata/sf0.001")
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = D.restate_consequence(v("done"))._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    assert "__spread" not in plan
