"""Sources, the risk table and the full run on the smallest test data."""

import dataclasses
import datetime as dt
import math

import pytest
from pyspark.sql import functions as F

from mainstay.checks.registry_run import RULES, inputs
from mainstay.checks.views import Inputs
from mainstay.functions.scalar import normal_cdf
from mainstay.operators import decision as D
from mainstay.operators import lifespan as L
from mainstay.plans.full_run import run_all
from mainstay.sources import tables as S


def test_round_trip_and_csv(spark, tmp_path):
    df = spark.createDataFrame([(1, 2.0), (2, None)], "obsevkey long, peak_score double")
    S.write_table(df, str(tmp_path / "peak"))
    S.write_table(df, str(tmp_path / "peak"))
    back = S.read_table(spark, str(tmp_path / "peak"), "peak_score")
    assert sorted(map(str, back.collect())) == sorted(map(str, df.collect()))
    S.export_csv(df, str(tmp_path / "csv"))
    assert spark.read.option("header", True).csv(str(tmp_path / "csv")).columns == ["obsevkey", "peak_score"]


def test_missing_column_is_an_error(spark):
    with pytest.raises(ValueError, match="peak_score"):
        S.conform(spark.range(1).toDF("OBSEVKEY"), "peak_score")


def test_columns_are_found_without_case_and_cast(spark):
    df = S.conform(spark.createDataFrame([("7", 3)], "OBSEVKEY string, Peak_Score int"), "peak_score")
    assert df.first().asDict() == {"obsevkey": 7, "peak_score": 3.0}


def test_scan_reads_only_declared_columns(spark, tmp_path):
    df = spark.range(5).selectExpr("id AS obsevkey", "1.0D AS peak_score", "'x' AS other")
    S.write_table(df, str(tmp_path / "t"))
    plan = S.read_table(spark, str(tmp_path / "t"), "peak_score").filter("obsevkey > 3")._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<obsevkey:bigint,peak_score:double>" in plan
    assert "PushedFilters: [IsNotNull(obsevkey), GreaterThan(obsevkey,3)]" in plan


def test_normal_cdf_keeps_the_tails(spark):
    xs = [-12.0, -7.5, -3.0, -0.1, 0.0, 0.1, 2.0, 6.9, 7.2]
    df = spark.createDataFrame([(x,) for x in xs], "x double").select("x", normal_cdf("x", F.lit(0.0), F.lit(1.0)).alias("p"))
    for r in df.collect():
        # Beyond 7.07 the published form holds nine digits of a tail below 1e-12.
        digits = 1e-12 if abs(r.x) < 7.07 else 1e-8
        assert r.p == pytest.approx(0.5 * math.erfc(-r.x / math.sqrt(2)), rel=digits, abs=1e-300)


def test_risk_table_size_and_range(spark):
    risk = L.risk_multiplier(spark, 2016).cache()
    assert risk.count() == 14_100
    assert risk.filter("unit_multiplier <= 0 OR unit_multiplier > 1 + 1e-12").count() == 0
    row = risk.filter("failure_year = 2030 AND std_dev = 5").first()

    def cdf(x):
        return 0.5 * math.erfc(-(x - 2030) / 5 / math.sqrt(2))

    expected = sum(1.025 ** -(y - 2016) * (cdf(y + 1) - cdf(y)) for y in range(2016, 2257)) / (1 - cdf(2016))
    assert row.unit_multiplier == pytest.approx(expected, rel=1e-9)
    probe = spark.createDataFrame([(2030, 5.0), (2030, 7.35), (1974, 5.0), (2257, 5.0), (2030, 51.0)], "y int, sd double")
    found = L.with_risk_table(probe, risk).select(L.risk_at(F.col("y"), F.col("sd")).alias("m")).collect()
    assert found[0].m == row.unit_multiplier and [r.m for r in found[1:]] == [None] * 4


def test_choice_with_ties_unknown_and_all_unknown(spark):
    names = ["compkey", *D.RATIO_NAMES]
    schema = "compkey long, " + ", ".join(f"{n} double" for n in D.RATIO_NAMES)
    base = dict.fromkeys(D.RATIO_NAMES)
    cases = [
        {**base, "compkey": 1},
        {**base, "compkey": 2, "nbcr_oc_oc": 1.0, "nbcr_oc_sp": 1.0, "nbcr_sp_oc": 1.0},
        {**base, "compkey": 3, "nbcr_sp_sp": 2.0, "nbcr_oc_oc": -1.0},
        {**base, "compkey": 4, "nbcr_cipp_cipp": -0.5, "nbcr_oc_oc": -2.0},
    ]
    df = spark.createDataFrame([tuple(c[n] for n in names) for c in cases], schema)
    found = {r.compkey: (r.solution, r.solution_nbcr) for r in D.choose_action(df).collect()}
    assert found == {1: (None, None), 2: ("OC", 1.0), 3: ("SP", 2.0), 4: ("CIPP", -0.5)}


@pytest.fixture(scope="module")
def run(spark):
    return run_all(inputs(Inputs(spark, "/root/testdata/sf0.001")), dt.date(2024, 1, 20), RULES)


def test_run_keeps_every_pipe_and_segment(spark, run):
    v = Inputs(spark, "/root/testdata/sf0.001")
    rows = v("seg").count() + v("whole").count()
    assert run.published.count() == rows and run.final.count() == rows
    assert run.published.select("id").distinct().count() == rows
    assert run.branches.count() == v("whole").count()


def test_run_prices_every_job(spark, run):
    v = Inputs(spark, "/root/testdata/sf0.001")
    kinds = {r.type: r["count"] for r in run.jobs.groupBy("type").count().collect()}
    assert kinds == {"Spot": v("seg").count(), "Line": v("whole").count(), "Dig": v("whole").count()}
    assert run.jobs.filter("capitalnonmobilization IS NULL").count() == 0


def test_run_publishes_the_columns_of_all_steps(run):
    from mainstay.plans.full_run import PUBLISHED

    assert set(PUBLISHED) <= set(run.published.columns)
    for name in ("mat_note", "last_inspection", "years_since", "years", "lateral_segment", "replace_total"):
        assert run.published.filter(F.col(name).isNotNull()).count() > 0, name


def test_run_of_a_subset(spark, run):
    x = inputs(Inputs(spark, "/root/testdata/sf0.001"))
    some = x.pipes.filter("compkey < 40").select("id", "compkey")
    part = run_all(dataclasses.replace(x, subset=some), dt.date(2024, 1, 20), RULES)
    ids = sorted(r.id for r in some.collect())
    assert sorted(r.id for r in part.published.collect()) == ids
    assert sorted(r.id for r in part.final.collect()) == ids
    columns = ["id", "failure_year", "action", "replacecost", "seg_count"]
    whole = {r.id: r for r in run.published.filter("compkey < 40").select(*columns).collect()}
    assert all(whole[r.id] == r for r in part.published.select(*columns).collect())


def test_segments_carry_the_choice_of_their_pipe(run):
    whole = run.final.filter("cutno = 0").select("compkey", F.col("recommended").alias("chosen"))
    seg = run.final.filter("cutno > 0").join(whole, "compkey")
    assert seg.filter("NOT (recommended <=> chosen)").count() == 0


def test_not_maintained_pipes_say_so(run):
    rows = run.branches.filter(F.col("solution") == D.NOT_MAINTAINED)
    assert rows.count() > 0
    assert rows.filter(~F.col("problems").contains(D.NOTE_NOT_MAINTAINED)).count() == 0
