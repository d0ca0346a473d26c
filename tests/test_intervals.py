"""Hand-made edge rows and properties of the interval and lookup operators."""

import itertools

import pytest
from pyspark.sql import functions as F

from mainstay.operators import condition as C
from mainstay.operators.intervals import (
    VARIANTS, _in_level_cells, _level, clipped_length, overlap_join, pipe_extent, point_in_segment,
)
from mainstay.operators.lookups import band_lookup, ceiling_lookup, floor_lookup
from mainstay.operators.skew import hot_keys

SEG = "id long, compkey long, fm double, to_ double"
IV = "k long, compkey long, distfrom double, distto double"


def segments(spark):
    rows = [(40000000 + p * 100 + i, p, 10.0 * i, 10.0 * i + 10) for p in (0, 1, 2) for i in range(12)]
    return spark.createDataFrame(rows, SEG)


def intervals(spark):
    ends = [0.0, 5.0, 10.0, 15.0, 60.0, 119.0, 120.0, 500.0, 1e7]
    pairs = list(itertools.product(ends, [*ends, None])) + [(None, 20.0), (None, None)]
    return spark.createDataFrame([(i, i % 3, a, b) for i, (a, b) in enumerate(pairs)] + [(900, None, 1.0, 2.0)], IV)


@pytest.mark.parametrize("variant", sorted(VARIANTS))
def test_overlap_equals_brute_force(spark, variant):
    seg, iv = segments(spark), intervals(spark)
    test = VARIANTS[variant](F.col("fm"), F.col("to_"), F.col("distfrom"), F.col("distto"))
    expected = sorted((r.id, r.k) for r in seg.join(iv, "compkey").filter(test).select("id", "k").collect())
    found = overlap_join(seg, iv, variant)
    assert sorted((r.id, r.k) for r in found.select("id", "k").collect()) == expected
    salted = overlap_join(seg, iv, variant, hot=hot_keys(iv, ["compkey"], parts=20))
    assert sorted((r.id, r.k) for r in salted.select("id", "k").collect()) == expected


def test_far_ends_make_no_cells(spark):
    seg = segments(spark).unionByName(spark.createDataFrame([(99, 1, 0.0, 1e15)], SEG))
    iv = intervals(spark).filter("distto < 1e6")
    found = overlap_join(seg, iv, "closed")
    assert found.filter("id = 99").count() == iv.filter("compkey = 1").count()
    pts = iv.filter("compkey IS NOT NULL AND distfrom IS NOT NULL").select("k", "compkey", "distfrom")
    assert point_in_segment(seg, pts).filter("id = 99").count() == pts.filter("compkey = 1").count()


@pytest.mark.parametrize("variant", sorted(VARIANTS))
def test_long_and_short_ranges_of_all_levels(spark, variant):
    """Lengths from a point to 100 miles on both sides, against a join on the pipe."""
    mile, reach = 5280.0, [0.0, 10.0, 60.0, 400.0, 3000.0, 528_000.0]
    seg = [(k, k % 2, 37.0 * k * k % (100 * mile), 37.0 * k * k % (100 * mile) + reach[k % 6]) for k in range(300)]
    seg += [(900, 0, -50.0, 1e300), (901, 1, None, 7.0), (902, 1, None, None)]
    iv = [(k, k % 3, 53.0 * k * k % (100 * mile), 53.0 * k * k % (100 * mile) + reach[k % 5 + 1]) for k in range(300)]
    iv += [(900, 1, 0.0, 1e300), (901, 0, 5.0, None), (902, 0, 1e16, 1e17)]
    seg, iv = spark.createDataFrame(seg, SEG), spark.createDataFrame(iv, IV)
    test = VARIANTS[variant](F.col("fm"), F.col("to_"), F.col("distfrom"), F.col("distto"))
    expected = sorted((r.id, r.k) for r in seg.join(iv, "compkey").filter(test).select("id", "k").collect())
    assert sorted((r.id, r.k) for r in overlap_join(seg, iv, variant).select("id", "k").collect()) == expected


def test_a_long_interval_makes_few_rows(spark):
    """100 miles of interval, on a pipe with segments of four lengths: fewer than 50 rows, and 2 or 3 per segment and level."""
    seg = spark.createDataFrame(
        [(10 * k, 1, 10.0 * k, 10.0 * k + width) for k in range(0, 52_800, 50) for width in (10.0, 300.0, 5000.0, 100_000.0)], SEG
    )
    mask = pipe_extent(seg).first()["__levels"]
    iv = spark.createDataFrame([(1, 1, 3.0, 527_990.0, mask)], IV + ", levels long")
    low, high = F.col("distfrom"), F.col("distto")
    rows = _in_level_cells(iv, low, high, _level(low, high, 50.0), F.col("levels"), 50.0, "i")
    assert 0 < rows.count() < 50
    own = _in_level_cells(seg, F.col("fm"), F.col("to_"), _level(F.col("fm"), F.col("to_"), 50.0), F.lit(0).cast("long"), 50.0, "s")
    assert own.groupBy("id", "fm", "to_").count().agg(F.max("count")).first()[0] <= 3
    assert overlap_join(seg, iv, "closed").count() == seg.filter("to_ >= 3 AND fm <= 527990").count()


def test_closed_variant_is_range_overlap(spark):
    seg = segments(spark)
    iv = intervals(spark).filter("distfrom <= distto")
    expected = seg.join(iv, "compkey").filter("fm <= distto AND to_ >= distfrom").count()
    assert overlap_join(seg, iv, "closed").count() == expected


def test_point_in_segment_is_half_open(spark):
    pts = spark.createDataFrame([(0.0, 1), (10.0, 1), (120.0, 1), (None, 1)], "distfrom double, compkey long")
    found = point_in_segment(segments(spark), pts).select("fm", "distfrom").collect()
    assert sorted((r.fm, r.distfrom) for r in found) == [(0.0, 0.0), (10.0, 10.0)]


def test_clipped_lengths_never_exceed_the_defect(spark):
    seg = segments(spark).withColumn("length", F.col("to_") - F.col("fm"))
    iv = intervals(spark).filter("distfrom < distto")
    sums = overlap_join(seg, iv, "closed").groupBy("k", "distfrom", "distto").agg(F.sum(clipped_length()).alias("feet"))
    assert sums.filter("feet > distto - distfrom").count() == 0


def test_point_scores_of_the_last_segment(spark):
    seg = segments(spark).withColumns({"cutno": ((F.col("id") % 100) + 1).cast("int"), "seg_count": F.lit(12), "length": F.lit(10.0)})
    obs = spark.createDataFrame(
        [(1, 7, 5.0, None), (1, 7, 5.0, 0.0), (1, 7, 5.0, 9.0), (1, 7, 300.0, 400.0), (1, 7, 112.0, 113.0)],
        "compkey long, obsevkey long, distfrom double, distto double",
    )
    peak = spark.createDataFrame([(7, 4.0)], "obsevkey long, peak_score double")
    found = {r.cutno: r.point_score for r in C.point_defect_scores(seg, obs, peak).collect()}
    assert found == {1: 8.0, 12: 8.0}


def test_inspection_flags(spark):
    rows = [
        (1, None, "1990-01-01", "IN"), (2, "2000-01-01", "2010-01-01", "IN"), (3, "2000-01-01", None, "tbab"),
        (4, "2000-01-01", "1990-01-01", "IN"), (5, None, None, "PEND"), (6, "2000-01-01", None, "IN"),
    ]
    df = spark.createDataFrame(rows, "id long, last_inspection string, instdate string, hservstat string")
    df = df.withColumns({c: F.col(c).cast("date") for c in ("last_inspection", "instdate")})
    assert {r.id: r.insp_curr for r in C.inspection_flag(df).collect()} == {1: 4, 2: 3, 3: 2, 4: 1, 5: 4, 6: 1}


def test_lookups_on_their_edges(spark):
    table = spark.createDataFrame([(8.0, 1.0), (12.0, 2.0)], "bound double, out double")
    df = spark.createDataFrame([(7.0,), (8.0,), (8.5,), (12.0,), (13.0,), (None,)], "v double")
    up = [r.hit for r in ceiling_lookup(df, "v", table, "bound", {"out": "hit"}).collect()]
    assert up == [1.0, 1.0, 2.0, 2.0, None, None]
    down = [r.hit for r in floor_lookup(df, ["v"], table, ["bound"], {"out": "hit"}, {"out": 0.0}).collect()]
    assert down == [0.0, 1.0, 1.0, 2.0, 2.0, 0.0]
    strict = [r.hit for r in floor_lookup(df, ["v"], table, ["bound"], {"out": "hit"}, strict=True).collect()]
    assert strict == [None, None, 1.0, 1.0, 2.0, None]


def test_band_edges_and_unknown_material(spark):
    bands = spark.createDataFrame([("a", 0.0, 10.0, 50.0), ("a", 10.0, 20.0, 30.0)], "curve string, score_lower_bound double, score_upper_bound double, yearstofailure double")
    names = spark.createDataFrame([("CSP", "a"), ("PVC", "none")], "category string, curve string")
    df = spark.createDataFrame([(1, "csp", 10.0), (2, "CSP", 20.0), (3, "PVC", 5.0), (4, "CSP", 0.0)], "id long, material string, s double")
    found = {r.id: r.yearstofailure for r in band_lookup(df, "s", "material", bands, names).collect()}
    assert found == {1: 30.0, 4: 50.0}


def brute_floor(rows, values, strict=False):
    fits = [r for r in rows if all((v > b) if strict else (v >= b) for v, b in zip(values, r))]
    return max(fits)[-1] if fits else None


def test_large_lookup_tables(spark):
    """50,000 uneven bounds, in both directions, against a plain search."""
    import bisect

    bounds = sorted({round(1.0003 ** (k % 40_000) + k / 7, 4) for k in range(50_000)})
    table = spark.createDataFrame([(b, float(k)) for k, b in enumerate(bounds)], "bound double, out double").repartition(8)
    values = [bounds[0] - 1, bounds[-1] + 1, *bounds[::997], *[b + 0.01 for b in bounds[::1009]]]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    up = {r.v: r.hit for r in ceiling_lookup(df, "v", table, "bound", {"out": "hit"}).collect()}
    down = {r.v: r.hit for r in floor_lookup(df, ["v"], table, ["bound"], {"out": "hit"}).collect()}
    for v in values:
        at, below = bisect.bisect_left(bounds, v), bisect.bisect_right(bounds, v) - 1
        assert up[v] == (at if at < len(bounds) else None)
        assert down[v] == (below if below >= 0 else None)


def test_two_bounds_decide_in_order(spark):
    rows = [(a, b, 100.0 * a + b) for a, b in itertools.product((1.0, 4.0, 6.0, 30.0), (0.0, 2.0, 9.0)) if (a + b) % 5 != 0]
    table = spark.createDataFrame(rows, "a double, b double, out double")
    ends = [0.0, 0.5, 1.0, 2.0, 4.0, 5.0, 6.0, 8.5, 9.0, 31.0]
    df = spark.createDataFrame(list(itertools.product(ends, ends)) + [(None, 1.0), (1.0, None)], "x double, y double")
    for strict in (False, True):
        found = {(r.x, r.y): r.hit for r in floor_lookup(df, ["x", "y"], table, ["a", "b"], {"out": "hit"}, strict=strict).collect()}
        for pair in itertools.product(ends, ends):
            assert found[pair] == brute_floor(rows, pair, strict), (pair, strict)
        assert found[None, 1.0] is None and found[1.0, None] is None


def test_empty_lookup_table(spark):
    table = spark.createDataFrame([], "bound double, out double")
    df = spark.createDataFrame([(1.0,), (None,)], "v double")
    assert [r.hit for r in ceiling_lookup(df, "v", table, "bound", {"out": "hit"}, {"out": 5.0}).collect()] == [5.0, 5.0]
    assert [r.hit for r in floor_lookup(df, ["v"], table, ["bound"], {"out": "hit"}).collect()] == [None, None]


def test_search_time_hardly_grows_with_the_table(spark, tmp_path):
    """A hundred times as many bounds take at most twice the time."""
    import time

    path = str(tmp_path / "values")
    spark.range(400_000).select((F.col("id") % 99_991 * 0.5).alias("v")).write.parquet(path)
    df = spark.read.parquet(path)

    def seconds(n):
        table = spark.range(n).select((F.col("id") * 50_000.0 / n).alias("bound"), F.col("id").alias("out"))
        start = time.perf_counter()
        ceiling_lookup(df, "v", table, "bound", {"out": "hit"}).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - start

    seconds(500)
    small, large = min(seconds(500) for _ in range(3)), min(seconds(50_000) for _ in range(3))
    assert large < 2 * small


def test_bands_of_a_thousand_categories(spark):
    names = spark.range(1000).select(F.format_string("Kind %d", "id").alias("category"), (F.col("id") % 400).alias("curve"))
    cuts = F.explode(F.sequence(F.lit(0), F.lit(9))).alias("k")
    bands = spark.range(400).select(F.col("id").alias("curve"), cuts).select(
        "curve", (F.col("k") * 10.0).alias("score_lower_bound"), (F.col("k") * 10.0 + 15.0).alias("score_upper_bound"),
        (F.col("curve") * 100 + F.col("k")).alias("years"),
    )
    df = spark.range(3000).select("id", F.format_string("KIND %d", F.col("id") % 1500).alias("material"), (F.col("id") % 120).cast("double").alias("s"))
    found = sorted((r.id, r.years) for r in band_lookup(df, "s", "material", bands, names).collect())
    expected = sorted(
        (i, (i % 1500 % 400) * 100 + k) for i in range(3000) if i % 1500 < 1000
        for k in range(10) if 10 * k <= i % 120 < 10 * k + 15
    )
    assert found == expected


def test_bounds_that_are_missing_fit_nothing(spark):
    table = spark.createDataFrame([(None, 1.0), (5.0, 2.0), (None, 3.0), (9.0, None)], "bound double, out double")
    df = spark.createDataFrame([(1.0,), (5.0,), (7.0,), (20.0,)], "v double")
    assert [r.hit for r in ceiling_lookup(df, "v", table, "bound", {"out": "hit"}).collect()] == [2.0, 2.0, None, None]
    assert [r.hit for r in floor_lookup(df, ["v"], table, ["bound"], {"out": "hit"}).collect()] == [None, 2.0, 2.0, None]
