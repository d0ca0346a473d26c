"""Registered queries of the reusable operators: filters, joins, aggregates, intervals, lookups."""

from __future__ import annotations

from pyspark.sql import functions as F

from mainstay.checks.common import AS_OF, Query, rounded
from mainstay.functions.scalar import append_note, flag, is_unit_id, normal_cdf, same_text
from mainstay.operators import condition as C
from mainstay.operators import decision as D
from mainstay.operators.intervals import overlap_join, point_in_segment
from mainstay.operators.lookups import band_lookup, ceiling_lookup, floor_lookup
from mainstay.operators.skew import attach
from mainstay.operators.tables import (
    accumulate_layers, copy_segments_to_whole, copy_whole_to_segments, job_cost_agg, latest_inspections, masked_max,
    masked_sum, rows_at_max, sandwich, shares_node, with_updates,
)
from mainstay.sources.tables import base_segments

Q: dict[str, Query] = {}
SQL: dict[str, str] = {}

# --- sources and filters -------------------------------------------------------------

Q["s3_base_segments"] = lambda v: base_segments(v("seg"), {"segment_id": "id", "pipe": "compkey", "cut": "cutno", "feet": "length"})
SQL["s3_base_segments"] = "SELECT id AS segment_id, compkey AS pipe, cutno AS cut, length AS feet FROM seg"

Q["s8_subset_of_segments"] = lambda v: (
    v("seg").join(v("chg").select("compkey").distinct(), "compkey", "left_semi").select("id", "compkey", "length")
)
SQL["s8_subset_of_segments"] = "SELECT id, compkey, length FROM seg WHERE compkey IN (SELECT compkey FROM chg)"


def _grain(v):
    both = v("seg").select("id", "compkey", "length").unionByName(v("whole").select("id", "compkey", "length"))
    w = C.whole(both).agg(F.count(F.lit(1)).alias("rows"), F.sum("length").alias("feet")).withColumn("grain", F.lit("whole"))
    s = C.segments(both).agg(F.count(F.lit(1)).alias("rows"), F.sum("length").alias("feet")).withColumn("grain", F.lit("segment"))
    return w.unionByName(s)


Q["f1_split_by_grain"] = _grain
SQL["f1_split_by_grain"] = """
SELECT CASE WHEN id < 40000000 THEN 'whole' ELSE 'segment' END AS grain, count(*) AS rows, sum(length) AS feet
FROM (SELECT id, length FROM seg UNION ALL SELECT id, length FROM whole) b GROUP BY 1
"""

Q["f2_as_of"] = lambda v: C.as_of(v("insp"), AS_OF).select("inspkey", "compkey", "startdttm")
SQL["f2_as_of"] = "SELECT inspkey, compkey, startdttm FROM insp WHERE startdttm <= DATE '2024-01-20'"

Q["f3_text_without_case"] = lambda v: v("sanitary").filter(same_text("unittype", "csml")).select("compkey", "unittype")
SQL["f3_text_without_case"] = "SELECT compkey, unittype FROM sanitary WHERE unittype ILIKE 'csml'"

Q["f4_unit_id"] = lambda v: v("sanitary").select("compkey", flag(is_unit_id("unitid")).alias("ok"), flag(is_unit_id("unitid2")).alias("ok2"))
SQL["f4_unit_id"] = """
SELECT compkey, CAST(CASE WHEN regexp_full_match(upper(unitid), '[A-Z][A-Z][A-Z][0-9][0-9][0-9] {0,1}') THEN 1 ELSE 0 END AS INT) AS ok,
       CAST(CASE WHEN regexp_full_match(upper(unitid2), '[A-Z][A-Z][A-Z][0-9][0-9][0-9] {0,1}') THEN 1 ELSE 0 END AS INT) AS ok2 FROM sanitary
"""

Q["f7_filter_on_group_key"] = lambda v: (
    v("linkxp").join(v("street"), F.col("pstrttyp") == F.col("street_number")).filter(F.col("street_grp").isin("Art", "Strt"))
    .groupBy("street_grp").agg(F.count(F.lit(1)).alias("rows"))
)
SQL["f7_filter_on_group_key"] = """
SELECT s.street_grp, count(*) AS rows FROM linkxp x JOIN street s ON s.street_number = x.pstrttyp
GROUP BY s.street_grp HAVING s.street_grp = 'Art' OR s.street_grp = 'Strt'
"""

# --- joins ---------------------------------------------------------------------------

Q["j1_inner_join_four_keys"] = lambda v: (
    v("latest").join(v("peak"), "obsevkey").groupBy("compkey").agg(F.count(F.lit(1)).alias("rows"), F.sum("peak_score").alias("score"))
)
SQL["j1_inner_join_four_keys"] = "SELECT l.compkey, count(*) AS rows, sum(p.peak_score) AS score FROM latest l JOIN peak p ON p.obsevkey = l.obsevkey GROUP BY l.compkey"

Q["j2_left_join_nested"] = lambda v: (
    v("pipe").select("compkey").join(
        v("scored").filter("def_tot >= 1000").join(v("jobs").filter("type = 'Spot'").select("id", "basetime"), "id").select("compkey", "basetime"),
        "compkey", "left",
    ).groupBy("compkey").agg(F.sum(F.coalesce("basetime", F.lit(0.0))).alias("hours"))
)
SQL["j2_left_join_nested"] = """
SELECT p.compkey, sum(coalesce(j.basetime, 0)) AS hours
FROM pipe p LEFT JOIN (scored s JOIN jobs j ON j.id = s.id AND j.type = 'Spot' AND s.def_tot >= 1000) ON s.compkey = p.compkey
GROUP BY p.compkey
"""

Q["j4_semi_join"] = lambda v: v("whole").join(v("insp").select("compkey").distinct(), "compkey", "left_semi").select("compkey", "length")
SQL["j4_semi_join"] = "SELECT compkey, length FROM whole WHERE compkey IN (SELECT compkey FROM insp)"

Q["j5_anti_join_two_tables"] = lambda v: (
    v("whole").join(v("sanitary").select("compkey").union(v("storm").select("compkey")), "compkey", "left_anti").select("compkey")
)
SQL["j5_anti_join_two_tables"] = """
SELECT w.compkey FROM whole w LEFT JOIN sanitary a ON a.compkey = w.compkey LEFT JOIN storm b ON b.compkey = w.compkey
WHERE a.compkey IS NULL AND b.compkey IS NULL
"""


def _pairs(variant):
    def run(v):
        hot = v.hot("latest")
        pairs = overlap_join(v("seg").select("id", "compkey", "fm", "to_"), v("latest").select("compkey", "obskey", "distfrom", "distto"), variant, hot=hot)
        return pairs.select("id", "obskey", "distfrom", "distto")

    return run


def _overlap_sql(test):
    return f"""
SELECT s.id, l.obskey, l.distfrom, l.distto FROM seg s JOIN latest l ON l.compkey = s.compkey
WHERE {test}
"""


Q["j6_overlap_join"] = lambda v: (
    overlap_join(v("seg").select("id", "compkey", "fm", "to_", "length"), v("chg").select("compkey", "chdetail", "distfrom", "distto"), "closed")
    .groupBy("id", "chdetail").agg(F.count(F.lit(1)).alias("rows"), F.min("distfrom").alias("first_from"))
)
SQL["j6_overlap_join"] = """
SELECT s.id, c.chdetail, count(*) AS rows, min(c.distfrom) AS first_from FROM seg s JOIN chg c ON c.compkey = s.compkey
WHERE s.fm <= c.distto AND s.to_ >= c.distfrom GROUP BY s.id, c.chdetail
"""

Q["v1_overlap_closed"] = _pairs("closed")
SQL["v1_overlap_closed"] = _overlap_sql("(s.fm BETWEEN l.distfrom AND l.distto) OR (s.to_ BETWEEN l.distfrom AND l.distto) OR (l.distfrom >= s.fm AND l.distto <= s.to_)")
Q["v2_overlap_half_open"] = _pairs("half_open")
SQL["v2_overlap_half_open"] = _overlap_sql(
    "(l.distfrom <= s.fm AND s.fm < l.distto) OR (l.distfrom <= s.to_ AND s.to_ < l.distto) OR (s.fm <= l.distfrom AND l.distto < s.to_) OR (l.distfrom = s.fm AND l.distto = s.fm)"
)
Q["v3_overlap_straddle"] = _pairs("straddle")
SQL["v3_overlap_straddle"] = _overlap_sql(
    "(l.distfrom <= s.fm AND s.to_ <= l.distto) OR (l.distfrom BETWEEN s.fm AND s.to_) OR (l.distto BETWEEN s.fm AND s.to_)"
)
Q["v4_overlap_mixed"] = _pairs("mixed")
SQL["v4_overlap_mixed"] = _overlap_sql(
    "l.distfrom <> l.distto AND ((s.fm BETWEEN l.distfrom AND l.distto) OR (l.distfrom < s.to_ AND s.to_ < l.distto) OR (s.fm <= l.distfrom AND l.distto < s.to_))"
)

Q["j7_point_in_segment"] = lambda v: point_in_segment(
    v("seg").select("id", "compkey", "fm", "to_"), v("chg").select("compkey", "chdetail", "distfrom")
).select("id", "chdetail", "distfrom")
SQL["j7_point_in_segment"] = """
SELECT s.id, c.chdetail, c.distfrom FROM seg s JOIN chg c ON c.compkey = s.compkey AND c.distfrom >= s.fm AND c.distfrom < s.to_
"""
Q["v5_point_in_segment"] = lambda v: point_in_segment(
    v("seg").select("id", "compkey", "fm", "to_"), v("latest").select("compkey", "obskey", "distfrom")
).select("id", "obskey", "distfrom")
SQL["v5_point_in_segment"] = """
SELECT s.id, l.obskey, l.distfrom FROM latest l JOIN seg s ON s.compkey = l.compkey AND s.fm <= l.distfrom AND l.distfrom < s.to_
"""

Q["j8_band_lookup"] = lambda v: band_lookup(
    v("scored").join(v("seg").select("id", F.col("material").alias("kind")), "id").select("id", "def_tot", F.upper("kind").alias("material")),
    "def_tot", "material", v("bands"), v("rosetta"),
).select("id", "def_tot", "yearstofailure")
SQL["j8_band_lookup"] = """
SELECT s.id, s.def_tot, b.yearstofailure FROM scored s JOIN rosetta r ON lower(r.category) = lower(s.material)
JOIN bands b ON b.curve = r.curve AND s.def_tot >= b.score_lower_bound AND s.def_tot < b.score_upper_bound
"""


def _both_lookups(v):
    base = v("seg").select("id", F.col("diamwidth").cast("double").alias("size"))
    up = ceiling_lookup(base, "size", v("diameters"), "inside", {"outside": "outside"})
    return floor_lookup(up, ["size"], v("prices"), ["min_diameter"], {"price": "price"}, {"price": 0.0})


Q["j9_ceiling_and_floor_lookup"] = _both_lookups
SQL["j9_ceiling_and_floor_lookup"] = """
SELECT s.id, CAST(s.diamwidth AS DOUBLE) AS size,
       (SELECT min(d.outside) FROM diameters d WHERE d.inside >= s.diamwidth) AS outside,
       coalesce((SELECT max(p.price) FROM prices p WHERE p.min_diameter <= s.diamwidth), 0) AS price
FROM seg s
"""

Q["j10_sandwich"] = lambda v: sandwich(
    v("whole").filter("grade_h5 < 3").select("compkey", "usnode", "dsnode"), v("whole").filter("grade_h5 >= 2").select("usnode", "dsnode")
).select("compkey")
SQL["j10_sandwich"] = """
SELECT m.compkey FROM whole m WHERE m.grade_h5 < 3 AND EXISTS (SELECT 1 FROM whole u WHERE u.grade_h5 >= 2 AND u.dsnode = m.usnode)
AND EXISTS (SELECT 1 FROM whole d WHERE d.grade_h5 >= 2 AND d.usnode = m.dsnode)
"""


def _both_ways(v):
    hot = v.hot("seg")
    down = copy_whole_to_segments(v("seg").select("id", "compkey", "length"), v("whole"), ["grade_h5"], hot)
    up = copy_segments_to_whole(v("whole").select("compkey", "length"), v("seg"), {"length": F.max("length"), "cuts": F.count(F.lit(1))})
    return down.join(up.select("compkey", F.col("length").alias("longest"), "cuts"), "compkey").select("id", "length", "grade_h5", "longest", "cuts")


Q["j11_copy_between_grains"] = _both_ways
SQL["j11_copy_between_grains"] = """
SELECT s.id, s.length, w.grade_h5, a.longest, a.cuts FROM seg s JOIN whole w ON w.compkey = s.compkey
JOIN (SELECT compkey, max(length) AS longest, count(*) AS cuts FROM seg GROUP BY compkey) a ON a.compkey = s.compkey
"""

Q["j12_join_on_other_rows_value"] = lambda v: (
    attach(v("scored").select("id", "compkey", "fail_yr_seg"), v("pipe").select("compkey", F.col("fail_yr").alias("first_failure")), "compkey", "inner", v.hot("scored"))
    .filter(F.col("fail_yr_seg") <= F.col("first_failure") + 30).groupBy("compkey").agg(F.count(F.lit(1)).alias("rows"))
)
SQL["j12_join_on_other_rows_value"] = """
SELECT s.compkey, count(*) AS rows FROM scored s JOIN pipe p ON p.compkey = s.compkey AND s.fail_yr_seg <= p.fail_yr + 30 GROUP BY s.compkey
"""


def _shared(v):
    a = v("line").select(F.col("feature_id").alias("a"), F.col("us_node").alias("au"), F.col("ds_node").alias("ad"), "status", "value")
    b = v("line").select(F.col("feature_id").alias("b"), F.col("us_node").alias("bu"), F.col("ds_node").alias("bd"), F.col("feature_id").alias("near"))
    near = a.withColumn("near", F.explode(F.sequence(F.col("a") - 2, F.col("a") + 2))).join(b, "near")
    return near.filter(~shares_node(F.col("au"), F.col("ad"), F.col("bu"), F.col("bd"))).select("a", "b")


Q["j13_pairs_without_shared_node"] = _shared
SQL["j13_pairs_without_shared_node"] = """
SELECT x.feature_id AS a, y.feature_id AS b FROM line x JOIN line y ON y.feature_id IN (x.feature_id - 2, x.feature_id - 1, x.feature_id, x.feature_id + 1, x.feature_id + 2)
WHERE trim(lower(x.us_node)) <> trim(lower(y.us_node)) AND trim(lower(x.ds_node)) <> trim(lower(y.ds_node))
  AND trim(lower(x.us_node)) <> trim(lower(y.ds_node)) AND trim(lower(x.ds_node)) <> trim(lower(y.us_node))
"""

Q["j14_update_from_join"] = lambda v: with_updates(
    v("seg").select("id", "compkey", "material"), v("chg"), ["compkey"], {"material": "chdetail"}, v.hot("seg")
).select("id", "material")
SQL["j14_update_from_join"] = """
SELECT s.id, CASE WHEN c.compkey IS NULL THEN s.material ELSE c.detail END AS material
FROM seg s LEFT JOIN (SELECT compkey, max(chdetail) AS detail FROM chg GROUP BY compkey) c ON c.compkey = s.compkey
"""

# --- aggregates and windows ----------------------------------------------------------

Q["a2_distinct_count"] = lambda v: (
    v("chg").filter(F.col("chdetail").isNotNull()).groupBy("compkey").agg(F.countDistinct("chdetail").alias("materials"))
)
SQL["a2_distinct_count"] = "SELECT compkey, count(*) AS materials FROM (SELECT compkey, chdetail FROM chg GROUP BY compkey, chdetail) x GROUP BY compkey"

Q["a4_job_cost"] = lambda v: v("jobs").groupBy("compkey", "type").agg(F.round(job_cost_agg(), 3).alias("bid"))
SQL["a4_job_cost"] = """
SELECT compkey, type, round(sum(capitalnonmobilization) + max(capitalmobilizationrate) * (sum(basetime) + max(mobilizationtime)) / 8, 3) AS bid
FROM jobs GROUP BY compkey, type
"""

Q["a5_rows_at_max"] = lambda v: rows_at_max(v("chg"), ["compkey"], "distto", v.hot("chg")).select("compkey", "chdetail", "distto")
SQL["a5_rows_at_max"] = """
SELECT c.compkey, c.chdetail, c.distto FROM chg c JOIN (SELECT compkey, max(distto) AS far FROM chg GROUP BY compkey) m ON m.compkey = c.compkey AND m.far = c.distto
"""

Q["a6_having_count_range"] = lambda v: (
    v("scored").filter("def_tot > 1000").groupBy("compkey").agg(F.count(F.lit(1)).alias("spots")).filter(F.col("spots").between(1, 2))
)
SQL["a6_having_count_range"] = "SELECT compkey, count(*) AS spots FROM scored WHERE def_tot > 1000 GROUP BY compkey HAVING count(*) > 0 AND count(*) <= 2"

Q["a7_masked_sum_and_max"] = lambda v: v("latest").groupBy("compkey").agg(
    masked_sum("compdttm", "distfrom").alias("known_sum"), masked_max("distto", "distfrom").alias("known_max")
)
SQL["a7_masked_sum_and_max"] = """
SELECT compkey, sum(distfrom * (CASE WHEN compdttm IS NULL THEN 0 ELSE 1 END)) AS known_sum,
       max(distfrom * (CASE WHEN distto IS NULL THEN 0 ELSE 1 END)) AS known_max FROM latest GROUP BY compkey
"""

Q["a9_greatest_of_columns"] = lambda v: v("ratios").select(
    "compkey", F.greatest("nbcr_oc_oc", "nbcr_cipp_cipp", "nbcr_sp_cipp").alias("best"), F.least("nbcr_oc_oc", "nbcr_cipp_cipp", "nbcr_sp_cipp").alias("worst")
)
SQL["a9_greatest_of_columns"] = """
SELECT compkey, max(x) AS best, min(x) AS worst FROM (SELECT compkey, nbcr_oc_oc AS x FROM ratios UNION ALL SELECT compkey, nbcr_cipp_cipp FROM ratios
  UNION ALL SELECT compkey, nbcr_sp_cipp FROM ratios) u GROUP BY compkey
"""

Q["w1_latest_inspection"] = lambda v: latest_inspections(v("insp"), v.hot("insp")).select("inspkey", "compkey", "compdttm")
SQL["w1_latest_inspection"] = """
SELECT inspkey, compkey, compdttm FROM (SELECT *, rank() OVER (PARTITION BY compkey ORDER BY compdttm DESC NULLS LAST) AS place FROM insp) x WHERE place = 1
"""

# --- unions and scalars --------------------------------------------------------------

Q["u3_accumulate_layers"] = lambda v: rounded(
    accumulate_layers(
        v("seg").select("id"),
        [
            v("xp").filter("xschl > 1").select("id", F.lit(800.0).alias("consequence")),
            v("xp").filter("xfire > 2").select("id", F.lit(120.5).alias("consequence")),
            v("seg").filter("length > 30").select("id", (F.col("replacecost") * 0.01).alias("consequence")),
        ],
    ), ["cost"],
)
SQL["u3_accumulate_layers"] = """
SELECT s.id, CASE WHEN x.xschl > 1 OR x.xfire > 2 OR s.length > 30 THEN
  round((CASE WHEN x.xschl > 1 THEN 800 ELSE 0 END) + (CASE WHEN x.xfire > 2 THEN 120.5 ELSE 0 END) + (CASE WHEN s.length > 30 THEN s.replacecost * 0.01 ELSE 0 END), 4) END AS cost
FROM seg s JOIN xp x ON x.id = s.id
"""

Q["e5_append_note"] = lambda v: v("ratios").select(
    "compkey", append_note("problems", ", seen").alias("noted"), append_note("problems", ", seen", keep_null=True).alias("kept")
)
SQL["e5_append_note"] = "SELECT compkey, coalesce(problems, '') || ', seen' AS noted, problems || ', seen' AS kept FROM ratios"

# Standard normal tail as one arithmetic expression of a column z, for the comparison SQL.
TAIL_SQL = """(CASE WHEN abs({z}) > 37 THEN 0 WHEN abs({z}) < 7.07106781186547e0 THEN
 exp(-({z}) * ({z}) / 2) * ((((((3.52624965998911e-02 * abs({z}) + 0.700383064443688e0) * abs({z}) + 6.37396220353165e0) * abs({z}) + 33.912866078383e0) * abs({z}) + 112.079291497871e0) * abs({z}) + 221.213596169931e0) * abs({z}) + 220.206867912376e0)
 / (((((((8.83883476483184e-02 * abs({z}) + 1.75566716318264e0) * abs({z}) + 16.064177579207e0) * abs({z}) + 86.7807322029461e0) * abs({z}) + 296.564248779674e0) * abs({z}) + 637.333633378831e0) * abs({z}) + 793.826512519948e0) * abs({z}) + 440.413735824752e0)
 ELSE exp(-({z}) * ({z}) / 2) / (abs({z}) + 1 / (abs({z}) + 2 / (abs({z}) + 3 / (abs({z}) + 4 / (abs({z}) + 0.65e0))))) / 2.506628274631e0 END)"""


def tail_sql(z: str) -> str:
    """Upper tail for any sign of z."""
    t = TAIL_SQL.format(z=z)
    return f"(CASE WHEN {z} > 0 THEN {t} ELSE 1 - {t} END)"


Q["e7_normal_cdf"] = lambda v: v("scored").select("id", F.round(normal_cdf("def_tot", F.lit(700.0), F.col("length") + 90.0), 9).alias("p"))
SQL["e7_normal_cdf"] = f"SELECT id, round({tail_sql('z')}, 9) AS p FROM (SELECT id, (700 - def_tot) / (length + 90) AS z FROM scored) x"


def _rates(v):
    base = v("site").select("id", "diamwidth", ((F.col("udepth") + F.col("ddepth")) / 2).alias("depth"))
    out = ceiling_lookup(base, "depth", v("depth_rates"), "depth", {"cost_per_yard": "dig"})
    return floor_lookup(out, ["diamwidth", "depth"], v("difficulty"), ["min_diameter", "min_depth"], {"factor": "hard"}, {"factor": 1.0})


Q["e9_rate_lookups"] = _rates
SQL["e9_rate_lookups"] = """
SELECT s.id, s.diamwidth, (s.udepth + s.ddepth) / 2 AS depth,
  (SELECT r.cost_per_yard FROM depth_rates r WHERE r.depth >= (s.udepth + s.ddepth) / 2 ORDER BY r.depth LIMIT 1) AS dig,
  coalesce((SELECT d.factor FROM difficulty d WHERE d.min_diameter <= s.diamwidth AND d.min_depth <= (s.udepth + s.ddepth) / 2
            ORDER BY d.min_diameter DESC, d.min_depth DESC LIMIT 1), 1) AS hard
FROM site s
"""
