"""Registered queries of the cost estimate, durations and failure windows."""

from __future__ import annotations

from pyspark.sql import functions as F

from mainstay import params as P
from mainstay.checks.common import NUDGE, Query, YEAR, rounded
from mainstay.operators import costs as K
from mainstay.operators import durations as D
from mainstay.operators import windows as W
from mainstay.operators.skew import hot_keys
from mainstay.session import cut_lineage

Q: dict[str, Query] = {}
SQL: dict[str, str] = {}

Z = "((s.udepth + s.ddepth) / 2)"
OD = "(SELECT min(d.outside) FROM diameters d WHERE d.inside >= s.diamwidth)"
SIZED = f"""
sized AS (SELECT s.*, {Z} AS z, (SELECT min(t.width) FROM trenches t WHERE t.max_outside >= s.outside) AS w
  FROM (SELECT s.*, {OD} AS outside FROM site s) s),
vol AS (SELECT sized.*, z * w / 27 AS v FROM sized)
"""


def _tables(v):
    names = ["diameters", "trenches", "depth_rates", "prices", "difficulty", "bypass_rates"]
    return {n: v(n) for n in names}


def _sized(v, name="site"):
    return K.excavation_volume(K.pipe_dimensions(v(name), v("diameters"), v("trenches")))


def _pick(df, *names, digits=4):
    return rounded(df.select("id", *names), list(names), digits)


def _vol_sql(expr, where=""):
    return f"WITH {SIZED} SELECT id, {expr} FROM vol {where}"


Q["k1_job_rows"] = lambda v: K.job_rows(v("seg").select("id", "compkey").unionByName(v("whole").select("id", "compkey")))
SQL["k1_job_rows"] = """
SELECT id, compkey, 'Spot' AS type FROM seg UNION ALL SELECT id, compkey, 'Line' AS type FROM whole UNION ALL SELECT id, compkey, 'Dig' AS type FROM whole
"""
Q["k2_pipe_dimensions"] = lambda v: K.pipe_dimensions(v("site"), v("diameters"), v("trenches")).select("id", "outside", "trench_width")
SQL["k2_pipe_dimensions"] = f"WITH {SIZED} SELECT id, outside, w AS trench_width FROM sized"
Q["k3_excavation_volume"] = lambda v: _pick(_sized(v), "volume")
SQL["k3_excavation_volume"] = _vol_sql("round(v, 4) AS volume")
Q["k4_water_relocation"] = lambda v: _pick(K.water_relocation(v("site")), "water")
SQL["k4_water_relocation"] = "SELECT id, CASE WHEN pwtr > 0 THEN round(CAST(7.9126 AS DOUBLE) * pwtrmaxd + 74.093, 4) END AS water FROM site"
Q["k5_crossing_relocation"] = lambda v: _pick(K.crossing_relocation(v("site")), "crossing")
SQL["k5_crossing_relocation"] = """
SELECT id, CAST(5000 * (coalesce(xsewer, 0) + coalesce(xwtr, 0) + coalesce(xgas, 0) + coalesce(xfiber, 0)) AS DOUBLE) AS crossing FROM site
"""
Q["k6_hazardous_material"] = lambda v: _pick(K.hazardous_material(_sized(v)).withColumnRenamed("hazard", "one"), "one").join(
    _pick(K.hazardous_material(_sized(v), any_site=True).withColumnRenamed("hazard", "some"), "some"), "id"
)
SQL["k6_hazardous_material"] = _vol_sql(
    "CASE WHEN xecsi = 1 THEN round(least(length, 50) * v * 50, 4) END AS one, CASE WHEN xecsi > 0 THEN round(least(length, 50) * v * 50, 4) END AS some"
)
Q["k7_environmental_mitigation"] = lambda v: _pick(K.environmental_mitigation(v("site")), "mitigation")
SQL["k7_environmental_mitigation"] = """
SELECT id, CASE WHEN xftezonc > 0 OR xftezonp > 0 THEN round(CAST(150000 AS DOUBLE) * (coalesce(xftezonc, 0) * 25 + coalesce(xftezonp, 0) * 25) / 43560, 4) END AS mitigation FROM site
"""
PATCH = "(CASE WHEN coalesce(hardarea, 0) > 0 THEN 55.77 WHEN pstrttext = 'A' THEN 55.77 WHEN pstrttext = 'S' THEN 44.27 WHEN pstrttext = 'H' THEN 28.62 END)"
Q["k8_asphalt"] = lambda v: _pick(K.asphalt(_sized(v)), "asphalt_removal", "base_course", "patch")
SQL["k8_asphalt"] = _vol_sql(f"""round(8.12 * ((w + 1) / 9) * length, 4) AS asphalt_removal,
 round(((w + 1) * 0.6666667 / 27) * 29.52 * length, 4) AS base_course, round(((w + 1) / 9) * {PATCH} * length, 4) AS patch""")
Q["k9_backfill"] = lambda v: _pick(K.backfill(_sized(v)), "fill", "backfill")
SQL["k9_backfill"] = _vol_sql("""round((v - w * ((0.6666667 + outside + 18) / 12) / 27) * length * 27.3, 4) AS fill,
 round((w * ((outside + 18) / 12) / 27 - (pow(outside, 2) * 12 * (pi() / 4)) / pow(36, 3)) * length * 70.55, 4) AS backfill""")
RATE = "(SELECT r.cost_per_yard FROM depth_rates r WHERE r.depth >= vol.z ORDER BY r.depth LIMIT 1)"
Q["k10_excavation_costs"] = lambda v: _pick(K.excavation_costs(_sized(v), v("depth_rates")), "saw", "excavation", "haul", "shoring")
SQL["k10_excavation_costs"] = _vol_sql(f"""round(CAST(4 AS DOUBLE) * 4.21 * length, 4) AS saw, round({RATE} * v * 1.2 * length, 4) AS excavation,
 round((v * 1.2) * 4.72 * length, 4) AS haul, CASE WHEN z > 18 THEN round(z * 2 * 2.57 * length, 4) END AS shoring""")
PRICE = "coalesce((SELECT p.price FROM prices p WHERE p.min_diameter <= vol.diamwidth ORDER BY p.min_diameter DESC LIMIT 1), 0)"
HARD = "coalesce((SELECT d.factor FROM difficulty d WHERE d.min_diameter <= vol.diamwidth AND d.min_depth <= vol.z ORDER BY d.min_diameter DESC, d.min_depth DESC LIMIT 1), 1)"
Q["k11_pipe_material"] = lambda v: _pick(K.pipe_material(v("site"), v("prices"), v("difficulty")), "pipe")
SQL["k11_pipe_material"] = _vol_sql(f"round({HARD} * {PRICE} * length, 4) AS pipe")


def _manhole_whole(v, add=False):
    return K.manhole_detail(v("wsite"), v("mh_sizes"), v("mh_prices"), v("mh_factors"), add)


def _manholes(v):
    wholes = _manhole_whole(v)
    seg = K.manhole(v("site").select("id", "compkey", "cutno"), wholes)
    return _pick(seg.select("id", "manhole").unionByName(wholes.select("id", "manhole")), "manhole")


MH = """
mh0 AS (SELECT s.*, (s.udepth + s.ddepth) / 2 AS z, coalesce((SELECT m.manhole_size FROM mh_sizes m WHERE m.max_inside >= s.diamwidth ORDER BY m.max_inside LIMIT 1), 0) AS size FROM wsite s),
mh AS (SELECT m.id, m.compkey, coalesce((SELECT f.factor FROM mh_factors f WHERE f.min_size <= m.size AND f.min_depth <= m.z ORDER BY f.min_size DESC, f.min_depth DESC LIMIT 1), 0)
  * (coalesce((SELECT p.base_cost FROM mh_prices p WHERE p.max_size >= m.size ORDER BY p.max_size LIMIT 1), 0)
   * coalesce((SELECT p.per_foot FROM mh_prices p WHERE p.max_size >= m.size ORDER BY p.max_size LIMIT 1), 0) * greatest(m.z - 8, 0)
   + coalesce((SELECT p.rim FROM mh_prices p WHERE p.max_size >= m.size ORDER BY p.max_size LIMIT 1), 0)) AS manhole FROM mh0 m)
"""
Q["k12_manhole"] = _manholes
SQL["k12_manhole"] = f"""
WITH {MH} SELECT s.id, CASE WHEN s.cutno = 1 THEN round(m.manhole, 4) WHEN s.cutno > 1 THEN 0 END AS manhole FROM site s LEFT JOIN mh m ON m.compkey = s.compkey
UNION ALL SELECT id, round(manhole, 4) AS manhole FROM mh
"""
FLOW = "(CAST(0.2 AS DOUBLE) * 1.486 / 0.013 * pow(coalesce(s.diamwidth, 0) / 48, CAST(2 AS DOUBLE) / 3) * sqrt(CASE WHEN s.xpipslope > 0 THEN s.xpipslope ELSE CAST(0.005 AS DOUBLE) END))"
TRAFFIC = "((CASE lower(s.pstrttext) WHEN 'f' THEN 0 WHEN 'a' THEN 1000 WHEN 'm' THEN 3000 WHEN 's' THEN 500 ELSE 0 END) * (CAST(CASE WHEN coalesce(s.uxclx, 0) < 2 THEN 0 ELSE s.uxclx - 2 END AS DOUBLE) / 2 + 1))"
RATED = """
rated{n} AS (SELECT s.*, coalesce((SELECT b.cost FROM bypass_rates b WHERE b.flow < s.flow ORDER BY b.flow DESC LIMIT 1), 0) AS br
  FROM (SELECT s.*, {flow} AS flow, {traffic} AS tr FROM {src} s) s)
"""


def _rated_sql(src, n=""):
    return RATED.format(n=n, flow=FLOW, traffic=TRAFFIC, src=src)


def _rated(v, name="site"):
    return K.traffic_rate(K.bypass_rate(v(name), v("bypass_rates")))


Q["k13_time_costs"] = lambda v: _pick(K.time_costs(_rated(v)), "bypass", "traffic")
SQL["k13_time_costs"] = f"WITH {_rated_sql('site')} SELECT id, round(br * (base_hours + mob_hours), 4) AS bypass, round(tr * (base_hours + mob_hours), 4) AS traffic FROM rated"


def _mob(v):
    seg = K.mobilization_rate(_rated(v), add_bypass=False)
    wholes = K.mobilization_rate(_rated(v, "wsite"), add_bypass=True)
    return _pick(seg.select("id", "mob_rate").unionByName(wholes.select("id", "mob_rate")), "mob_rate")


Q["k14_mobilization_rate"] = _mob
SQL["k14_mobilization_rate"] = f"""
WITH {_rated_sql('site')}, {_rated_sql('wsite', '2')} SELECT id, round(coalesce(tr, 0), 4) AS mob_rate FROM rated UNION ALL SELECT id, round(coalesce(br, 0) + coalesce(tr, 0), 4) AS mob_rate FROM rated2
"""


def _boring(v):
    seg = K.boring_jacking(v("site"))
    wholes = K.boring_jacking(v("wsite"), is_whole=True)
    return _pick(seg.select("id", "boring").unionByName(wholes.select("id", "boring")), "boring")


BORE = "round(566.95 * (CAST(8090 AS DOUBLE) / 9500) * exp(0.0119 * s.diamwidth) * s.length, 4)"
Q["k15_boring_jacking"] = _boring
SQL["k15_boring_jacking"] = f"""
SELECT s.id, CASE WHEN {Z} > 25 OR s.pstrttyp IN (1110, 1121, 1122, 1123, 1200) OR s.xbldg > 0 OR s.xlrt > 0 OR s.xrail > 0 THEN {BORE} END AS boring FROM site s
UNION ALL SELECT s.id, CASE WHEN {Z} > 25 OR s.xfrwy > 0 OR s.xbldg > 0 OR s.xlrt > 0 OR s.xrail > 0 THEN {BORE} END AS boring FROM wsite s
"""


def _difficult(v):
    seg = K.difficult_area(v("site"))
    wholes = K.difficult_area(v("wsite"), is_whole=True)
    return seg.select("id", "difficult").unionByName(wholes.select("id", "difficult"))


N4 = "((CASE WHEN hardarea > 0 THEN 1 ELSE 0 END) + (CASE WHEN prail > 0 THEN 1 ELSE 0 END) + (CASE WHEN plrt > 0 THEN 1 ELSE 0 END) + (CASE WHEN abs(coalesce(gslope, 0)) >= 0.1 THEN 1 ELSE 0 END))"
POWER = "(CASE {n} WHEN 0 THEN 1.0 WHEN 1 THEN 1.5 WHEN 2 THEN 2.3 WHEN 3 THEN 3.4 WHEN 4 THEN 5.1 END)"
DIFFICULT = f"(CASE WHEN hardarea = 1 OR prail > 0 OR plrt = 1 THEN CAST({POWER.format(n=N4)} AS DOUBLE) END)"
Q["k16_difficult_area"] = _difficult
SQL["k16_difficult_area"] = f"""
SELECT id, {DIFFICULT} AS difficult FROM site
UNION ALL SELECT id, CASE WHEN hardarea > 0 OR prail > 0 OR plrt > 0 THEN CAST(1 AS DOUBLE) END AS difficult FROM wsite
"""


def _laterals(v):
    return K.laterals(v("insp"), v("obs"), "obcode", "LT", hot=v.hot("insp"))


LATERALS = """
ranked AS (SELECT i.inspkey, i.compkey, i.compdttm, rank() OVER (PARTITION BY i.compkey ORDER BY i.compdttm DESC NULLS LAST) AS place
  FROM insp i WHERE EXISTS (SELECT 1 FROM obs o WHERE o.inspkey = i.inspkey AND o.obsevkey NOT IN (1083, 1084, 1085, 1086))),
lats AS (SELECT r.compkey, r.compdttm, o.distfrom, o.obsevkey, o.obskey, o.inspkey FROM ranked r JOIN obs o ON o.inspkey = r.inspkey WHERE r.place = 1 AND o.obcode = 'LT')
"""
Q["k17_laterals"] = lambda v: _laterals(v).select("compkey", "compdttm", "distfrom", "obsevkey", "obskey")
SQL["k17_laterals"] = f"WITH {LATERALS} SELECT compkey, compdttm, distfrom, obsevkey, obskey FROM lats"


def _lateral_cost(v):
    seg = K.lateral_cost(v("site"), _laterals(v))
    wholes = K.lateral_cost_whole(v("wsite"), seg)
    both = seg.select("id", F.col("lateral").alias("laterals")).unionByName(wholes.select("id", "lateral").toDF("id", "laterals"))
    return _pick(both, "laterals")


N3 = "((CASE WHEN prail > 0 THEN 1 ELSE 0 END) + (CASE WHEN plrt > 0 THEN 1 ELSE 0 END) + (CASE WHEN abs(coalesce(gslope, 0)) >= 0.1 THEN 1 ELSE 0 END))"
COUNTED = "counted AS (SELECT s.id, count(*) AS n FROM site s JOIN lats l ON l.compkey = s.compkey AND s.fm <= l.distfrom AND s.to_ > l.distfrom GROUP BY s.id)"
Q["k18_lateral_cost"] = _lateral_cost
SQL["k18_lateral_cost"] = f"""
WITH {LATERALS}, {COUNTED},
priced AS (SELECT s.id, s.compkey, CAST(5000 AS DOUBLE) * 1.4 * 1.7375 * coalesce(c.n, 0) * (CASE WHEN prail > 0 OR plrt = 1 THEN {POWER.format(n=N3)} ELSE 1 END)
   * (CASE WHEN hardarea = 1 THEN 4 ELSE 1 END) AS amount FROM site s LEFT JOIN counted c ON c.id = s.id)
SELECT id, round(amount, 4) AS laterals FROM priced UNION ALL SELECT w.id, (SELECT round(sum(p.amount), 4) FROM priced p WHERE p.compkey = w.compkey) AS laterals FROM wsite w
"""


def _full(v, name="site"):
    is_whole = name == "wsite"
    out = K.cost_components(v(name), _tables(v), is_whole=is_whole)
    if is_whole:
        out = K.manhole_detail(out, v("mh_sizes"), v("mh_prices"), v("mh_factors"))
    return K.direct_cost(out, is_whole=is_whole)


def _components_sql(src, n, whole):
    """All components of one frame; written from the formulas, one expression each."""
    hazard = "s.xecsi > 0" if whole else "s.xecsi = 1"
    manhole = "coalesce(mh.manhole, 0)" if whole else "0"
    join = "LEFT JOIN mh ON mh.id = s.id" if whole else ""
    difficult = "(CASE WHEN hardarea > 0 OR prail > 0 OR plrt > 0 THEN CAST(1 AS DOUBLE) END)" if whole else DIFFICULT
    z = "((s.udepth + s.ddepth) / 2)"
    return f"""
{_rated_sql(src, n)},
dim{n} AS (SELECT s.*, (SELECT min(t.width) FROM trenches t WHERE t.max_outside >= s.outside) AS w, {z} AS z FROM (SELECT s.*, {OD} AS outside FROM rated{n} s) s),
dig{n} AS (SELECT s.*, z * w / 27 AS v FROM dim{n} s),
parts{n} AS (SELECT s.id, s.compkey, s.length, s.br, s.tr, coalesce({difficult}, 1) AS hard,
   coalesce(s.br * (s.base_hours + s.mob_hours), 0) + coalesce(s.tr * (s.base_hours + s.mob_hours), 0) AS timed,
   coalesce(CASE WHEN z > 18 THEN z * 2 * 2.57 * s.length END, 0)
   + coalesce((SELECT r.cost_per_yard FROM depth_rates r WHERE r.depth >= s.z ORDER BY r.depth LIMIT 1) * v * 1.2 * s.length, 0)
   + coalesce(v * 1.2 * 4.72 * s.length, 0)
   + coalesce(coalesce((SELECT d.factor FROM difficulty d WHERE d.min_diameter <= s.diamwidth AND d.min_depth <= s.z ORDER BY d.min_diameter DESC, d.min_depth DESC LIMIT 1), 1)
       * coalesce((SELECT p.price FROM prices p WHERE p.min_diameter <= s.diamwidth ORDER BY p.min_diameter DESC LIMIT 1), 0) * s.length, 0)
   + coalesce((v - w * ((0.6666667 + outside + 18) / 12) / 27) * s.length * 27.3, 0)
   + coalesce((w * ((outside + 18) / 12) / 27 - (pow(outside, 2) * 12 * (pi() / 4)) / pow(36, 3)) * s.length * 70.55, 0)
   + coalesce(CAST(4 AS DOUBLE) * 4.21 * s.length, 0)
   + coalesce(8.12 * ((w + 1) / 9) * s.length, 0) + coalesce(((w + 1) / 9) * {PATCH} * s.length, 0) + coalesce(((w + 1) * 0.6666667 / 27) * 29.52 * s.length, 0)
   + coalesce(CASE WHEN pwtr > 0 THEN CAST(7.9126 AS DOUBLE) * pwtrmaxd + 74.093 END, 0)
   + 5000 * (coalesce(xsewer, 0) + coalesce(xwtr, 0) + coalesce(xgas, 0) + coalesce(xfiber, 0))
   + coalesce(CASE WHEN {hazard} THEN least(s.length, 50) * v * 50 END, 0)
   + coalesce(CASE WHEN xftezonc > 0 OR xftezonp > 0 THEN CAST(150000 AS DOUBLE) * (coalesce(xftezonc, 0) + coalesce(xftezonp, 0)) * 25 / 43560 END, 0)
   + {manhole} AS fixed FROM dig{n} s {join})
"""


INDEX = "(CAST(9835 AS DOUBLE) / 8090)"
BOTH = f"WITH {MH}, {_components_sql('site', '', False)}, {_components_sql('wsite', '2', True)}"


def _direct(v, *names):
    cols = ["id", *names]
    seg, wholes = _full(v), _full(v, "wsite")
    return K.capital_cost(seg).select(*cols).unionByName(K.capital_cost(wholes).select(*cols))


Q["k19_direct_cost"] = lambda v: rounded(_direct(v, "direct"), ["direct"], 3)
SQL["k19_direct_cost"] = f"""
{BOTH} SELECT id, round(hard * {INDEX} * (timed + fixed), 3) AS direct FROM parts UNION ALL SELECT id, round(hard * {INDEX} * (timed + fixed), 3) AS direct FROM parts2
"""
Q["k20_capital_cost"] = lambda v: rounded(
    _direct(v, "standard_cost", "contingency_cost", "capital"), ["standard_cost", "contingency_cost", "capital"], 3
)
_MARKED = f"""SELECT id, round(hard * {INDEX} * (timed + fixed) * 1.15, 3) AS standard_cost, round(hard * {INDEX} * (timed + fixed) * 1.15 * 1.25, 3) AS contingency_cost,
 round(hard * {INDEX} * (timed + fixed) * 1.15 * 1.25 * 1.39, 3) AS capital FROM """
SQL["k20_capital_cost"] = f"{BOTH} {_MARKED} parts UNION ALL {_MARKED} parts2"


def _lined(v):
    rated = K.mobilization_rate(K.difficult_area(_rated(v, "wsite"), is_whole=True), add_bypass=True)
    return K.liner_cost(rated, v("liner_prices"), v("cleaning_prices"))


def _nonmob(v):
    cols = ["id", "compkey", "type", "capitalnonmobilization", "capitalmobilizationrate"]
    parts = [K.capital_nonmob(_full(v), "Spot"), K.capital_nonmob(_full(v, "wsite"), "Dig"), K.capital_nonmob(_lined(v), "Line")]
    out = parts[0].select(*cols).unionByName(parts[1].select(*cols)).unionByName(parts[2].select(*cols))
    return rounded(out, ["capitalnonmobilization", "capitalmobilizationrate"], 3)


LINER = "(SELECT l.price FROM liner_prices l WHERE l.max_diameter >= w.diamwidth ORDER BY l.max_diameter LIMIT 1) * w.length"
CLEAN = "(SELECT c.price FROM cleaning_prices c WHERE c.max_diameter >= w.diamwidth ORDER BY c.max_diameter LIMIT 1) * w.length"
M3 = "1.15 * 1.25 * 1.39"
Q["k21_capital_nonmob"] = _nonmob
SQL["k21_capital_nonmob"] = f"""
{BOTH} SELECT id, compkey, 'Spot' AS type, round(hard * {INDEX} * fixed * {M3}, 3) AS capitalnonmobilization, round(hard * {INDEX} * coalesce(tr, 0) * {M3}, 3) AS capitalmobilizationrate FROM parts
UNION ALL SELECT id, compkey, 'Dig' AS type, round(hard * {INDEX} * fixed * {M3}, 3) AS capitalnonmobilization, round(hard * {INDEX} * (coalesce(br, 0) + coalesce(tr, 0)) * {M3}, 3) AS capitalmobilizationrate FROM parts2
UNION ALL SELECT p.id, p.compkey, 'Line' AS type, round(p.hard * {INDEX} * (coalesce({LINER}, 0) + coalesce({CLEAN}, 0)) * {M3}, 3) AS capitalnonmobilization,
  round(p.hard * {INDEX} * (coalesce(p.br, 0) + coalesce(p.tr, 0)) * {M3}, 3) AS capitalmobilizationrate FROM parts2 p JOIN wsite w ON w.id = p.id
"""
Q["k22_liner_cost"] = lambda v: _pick(_lined(v), "liner_direct", "liner_capital", digits=3)
_LINER_SUM = f"(p.hard * {INDEX} * (3 * p.tr + 3 * p.br + coalesce({LINER}, 0) + coalesce({CLEAN}, 0)))"
SQL["k22_liner_cost"] = f"{BOTH} SELECT p.id, round({_LINER_SUM}, 3) AS liner_direct, round({_LINER_SUM} * {M3}, 3) AS liner_capital FROM parts2 p JOIN wsite w ON w.id = p.id"

Q["k23_spot_and_line_shims"] = lambda v: rounded(
    K.line_shim(K.spot_shim(v("jobs"))).select("id", "type", "capitalnonmobilization"), ["capitalnonmobilization"], 3
)
SQL["k23_spot_and_line_shims"] = """
SELECT id, type, round(CASE WHEN type = 'Spot' AND cutno > 0 THEN coalesce(capitalnonmobilization, 0) + CASE WHEN diamwidth <= 12 THEN 5121 WHEN diamwidth <= 21 THEN 7058 WHEN diamwidth <= 36 THEN 11280 ELSE 17784 END
  WHEN type = 'Line' AND cutno = 0 THEN coalesce(capitalnonmobilization, 0) * 1.2 ELSE capitalnonmobilization END, 3) AS capitalnonmobilization FROM jobs
"""
Q["k24_simplified_costs"] = lambda v: rounded(K.simplified_costs(v("jobs")), ["total_cost", "build_days"], 3)
SQL["k24_simplified_costs"] = """
SELECT id, compkey, CASE type WHEN 'Spot' THEN 'S' WHEN 'Dig' THEN 'W' ELSE 'L' END AS type,
  round(capitalnonmobilization + capitalmobilizationrate * (mobilizationtime + basetime) / 8, 3) AS total_cost, round((mobilizationtime + basetime) / 8, 3) AS build_days FROM jobs
"""

# --- durations -----------------------------------------------------------------------


def _frame(v):
    return v("site").unionByName(v("wsite"))


def _dims(v):
    return K.pipe_dimensions(_frame(v), v("diameters"), v("trenches"))


FRAME = f"""
frame AS (SELECT s.*, (SELECT min(t.width) FROM trenches t WHERE t.max_outside >= s.outside) AS w, {Z} AS z
   FROM (SELECT s.*, {OD} AS outside FROM (SELECT * FROM site UNION ALL SELECT * FROM wsite) s) s),
base AS (SELECT f.*, CASE WHEN id < 40000000 THEN ((z * w / 27) / 140 + length / 250) * 8 + 0.5 * 8 * (coalesce(xwtr, 0) + coalesce(xgas, 0) + coalesce(xfiber, 0) + coalesce(xsewer, 0)) END AS open_cut,
   CASE WHEN cutno = 0 THEN CAST(8 AS DOUBLE) END AS pipe_burst,
   CASE WHEN id < 40000000 THEN CASE WHEN diamwidth < 24 THEN length / 100 + 16 WHEN diamwidth <= 60 THEN length / 50 + 16 ELSE length / 50 END END AS bore_jack,
   CASE WHEN cutno = 0 THEN CAST(24 AS DOUBLE) END AS cipp,
   CASE WHEN id >= 40000000 THEN CASE WHEN z < 20 THEN CAST(4 AS DOUBLE) ELSE CAST(8 AS DOUBLE) END END AS spot FROM frame f)
"""
Q["k25_base_durations"] = lambda v: _pick(D.base_durations(_dims(v)), "open_cut", "pipe_burst", "bore_jack", "cipp", "spot")
SQL["k25_base_durations"] = f"""
WITH {FRAME} SELECT id, round(open_cut, 4) AS open_cut, pipe_burst, round(bore_jack, 4) AS bore_jack, cipp, spot FROM base
"""
TRAFFIC_HOURS = """
seg_traffic AS (SELECT b.id, b.compkey, CAST(CASE st.street_grp WHEN 'Strt' THEN 1 WHEN 'Art' THEN 2 WHEN 'MajArt' THEN 3 ELSE 0 END AS DOUBLE) AS traffic
   FROM base b JOIN street st ON st.street_number = b.pstrttyp WHERE b.id >= 40000000),
moved AS (SELECT b.*, CASE WHEN b.id >= 40000000 THEN t.traffic ELSE m.traffic END AS traffic,
   CASE WHEN b.z < {trench} AND b.diamwidth <= 15 THEN CAST(4 AS DOUBLE) ELSE CAST(8 AS DOUBLE) END AS bypass,
   CASE WHEN b.cutno = 0 THEN greatest(b.z, 10) / 10 * 8 WHEN b.cutno = 1 THEN (SELECT greatest(q.z, 10) / 10 * 8 FROM base q WHERE q.compkey = b.compkey AND q.cutno = 0) END AS manhole,
   b.lateral_count * ((4 * 10 * b.z) / (27 * 140) + CAST(10 AS DOUBLE) / 250) AS lateral_bypass,
   CASE WHEN b.cutno = 0 THEN b.lateral_count * ((460 * b.z) / (27 * 140)) END AS bore_pit
   FROM base b LEFT JOIN seg_traffic t ON t.id = b.id LEFT JOIN (SELECT compkey, max(traffic) AS traffic FROM seg_traffic GROUP BY compkey) m ON m.compkey = b.compkey)
"""
MOVED = f"{FRAME}, {TRAFFIC_HOURS.format(trench=20)}"
Q["k26_traffic_mobilization"] = lambda v: D.traffic_mobilization(_frame(v), v("street")).select("id", "traffic")
SQL["k26_traffic_mobilization"] = f"WITH {MOVED} SELECT id, traffic FROM moved"
Q["k27_mobilization_durations"] = lambda v: _pick(D.mobilization_durations(_frame(v)), "bypass", "manhole", "lateral_bypass", "bore_pit")
SQL["k27_mobilization_durations"] = f"""
WITH {MOVED} SELECT id, bypass, round(manhole, 4) AS manhole, round(lateral_bypass, 4) AS lateral_bypass, round(bore_pit, 4) AS bore_pit FROM moved
"""
HOURS = ["open_cut", "bore_jack", "bore_pit", "open_cut_total", "bore_jack_total", "cipp_total", "spot_total"]


def _durations(v):
    return D.durations(_dims(v), v("street"), v("wholexp"))


NEED = "((x.udepth + x.ddepth) / 2 > 25 OR x.xbldg > 0 OR x.xlrt > 0 OR x.xrail > 0 OR x.countxfrwy > 0)"
FREE = "((x.udepth + x.ddepth) / 2 <= 25 AND coalesce(x.xbldg, 0) = 0 AND coalesce(x.xlrt, 0) = 0 AND coalesce(x.xrail, 0) = 0 AND coalesce(x.countxfrwy, 0) = 0)"
TIMES = f"""{MOVED},
times AS (SELECT m.id, m.compkey, m.cutno, m.spot, m.cipp, m.traffic, m.bypass, m.manhole, m.lateral_bypass,
   CASE WHEN m.id < 40000000 AND {NEED} THEN NULL ELSE m.open_cut END AS open_cut,
   CASE WHEN m.id < 40000000 AND {NEED} THEN NULL ELSE m.open_cut + m.manhole + m.traffic + m.bypass END AS open_cut_total,
   CASE WHEN m.id < 40000000 AND {FREE} THEN NULL ELSE m.bore_jack END AS bore_jack, CASE WHEN m.id < 40000000 AND {FREE} THEN NULL ELSE m.bore_pit END AS bore_pit,
   CASE WHEN m.cutno <> 0 OR (m.id < 40000000 AND {FREE}) THEN NULL ELSE m.bore_jack + m.traffic + m.bypass + m.lateral_bypass + m.bore_pit END AS bore_jack_total,
   CASE WHEN m.cutno = 0 THEN m.cipp + m.spot + m.traffic + m.bypass + m.lateral_bypass END AS cipp_total, m.spot + m.traffic + m.bypass AS spot_total
   FROM moved m LEFT JOIN wholexp x ON x.compkey = m.compkey)
"""
Q["k28_method_durations"] = lambda v: _pick(_durations(v), *HOURS)
SQL["k28_method_durations"] = f"WITH {TIMES} SELECT id, " + ", ".join(f"round({h}, 4) AS {h}" for h in HOURS) + " FROM times"

# --- windows -------------------------------------------------------------------------

_SOON = "fail_yr_seg <= {s} + 20 AND fail_yr_seg > 0"


def _window_sql(name, source, start):
    soon = _SOON.format(s=start)
    return f"""
{name} AS (SELECT compkey, cutno, 'A' AS w, fail_yr_seg AS y FROM {source} WHERE cutno > 0 AND def_tot >= 1000 AND {soon}
 UNION ALL SELECT compkey, cutno, 'small' AS w, CAST({start} + 21 AS INT) AS y FROM {source} WHERE cutno > 0 AND def_tot < 1000 AND {soon}
 UNION ALL SELECT compkey, cutno, 'B' AS w, fail_yr_seg AS y FROM {source} WHERE cutno > 0 AND fail_yr_seg > {start} + 20 AND fail_yr_seg <= {start} + 40 AND fail_yr_seg > 0
 UNION ALL SELECT compkey, cutno, 'returns' AS w, CAST({start} + 40 AS INT) AS y FROM {source} WHERE cutno > 0 AND def_tot >= 1000 AND {soon})
"""


PRO = _window_sql("pro", "scored", YEAR)
STARTS = f"""
starts AS (SELECT compkey, min(fail_yr_seg) AS s0 FROM scored WHERE cutno > 0 AND def_tot >= 1000 AND {_SOON.format(s=YEAR)} GROUP BY compkey),
own AS (SELECT s.compkey, s.cutno, s.def_tot, s.fail_yr_seg, t.s0 FROM scored s JOIN starts t ON t.compkey = s.compkey)
"""
REA = f"{STARTS}, {_window_sql('rea', 'own', 's0')}"


def _pro(v):
    return W.windows_proactive(v("scored"), YEAR)


def _rea(v):
    return W.windows_reactive(v("scored"), YEAR, hot=v.hot("seg"))


Q["k29_windows_proactive"] = _pro
SQL["k29_windows_proactive"] = f'WITH {PRO} SELECT compkey, cutno, w AS "window", CAST(y AS INT) AS year FROM pro'
Q["k30_windows_reactive"] = _rea
SQL["k30_windows_reactive"] = f'WITH {REA} SELECT compkey, cutno, w AS "window", CAST(y AS INT) AS year FROM rea'


def _action_years(v):
    pro, rea = _pro(v), _rea(v)
    out = None
    for form, windows in (("proactive", pro), ("reactive", rea)):
        years = W.action_years(windows, hot=v.hot("seg")).join(W.window_totals(windows), "compkey", "left").withColumn("form", F.lit(form))
        out = years if out is None else out.unionByName(years)
    return out.withColumns({n: F.col(n).cast("long") for n in ("window_a", "window_b")})


def _years_sql(name, form):
    return f"""
SELECT b.compkey, b.cutno, CAST(b.y AS INT) AS window_b_year, CAST(a.l AS INT) AS line_at_year, CAST(a.l + 60 AS INT) AS replace_at_year, t.window_a, t.window_b, '{form}' AS form
FROM (SELECT * FROM {name} WHERE w <> 'A') b JOIN (SELECT compkey, min(y) AS l FROM {name} WHERE w <> 'A' GROUP BY compkey) a ON a.compkey = b.compkey
LEFT JOIN (SELECT m.compkey, m.n AS window_a, q.n - m.n AS window_b FROM (SELECT compkey, count(*) AS n FROM {name} WHERE w = 'A' GROUP BY compkey) m
   JOIN (SELECT compkey, count(*) AS n FROM {name} WHERE w <> 'A' GROUP BY compkey) q ON q.compkey = m.compkey) t ON t.compkey = b.compkey
"""


Q["k31_action_years"] = _action_years
SQL["k31_action_years"] = f"WITH {PRO}, {REA} {_years_sql('pro', 'proactive')} UNION ALL {_years_sql('rea', 'reactive')}"


def _line_years(v):
    pro = W.line_at_year(_pro(v), YEAR, hot=v.hot("seg")).withColumn("form", F.lit("proactive"))
    return pro.unionByName(W.line_at_year(_rea(v), None, hot=v.hot("seg")).withColumn("form", F.lit("reactive")))


def _line_sql(name, first):
    return f"""
SELECT x.compkey, x.cutno, x.ay, x.byr, m.l FROM (
   SELECT compkey, cutno, y AS ay, CAST(NULL AS INT) AS byr FROM {name} WHERE w = 'A'
   UNION ALL SELECT compkey, cutno, CAST(NULL AS INT) AS ay, y AS byr FROM {name} WHERE w = 'B' AND compkey IN (SELECT compkey FROM {name} WHERE w = 'A')) x
 JOIN (SELECT compkey, min(l) AS l FROM (SELECT compkey, {first} AS l FROM {name} WHERE w = 'A' UNION ALL SELECT compkey, y AS l FROM {name} WHERE w = 'B' AND compkey IN (SELECT compkey FROM {name} WHERE w = 'A')) u GROUP BY compkey) m
 ON m.compkey = x.compkey
"""


LINE_PRO = f"lpro AS ({_line_sql('pro', str(YEAR + 40))})"
LINE_REA = f"lrea AS ({_line_sql('rea', 'y + 40')})"
_LINE_COLS = "compkey, cutno, CAST(ay AS INT) AS window_a_year, CAST(byr AS INT) AS window_b_year, CAST(l AS INT) AS line_at_year"
Q["k32_line_at_year"] = _line_years
SQL["k32_line_at_year"] = f"""
WITH {PRO}, {REA}, {LINE_PRO}, {LINE_REA} SELECT {_LINE_COLS}, 'proactive' AS form FROM lpro UNION ALL SELECT {_LINE_COLS}, 'reactive' AS form FROM lrea
"""


def _hours(v):
    return _durations(v).select("id", "compkey", "cutno", "spot", "cipp", "open_cut", "bore_jack", "bore_pit", "traffic", "bypass", "manhole", "lateral_bypass")


Q["k33_window_spot_durations"] = lambda v: W.window_spot_durations(W.line_at_year(_pro(v), YEAR, hot=v.hot("seg")), _hours(v))
SPOTS = """spots{n} AS (SELECT l.compkey, sum(CASE WHEN ay IS NULL THEN 0 ELSE 1 END * t.spot) AS spot_a, max(CASE WHEN ay IS NULL THEN 0 ELSE 1 END * t.traffic) AS traffic_a,
  max(CASE WHEN ay IS NULL THEN 0 ELSE 1 END * t.bypass) AS bypass_a, sum(CASE WHEN byr IS NULL THEN 0 ELSE 1 END * t.spot) AS spot_b,
  max(CASE WHEN byr IS NULL THEN 0 ELSE 1 END * t.traffic) AS traffic_b, max(CASE WHEN byr IS NULL THEN 0 ELSE 1 END * t.bypass) AS bypass_b
  FROM {src} l JOIN times t ON t.compkey = l.compkey AND t.cutno = l.cutno GROUP BY l.compkey)"""
SQL["k33_window_spot_durations"] = f"WITH {TIMES}, {PRO}, {LINE_PRO}, {SPOTS.format(n='', src='lpro')} SELECT * FROM spots"

ARTERIAL = "(CASE WHEN coalesce(x.countxart, 0) + coalesce(x.countxmjart, 0) > 0 THEN 1 ELSE 0 END)"
Q["k34_job_times"] = lambda v: rounded(
    W.job_times(v("jobs").select("id", "compkey", "type"), _hours(v), v("wholexp")), ["basetime", "mobilizationtime"]
)
SQL["k34_job_times"] = f"""
WITH {TIMES} SELECT j.id, j.compkey, j.type,
  round(CASE j.type WHEN 'Spot' THEN t.spot WHEN 'Line' THEN t.cipp ELSE coalesce(t.open_cut, t.bore_jack) + coalesce(t.bore_pit, 0) END, 4) AS basetime,
  round(CASE j.type WHEN 'Spot' THEN coalesce(t.traffic, 0) + coalesce(t.bypass, 0) WHEN 'Line' THEN {ARTERIAL} * t.lateral_bypass + coalesce(t.traffic, 0) + coalesce(t.bypass, 0)
    ELSE coalesce(t.traffic, 0) + coalesce(t.bypass, 0) + CASE WHEN t.open_cut IS NULL THEN 0 ELSE coalesce(t.lateral_bypass, 0) END END, 4) AS mobilizationtime
FROM jobs j JOIN times t ON t.id = j.id LEFT JOIN wholexp x ON x.compkey = j.compkey AND j.type = 'Line'
"""


def _final(v):
    # As in the full run, what both forms read several times is made once.
    hours, xp = cut_lineage(_hours(v)), v("wholexp")
    scored = cut_lineage(v("scored").select("compkey", "cutno", "fail_yr_seg", "def_tot"))
    hot = hot_keys(scored, ["compkey"])
    pro, rea = W.windows_proactive(scored, YEAR), W.windows_reactive(scored, YEAR, hot=hot)
    a = W.final_times(pro, W.line_at_year(pro, YEAR, hot=hot), hours, xp).withColumn("form", F.lit("proactive"))
    b = W.final_times(rea, W.line_at_year(rea, None, hot=hot), hours, xp).withColumn("form", F.lit("reactive"))
    return rounded(a.unionByName(b), ["spot_time_a", "line_time_b", "whole_time", "line_time_a"])


def _final_sql(form, n, name):
    def lined(k):
        return f"""coalesce(t.cipp, 0) + coalesce(p.spot_{k}, 0) + coalesce(CASE WHEN t.traffic > p.traffic_{k} THEN t.traffic ELSE p.traffic_{k} END, 0)
 + coalesce(CASE WHEN t.bypass > p.bypass_{k} THEN t.bypass ELSE p.bypass_{k} END, 0) + coalesce(t.lateral_bypass * {ARTERIAL}, 0)"""

    return f"""
SELECT p.compkey, round(coalesce(p.spot_a, 0) + coalesce(p.traffic_a, 0) + coalesce(p.bypass_a, 0), 4) AS spot_time_a, round({lined('b')}, 4) AS line_time_b,
  round(coalesce(t.open_cut, t.bore_jack) + coalesce(t.manhole, 0) + coalesce(t.traffic, 0) + coalesce(t.bypass, 0) + coalesce(t.bore_pit, 0)
    + CASE WHEN t.open_cut IS NULL THEN 0 ELSE coalesce(t.lateral_bypass, 0) END, 4) AS whole_time, round({lined('a')}, 4) AS line_time_a, '{form}' AS form
FROM spots{n} p JOIN times t ON t.compkey = p.compkey AND t.cutno = 0 LEFT JOIN wholexp x ON x.compkey = p.compkey
WHERE p.compkey IN (SELECT compkey FROM {name} WHERE w = 'A') AND p.compkey IN (SELECT compkey FROM {name} WHERE w <> 'A')
"""


Q["k35_final_times"] = _final
SQL["k35_final_times"] = f"""
WITH {TIMES}, {PRO}, {REA}, {LINE_PRO}, {LINE_REA}, {SPOTS.format(n='', src='lpro')}, {SPOTS.format(n='2', src='lrea')}
{_final_sql('proactive', '', 'pro')} UNION ALL {_final_sql('reactive', '2', 'rea')}
"""

# --- costs on both grains ------------------------------------------------------------

_COSTS = ["replacecost", "linercost", "lateral_total", "line_total"]


def _applied(v):
    simple = K.simplified_costs(v("jobs"))
    return K.apply_costs(v("scored"), v("pipe").drop("action"), simple, _laterals(v))


def _apply_rows(v):
    seg, pipes = _applied(v)
    cols = ["id", "lateral_count", *_COSTS]
    empty = {n: F.lit(None).cast("double") for n in ("replace_total", "spot_total", "spot_sum")}
    out = seg.select(*cols).withColumns(empty).unionByName(pipes.select(*cols, *empty))
    return rounded(out, [*_COSTS, *empty], 3)


APPLIED = f"""{LATERALS}, counted AS (SELECT s.id, count(*) AS n FROM scored s JOIN lats l ON l.compkey = s.compkey AND s.fm <= l.distfrom AND s.to_ > l.distfrom GROUP BY s.id),
simple AS (SELECT id, type, capitalnonmobilization + capitalmobilizationrate * (mobilizationtime + basetime) / 8 AS c FROM jobs),
sc AS (SELECT s.id, s.compkey, s.cutno, s.spot_count, s.action, s.cof, j.c AS replacecost, s.linercost, CAST(coalesce(k.n, 0) AS BIGINT) AS lateral_count, CAST(5000 AS DOUBLE) * 1.4 * 1.7375 * coalesce(k.n, 0) AS lat
   FROM scored s JOIN simple j ON j.id = s.id AND j.type = 'Spot' LEFT JOIN counted k ON k.id = s.id),
pc AS (SELECT p.id, p.compkey, w.c AS replacecost, l.c AS linercost, CAST(coalesce(k.n, 0) AS BIGINT) AS lateral_count, CAST(5000 AS DOUBLE) * 1.4 * 1.7375 * coalesce(k.n, 0) AS lat, q.spot_sum
   FROM pipe p JOIN simple w ON w.id = p.id AND w.type = 'Dig' JOIN simple l ON l.id = p.id AND l.type = 'Line'
   LEFT JOIN (SELECT compkey, count(*) AS n FROM lats GROUP BY compkey) k ON k.compkey = p.compkey
   LEFT JOIN (SELECT compkey, sum(replacecost * spot_count) AS spot_sum FROM sc WHERE spot_count = 1 AND cutno > 0 GROUP BY compkey) q ON q.compkey = p.compkey)
"""
Q["k36_apply_costs"] = _apply_rows
SQL["k36_apply_costs"] = f"""
WITH {APPLIED}
SELECT id, lateral_count, round(replacecost, 3) AS replacecost, round(linercost, 3) AS linercost, round(lat, 3) AS lateral_total, round(linercost + lat, 3) AS line_total,
  CAST(NULL AS DOUBLE) AS replace_total, CAST(NULL AS DOUBLE) AS spot_total, CAST(NULL AS DOUBLE) AS spot_sum FROM sc
UNION ALL SELECT id, lateral_count, round(replacecost, 3) AS replacecost, round(linercost, 3) AS linercost, round(lat, 3) AS lateral_total, round(linercost + lat, 3) AS line_total,
  round(replacecost + lat, 3) AS replace_total, round(spot_sum + lat, 3) AS spot_total, round(spot_sum, 3) AS spot_sum FROM pc
"""


def _finished(v):
    # Scores, jobs, sites and manholes all read the segments: one copy serves them, with the columns that are read.
    seg = ["id", "compkey", "cutno", "fm", "to_", "length", "diamwidth", "replacecost"]
    v.written_once("scored", only=[*seg, "action", "spot_count", "linercost"])
    v.read_from("seg", "scored", seg)
    seg, pipes = _applied(v)
    manholes = _manhole_whole(v).select("id", "manhole").unionByName(
        v("site").filter("cutno = 1").select("id", F.col("length").alias("manhole"))
    )
    priced = seg.withColumns({"spotcost": F.col("replacecost") * 0.25, "spot_total": F.col("replacecost") * 0.5})
    seg, pipes = K.finish_costs(priced, pipes, manholes)
    cols = ["id", "manhole_cost", "linercost", "line_total", "spot_total"]
    return rounded(seg.select(*cols).unionByName(pipes.select(*cols)), cols[1:], 3, NUDGE)


Q["k37_finish_costs"] = _finished
SQL["k37_finish_costs"] = f"""
WITH {MH}, {APPLIED}
SELECT s.id, CASE WHEN s.cutno = 1 THEN t.length END AS manhole_cost, round(CASE WHEN s.action = 3 THEN s.linercost + s.replacecost ELSE s.linercost END + 0.0000001, 3) AS linercost,
  round(s.linercost + s.lat + s.replacecost * 0.25 - s.lat * s.spot_count + 0.0000001, 3) AS line_total, round(s.replacecost * 0.5 * s.spot_count + 0.0000001, 3) AS spot_total
FROM sc s JOIN site t ON t.id = s.id
UNION ALL
SELECT p.id, round(m.manhole + 0.0000001, 3) AS manhole_cost, round(CASE WHEN a.compkey IS NOT NULL THEN p.linercost + a.spots ELSE p.linercost END + 0.0000001, 3) AS linercost,
  round(CASE WHEN b.compkey IS NOT NULL THEN p.linercost + p.lat + b.spotcost - b.lats ELSE p.linercost + p.lat END + 0.0000001, 3) AS line_total,
  round(CASE WHEN h.compkey IS NOT NULL THEN h.totals ELSE p.spot_sum + p.lat END + 0.0000001, 3) AS spot_total
FROM pc p LEFT JOIN (SELECT compkey, sum(replacecost * 0.5 * spot_count * spot_count) AS totals FROM sc GROUP BY compkey) h ON h.compkey = p.compkey JOIN mh m ON m.id = p.id LEFT JOIN (SELECT compkey, sum(replacecost) AS spots FROM sc WHERE compkey > 0 AND action = 3 GROUP BY compkey) a ON a.compkey = p.compkey
LEFT JOIN (SELECT compkey, sum(lat * spot_count) AS lats, sum(replacecost * 0.25 * spot_count) AS spotcost FROM sc WHERE compkey > 0 GROUP BY compkey) b ON b.compkey = p.compkey
"""

# --- desktop form --------------------------------------------------------------------

Q["g1_sizes"] = lambda v: K.pipe_dimensions(v("wsite"), v("diameters"), v("trenches")).select("id", "outside", "trench_width")
SQL["g1_sizes"] = f"""
SELECT s.id, s.outside, (SELECT min(t.width) FROM trenches t WHERE t.max_outside >= s.outside) AS trench_width FROM (SELECT s.*, {OD} AS outside FROM wsite s) s
"""
Q["g2_excavation_rate"] = lambda v: K.ceiling_lookup(
    v("wsite"), K.mean_depth(), v("depth_rates"), "depth", {"cost_per_yard": "rate"}
).select("id", "rate")
SQL["g2_excavation_rate"] = f"SELECT s.id, (SELECT r.cost_per_yard FROM depth_rates r WHERE {Z} <= r.depth ORDER BY r.depth LIMIT 1) AS rate FROM wsite s"
Q["g3_pipe_price_and_difficulty"] = lambda v: K.pipe_material(v("wsite"), v("prices"), v("difficulty")).select("id", "pipe_price", "depth_factor")
SQL["g3_pipe_price_and_difficulty"] = f"WITH vol AS (SELECT s.*, {Z} AS z FROM wsite s) SELECT id, {PRICE} AS pipe_price, {HARD} AS depth_factor FROM vol"
Q["g4_manhole_detail"] = lambda v: _pick(_manhole_whole(v), "manhole")
SQL["g4_manhole_detail"] = f"WITH {MH} SELECT id, round(manhole, 4) AS manhole FROM mh"
Q["g5_bypass_rate"] = lambda v: K.bypass_rate(v("wsite"), v("bypass_rates")).select("id", F.round("bypass_flow", 6).alias("bypass_flow"), "bypass_rate")
SQL["g5_bypass_rate"] = f"WITH {_rated_sql('wsite')} SELECT id, round(flow, 6) AS bypass_flow, br AS bypass_rate FROM rated"
Q["g6_traffic_rate"] = lambda v: K.traffic_rate(v("wsite")).select("id", "traffic_rate")
SQL["g6_traffic_rate"] = f"SELECT s.id, {TRAFFIC} AS traffic_rate FROM wsite s"
Q["g7_patch_rate"] = lambda v: v("wsite").select("id", K.patch_rate().alias("rate"))
SQL["g7_patch_rate"] = f"SELECT id, CAST({PATCH} AS DOUBLE) AS rate FROM wsite"


def _desktop(v):
    unit = P.UnitCosts(crossing=4000.0, saw_cost=5.0)
    out = K.manhole_detail(K.cost_components(v("wsite"), _tables(v), unit, is_whole=True), v("mh_sizes"), v("mh_prices"), v("mh_factors"))
    return _pick(K.capital_cost(K.direct_cost(out, unit, is_whole=True), P.DESKTOP_MARKUPS), "direct", "capital", digits=3)


_DESKTOP_DIRECT = f"hard * {INDEX} * (timed + fixed - CAST(1000 AS DOUBLE) * x.n + CAST(4 AS DOUBLE) * 0.79 * p.length)"
Q["g8_cost_components"] = _desktop
SQL["g8_cost_components"] = f"""
{BOTH} SELECT p.id, round({_DESKTOP_DIRECT}, 3) AS direct, round({_DESKTOP_DIRECT} * 1.15 * 1.25 * 1.48, 3) AS capital
FROM parts2 p JOIN (SELECT id, coalesce(xsewer, 0) + coalesce(xwtr, 0) + coalesce(xgas, 0) + coalesce(xfiber, 0) AS n FROM wsite) x ON x.id = p.id
"""
DESK_HOURS = ["open_cut", "bore_jack", "open_cut_total", "bore_jack_total", "cipp_total", "spot_total"]
DESK = P.TimeRates(shallow_trench=1.0, bore_depth=18.0)
Q["g9_durations"] = lambda v: _pick(
    D.durations(_dims(v).withColumn("countxfrwy", F.col("xfrwy")), v("street"), rates=DESK, null_as_zero=True), *DESK_HOURS
)
_C = "coalesce({0}, 0)"
_DNEED = "(cutno = 0 AND (z > 18 OR xbldg > 0 OR xlrt > 0 OR xrail > 0 OR xfrwy > 0))"
_DFREE = "(cutno = 0 AND z <= 18 AND xbldg = 0 AND xlrt = 0 AND xrail = 0 AND xfrwy = 0)"
SQL["g9_durations"] = f"""
WITH {FRAME}, {TRAFFIC_HOURS.format(trench=1)},
t AS (SELECT *, CASE WHEN cutno = 0 THEN coalesce(open_cut, 0) + coalesce(manhole, 0) + coalesce(traffic, 0) + coalesce(bypass, 0) END AS oc,
  CASE WHEN cutno = 0 THEN coalesce(bore_jack, 0) + coalesce(traffic, 0) + coalesce(bypass, 0) + coalesce(lateral_bypass, 0) + coalesce(bore_pit, 0) END AS bj FROM moved)
SELECT id, CASE WHEN {_DNEED} OR oc = 0 THEN NULL ELSE round(open_cut, 4) END AS open_cut, CASE WHEN {_DFREE} OR bore_jack = 0 THEN NULL ELSE round(bore_jack, 4) END AS bore_jack,
  CASE WHEN {_DNEED} OR oc = 0 THEN NULL ELSE round(oc, 4) END AS open_cut_total, CASE WHEN {_DFREE} OR bore_jack = 0 THEN NULL ELSE round(bj, 4) END AS bore_jack_total,
  CASE WHEN cutno = 0 THEN round(coalesce(cipp, 0) + coalesce(spot, 0) + coalesce(traffic, 0) + coalesce(bypass, 0) + coalesce(lateral_bypass, 0), 4) END AS cipp_total,
  round(coalesce(spot, 0) + coalesce(traffic, 0) + coalesce(bypass, 0), 4) AS spot_total FROM t
"""
