"""Registered queries of inspection choice, scores, material and remaining life."""

from __future__ import annotations

from pyspark.sql import functions as F

from mainstay.checks.common import AS_OF, Query, YEAR, rounded
from mainstay.operators import condition as C
from mainstay.operators import material as M

Q: dict[str, Query] = {}
SQL: dict[str, str] = {}

STRUCTURAL = ["BP", "BRK", "CR", "DS"]


def _hot(v, name="seg"):
    return v.hot(name)


def _codes(v):
    wanted = C.resolve_codes(v("obs"), "obcode", "obsevkey", ["bp", "Brk"])
    return v("obs").join(wanted, "obsevkey", "left_semi").groupBy("obsevkey").agg(F.count(F.lit(1)).alias("rows"))


Q["d1_resolve_codes"] = _codes
SQL["d1_resolve_codes"] = """
SELECT obsevkey, count(*) AS rows FROM obs WHERE obsevkey IN (SELECT obsevkey FROM obs WHERE lower(obcode) = 'bp' OR lower(obcode) = 'brk') GROUP BY obsevkey
"""

Q["d2_service_status"] = lambda v: C.with_service_status(
    v("whole").select("compkey", "hservstat"), v("sanitary"), v("storm"), _hot(v, "whole")
)
SQL["d2_service_status"] = """
SELECT w.compkey, CASE WHEN t.compkey IS NOT NULL THEN t.servstat WHEN s.compkey IS NOT NULL THEN s.servstat ELSE w.hservstat END AS hservstat
FROM whole w LEFT JOIN sanitary s ON s.compkey = w.compkey LEFT JOIN storm t ON t.compkey = w.compkey
"""


def _valid(v, asset, subset=None):
    return C.valid_inspections(
        v(asset).select("compkey", "own", "unittype", "servstat"), v("insp"), v("obs"), v("idx"), STRUCTURAL, AS_OF, subset
    )


_VALID_COLUMNS = ["compkey", "inspkey", "obskey", "newscore", "distfrom", "distto", "startdttm", "compdttm", "rating", "servstat"]
Q["d3_valid_inspections"] = lambda v: _valid(v, "sanitary", v("seg")).select(*_VALID_COLUMNS)
SQL["d3_valid_inspections"] = """
SELECT i.compkey, i.inspkey, o.obskey, CASE WHEN o.obcode IN ('BP', 'BRK', 'CR', 'DS') THEN CAST(o.obrating AS DOUBLE) ELSE 0 END AS newscore,
       o.distfrom, o.distto, i.startdttm, i.compdttm, x.rating, a.servstat
FROM sanitary a JOIN insp i ON i.compkey = a.compkey JOIN obs o ON o.inspkey = i.inspkey JOIN idx x ON x.inspkey = i.inspkey
WHERE i.startdttm <= DATE '2024-01-20' AND i.compkey IN (SELECT compkey FROM seg)
"""

Q["d4_latest_observations"] = lambda v: C.latest_observations(
    _valid(v, "sanitary", v("seg")), _valid(v, "storm")
).select("compkey", "inspkey", "obskey", "newscore", "distfrom", "distto", "startdttm")
SQL["d4_latest_observations"] = """
WITH valid AS (
  SELECT k.kind, i.compkey, i.inspkey, o.obskey, CASE WHEN o.obcode IN ('BP', 'BRK', 'CR', 'DS') THEN CAST(o.obrating AS DOUBLE) ELSE 0 END AS newscore,
         o.distfrom, o.distto, i.startdttm
  FROM (SELECT 'a' AS kind, compkey FROM sanitary UNION ALL SELECT 'b' AS kind, compkey FROM storm) k
  JOIN insp i ON i.compkey = k.compkey JOIN obs o ON o.inspkey = i.inspkey JOIN idx x ON x.inspkey = i.inspkey
  WHERE i.startdttm <= DATE '2024-01-20' AND (k.kind = 'b' OR i.compkey IN (SELECT compkey FROM seg)))
SELECT compkey, inspkey, obskey, newscore, distfrom, distto, startdttm FROM valid
QUALIFY startdttm = max(startdttm) OVER (PARTITION BY kind, compkey)
"""


def _latest(v):
    return C.observations_of_latest(v("insp"), v("obs"), _hot(v, "insp"))


def _points(v):
    return C.point_defect_scores(v("seg"), _latest(v), v("peak"), _hot(v))


def _lines(v):
    return C.linear_defect_scores(v("seg"), _latest(v), v("peak"), _hot(v))


POINTS_SQL = """
SELECT s.id, s.compkey, s.cutno, coalesce(sum(p.peak_score), 0) AS point_score
FROM latest l JOIN seg s ON s.compkey = l.compkey JOIN peak p ON p.obsevkey = l.obsevkey
WHERE (s.cutno = s.seg_count AND l.distfrom >= s.fm)
   OR (l.distfrom >= s.fm AND l.distfrom < s.to_ AND (l.distto IS NULL OR l.distto = 0 OR l.distto = l.distfrom))
GROUP BY s.id, s.compkey, s.cutno
"""
LINES_SQL = """
SELECT s.id, s.compkey, s.cutno, sum(p.peak_score * CASE
         WHEN s.fm >= l.distfrom AND s.to_ <= l.distto THEN s.length
         WHEN s.fm < l.distfrom AND s.to_ > l.distto THEN l.distto - l.distfrom
         WHEN s.to_ > l.distto THEN l.distto - s.fm
         WHEN s.fm < l.distfrom THEN s.to_ - l.distfrom ELSE 0 END) AS linear_score
FROM latest l JOIN seg s ON s.compkey = l.compkey JOIN peak p ON p.obsevkey = l.obsevkey
WHERE (s.fm BETWEEN l.distfrom AND l.distto) OR (s.to_ BETWEEN l.distfrom AND l.distto) OR (s.fm <= l.distfrom AND s.to_ >= l.distto)
GROUP BY s.id, s.compkey, s.cutno
"""

Q["d5_point_defect_scores"] = _points
SQL["d5_point_defect_scores"] = POINTS_SQL
Q["d6_linear_defect_scores"] = _lines
SQL["d6_linear_defect_scores"] = LINES_SQL


def _apply(v):
    cols = ["id", "compkey", "point_score", "linear_score", "total_score"]
    points, lines = _points(v), _lines(v)
    segs = C.apply_scores(v("seg"), points, lines)
    wholes = C.apply_scores_whole(v("whole"), points, lines)
    return segs.select(*cols).unionByName(wholes.select(*cols))


Q["d7_apply_scores"] = _apply
SQL["d7_apply_scores"] = f"""
WITH pts AS ({POINTS_SQL}), lin AS ({LINES_SQL}),
both_grains AS (
  SELECT s.id, s.compkey, coalesce(p.point_score, 0) AS p, coalesce(l.linear_score, 0) AS l FROM seg s LEFT JOIN pts p ON p.id = s.id LEFT JOIN lin l ON l.id = s.id
  UNION ALL
  SELECT w.id, w.compkey, coalesce((SELECT sum(p.point_score) FROM pts p WHERE p.compkey = w.compkey), 0) AS p,
         coalesce((SELECT sum(l.linear_score) FROM lin l WHERE l.compkey = w.compkey), 0) AS l FROM whole w)
SELECT id, compkey, CAST(p AS DOUBLE) AS point_score, CAST(l AS DOUBLE) AS linear_score, CAST(p + l AS DOUBLE) AS total_score FROM both_grains
"""


def _inspected(v):
    latest = _latest(v).withColumnRenamed("obrating", "rating")
    seg = v("seg").join(v("whole").select("compkey", "instdate", "hservstat"), "compkey")
    return C.inspection_flag(C.inspection_recency(seg, latest, YEAR, _hot(v)))


Q["d8_inspection_recency"] = lambda v: C.inspection_recency(
    v("seg").select("id", "compkey"), _latest(v).withColumnRenamed("obrating", "rating"), YEAR, _hot(v)
)
SQL["d8_inspection_recency"] = """
SELECT s.id, s.compkey, l.d AS last_inspection, CAST(l.g AS INT) AS rating, CAST(2024 - year(l.d) AS INT) AS years_since
FROM seg s LEFT JOIN (SELECT compkey, max(startdttm) AS d, max(rating) AS g FROM latest GROUP BY compkey) l ON l.compkey = s.compkey
"""


def _flagged(v):
    # Dates moved back put inspections on both sides of the install dates.
    seg = v("seg").join(v("whole").select("compkey", "instdate", "hservstat"), "compkey")
    latest = _latest(v).withColumnRenamed("obrating", "rating").withColumn(
        "startdttm", F.add_months("startdttm", -(F.col("compkey") % 30).cast("int") * 12)
    )
    return C.inspection_flag(C.inspection_recency(seg, latest, YEAR, _hot(v)))


FLAG_SQL = """
SELECT s.id, s.compkey, s.cutno, w.hservstat, w.instdate, l.d AS last_inspection, l.g AS rating, CAST(CASE WHEN l.d IS NULL THEN 4 WHEN w.instdate > l.d THEN 3
         WHEN w.instdate IS NULL AND w.hservstat IN ('TBAB', 'ABAN') THEN 2
         WHEN l.d >= w.instdate OR w.instdate IS NULL OR w.hservstat = 'PEND' THEN 1 END AS INT) AS insp_curr
FROM seg s JOIN whole w ON w.compkey = s.compkey
LEFT JOIN (SELECT compkey, CAST(max(startdttm - to_months(CAST(12 * (compkey % 30) AS INT))) AS DATE) AS d, max(rating) AS g FROM latest GROUP BY compkey) l ON l.compkey = s.compkey
"""
Q["d9_inspection_flag"] = lambda v: _flagged(v).select("id", "insp_curr")
SQL["d9_inspection_flag"] = f"SELECT id, insp_curr FROM ({FLAG_SQL}) x"


def _stale(v):
    seg = C.clear_stale_rating(_flagged(v))
    wholes = C.whole_takes_segment_flags(v("whole").select("id", "compkey"), seg)
    return seg.select("id", "insp_curr", "rating").unionByName(wholes.select("id", "insp_curr", "rating"))


Q["d10_clear_stale_rating"] = _stale
SQL["d10_clear_stale_rating"] = f"""
WITH f AS (SELECT id, compkey, insp_curr, CAST(CASE WHEN insp_curr = 4 THEN 0 ELSE rating END AS INT) AS rating FROM ({FLAG_SQL}) x)
SELECT id, insp_curr, rating FROM f UNION ALL
SELECT w.id, g.insp_curr, g.rating FROM whole w LEFT JOIN (SELECT compkey, max(insp_curr) AS insp_curr, max(rating) AS rating FROM f GROUP BY compkey) g ON g.compkey = w.compkey
"""

Q["d11_remaining_years"] = lambda v: C.remaining_years(v("scored"), v("rosetta"), v("bands"), "def_tot").select("id", "years")
SQL["d11_remaining_years"] = """
SELECT s.id, CAST(trunc(b.yearstofailure) AS INT) AS years
FROM scored s JOIN rosetta r ON lower(r.category) = lower(s.material)
JOIN bands b ON b.curve = r.curve AND b.score_lower_bound <= s.def_tot AND s.def_tot < b.score_upper_bound
"""


def _life(v):
    years = C.remaining_years(v("scored").select("id", "material", "def_tot"), v("rosetta"), v("bands"), "def_tot").select("id", "years")
    joined = _flagged(v).join(years, "id", "left")
    return rounded(C.failure_year(joined).select("id", "failure_year", "std_dev"), ["std_dev"])


Q["d12_failure_year"] = _life
SQL["d12_failure_year"] = f"""
WITH y AS (SELECT s.id, CAST(trunc(b.yearstofailure) AS INT) AS years FROM scored s JOIN rosetta r ON r.category = s.material
             JOIN bands b ON b.curve = r.curve WHERE s.def_tot >= b.score_lower_bound AND s.def_tot < b.score_upper_bound)
SELECT f.id, CAST(CASE WHEN f.insp_curr IN (1, 2) THEN year(f.last_inspection) + y.years END AS INT) AS failure_year,
  CASE WHEN f.insp_curr IN (1, 2) AND y.years IS NOT NULL THEN round(greatest(CAST(5 AS DOUBLE), CAST(0.1 AS DOUBLE) * y.years + CAST(0.25 AS DOUBLE) * (2024 - year(f.last_inspection))), 4) END AS std_dev
FROM ({FLAG_SQL}) f LEFT JOIN y ON y.id = f.id
"""

# --- material ------------------------------------------------------------------------

_STRADDLE = """((s.fm >= c.distfrom AND s.to_ <= c.distto) OR (s.fm <= c.distfrom AND s.to_ >= c.distfrom) OR (s.fm <= c.distto AND s.to_ >= c.distto))"""
_TOUCH = f"""
touch AS (SELECT s.id, s.compkey, s.fm, s.to_, c.distfrom, c.distto, c.chdetail FROM seg s JOIN chg c ON c.compkey = s.compkey
  WHERE s.material = 'VARIES' AND c.chtype = 'MATERIAL' AND {_STRADDLE}),
held AS (SELECT DISTINCT compkey FROM touch WHERE chdetail = 'MAT-VSP')
"""
_TOUCH_COLUMNS = ["id", "compkey", "distfrom", "distto", "chdetail"]

Q["d13_varies_and_changes"] = lambda v: (
    M.varies_segments(v("seg")).groupBy("compkey").agg(F.count(F.lit(1)).alias("cuts"))
    .join(M.material_changes(v("chg")).groupBy("compkey").agg(F.count(F.lit(1)).alias("changes")), "compkey")
)
SQL["d13_varies_and_changes"] = """
SELECT s.compkey, s.cuts, c.changes FROM (SELECT compkey, count(*) AS cuts FROM seg WHERE material ILIKE 'varies' GROUP BY compkey) s
JOIN (SELECT compkey, count(*) AS changes FROM chg WHERE chtype ILIKE 'material' GROUP BY compkey) c ON c.compkey = s.compkey
"""
Q["d14_segments_with_material"] = lambda v: M.segments_with_material(v("seg"), v("chg"), hot=_hot(v, "chg")).select(*_TOUCH_COLUMNS)
SQL["d14_segments_with_material"] = f"WITH {_TOUCH} SELECT id, compkey, distfrom, distto, chdetail FROM touch WHERE chdetail = 'MAT-VSP'"
Q["d15_patch_segments"] = lambda v: M.patch_segments(v("seg"), v("chg"), hot=_hot(v, "chg")).select(*_TOUCH_COLUMNS)
SQL["d15_patch_segments"] = f"""
WITH {_TOUCH} SELECT id, compkey, distfrom, distto, chdetail FROM touch WHERE chdetail <> 'MAT-VSP' AND compkey IN (SELECT compkey FROM held)
"""
Q["d16_pipes_without_material"] = lambda v: M.pipes_without_material(v("seg"), v("chg"), hot=_hot(v, "chg"))
SQL["d16_pipes_without_material"] = f"""
WITH {_TOUCH} SELECT s.compkey FROM seg s LEFT JOIN held h ON h.compkey = s.compkey WHERE h.compkey IS NULL AND s.material = 'VARIES' GROUP BY s.compkey
"""
Q["d17_other_material_segments"] = lambda v: M.other_material_segments(v("seg"), v("chg"), hot=_hot(v, "chg")).select(*_TOUCH_COLUMNS)
SQL["d17_other_material_segments"] = f"""
WITH {_TOUCH} SELECT id, compkey, distfrom, distto, chdetail FROM touch WHERE compkey NOT IN (SELECT compkey FROM held)
"""
Q["d18_dominant_material"] = lambda v: M.dominant_material(v("chg"))
SQL["d18_dominant_material"] = """
SELECT compkey, chdetail, total_length FROM (SELECT compkey, chdetail, sum(abs(distto - distfrom)) AS total_length FROM chg WHERE chtype = 'MATERIAL' GROUP BY compkey, chdetail) x
QUALIFY rank() OVER (PARTITION BY compkey ORDER BY total_length DESC) = 1
"""
Q["d19_stamp_material"] = lambda v: M.stamp_material(v("seg"), v("chg"), hot=_hot(v, "chg")).select("id", "material")
SQL["d19_stamp_material"] = f"""
WITH {_TOUCH},
tot AS (SELECT compkey, chdetail, sum(abs(distto - distfrom)) AS len FROM chg WHERE chtype = 'MATERIAL' GROUP BY compkey, chdetail),
dom AS (SELECT t.compkey, t.chdetail FROM tot t JOIN (SELECT compkey, max(len) AS len FROM tot GROUP BY compkey) m ON m.compkey = t.compkey AND m.len = t.len),
patch AS (SELECT id, min(chdetail) AS d FROM touch WHERE chdetail <> 'MAT-VSP' AND compkey IN (SELECT compkey FROM held) GROUP BY id),
prim AS (SELECT t.id, min(t.chdetail) AS d FROM touch t JOIN dom m ON m.compkey = t.compkey AND m.chdetail = t.chdetail WHERE t.compkey NOT IN (SELECT compkey FROM held) GROUP BY t.id),
oth AS (SELECT id, min(chdetail) AS d FROM touch WHERE compkey NOT IN (SELECT compkey FROM held) GROUP BY id)
SELECT s.id, CASE WHEN s.material <> 'VARIES' THEN s.material WHEN p.id IS NOT NULL THEN '2_' || replace(p.d, 'MAT-', '')
   WHEN q.id IS NOT NULL THEN '1_' || replace(q.d, 'MAT-', '') WHEN o.id IS NOT NULL THEN '2_' || replace(o.d, 'MAT-', '') ELSE s.material END AS material
FROM seg s LEFT JOIN patch p ON p.id = s.id LEFT JOIN prim q ON q.id = s.id LEFT JOIN oth o ON o.id = s.id
"""
