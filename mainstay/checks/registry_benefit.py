"""Registered queries of the benefit-cost ratios, the choice of a method and the final tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from mainstay import params as P
from mainstay.checks.common import NUDGE, Query, YEAR, rounded
from mainstay.checks.registry_lifespan import RISK_SQL
from mainstay.operators import benefit as B
from mainstay.operators import decision as D
from mainstay.operators.lifespan import risk_multiplier, with_risk_table

Q: dict[str, Query] = {}
SQL: dict[str, str] = {}


def _branches(v):
    return B.branches(v("pipe"))


BRANCH = "br AS (SELECT compkey, fail_yr AS f, std_dev AS sd, replacecost AS r, spotcost, line_alone AS linecost FROM pipe WHERE cutno = 0)"
Q["b1_branches"] = lambda v: rounded(_branches(v), ["replacecost", "spotcost", "linecost"], 3, NUDGE)
SQL["b1_branches"] = """
SELECT compkey, fail_yr AS first_failure, std_dev, round(replacecost + 0.0000001, 3) AS replacecost, round(spotcost + 0.0000001, 3) AS spotcost,
  round(line_alone + 0.0000001, 3) AS linecost, CAST(NULL AS VARCHAR) AS problems FROM pipe WHERE cutno = 0
"""
Q["b2_surcharged"] = lambda v: B.surcharged(v("surch"), 4.0).withColumn("feet", F.lit(4)).unionByName(
    B.surcharged(v("surch"), 3.0).withColumn("feet", F.lit(3))
)
SQL["b2_surcharged"] = """
SELECT DISTINCT compkey, CAST(4 AS INT) AS feet FROM surch WHERE try_cast(ussurch AS DOUBLE) >= 4
UNION ALL SELECT DISTINCT compkey, CAST(3 AS INT) AS feet FROM surch WHERE try_cast(ussurch AS DOUBLE) >= 3
"""


def _fraction(v, severities):
    return B.defect_fraction(v("insp"), v("obs"), v("seg"), v("whole"), severities, hot=v.hot("insp"))


def _fraction_sql(severities):
    return f"""
SELECT x.compkey, x.len AS defect_length, w.length, x.len / w.length AS fraction FROM (
  SELECT compkey, sum(len) AS len FROM (
    SELECT s.id, s.compkey, max(CASE WHEN o.distto - o.distfrom < 10 THEN 10 ELSE o.distto - o.distfrom END) AS len
    FROM (SELECT i.inspkey, i.compkey, rank() OVER (PARTITION BY i.compkey ORDER BY i.compdttm DESC NULLS LAST) AS place FROM insp i WHERE EXISTS (SELECT 1 FROM obs q WHERE q.inspkey = i.inspkey)) r
    JOIN obs o ON o.inspkey = r.inspkey AND o.severity IN {severities}
    JOIN seg s ON s.compkey = r.compkey AND s.fm <= o.distfrom AND s.to_ > o.distfrom
    WHERE r.place = 1 AND s.remarks IN ('BES', '_BES') GROUP BY s.id, s.compkey) y GROUP BY compkey) x
JOIN whole w ON w.compkey = x.compkey WHERE x.len / w.length > 0.1
"""


SAG, OVAL = "('A25', 'B50', 'CUW')", "('BRKO', 'OS')"
Q["b3_defect_fraction"] = lambda v: rounded(
    _fraction(v, P.SAGGING_SEVERITIES).withColumn("kind", F.lit("sag")).unionByName(
        _fraction(v, P.OVALING_SEVERITIES).withColumn("kind", F.lit("oval"))
    ).select("compkey", "defect_length", "fraction", "kind"), ["fraction"], 6,
)
SQL["b3_defect_fraction"] = f"""
SELECT compkey, defect_length, round(fraction, 6) AS fraction, 'sag' AS kind FROM ({_fraction_sql(SAG)}) a
UNION ALL SELECT compkey, defect_length, round(fraction, 6) AS fraction, 'oval' AS kind FROM ({_fraction_sql(OVAL)}) b
"""


def _noted(v):
    out = B.with_notes(_branches(v), B.surcharged(v("surch"), 4.0), B.SURCHARGE_NOTE)
    # A share of the pipes counts as deformed, to reach the rule for them.
    return B.with_notes(out, v("pipe").filter("grade_h5 = 5").select("compkey"), B.SAG_NOTE)


PV = f"""{BRANCH},
pv AS (SELECT b.compkey, CASE WHEN p.grade_h5 = 5 THEN 0 WHEN x.a > 0.6 * b.r THEN 0.6 * b.r ELSE x.a END AS pv_whole,
   CASE WHEN x.l > 0.6 * b.r THEN 0.6 * b.r ELSE x.l END AS pv_liner
 FROM br b JOIN pipe p ON p.compkey = b.compkey LEFT JOIN (
   SELECT compkey, sum(0.25 * replacecost * q) AS a, sum(0.36 * replacecost * q * (CASE WHEN fail_yr < {YEAR} + 39.6 THEN 1 ELSE 3 END) * (CASE WHEN fail_yr < {YEAR} + 60 THEN 1 ELSE 3 END)) AS l
   FROM (SELECT *, (CASE WHEN def_tot >= 1000 THEN 0 ELSE (CAST(1000 AS DOUBLE) - def_tot) / 1000 END) * (CASE WHEN action = 3 THEN 0 ELSE 1 END) AS q FROM scored WHERE cutno > 0) y GROUP BY compkey) x
 ON x.compkey = b.compkey)
"""
Q["b4_present_value_lost"] = lambda v: rounded(
    B.present_value_lost(_noted(v), v("scored"), YEAR).select("compkey", "pv_whole", "pv_liner", "pv_spot"), ["pv_whole", "pv_liner"], 3, NUDGE
)
_N = "+ 0.0000001, 3)"
SQL["b4_present_value_lost"] = f"WITH {PV} SELECT compkey, round(pv_whole {_N} AS pv_whole, round(pv_liner {_N} AS pv_liner, CAST(NULL AS DOUBLE) AS pv_spot FROM pv"
MAXCOF = "mc AS (SELECT compkey, max(cof - 1.4 * replacecost) AS c FROM scored WHERE cutno > 0 GROUP BY compkey)"
Q["b5_max_cof_without_replacement"] = lambda v: rounded(
    B.max_cof_without_replacement(_branches(v), v("scored")).select("compkey", "max_cof"), ["max_cof"], 3, NUDGE
)
SQL["b5_max_cof_without_replacement"] = f"WITH {BRANCH}, {MAXCOF} SELECT b.compkey, round(m.c {_N} AS max_cof FROM br b LEFT JOIN mc m ON m.compkey = b.compkey"

_BIDS = ["spot_now", "spot_later", "spot_fail", "spot_after"]


def _sums(v):
    return B.spot_sums(_branches(v), v("scored"), v("jobs"), YEAR, hot=v.hot("seg"))


SPOT_ROWS = f"""
sj AS (SELECT s.compkey, s.def_tot, s.fail_yr_seg AS fy, s.action, b.f, j.capitalnonmobilization AS n, j.capitalmobilizationrate AS ra, j.basetime AS ba, j.mobilizationtime AS mo
  FROM scored s JOIN jobs j ON j.id = s.id AND j.type = 'Spot' JOIN br b ON b.compkey = s.compkey WHERE s.cutno > 0)
"""


def _bid_sql(name, test):
    return f"{name} AS (SELECT compkey, sum(n) + max(ra) * (sum(ba) + max(mo)) / 8 AS bid, sum(n) AS n, max(ra) AS ra, sum(ba) AS ba, max(mo) AS mo FROM sj WHERE {test} GROUP BY compkey)"


BIDS = ", ".join([
    _bid_sql("s_now", f"(fy <= {YEAR} + 30 AND def_tot >= 1000) OR action = 3"),
    _bid_sql("s_later", f"fy > {YEAR} + 30 AND def_tot >= 1000"),
    _bid_sql("s_fail", "fy <= f + 30 AND (def_tot >= 1000 OR action = 3)"),
    _bid_sql("s_after", "fy > f + 30 AND (def_tot >= 1000 OR action = 3)"),
    _bid_sql("s_liner", "action = 3 OR (def_tot >= 1000 AND fy <= f + 30)"),
    _bid_sql("s_now_after", f"fy > {YEAR} + 30 AND (def_tot >= 1000 OR action = 3)"),
])
Q["b6_spot_bids"] = lambda v: rounded(B.spot_bids(_branches(v), _sums(v)).select("compkey", *_BIDS), _BIDS, 3, NUDGE)
SQL["b6_spot_bids"] = f"""
WITH {BRANCH}, {SPOT_ROWS}, {BIDS}
SELECT b.compkey, round(n.bid {_N} AS spot_now, round(l.bid {_N} AS spot_later, round(q.bid {_N} AS spot_fail, round(a.bid {_N} AS spot_after
FROM br b LEFT JOIN s_now n ON n.compkey = b.compkey LEFT JOIN s_later l ON l.compkey = b.compkey LEFT JOIN s_fail q ON q.compkey = b.compkey LEFT JOIN s_after a ON a.compkey = b.compkey
"""


def _prepared(v):
    out = B.present_value_lost(_noted(v), v("scored"), YEAR)
    out = B.max_cof_without_replacement(out, v("scored"))
    out = B.spot_bids(out, _sums(v))
    out = out.join(B.line_jobs(v("jobs")), "compkey", "left")
    return with_risk_table(out, risk_multiplier(v.spark, YEAR))


def _combined(p):
    return f"""(coalesce({p}.n, 0) + j.n + greatest(coalesce({p}.ra, 0), coalesce(j.ra, 0)) * (greatest(coalesce({p}.mo, 0), coalesce(j.mo, 0)) + coalesce({p}.ba, 0) + j.ba) / 8)"""


LINES = "lj AS (SELECT compkey, capitalnonmobilization AS n, capitalmobilizationrate AS ra, basetime AS ba, mobilizationtime AS mo FROM jobs WHERE type = 'Line' AND id < 40000000)"
Q["b8_combined_bid"] = lambda v: rounded(
    _prepared(v).filter("has_line").select("compkey", B.combined_bid("with_liner").alias("bid")), ["bid"], 3, NUDGE
)
SQL["b8_combined_bid"] = f"""
WITH {BRANCH}, {SPOT_ROWS}, {BIDS}, {LINES} SELECT b.compkey, round({_combined('s')} {_N} AS bid FROM br b JOIN lj j ON j.compkey = b.compkey LEFT JOIN s_liner s ON s.compkey = b.compkey
"""


def _m(year, sd):
    return f"(SELECT k.m FROM risk k WHERE k.fy = {year} AND k.sd = {sd})"


def _refilled(prefix, stage, years, start):
    t = f"T * {_m(f'{start} + 30 + {years}', 12)}"
    test = f"T * {_m(f'{start} + 30', 12)}"
    old = f"(CASE WHEN {prefix}2 > {test} THEN 0 ELSE {prefix}{stage} END)"
    return f"(CASE WHEN {old} = 0 AND {_m(f'{start} + 30 + {years}', 12)} IS NOT NULL THEN {t} ELSE {old} END)"


STAGES = f"""{BRANCH}, {PV[len(BRANCH) + 1:]}, {MAXCOF}, {SPOT_ROWS}, {BIDS}, {LINES}, {RISK_SQL},
st0 AS (SELECT b.compkey, b.f, b.sd, b.r, m.c, 1.4 * b.r + m.c AS T, v.pv_whole, v.pv_liner, w.bid AS spot_now, q.bid AS spot_fail, s.compkey AS has_s,
   {_combined('s')} AS bid_l, {_combined('a')} AS bid_a, {_combined('z')} AS bid_z, j.n + j.ra * (j.mo + j.ba) / 8 AS bid_j
 FROM br b LEFT JOIN mc m ON m.compkey = b.compkey LEFT JOIN pv v ON v.compkey = b.compkey LEFT JOIN s_now w ON w.compkey = b.compkey LEFT JOIN s_fail q ON q.compkey = b.compkey
 LEFT JOIN s_liner s ON s.compkey = b.compkey LEFT JOIN s_after a ON a.compkey = b.compkey LEFT JOIN s_now_after z ON z.compkey = b.compkey LEFT JOIN lj j ON j.compkey = b.compkey),
st1 AS (SELECT *, T * {_m('f', 'st0.sd')} AS oc1, T * {_m('f + 120', 12)} AS oc2,
   CASE WHEN has_s IS NOT NULL THEN (1.4 * bid_l + c) * {_m('f', 'st0.sd')} END AS l1, T * {_m('f + 60', 6)} AS l2, T * {_m('f + 180', 12)} AS l3,
   (1.4 * spot_fail + c) * {_m('f', 'st0.sd')} AS p1, (1.4 * bid_a + c) * {_m('f + 30', 4)} AS p2, T * {_m('f + 90', 6)} AS p3, T * {_m('f + 210', 12)} AS p4,
   coalesce(r, 0) + coalesce(pv_whole, 0) AS a1, T * {_m(YEAR + 120, 12)} AS a2,
   coalesce(bid_j, 0) + coalesce(pv_liner, 0) AS c1, T * {_m(YEAR + 60, 6)} AS c2, T * {_m(YEAR + 180, 12)} AS c3,
   coalesce(spot_now, 0) AS q1, (1.4 * bid_z + c) * {_m(YEAR + 30, 4)} AS q2, T * {_m(YEAR + 90, 6)} AS q3, T * {_m(YEAR + 210, 12)} AS q4 FROM st0),
st AS (SELECT compkey, oc1 AS bpw_oc1, oc2 AS bpw_oc2, CASE WHEN l1 > oc1 THEN oc1 ELSE l1 END AS bpw_cipp1, CASE WHEN l1 > oc1 THEN oc2 ELSE l2 END AS bpw_cipp2, CASE WHEN l1 > oc1 THEN 0 ELSE l3 END AS bpw_cipp3,
   p1 AS bpw_sp1, {_refilled('p', 2, 0, 'f')} AS bpw_sp2, {_refilled('p', 3, 120, 'f')} AS bpw_sp3, {_refilled('p', 4, 240, 'f')} AS bpw_sp4,
   a1 AS apw_oc1, a2 AS apw_oc2, c1 AS apw_cipp1, c2 AS apw_cipp2, c3 AS apw_cipp3,
   q1 AS apw_sp1, {_refilled('q', 2, 0, YEAR)} AS apw_sp2, {_refilled('q', 3, 120, YEAR)} AS apw_sp3, {_refilled('q', 4, 240, YEAR)} AS apw_sp4 FROM st1)
"""


def _stage_query(names, *steps):
    def run(v):
        out = _prepared(v)
        for step in steps:
            out = step(out)
        return rounded(out.select("compkey", *names), list(names), 2, NUDGE)

    return run


def _stage_sql(names):
    return f"WITH {STAGES} SELECT compkey, " + ", ".join(f"round({n} + 0.0000001, 2) AS {n}" for n in names) + " FROM st"


_OC, _CIPP, _SP = ["bpw_oc1", "bpw_oc2"], ["bpw_cipp1", "bpw_cipp2", "bpw_cipp3"], ["bpw_sp1", "bpw_sp2", "bpw_sp3", "bpw_sp4"]
_APW = ["apw_oc1", "apw_oc2", "apw_cipp1", "apw_cipp2", "apw_cipp3", "apw_sp1", "apw_sp2", "apw_sp3", "apw_sp4"]
Q["b7_reactive_open_cut"] = _stage_query(_OC, B.bpw_open_cut)
SQL["b7_reactive_open_cut"] = _stage_sql(_OC)
Q["b9_reactive_liner"] = _stage_query(_CIPP, B.bpw_open_cut, B.bpw_liner)
SQL["b9_reactive_liner"] = _stage_sql(_CIPP)
Q["b10_reactive_spot"] = _stage_query(_SP, B.bpw_spot)
SQL["b10_reactive_spot"] = _stage_sql(_SP)
Q["b11_proactive_stages"] = _stage_query(
    _APW, lambda d: B.apw_open_cut(d, YEAR), lambda d: B.apw_liner(d, YEAR), lambda d: B.apw_spot(d, YEAR)
)
SQL["b11_proactive_stages"] = _stage_sql(_APW)


def _benefit(v):
    return B.benefit(_noted(v), v("scored"), v("jobs"), risk_multiplier(v.spark, YEAR), YEAR, hot=v.hot("seg"))


_SUMS = ["bpw_oc", "bpw_cipp", "bpw_sp", "apw_oc", "apw_cipp", "apw_sp"]
Q["b12_nbcr"] = lambda v: rounded(
    rounded(_benefit(v).select("compkey", *_SUMS, *B.RATIO_NAMES), _SUMS, 2, NUDGE), B.RATIO_NAMES, 5
)


def _ratio(name):
    cost = "apw_" + name.rsplit("_", 1)[1]
    value = f"(bpw_oc - {cost}) / nullif({cost}, 0)"
    return f"round({value}, 5) AS {name}" if name == "nbcr_oc_oc" else f"round(coalesce({value}, -10), 5) AS {name}"


SQL["b12_nbcr"] = f"""
WITH {STAGES}, ad AS (SELECT compkey, bpw_oc1 + coalesce(bpw_oc2, 0) AS o, bpw_cipp1 + bpw_cipp2 + coalesce(bpw_cipp3, 0) AS bpw_cipp, bpw_sp1 + bpw_sp2 + coalesce(bpw_sp3, 0) + coalesce(bpw_sp4, 0) AS bpw_sp,
  apw_oc1 + coalesce(apw_oc2, 0) AS apw_oc, apw_cipp1 + apw_cipp2 + coalesce(apw_cipp3, 0) AS apw_cipp, apw_sp1 + apw_sp2 + coalesce(apw_sp3, 0) + coalesce(apw_sp4, 0) AS apw_sp FROM st),
le AS (SELECT *, least(o, bpw_cipp, bpw_sp) AS bpw_oc FROM ad)
SELECT compkey, {', '.join(f'round({n} + 0.0000001, 2) AS {n}' for n in _SUMS)}, {', '.join(_ratio(n) for n in B.RATIO_NAMES)} FROM le
"""
Q["b13_with_present_value"] = lambda v: rounded(
    B.with_present_value(v("ratios").select("compkey", "solution"), B.present_value_lost(_noted(v), v("scored"), YEAR)), ["pv_whole", "pv_liner"], 3, NUDGE
)
SQL["b13_with_present_value"] = f"""
WITH {PV} SELECT t.compkey, t.solution, round(pv_whole {_N} AS pv_whole, round(pv_liner {_N} AS pv_liner, CAST(NULL AS DOUBLE) AS pv_spot FROM ratios t LEFT JOIN pv ON pv.compkey = t.compkey
"""

# --- decision ------------------------------------------------------------------------

_RATIO_LIST = ", ".join(B.RATIO_NAMES)


def _trim(v):
    return D.trim_matrix(
        v("ratios").select("compkey", *B.RATIO_NAMES), B.surcharged(v("surch"), 3.0), _fraction(v, P.SAGGING_SEVERITIES), _fraction(v, P.OVALING_SEVERITIES)
    )


Q["m1_trim_matrix"] = _trim
_WET = "w.compkey IS NOT NULL"
_BENT = "d.compkey IS NOT NULL"


def _trimmed(name):
    tests = [t for t, names in ((_WET, D.SURCHARGE_BLANKS), (_BENT, D.DEFORMED_BLANKS)) if name in names]
    return f"CASE WHEN {' OR '.join(tests)} THEN NULL ELSE r.{name} END AS {name}" if tests else f"r.{name}"


SQL["m1_trim_matrix"] = f"""
SELECT r.compkey, {', '.join(_trimmed(n) for n in B.RATIO_NAMES)} FROM ratios r
LEFT JOIN (SELECT DISTINCT compkey FROM surch WHERE try_cast(ussurch AS DOUBLE) >= 3) w ON w.compkey = r.compkey
LEFT JOIN (SELECT compkey FROM ({_fraction_sql(SAG)}) a UNION SELECT compkey FROM ({_fraction_sql(OVAL)}) b) d ON d.compkey = r.compkey
"""


def _case(names, test):
    return " OR ".join(f"{test} = {n}" for n in names)


_TARGETS = {"OC": ["nbcr_oc_oc", "nbcr_cipp_oc", "nbcr_sp_oc"], "SP": ["nbcr_oc_sp", "nbcr_cipp_sp", "nbcr_sp_sp"], "CIPP": ["nbcr_oc_cipp", "nbcr_cipp_cipp", "nbcr_sp_cipp"]}
Q["m2_choose_action"] = lambda v: D.choose_action(v("ratios").drop("solution", "solution_nbcr")).select("compkey", "solution", "solution_nbcr")
SQL["m2_choose_action"] = f"""
WITH a AS (SELECT *, greatest({_RATIO_LIST}) AS mx FROM ratios),
b AS (SELECT *, CASE WHEN {_case(_TARGETS['OC'], 'mx')} THEN greatest(nbcr_oc_oc, nbcr_oc_sp, nbcr_oc_cipp) WHEN {_case(_TARGETS['SP'], 'mx')} THEN greatest(nbcr_sp_oc, nbcr_sp_sp, nbcr_sp_cipp)
   WHEN {_case(_TARGETS['CIPP'], 'mx')} THEN greatest(nbcr_cipp_oc, nbcr_cipp_sp, nbcr_cipp_cipp) END AS m2 FROM a)
SELECT compkey, m2 AS solution_nbcr, CASE WHEN {_case(_TARGETS['OC'], 'm2')} THEN 'OC' WHEN {_case(_TARGETS['SP'], 'm2')} THEN 'SP' WHEN {_case(_TARGETS['CIPP'], 'm2')} THEN 'CIPP' END AS solution FROM b
"""
_CHOICE = ["compkey", "solution", "problems"]
Q["m3_gate_few_spots"] = lambda v: D.gate_few_spots(v("ratios"), v("scored")).select(*_CHOICE)
SQL["m3_gate_few_spots"] = """
WITH few AS (SELECT compkey FROM scored WHERE cutno > 0 AND (action = 3 OR def_tot > 100) GROUP BY compkey HAVING count(*) BETWEEN 1 AND 2),
h AS (SELECT *, compkey IN (SELECT compkey FROM few) AND problems NOT ILIKE '%oval%' AND problems NOT ILIKE '%sagg%' AS hit FROM ratios)
SELECT compkey, CASE WHEN hit THEN 'SP' ELSE solution END AS solution, CASE WHEN hit THEN coalesce(problems, '') || ', only one or two bad spots' ELSE problems END AS problems FROM h
"""
Q["m4_gate_sandwich"] = lambda v: D.gate_sandwich(v("ratios"), v("whole"), 2).select(*_CHOICE)
SQL["m4_gate_sandwich"] = """
WITH g AS (SELECT r.compkey, r.solution, w.usnode, w.dsnode FROM ratios r JOIN whole w ON w.compkey = r.compkey AND w.cutno = 0 AND w.grade_h5 >= 2),
s AS (SELECT DISTINCT b.compkey FROM g b JOIN g c ON c.solution = 'OC' AND b.usnode = c.dsnode JOIN g d ON d.solution = 'OC' AND b.dsnode = d.usnode WHERE b.solution NOT IN ('OC', 'OC Sandwich'))
SELECT r.compkey, CASE WHEN s.compkey IS NOT NULL THEN 'OC Sandwich' ELSE r.solution END AS solution,
  CASE WHEN s.compkey IS NOT NULL THEN coalesce(r.problems, '') || ', in between two OC' ELSE r.problems END AS problems FROM ratios r LEFT JOIN s ON s.compkey = r.compkey
"""


def _notes(v):
    pipes = v("pipe").select("compkey", "cutno", "length", "insp_curr").unionByName(
        v("seg").select("compkey", "cutno", "length", F.lit(1).alias("insp_curr"))
    )
    return D.problem_notes(v("ratios"), pipes, v("sanitary"), v("storm"), v("latest")).select("compkey", "problems")


Q["m5_problem_notes"] = _notes
SQL["m5_problem_notes"] = """
SELECT r.compkey, r.problems
  || CASE WHEN r.compkey NOT IN (SELECT compkey FROM sanitary) AND r.compkey NOT IN (SELECT compkey FROM storm) THEN ', no match in COMPSMN OR COMPSTMN' ELSE '' END
  || CASE WHEN p.insp_curr = 3 THEN ', pipe was replaced after last inspection' ELSE '' END || CASE WHEN p.insp_curr = 4 THEN ', no valid inspection' ELSE '' END
  || CASE WHEN p.insp_curr = 2 THEN ', pipe has no install date and is tbab or aban' ELSE '' END
  || CASE WHEN r.compkey IN (SELECT compkey FROM latest WHERE compdttm IS NULL) THEN ', inspection not completed in one pass' ELSE '' END
  || CASE WHEN EXISTS (SELECT 1 FROM latest l WHERE l.compkey = r.compkey AND (l.distfrom > p.length OR l.distto > p.length)) THEN ', inspection is longer than known length of pipe' ELSE '' END AS problems
FROM ratios r JOIN pipe p ON p.compkey = r.compkey
"""


def _maintained(v):
    return D.gate_maintained(v("ratios"), D.maintained_pipes(v("sanitary"), v("storm"), v("grades"))).select(*_CHOICE)


Q["m6_gate_maintained"] = _maintained
_IDS = "regexp_full_match(upper(unitid), '[A-Z]{3}[0-9]{3}[ ]?') AND regexp_full_match(upper(unitid2), '[A-Z]{3}[0-9]{3}[ ]?')"
SQL["m6_gate_maintained"] = f"""
WITH ok AS (SELECT compkey FROM sanitary WHERE lower(unittype) IN ('saml', 'csml', 'csint', 'saint', 'csdet', 'csotn', 'embpg') AND servstat <> 'ABAN' AND servstat <> 'TBAB' AND {_IDS}
 UNION ALL SELECT compkey FROM storm WHERE own = 'BES' AND unittype IN ('stml', 'csml', 'csint', 'saint', 'csdet', 'csotn', 'embpg') AND servstat <> 'ABAN' AND servstat <> 'TBAB' AND {_IDS}
   AND compkey IN (SELECT compkey FROM grades WHERE altidtyp = 'OFID' AND compkey > 1))
SELECT r.compkey, CASE WHEN k.compkey IS NULL THEN 'Not a BES maintained rehab pipe' ELSE r.solution END AS solution,
  CASE WHEN k.compkey IS NULL THEN coalesce(r.problems, '') || ', not a BES maintained rehab pipe' ELSE r.problems END AS problems
FROM ratios r LEFT JOIN (SELECT DISTINCT compkey FROM ok) k ON k.compkey = r.compkey
"""

# --- final tables --------------------------------------------------------------------

Q["n1_final_table"] = lambda v: D.final_table(v("fin")).select("id", "compkey", "cutno", "spots_before_lining")
SQL["n1_final_table"] = """
SELECT f.id, f.compkey, f.cutno, CAST(CASE WHEN f.cutno = 0 AND s.n IS NOT NULL THEN s.n WHEN f.action = 3 THEN 1 ELSE 0 END AS BIGINT) AS spots_before_lining
FROM fin f LEFT JOIN (SELECT compkey, sum(CASE WHEN action = 3 THEN 1 ELSE 0 END) AS n FROM fin WHERE cutno > 0 GROUP BY compkey) s ON s.compkey = f.compkey
"""
_WIDE = [f"{k}_{p}" for k in ("spot", "whole", "liner") for p in ("cost", "rate", "base_days", "mob_days", "only")]
Q["n2_wide_costs"] = lambda v: rounded(D.wide_costs(v("fin").select("id"), v("jobs")).select("id", *_WIDE), _WIDE, 3, NUDGE)


def _wide_sql():
    cols = []
    for alias, name in (("s", "spot"), ("d", "whole"), ("l", "liner")):
        cols += [
            f"round({alias}.capitalnonmobilization {_N} AS {name}_cost", f"round({alias}.capitalmobilizationrate {_N} AS {name}_rate",
            f"round({alias}.basetime / 8 {_N} AS {name}_base_days", f"round({alias}.mobilizationtime / 8 {_N} AS {name}_mob_days",
            f"round({alias}.capitalnonmobilization + {alias}.capitalmobilizationrate * ({alias}.basetime / 8 + {alias}.mobilizationtime / 8) {_N} AS {name}_only",
        ]
    return f"""SELECT f.id, {', '.join(cols)} FROM fin f LEFT JOIN jobs s ON s.id = f.id AND s.type = 'Spot' LEFT JOIN jobs d ON d.id = f.id AND d.type = 'Dig' LEFT JOIN jobs l ON l.id = f.id AND l.type = 'Line'"""


SQL["n2_wide_costs"] = _wide_sql()

_RECOMMENDED = ["failure_action", "recommended", "recommended_nbcr", "spot_nbcr", "liner_nbcr", "whole_nbcr", "bpw", "apw_spot", "apw_liner", "apw_whole"]
_MONEY = ["bpw", "apw_spot", "apw_liner", "apw_whole"]


def _recommend(v):
    return D.recommend(v("fin").withColumns({"problems": F.lit(None).cast("string"), "max_cof": F.lit(None).cast("double")}), v("ratios"), YEAR, hot=v.hot("seg"))


Q["n3_recommend"] = lambda v: rounded(_recommend(v).select("id", *_RECOMMENDED), _MONEY, 3, NUDGE)


def _chosen(values):
    body = " ".join(f"WHEN r.solution = '{s}' THEN r.{c}" for s, c in values.items())
    return f"CASE WHEN hit THEN CASE {body} END END"


SQL["n3_recommend"] = f"""
WITH x AS (SELECT f.*, coalesce(f.grade_h5 > 3 AND f.remarks = 'BES' AND r.first_failure <= {YEAR + 20} AND f.spot_count > 0 AND f.cutno = 0, FALSE) AS hit, w.fy AS wfy FROM fin f
  LEFT JOIN ratios r ON r.compkey = f.compkey LEFT JOIN (SELECT compkey, max(failure_year) AS fy FROM fin WHERE cutno = 0 GROUP BY compkey) w ON w.compkey = f.compkey)
SELECT x.id, CASE WHEN x.grade_h5 > 3 AND x.remarks = 'BES' AND x.failure_year <= {YEAR + 20} THEN NULL WHEN x.cutno > 0 AND x.wfy > {YEAR + 20} THEN 'Do nothing' END AS failure_action,
  CASE WHEN hit THEN r.solution ELSE 'Do Nothing' END AS recommended, CASE WHEN hit THEN r.solution_nbcr END AS recommended_nbcr,
  {_chosen({'OC': 'nbcr_oc_sp', 'SP': 'nbcr_sp_sp', 'CIPP': 'nbcr_cipp_sp'})} AS spot_nbcr, {_chosen({'OC': 'nbcr_oc_cipp', 'SP': 'nbcr_sp_cipp', 'CIPP': 'nbcr_cipp_cipp'})} AS liner_nbcr,
  {_chosen({'OC': 'nbcr_oc_oc', 'SP': 'nbcr_sp_oc', 'CIPP': 'nbcr_cipp_oc'})} AS whole_nbcr, round({_chosen({'OC': 'bpw_oc', 'SP': 'bpw_sp', 'CIPP': 'bpw_cipp'})} {_N} AS bpw,
  round(CASE WHEN hit THEN r.apw_sp END {_N} AS apw_spot, round(CASE WHEN hit THEN r.apw_cipp END {_N} AS apw_liner, round(CASE WHEN hit THEN r.apw_oc END {_N} AS apw_whole
FROM x LEFT JOIN ratios r ON r.compkey = x.compkey
"""
Q["n4_watch_list"] = lambda v: D.watch_list(v("done"), v("whole"), YEAR, hot=v.hot("seg")).select("id", "failure_action", "recommended")
SQL["n4_watch_list"] = f"""
WITH x AS (SELECT d.*, CASE WHEN d.compkey IN (SELECT compkey FROM whole WHERE hservstat = 'PEND') THEN coalesce(d.failure_action, '') || '(PEND)' ELSE d.failure_action END AS fa FROM done d)
SELECT id, fa AS failure_action, CASE WHEN grade_h5 > 3 AND ((recommended_nbcr < 0 AND failure_year > {YEAR + 20}) OR fa LIKE '%(PEND)%') THEN 'Watch me' ELSE recommended END AS recommended FROM x
"""
Q["n5_propagate"] = lambda v: D.propagate(v("done"), v.hot("seg")).select("id", *D.RESULT_COLUMNS)
SQL["n5_propagate"] = f"""
SELECT a.id, {', '.join(f'CASE WHEN a.cutno > 0 AND b.compkey IS NOT NULL THEN b.{c} ELSE a.{c} END AS {c}' for c in D.RESULT_COLUMNS)}
FROM done a LEFT JOIN (SELECT * FROM done WHERE cutno = 0) b ON b.compkey = a.compkey
"""
Q["n6_restate_consequence"] = lambda v: rounded(D.restate_consequence(v("done")).select("id", "cof"), ["cof"], 3, NUDGE)
SQL["n6_restate_consequence"] = f"""
SELECT a.id, round(CASE WHEN a.cutno > 0 THEN a.cof WHEN a.recommended = 'CIPP' THEN a.liner_only * 1.4 + a.max_cof WHEN a.recommended IN ('OC', 'OC Sandwich') THEN a.whole_only * 1.4 + a.max_cof
  WHEN b.compkey IS NULL THEN a.cof WHEN a.recommended = 'SP' THEN b.s * 1.4 + a.max_cof ELSE b.m * 1.4 + a.max_cof END {_N} AS cof
FROM done a LEFT JOIN (SELECT compkey, sum(spot_only * spot_count) AS s, max(spot_only) AS m FROM done WHERE cutno > 0 GROUP BY compkey) b ON b.compkey = a.compkey
"""
Q["n7_view_costs"] = lambda v: rounded(D.view_costs(v("done"), v("scored"), v("jobs"), YEAR), ["cost"], 3, NUDGE)
SQL["n7_view_costs"] = f"""
WITH {BRANCH}, {SPOT_ROWS}, {BIDS}, {LINES}
SELECT compkey, round(whole_only {_N} AS cost, lateral_cost FROM done WHERE cutno = 0 AND recommended IN ('OC', 'OC Sandwich')
UNION ALL SELECT d.compkey, round(n.bid {_N} AS cost, d.lateral_cost FROM done d JOIN s_now n ON n.compkey = d.compkey WHERE d.cutno = 0 AND d.recommended = 'SP'
UNION ALL SELECT d.compkey, round(j.n + j.ra * (j.mo + j.ba) / 8 {_N} AS cost, d.lateral_cost FROM done d JOIN lj j ON j.compkey = d.compkey WHERE d.cutno = 0 AND d.recommended = 'CIPP'
"""
