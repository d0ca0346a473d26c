"""Registered queries of the risk table, failure counts, action flags and publishing."""

from __future__ import annotations

from pyspark.sql import functions as F

from mainstay import params as P
from mainstay.checks.common import Query, SEVERE, SEVERE_SQL, YEAR, rounded
from mainstay.checks.registry_basics import tail_sql
from mainstay.operators import lifespan as L
from mainstay.operators.skew import hot_keys
from mainstay.session import cut_lineage

Q: dict[str, Query] = {}
SQL: dict[str, str] = {}


def _hot(v, name="seg"):
    return v.hot(name)


def _risk(v):
    return L.risk_multiplier(v.spark, YEAR)


RISK_SQL = f"""
pairs AS (SELECT f.y AS fy, s.s AS sd FROM (SELECT unnest(range(1975, 2265)) AS y) f CROSS JOIN (SELECT unnest(range(1, 51)) AS s) s),
terms AS (SELECT fy, sd, k.k, CAST(2024 + k.k - fy AS DOUBLE) / sd AS z0, CAST(2025 + k.k - fy AS DOUBLE) / sd AS z1, CAST(2024 - fy AS DOUBLE) / sd AS z FROM pairs CROSS JOIN (SELECT unnest(range(0, 241)) AS k) k),
tails AS (SELECT fy, sd, k, {tail_sql('z0')} AS q0, {tail_sql('z1')} AS q1, {tail_sql('z')} AS q FROM terms),
risk AS (SELECT CAST(fy AS DOUBLE) AS fy, CAST(sd AS DOUBLE) AS sd, CASE WHEN max(q) <= 0 THEN 1 ELSE sum(pow(CAST(1.025 AS DOUBLE), -k) * (q0 - q1) / nullif(q, 0)) END AS m FROM tails GROUP BY fy, sd)
"""

def _risk_rows(v):
    sd = F.col("length") % 12 + F.when(F.col("cutno") == 5, 0.5).otherwise(1.0)
    rows = L.with_risk_table(v("scored").select("id", "fail_yr_seg", sd.alias("sd")), _risk(v))
    return rounded(rows.select("id", "sd", L.risk_at(F.col("fail_yr_seg"), F.col("sd")).alias("multiplier")), ["multiplier"], 9)


Q["d20_risk_multiplier"] = _risk_rows
SQL["d20_risk_multiplier"] = f"""
WITH {RISK_SQL}, x AS (SELECT id, fail_yr_seg, CAST(length % 12 + CASE WHEN cutno = 5 THEN 0.5 ELSE 1 END AS DOUBLE) AS sd FROM scored)
SELECT x.id, x.sd, round(r.m, 9) AS multiplier FROM x LEFT JOIN risk r ON r.fy = x.fail_yr_seg AND r.sd = x.sd
"""


def _stamped(v):
    # A share of the materials carries a repair stamp.
    stamped = F.when(F.col("id") % 13 == 0, F.concat(F.lit("2_"), F.col("material"))).otherwise(F.col("material"))
    return v("scored").withColumn("material", stamped)


def _ledger(v):
    return L.defect_ledger(v("seg"), v("latest"), v("peak"), _hot(v, "latest"))


STAMPED_SQL = "st AS (SELECT id, compkey, cutno, fm, to_, length, cof, replacecost, linercost, CASE WHEN id % 13 = 0 THEN '2_' || material ELSE material END AS material FROM scored)"
BROKEN_SQL = f"""
br AS (SELECT compkey, count(DISTINCT cutno) AS broken FROM (
  SELECT s.compkey, s.cutno FROM seg s JOIN latest l ON l.compkey = s.compkey AND l.obsevkey IN {SEVERE_SQL}
  WHERE (s.fm >= l.distfrom AND s.fm < l.distto) OR (s.to_ >= l.distfrom AND s.to_ < l.distto) OR (s.fm <= l.distfrom AND s.to_ > l.distto)
     OR (s.fm = l.distfrom AND s.fm = l.distto)) x GROUP BY compkey)
"""
LEDGER_SQL = """
led AS (
 SELECT s.id, s.compkey, s.cutno, l.obskey, l.inspkey, l.obsevkey, l.distfrom, l.distto, p.peak_score * CASE
     WHEN s.fm >= l.distfrom AND s.to_ <= l.distto THEN s.length WHEN s.fm < l.distfrom AND s.to_ > l.distto THEN l.distto - l.distfrom
     WHEN s.to_ > l.distto THEN l.distto - s.fm WHEN s.fm < l.distfrom THEN s.to_ - l.distfrom ELSE 0 END AS score
 FROM seg s JOIN latest l ON l.compkey = s.compkey JOIN peak p ON p.obsevkey = l.obsevkey
 WHERE l.distfrom <> l.distto AND ((s.fm >= l.distfrom AND s.fm <= l.distto) OR (s.to_ > l.distfrom AND s.to_ < l.distto) OR (s.fm <= l.distfrom AND s.to_ > l.distto))
 UNION ALL
 SELECT s.id, s.compkey, s.cutno, l.obskey, l.inspkey, l.obsevkey, l.distfrom, l.distto, l.newscore AS score
 FROM seg s JOIN latest l ON l.compkey = s.compkey
 WHERE l.distfrom = l.distto AND ((s.cutno = s.seg_count AND l.distfrom >= s.fm) OR (l.distfrom >= s.fm AND l.distfrom < s.to_)))
"""
FAILED_SQL = f"""
fa AS (SELECT compkey, count(DISTINCT cutno) AS failed FROM (
  SELECT s.compkey, s.cutno FROM st s LEFT JOIN led d ON d.compkey = s.compkey AND d.cutno = s.cutno
  WHERE s.material LIKE '2_%' OR d.obsevkey IN {SEVERE_SQL}) x GROUP BY compkey)
"""
FIXED_SQL = "fx AS (SELECT compkey, count(*) AS fixed FROM st WHERE material LIKE '2_%' GROUP BY compkey)"
SUMMARY_SQL = f"""{STAMPED_SQL}, {BROKEN_SQL}, {LEDGER_SQL}, {FAILED_SQL}, {FIXED_SQL},
summ AS (SELECT b.compkey, b.segments, b.cof, b.replacecost, b.linercost, coalesce(br.broken, 0) AS broken, coalesce(fx.fixed, 0) AS fixed, coalesce(fa.failed, 0) AS failed
 FROM (SELECT compkey, count(*) AS segments, max(cof) AS cof, max(replacecost) AS replacecost, max(linercost) AS linercost FROM st WHERE compkey IS NOT NULL GROUP BY compkey) b
 LEFT JOIN br ON br.compkey = b.compkey LEFT JOIN fx ON fx.compkey = b.compkey LEFT JOIN fa ON fa.compkey = b.compkey)
"""


def _summary(v):
    # As in the full run, segments and observations are made once for the steps that read them.
    seg, latest = cut_lineage(_stamped(v)), cut_lineage(v("latest"))
    hot = hot_keys(latest, ["compkey"])
    return L.pipe_summary(seg, latest, L.defect_ledger(seg, latest, v("peak"), hot), SEVERE, hot)


Q["d21_pipe_summary"] = lambda v: rounded(_summary(v), ["cof", "replacecost", "linercost"], 3)
SQL["d21_pipe_summary"] = f"""
WITH {SUMMARY_SQL} SELECT compkey, segments, round(cof, 3) AS cof, round(replacecost, 3) AS replacecost, round(linercost, 3) AS linercost, broken, fixed, failed FROM summ
"""
Q["d22_broken_segments"] = lambda v: L.broken_segments(v("seg"), v("latest"), SEVERE, _hot(v, "latest"))
SQL["d22_broken_segments"] = f"WITH {BROKEN_SQL} SELECT compkey, broken FROM br"
Q["d23_repaired_segments"] = lambda v: L.repaired_segments(_stamped(v))
SQL["d23_repaired_segments"] = f"WITH {STAMPED_SQL}, {FIXED_SQL} SELECT compkey, fixed FROM fx"
Q["d24_failed_segments"] = lambda v: L.failed_segments(_stamped(v), _ledger(v), SEVERE)
SQL["d24_failed_segments"] = f"WITH {STAMPED_SQL}, {LEDGER_SQL}, {FAILED_SQL} SELECT compkey, failed FROM fa"
Q["d25_defect_ledger"] = lambda v: _ledger(v)
SQL["d25_defect_ledger"] = f"WITH {LEDGER_SQL} SELECT id, compkey, cutno, obskey, inspkey, obsevkey, distfrom, distto, CAST(score AS DOUBLE) AS score FROM led"


def _rollup(v):
    seg = v("scored").select("id", "compkey", F.col("fail_yr_seg").alias("failure_year"), F.when(F.col("id") % 29 == 0, 0.0).otherwise(F.col("length") + 4).alias("std_dev"))
    wholes = v("whole").select("id", "compkey", F.lit(0).alias("failure_year"), F.lit(0.0).alias("std_dev"))
    kept, rolled = L.rollup_failure(seg, wholes)
    return kept.select("id", F.col("fail_yr_seg").alias("failure_year"), F.col("std_dev_seg").alias("std_dev")).unionByName(
        rolled.select("id", "failure_year", "std_dev")
    )


Q["d26_rollup_failure"] = _rollup
SQL["d26_rollup_failure"] = """
WITH s AS (SELECT id, compkey, fail_yr_seg AS fy, CAST(CASE WHEN id % 29 = 0 THEN 0 ELSE length + 4 END AS DOUBLE) AS sd FROM scored),
 m AS (SELECT compkey, min(fy) AS fy, min(sd) AS sd FROM s WHERE fy <> 0 AND sd <> 0 GROUP BY compkey)
SELECT id, CASE WHEN fy <> 0 AND sd <> 0 THEN fy END AS failure_year, CASE WHEN fy <> 0 AND sd <> 0 THEN sd END AS std_dev FROM s
UNION ALL SELECT w.id, CAST(CASE WHEN m.compkey IS NULL THEN 0 ELSE m.fy END AS INT) AS failure_year, CASE WHEN m.compkey IS NULL THEN 0 ELSE m.sd END AS std_dev FROM whole w LEFT JOIN m ON m.compkey = w.compkey
"""


def _actions(v):
    return L.action_flags(v("scored").withColumnRenamed("def_tot", "total_score").drop("action", "spot_count"), v("latest"), SEVERE, _hot(v, "latest"))


def _action_rows(v):
    seg = _actions(v)
    wholes = L.whole_spot_counts(v("whole").select("id", "compkey"), seg)
    cols = ["id", "action", F.col("spot_count").cast("long").alias("spot_count")]
    return seg.select(*cols).unionByName(wholes.select(*cols))


Q["d27_action_flags"] = _action_rows
SQL["d27_action_flags"] = f"""
WITH sev AS (SELECT DISTINCT s.id FROM seg s JOIN latest l ON l.compkey = s.compkey AND l.obsevkey IN {SEVERE_SQL}
   WHERE (s.fm >= l.distfrom AND s.fm <= l.distto) OR (s.to_ >= l.distfrom AND s.to_ <= l.distto) OR (s.fm <= l.distfrom AND s.to_ >= l.distto)),
 a AS (SELECT s.id, s.compkey, CAST(CASE WHEN v.id IS NULL THEN 1 ELSE 3 END AS INT) AS action, CAST(CASE WHEN v.id IS NOT NULL OR s.def_tot >= 1000 THEN 1 ELSE 0 END AS BIGINT) AS spot_count
   FROM scored s LEFT JOIN sev v ON v.id = s.id)
SELECT id, action, spot_count FROM a UNION ALL
SELECT w.id, CAST(1 AS INT) AS action, CAST((SELECT sum(a.spot_count) FROM a WHERE a.compkey = w.compkey) AS BIGINT) AS spot_count FROM whole w
"""

Q["d28_in_replacement"] = lambda v: rounded(
    L.in_replacement(v("pipe"), 2040).select("compkey", "std_dev", "action"), ["std_dev"]
)
SQL["d28_in_replacement"] = """
SELECT compkey, round(CASE WHEN hit THEN greatest(CAST(3 AS DOUBLE), 0.2 * rulife) ELSE std_dev END, 4) AS std_dev, CAST(CASE WHEN hit THEN 0 ELSE action END AS INT) AS action
FROM (SELECT *, insp_curr IN (3, 4) AND hservstat <> 'NEW' AND (2040 - year(instdate) > 40 OR instdate IS NULL) AS hit FROM pipe) x
"""


def _percent(v):
    own = v("seg").select("id", "compkey", F.col("seg_count") + 100)
    both = own.toDF("id", "compkey", "seg_count").unionByName(v("whole").select("id", "compkey"), allowMissingColumns=True)
    return rounded(L.failure_percent(both, _summary(v), v.hot("seg")), ["fail_pct"])


Q["d29_failure_percent"] = _percent
SQL["d29_failure_percent"] = f"""
WITH {SUMMARY_SQL}
SELECT s.id, s.compkey, CASE WHEN s.compkey <> 0 THEN m.segments ELSE s.seg_count + 100 END AS seg_count, m.broken AS fail_near, m.fixed AS fail_prev, m.failed AS fail_tot,
  CASE WHEN s.compkey <> 0 THEN round(CASE WHEN m.segments = 0 THEN 0 ELSE 100 * CAST(m.failed AS DOUBLE) / m.segments END, 4) END AS fail_pct
FROM seg s LEFT JOIN summ m ON m.compkey = s.compkey
UNION ALL
SELECT w.id, w.compkey, m.segments AS seg_count, m.broken AS fail_near, m.fixed AS fail_prev, m.failed AS fail_tot,
  round(CASE WHEN m.segments = 0 THEN 0 ELSE 100 * CAST(m.failed AS DOUBLE) / m.segments END, 4) AS fail_pct
FROM whole w LEFT JOIN summ m ON m.compkey = w.compkey AND w.compkey <> 0
"""

Q["d30_repaired_material"] = lambda v: L.repaired_material(_stamped(v).select("id", "material"), v("scored")).select("id", "mat_note")
SQL["d30_repaired_material"] = f"WITH {STAMPED_SQL} SELECT s.id, CASE WHEN s.material <> b.material THEN s.material END AS mat_note FROM st s JOIN scored b ON b.id = s.id"

Q["d31_spot_cost"] = lambda v: rounded(L.spot_cost(v("scored")).select("id", "spotcost"), ["spotcost"], 3)
SQL["d31_spot_cost"] = "SELECT id, round(replacecost * spot_count, 3) AS spotcost FROM scored"


def _publish(v):
    cols = ["failure_year", "cof", "action"]
    base = v("seg").select("id", "compkey").unionByName(v("whole").select("id", "compkey"))
    out = L.publish(
        base, v("scored").withColumnRenamed("fail_yr_seg", "failure_year"), v("pipe").withColumnRenamed("fail_yr", "failure_year"), cols
    )
    return rounded(out, ["cof"], 3)


Q["d32_publish"] = _publish
SQL["d32_publish"] = """
SELECT id, compkey, fail_yr_seg AS failure_year, round(cof, 3) AS cof, action, CAST(NULL AS INT) AS fail_yr_whole, CAST(NULL AS INT) AS std_dev_whole FROM scored
UNION ALL SELECT id, compkey, fail_yr AS failure_year, round(cof, 3) AS cof, action, CAST(fail_yr + 120 AS INT) AS fail_yr_whole, CAST(12 AS INT) AS std_dev_whole FROM pipe
"""
