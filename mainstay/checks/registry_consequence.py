"""Registered queries of the consequence layers."""

from __future__ import annotations

from pyspark.sql import functions as F

from mainstay.checks.common import NUDGE, Query, rounded
from mainstay.operators import consequence as K
from mainstay.params import ConsequenceCosts

Q: dict[str, Query] = {}
SQL: dict[str, str] = {}
COSTS = ConsequenceCosts()


def _money(df):
    return rounded(df, ["consequence"], 2, NUDGE)


def _label(amount, reason, sfm, tblf):
    return (
        f"SELECT compkey, round(CAST({amount} AS DOUBLE) + 0.0000001, 2) AS consequence, CAST({sfm} AS INT) AS sfm, "
        f"CAST({tblf} AS INT) AS tblf, '{reason}' AS reason"
    )


# Every crossing row with the pipe of its link.
CROSS = "cross_rows AS (SELECT l.compkey, x.* FROM link k JOIN linkxp x ON x.mlinkid = k.mlinkid JOIN link l ON l.mlinkid = x.mlinkid)"
TOTALS = "totals AS (SELECT t.compkey, sum(k.length) AS sum_length, count(*) AS links FROM link k JOIN link t ON t.mlinkid = k.mlinkid GROUP BY t.compkey)"

Q["c1_trace"] = lambda v: K.trace(v("link"))
SQL["c1_trace"] = "SELECT mlinkid, compkey, usnode, dsnode FROM link"
Q["c2_trace_totals"] = lambda v: K.trace_totals(v("link"))
SQL["c2_trace_totals"] = f"WITH {TOTALS} SELECT compkey, sum_length, links FROM totals"
Q["c3_crossings"] = lambda v: K.crossings(v("link"), v("linkxp"))
SQL["c3_crossings"] = f"WITH {CROSS} SELECT compkey, mlinkid, xschl, xhosp, xpol, xfire, xwtr, xgas, pstrttyp FROM cross_rows"
Q["c4_capital_replacement"] = lambda v: rounded(K.capital_replacement(v("link"), v("linkcost")), ["cost"], 2)
SQL["c4_capital_replacement"] = "SELECT k.mlinkid, k.compkey, round(c.totalconstructioncost, 2) AS cost FROM link k JOIN linkcost c ON c.mlinkid = k.mlinkid"
Q["c5_replacement_cost"] = lambda v: _money(K.replacement_cost(v("link"), v("linkcost"), v("linkxp")))
C5 = _label("sum(c.totalconstructioncost)", "REPLACEMENT", 1, 3).replace("SELECT compkey", "SELECT k.compkey") + """
 FROM link k JOIN linkcost c ON c.mlinkid = k.mlinkid JOIN linkxp x ON x.mlinkid = k.mlinkid JOIN link t ON t.mlinkid = k.mlinkid GROUP BY k.compkey"""
SQL["c5_replacement_cost"] = C5
Q["c6_emergency_repair"] = lambda v: _money(K.emergency_repair(v("link"), v("linkcost"), COSTS))
C6 = _label("sum(1.4 * c.totalconstructioncost / nullif(t.sum_length, 0) * CASE WHEN t.sum_length < 10 THEN t.sum_length ELSE 10 END)", "EMERGENCYREPAIR", 1, 2).replace(
    "SELECT compkey", "SELECT k.compkey"
) + " FROM link k JOIN linkcost c ON c.mlinkid = k.mlinkid JOIN totals t ON t.compkey = k.compkey GROUP BY k.compkey"
SQL["c6_emergency_repair"] = f"WITH {TOTALS} {C6}"
Q["c7_emergency_lateral"] = lambda v: _money(K.emergency_lateral_repair(v("link"), COSTS))
C7 = _label("sum(5000)", "EMERGENCYLATERALREPAIR", 2, 2) + " FROM totals GROUP BY compkey"
SQL["c7_emergency_lateral"] = f"WITH {TOTALS} {C7}"
Q["c8_separated_area_fine"] = lambda v: _money(K.separated_area_fine(v("link"), v("linktype"), COSTS))
C8 = _label("sum(2000)", "SEPARATEDAREA", 1, 9) + " FROM link k JOIN linktype y ON y.mlinkid = k.mlinkid GROUP BY compkey, type HAVING type = 'S'"
SQL["c8_separated_area_fine"] = C8
Q["c9_basement_flooding"] = lambda v: _money(K.basement_flooding(v("link"), COSTS))
C9 = _label("sum(2 * 9000 * 0.5)", "BASEMENTFLOODING", 1, 10) + " FROM totals GROUP BY compkey"
SQL["c9_basement_flooding"] = f"WITH {TOTALS} {C9}"
Q["c10_flooding_health"] = lambda v: _money(K.flooding_health(v("link"), v("linkxp"), v("street"), COSTS))
C10 = _label("sum(9000 * 2 * 0.5)", "PUBHEALTHBSMT", 1, 12) + " FROM cross_rows WHERE compkey IN (SELECT compkey FROM totals) GROUP BY compkey"
SQL["c10_flooding_health"] = f"WITH {CROSS}, {TOTALS} {C10}"


def _sink(amount, reason, test):
    return _label(f"sum({amount})", reason, 1, 12) + (
        f" FROM cross_rows x JOIN street s ON s.street_number = x.pstrttyp GROUP BY compkey, street_grp HAVING {test}"
    )


C11B = _sink(250000, "PUBHEALTHSINKFRWY", "street_grp = 'Frwy'")
C11C = _sink(120000, "PUBHEALTHSINKMJRART", "street_grp = 'MjrArt'")
C11D = _sink(40000, "PUBHEALTHSINKRES", "street_grp = 'Art' OR street_grp = 'Strt'")
Q["c11_sinkholes"] = lambda v: _money(K.sinkholes(v("link"), v("linkxp"), v("street"), COSTS))
SQL["c11_sinkholes"] = f"WITH {CROSS} {C11B} UNION ALL {C11C} UNION ALL {C11D}"
Q["c12_near_public_building"] = lambda v: _money(K.near_public_building(v("link"), v("linkxp"), v("street"), COSTS))
C12 = _label("sum(15000)", "PUBHEALTHNEARPUBBLDG", 1, 12) + (
    " FROM cross_rows GROUP BY compkey, xschl, xhosp, xpol, xfire HAVING xschl > 0 OR xhosp > 0 OR xpol > 0 OR xfire > 0"
)
SQL["c12_near_public_building"] = f"WITH {CROSS} {C12}"
Q["c13_spill_and_school"] = lambda v: _money(
    K.spill_and_school(v("link"), v("linkxp"), v("street"), COSTS)
)
C13F = _label("sum(8000)", "PUBHEALTHSPILLNEARSCH", 1, 12) + " FROM cross_rows GROUP BY compkey, xschl HAVING xschl > 0"
C13G = _label("sum(3000)", "PUBHEALTHSPILLNEARSCH", 1, 12) + " FROM cross_rows GROUP BY compkey, xschl HAVING xschl = 0"
SQL["c13_spill_and_school"] = f"WITH {CROSS} {C13F} UNION ALL {C13G}"
HEALTH = f"health AS ({' UNION '.join([C10, C11B, C11C, C11D, C12, C13F, C13G])})"
Q["c14_all_health_safety"] = lambda v: _money(K.all_health_safety(v("link"), v("linkxp"), v("street"), COSTS))
SQL["c14_all_health_safety"] = f"WITH {CROSS}, {TOTALS}, {HEALTH} SELECT * FROM health"
Q["c15_health_safety"] = lambda v: _money(K.health_safety(v("link"), v("linkxp"), v("street"), COSTS))
C15 = _label("sum(consequence)", "PUBHEALTHSAFETY", 1, 12) + " FROM health WHERE compkey IN (SELECT compkey FROM totals) GROUP BY compkey"
SQL["c15_health_safety"] = f"WITH {CROSS}, {TOTALS}, {HEALTH} {C15}"
Q["c16_lateral_flooding"] = lambda v: _money(K.lateral_flooding(v("link"), COSTS).unionByName(K.lateral_flooding_health(v("link"), COSTS)))
C16A = _label("9000", "BASEMENTFLOODING", 2, 10) + " FROM totals GROUP BY compkey"
C16B = _label("9000", "BASEMENTFLOODING", 2, 12) + " FROM totals"
SQL["c16_lateral_flooding"] = f"WITH {TOTALS} {C16A} UNION ALL {C16B}"


def _all(v):
    return (v("link"), v("linkcost"), v("linktype"), v("linkxp"), v("street"), COSTS)


Q["c17_all_mortality_components"] = lambda v: _money(K.all_mortality_components(*_all(v)))
SQL["c17_all_mortality_components"] = f"WITH {CROSS}, {TOTALS}, {HEALTH} " + " UNION ".join([C5, C6, C7, C8, C9, "SELECT * FROM health", C16A, C16B])
Q["c17_all_mortality"] = lambda v: _money(K.all_mortality(*_all(v)))
SQL["c17_all_mortality"] = f"WITH {CROSS}, {TOTALS}, {HEALTH} " + " UNION ".join([C6, C8, C9, C15])
Q["c18_total_mortality"] = lambda v: _money(K.total_mortality(*_all(v)))
SQL["c18_total_mortality"] = (
    f"WITH {CROSS}, {TOTALS}, {HEALTH}, every_layer AS ({' UNION '.join([C6, C8, C9, C15])}) "
    "SELECT compkey, round(sum(consequence) + 0.0000001, 2) AS consequence FROM every_layer GROUP BY compkey"
)


def _layers(v):
    xp = v("site")
    return [
        K.consequence_layer(xp, F.col("pstrttyp") == 1110, 70_000.0),
        K.consequence_layer(xp, F.col("xecsi") > 1, F.col("length") * 20.0),
        K.consequence_layer(xp, F.col("hardarea") == 1, 1500.0),
        K.consequence_layer(v("xp"), F.col("xfire") > 2, 900.0),
    ]


def _total(v, add):
    seg = K.total_consequence(v("seg").select("id", "compkey", "replacecost"), _layers(v), add_emergency=add)
    wholes = K.whole_consequence(v("whole").select("id", "compkey"), seg)
    return rounded(seg.select("id", "cof").unionByName(wholes.select("id", "cof")), ["cof"], 2)


def _total_sql(add):
    return f"""
WITH c AS (SELECT s.id, s.compkey, CASE WHEN t.pstrttyp = 1110 OR t.xecsi > 1 OR t.hardarea = 1 OR x.xfire > 2 THEN
   (CASE WHEN t.pstrttyp = 1110 THEN 70000 ELSE 0 END) + (CASE WHEN t.xecsi > 1 THEN t.length * 20 ELSE 0 END) + (CASE WHEN t.hardarea = 1 THEN 1500 ELSE 0 END)
   + (CASE WHEN x.xfire > 2 THEN 900 ELSE 0 END) END {add} AS cof
 FROM seg s JOIN site t ON t.id = s.id JOIN xp x ON x.id = s.id)
SELECT id, round(cof, 2) AS cof FROM c UNION ALL
SELECT w.id, (SELECT round(max(c.cof), 2) FROM c WHERE c.compkey = w.compkey AND c.compkey > 0) AS cof FROM whole w
"""


Q["c19_total_consequence"] = lambda v: _total(v, False)
SQL["c19_total_consequence"] = _total_sql("")
Q["c20_consequence_with_emergency"] = lambda v: _total(v, True)
SQL["c20_consequence_with_emergency"] = _total_sql("+ 1.4 * s.replacecost")
