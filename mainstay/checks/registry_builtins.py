"""Registered queries of the forms that Spark has built in: predicates, joins, aggregates, unions, scalars."""

from __future__ import annotations

from pyspark.sql import functions as F

from mainstay import params as P
from mainstay.checks.common import Query, YEAR
from mainstay.functions.scalar import factor_power, zero
from mainstay.operators.costs import bypass_flow

Q: dict[str, Query] = {}
SQL: dict[str, str] = {}

Q["f5_in_list"] = lambda v: (
    v("sanitary").filter(F.lower("unittype").isin(*P.MAINTAINED_UNITS_SANITARY) & ~F.col("servstat").isin("ABAN", "TBAB")).select("compkey", "unittype")
)
SQL["f5_in_list"] = """
SELECT compkey, unittype FROM sanitary WHERE lower(unittype) IN ('saml', 'csml', 'csint', 'saint', 'csdet', 'csotn', 'embpg') AND servstat <> 'ABAN' AND servstat <> 'TBAB'
"""
Q["f6_unknown_is_not_true"] = lambda v: v("ratios").filter(~F.lower("problems").contains("oval")).select("compkey", "problems")
SQL["f6_unknown_is_not_true"] = "SELECT compkey, problems FROM ratios WHERE problems NOT ILIKE '%oval%'"


def _constants(v):
    # The largest street group stands in for the one row of constants.
    constants = v("street").agg(F.max("street_number").cast("double").alias("factor"))
    return v("seg").crossJoin(F.broadcast(constants)).select("id", F.round(F.col("length") * F.col("factor"), 2).alias("amount"))


Q["f8_constants"] = _constants
SQL["f8_constants"] = "SELECT s.id, round(s.length * c.factor, 2) AS amount FROM seg s CROSS JOIN (SELECT CAST(max(street_number) AS DOUBLE) AS factor FROM street) c"
Q["j3_cross_join_one_row"] = lambda v: (
    v("pipe").crossJoin(F.broadcast(v("pipe").agg(F.max("length").alias("longest")))).select("compkey", F.round(F.col("length") / F.col("longest"), 6).alias("share"))
)
SQL["j3_cross_join_one_row"] = "SELECT compkey, round(length / (SELECT max(length) FROM pipe), 6) AS share FROM pipe"
Q["a1_grouped_aggregates"] = lambda v: v("seg").groupBy("compkey").agg(
    F.sum("length").alias("feet"), F.count(F.lit(1)).alias("cuts"), F.min("fm").alias("first_from"), F.max("to_").alias("last_to")
)
SQL["a1_grouped_aggregates"] = "SELECT compkey, sum(length) AS feet, count(*) AS cuts, min(fm) AS first_from, max(to_) AS last_to FROM seg GROUP BY compkey"
Q["a3_weighted_sum"] = lambda v: v("scored").groupBy("compkey").agg(
    F.sum(F.when(F.col("def_tot") >= 1000, 0.0).otherwise(F.col("length")) * F.when(F.col("action") == 3, 0.0).otherwise(1.0)).alias("good_feet")
)
SQL["a3_weighted_sum"] = """
SELECT compkey, sum(CASE WHEN def_tot >= 1000 OR action = 3 THEN 0 ELSE length END) AS good_feet FROM scored GROUP BY compkey
"""
_FLAGS = ["xschl", "xhosp", "xpol", "xfire"]
Q["a8_group_by_flags"] = lambda v: v("xp").groupBy("compkey", *_FLAGS).agg(F.count(F.lit(1)).alias("rows")).drop(*_FLAGS)
SQL["a8_group_by_flags"] = "SELECT compkey, count(*) AS rows FROM xp GROUP BY compkey, xschl, xhosp, xpol, xfire"
Q["u1_union_distinct"] = lambda v: v("sanitary").select("compkey", "servstat").unionByName(v("storm").select("compkey", "servstat")).union(
    v("sanitary").select("compkey", "servstat")
).distinct()
SQL["u1_union_distinct"] = "SELECT compkey, servstat FROM sanitary UNION SELECT compkey, servstat FROM storm UNION SELECT compkey, servstat FROM sanitary"
Q["u2_union_all"] = lambda v: v("seg").select("id", "length").unionByName(v("whole").select("length", "id"))
SQL["u2_union_all"] = "SELECT id, length FROM seg UNION ALL SELECT id, length FROM whole"
Q["o2_first_by_order"] = lambda v: v("chg").groupBy("compkey").agg(F.min_by("chdetail", F.struct("distfrom", "distto", "chdetail")).alias("first_detail"))
SQL["o2_first_by_order"] = """
SELECT compkey, chdetail AS first_detail FROM chg QUALIFY row_number() OVER (PARTITION BY compkey ORDER BY distfrom, distto, chdetail) = 1
"""
Q["e1_null_as_zero"] = lambda v: v("site").select("id", (zero("xgas") + zero("xftezonc")).alias("n"))
SQL["e1_null_as_zero"] = "SELECT id, CAST(coalesce(xgas, 0) + coalesce(xftezonc, 0) AS DOUBLE) AS n FROM site"
Q["e2_nested_case"] = lambda v: v("site").select("id", F.when(
    F.col("hardarea") > 0, F.when(F.col("prail") > 0, F.when(F.col("plrt") > 0, "abc").otherwise("ab")).otherwise("a")
).when(F.col("xgas").isNull(), "?").otherwise("-").alias("kind"))
SQL["e2_nested_case"] = """
SELECT id, CASE WHEN hardarea > 0 THEN CASE WHEN prail > 0 THEN CASE WHEN plrt > 0 THEN 'abc' ELSE 'ab' END ELSE 'a' END WHEN xgas IS NULL THEN '?' ELSE '-' END AS kind FROM site
"""
Q["e3_math"] = lambda v: v("site").select(
    "id", F.round(F.exp(0.0119 * F.col("diamwidth")) * F.pi() * F.abs("gslope"), 8).alias("x"), factor_power(F.col("prail")).alias("p")
)
SQL["e3_math"] = "SELECT id, round(exp(0.0119 * diamwidth) * pi() * abs(gslope), 8) AS x, CASE prail WHEN 0 THEN 1.0 WHEN 1 THEN 1.5 ELSE CAST(2.3 AS DOUBLE) END AS p FROM site"
Q["e4_dates"] = lambda v: v("pipe").select("compkey", (F.lit(YEAR) - F.year("instdate")).alias("age"), (F.year("instdate") + F.col("insp_curr")).alias("later"))
SQL["e4_dates"] = f"SELECT compkey, CAST({YEAR} - year(instdate) AS INT) AS age, CAST(year(instdate + to_years(insp_curr)) AS INT) AS later FROM pipe"
Q["e6_casts"] = lambda v: v("surch").join(v("bands").agg(F.max("yearstofailure").alias("y")), how="cross").select(
    "compkey", F.expr("try_cast(ussurch AS DOUBLE)").alias("feet"), (F.col("y") * -0.99).cast("int").alias("cut")
)
SQL["e6_casts"] = "SELECT s.compkey, try_cast(s.ussurch AS DOUBLE) AS feet, CAST(trunc(b.y * CAST(-0.99 AS DOUBLE)) AS INT) AS cut FROM surch s CROSS JOIN (SELECT max(yearstofailure) AS y FROM bands) b"
Q["e8_power"] = lambda v: v("site").select("id", F.round(bypass_flow(), 6).alias("flow"), F.pow("diamwidth", F.lit(3.0)).alias("cube"))
SQL["e8_power"] = """
SELECT id, round(0.2 * 1.486 / 0.013 * pow(diamwidth / 48, CAST(2 AS DOUBLE) / 3) * pow(CASE WHEN xpipslope > 0 THEN xpipslope ELSE CAST(0.005 AS DOUBLE) END, 0.5), 6) AS flow, pow(diamwidth, 3) AS cube FROM site
"""
