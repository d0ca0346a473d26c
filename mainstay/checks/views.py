"""Stand-in inputs over the test tables, as SQL that Spark and DuckDB both accept.

The same texts feed the Spark queries (as temporary views) and the comparison SQL
(as a WITH prelude). A view may use the base tables and the views before it.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

from mainstay.operators.skew import HotKeys, hot_keys
from mainstay.scratch import written

# Declared schemas of the base tables the views read.
TABLES = {
    "customer": "c_custkey BIGINT, c_name STRING, c_nationkey INT, c_acctbal DOUBLE, c_mktsegment STRING",
    "part": "p_partkey BIGINT, p_name STRING, p_brand STRING, p_type STRING, p_size INT, p_retailprice DOUBLE",
    "orders": "o_orderkey BIGINT, o_custkey BIGINT, o_orderstatus STRING, o_totalprice DOUBLE, o_orderdate TIMESTAMP_NTZ, "
    "o_orderpriority STRING",
    "lineitem": "l_orderkey BIGINT, l_partkey BIGINT, l_suppkey BIGINT, l_linenumber INT, l_quantity DOUBLE, "
    "l_extendedprice DOUBLE, l_discount DOUBLE, l_tax DOUBLE, l_returnflag STRING, l_linestatus STRING, l_shipdate TIMESTAMP_NTZ",
    "events": "event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, value DOUBLE, props STRING",
}

VIEWS: dict[str, str] = {}

VIEWS["seg"] = """
SELECT CAST(40000000 + l.l_orderkey * 100 + l.cutno AS BIGINT) AS id, l.l_orderkey AS compkey, CAST(l.cutno AS INT) AS cutno,
       l.fm, l.fm + l.l_quantity AS to_, l.l_quantity AS length, p.p_size AS diamwidth,
       CASE WHEN l.l_orderkey % 4 = 0 THEN 'VARIES' ELSE p.p_type END AS material,
       CASE WHEN l.l_linestatus = 'O' THEN 'BES' ELSE 'OTH' END AS remarks,
       CAST(count(*) OVER (PARTITION BY l.l_orderkey) AS INT) AS seg_count, l.l_extendedprice AS replacecost
FROM (SELECT li.*,
        row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_extendedprice, l_shipdate) AS cutno,
        coalesce(sum(l_quantity) OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_extendedprice, l_shipdate
                 ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS fm
      FROM lineitem li) l
JOIN part p ON p.p_partkey = l.l_partkey
"""

VIEWS["whole"] = """
SELECT o.o_orderkey AS id, o.o_orderkey AS compkey, 0 AS cutno, o.o_orderkey AS usnode, o.o_orderkey + 1 AS dsnode, s.length,
       CASE WHEN o.o_orderstatus = 'P' THEN NULL ELSE CAST(o.o_orderdate AS DATE) END AS instdate,
       CASE o.o_orderpriority WHEN '1-URGENT' THEN 'PEND' WHEN '2-HIGH' THEN 'TBAB' WHEN '3-MEDIUM' THEN 'ABAN' WHEN '5-LOW' THEN 'NEW' ELSE 'IN' END AS hservstat,
       o.o_totalprice AS replacecost, CAST(o.o_custkey % 6 AS INT) AS grade_h5
FROM orders o JOIN (SELECT l_orderkey, sum(l_quantity) AS length FROM lineitem GROUP BY l_orderkey) s ON s.l_orderkey = o.o_orderkey
"""

VIEWS["insp"] = """
SELECT user_id * 100 + day(ts) AS inspkey, user_id AS compkey, CAST(date_trunc('week', min(ts)) AS DATE) AS startdttm,
       CASE WHEN (user_id * 100 + day(ts)) % 11 = 0 THEN NULL ELSE CAST(date_trunc('week', max(ts)) AS DATE) END AS compdttm
FROM events GROUP BY user_id, day(ts)
"""

VIEWS["obs"] = """
SELECT event_id AS obskey, user_id * 100 + day(ts) AS inspkey,
       CASE event_type WHEN 'error' THEN 'BP' WHEN 'purchase' THEN 'BRK' WHEN 'click' THEN 'CR' WHEN 'view' THEN 'DS' ELSE 'LT' END AS obcode,
       1000 + event_id % 50 AS obsevkey, CAST(floor(value) AS DOUBLE) AS distfrom,
       CASE WHEN event_id % 13 = 0 THEN NULL ELSE CAST(floor(value) + 5 * (event_id % 4) AS DOUBLE) END AS distto,
       CASE event_id % 7 WHEN 0 THEN 'A25' WHEN 1 THEN 'B50' WHEN 2 THEN 'CUW' WHEN 3 THEN 'BRKO' WHEN 4 THEN 'OS' ELSE 'OTHER' END AS severity,
       CAST(event_id % 5 AS INT) AS obrating
FROM events
"""

VIEWS["peak"] = """
SELECT DISTINCT 1000 + event_id % 50 AS obsevkey, CAST((event_id % 50) * 4 AS DOUBLE) AS peak_score FROM events
"""

VIEWS["chg"] = """
SELECT l_orderkey AS compkey, 'MATERIAL' AS chtype,
       CASE l_suppkey % 3 WHEN 0 THEN 'MAT-VSP' WHEN 1 THEN 'MAT-PVC' ELSE 'MAT-CSP' END AS chdetail,
       CAST(l_linenumber * 10 AS DOUBLE) AS distfrom, l_linenumber * 10 + l_quantity AS distto
FROM lineitem WHERE l_returnflag = 'R'
"""

VIEWS["xp"] = """
SELECT s.id, s.compkey, CAST(s.id % 3 AS INT) AS xschl, CAST(s.id % 5 AS INT) AS xhosp, CAST(s.id % 7 AS INT) AS xpol,
       CASE WHEN s.id % 11 = 0 THEN NULL ELSE CAST(s.id % 4 AS INT) END AS xfire, CAST(s.id % 2 AS INT) AS xwtr,
       CAST(s.id % 3 AS INT) AS xgas, CAST(s.diamwidth AS DOUBLE) / 2 AS udepth, CAST(s.diamwidth AS DOUBLE) * 0.75 AS ddepth,
       CAST(CASE s.id % 4 WHEN 0 THEN 1110 WHEN 1 THEN 1300 WHEN 2 THEN 1400 ELSE 1500 END AS INT) AS pstrttyp
FROM seg s
"""

VIEWS["edge"] = """
SELECT s.id, (s.compkey % 100) * 300 + s.fm AS x1, CAST(floor(s.compkey / 100) * 100 AS DOUBLE) AS y1,
       (s.compkey % 100) * 300 + s.to_ AS x2, CAST(floor(s.compkey / 100) * 100 AS DOUBLE) AS y2
FROM seg s
"""

VIEWS["poi"] = """
SELECT c_custkey AS feature_id, CAST((c_custkey * 137) % 30000 AS DOUBLE) AS x, CAST((c_custkey * 61) % 15000 AS DOUBLE) AS y,
       CASE c_mktsegment WHEN 'BUILDING' THEN 'school' WHEN 'MACHINERY' THEN 'fire' WHEN 'AUTOMOBILE' THEN 'police' ELSE 'hospital' END AS layer
FROM customer
"""

VIEWS["zone"] = """
SELECT p_partkey AS feature_id, CAST((p_partkey * 211) % 30000 AS DOUBLE) AS x1, CAST((p_partkey * 89) % 15000 AS DOUBLE) AS y1,
       CAST((p_partkey * 211) % 30000 + p_size * 10 AS DOUBLE) AS x2, CAST((p_partkey * 89) % 15000 + p_size * 10 AS DOUBLE) AS y2
FROM part
"""

# Lines that run across the pipes: streets, utilities, sewers and water mains in one table.
VIEWS["line"] = """
SELECT p_partkey AS feature_id, CAST((p_partkey * 173) % 30000 AS DOUBLE) AS x1, CAST((p_partkey * 97) % 15000 AS DOUBLE) AS y1,
       CAST((p_partkey * 173) % 30000 + (p_partkey % 9 - 4) * 20 AS DOUBLE) AS x2, CAST((p_partkey * 97) % 15000 + p_size * 6 AS DOUBLE) AS y2,
       CASE p_partkey % 5 WHEN 0 THEN 'gas' WHEN 1 THEN 'fiber' WHEN 2 THEN 'lrt' WHEN 3 THEN 'rail' ELSE 'emt' END AS layer,
       CASE p_partkey % 4 WHEN 0 THEN 'S' WHEN 1 THEN 'A' WHEN 2 THEN 'M' ELSE 'F' END AS type,
       CAST(CASE p_partkey % 4 WHEN 0 THEN 1500 WHEN 1 THEN 1400 WHEN 2 THEN 1300 ELSE 1110 END AS INT) AS value,
       CAST(p_size AS DOUBLE) AS pipesize, CAST(p_size AS DOUBLE) / 2 AS mainsize,
       concat('N', CAST(p_partkey AS VARCHAR(20))) AS us_node, concat('n', CAST(p_partkey + 1 AS VARCHAR(20)), ' ') AS ds_node,
       CASE WHEN p_partkey % 6 = 0 THEN 'ABN' WHEN p_partkey % 7 = 0 THEN NULL ELSE 'OP' END AS status,
       CAST(2 + p_partkey % 4 AS INT) AS count_streets
FROM part
"""

VIEWS["streetname"] = """
SELECT * FROM (VALUES (1500, 'S'), (1400, 'A'), (1300, 'M'), (1110, 'F')) AS t(value, type)
"""

VIEWS["street"] = """
SELECT * FROM (VALUES (1110, 'Frwy'), (1300, 'MjrArt'), (1400, 'Art'), (1500, 'Strt')) AS t(street_number, street_grp)
"""

VIEWS["link"] = """
SELECT s.id AS mlinkid, s.compkey, s.id AS usnode, s.id + 1 AS dsnode, s.length FROM seg s
"""

VIEWS["linkcost"] = """
SELECT s.id AS mlinkid, s.replacecost AS totalconstructioncost FROM seg s
"""

VIEWS["linktype"] = """
SELECT s.id AS mlinkid, CASE s.id % 3 WHEN 0 THEN 'S' WHEN 1 THEN 'C' ELSE 'T' END AS type FROM seg s
"""

VIEWS["linkxp"] = """
SELECT x.id AS mlinkid, x.xschl, x.xhosp, x.xpol, x.xfire, x.xwtr, x.xgas, x.pstrttyp FROM xp x
"""

# Segments with results of the earlier steps.
VIEWS["scored"] = """
SELECT s.id, s.compkey, s.cutno, s.fm, s.to_, s.length, s.diamwidth, s.material, s.remarks, s.seg_count, s.replacecost,
       CAST((s.id * 7) % 1500 AS DOUBLE) AS def_tot,
       CAST(CASE WHEN s.id % 19 = 0 THEN NULL WHEN s.id % 23 = 0 THEN 0 ELSE 2010 + (s.id * 13) % 75 END AS INT) AS fail_yr_seg,
       CAST(2010 + (s.id * 13) % 75 AS INT) AS fail_yr,
       CAST(CASE WHEN s.id % 17 = 0 THEN 3 ELSE 1 END AS INT) AS action,
       CAST(CASE WHEN s.id % 17 = 0 OR (s.id * 7) % 1500 >= 1000 THEN 1 ELSE 0 END AS INT) AS spot_count,
       s.replacecost * 2 + (s.id % 5) * 1000 AS cof, s.replacecost * 0.5 AS linercost
FROM seg s
"""

VIEWS["pipe"] = """
SELECT w.id, w.compkey, 0 AS cutno, w.usnode, w.dsnode, w.length, w.instdate, w.hservstat, w.replacecost, w.grade_h5,
       CAST(2010 + w.compkey % 60 AS INT) AS fail_yr,
       CAST(CASE WHEN w.compkey % 7 = 0 THEN 7.35 ELSE 5 + w.compkey % 4 END AS DOUBLE) AS std_dev,
       w.replacecost * 0.25 AS spotcost, w.replacecost * 0.5 AS line_alone, w.replacecost * 0.5 AS linercost,
       CASE WHEN w.compkey % 3 = 0 THEN 'OTH' ELSE 'BES' END AS remarks, CAST(1 + w.compkey % 4 AS INT) AS insp_curr,
       CAST(w.compkey % 3 AS INT) AS spot_count, CAST(w.compkey % 40 AS DOUBLE) AS rulife, CAST(1 AS INT) AS action,
       w.replacecost * 3 AS cof
FROM whole w
"""

VIEWS["jobs"] = """
SELECT s.id, s.compkey, 'Spot' AS type, s.cutno, CAST(s.diamwidth AS DOUBLE) AS diamwidth, s.replacecost AS capitalnonmobilization,
       CAST(500 + s.id % 700 AS DOUBLE) AS capitalmobilizationrate, CAST(4 + 4 * (s.id % 2) AS DOUBLE) AS basetime,
       CAST(4 + s.id % 6 AS DOUBLE) AS mobilizationtime
FROM scored s
UNION ALL
SELECT w.id, w.compkey, 'Line' AS type, 0 AS cutno, CAST(10 + w.compkey % 50 AS DOUBLE) AS diamwidth, w.replacecost * 0.5 AS capitalnonmobilization,
       CAST(800 + w.compkey % 900 AS DOUBLE) AS capitalmobilizationrate, CAST(24 AS DOUBLE) AS basetime, CAST(6 + w.compkey % 5 AS DOUBLE) AS mobilizationtime
FROM pipe w
UNION ALL
SELECT w.id, w.compkey, 'Dig' AS type, 0 AS cutno, CAST(10 + w.compkey % 50 AS DOUBLE) AS diamwidth, w.replacecost AS capitalnonmobilization,
       CAST(900 + w.compkey % 1100 AS DOUBLE) AS capitalmobilizationrate, CAST(40 + w.compkey % 30 AS DOUBLE) AS basetime, CAST(8 + w.compkey % 7 AS DOUBLE) AS mobilizationtime
FROM pipe w
"""

_XP_COLUMNS = """
       CAST({k} % 2 AS INT) AS pwtr, CAST(4 + {k} % 20 AS DOUBLE) AS pwtrmaxd, CAST({k} % 3 AS INT) AS xsewer, CAST({k} % 2 AS INT) AS xwtr,
       CASE WHEN {k} % 5 = 0 THEN NULL ELSE CAST({k} % 3 AS INT) END AS xgas, CAST({k} % 4 AS INT) AS xfiber, CAST({k} % 3 AS INT) AS xecsi,
       CASE WHEN {k} % 6 = 0 THEN CAST(12 AS DOUBLE) ELSE NULL END AS xftezonc, CAST({k} % 4 AS DOUBLE) AS xftezonp,
       CAST({k} % 2 AS INT) AS hardarea, CAST({k} % 3 AS INT) AS prail, CAST({k} % 5 AS INT) AS plrt, CAST({k} % 30 - 15 AS DOUBLE) / 100 AS gslope,
       CAST(CASE {k} % 4 WHEN 0 THEN 1110 WHEN 1 THEN 1300 WHEN 2 THEN 1400 ELSE 1500 END AS INT) AS pstrttyp,
       CASE {k} % 6 WHEN 0 THEN 'A' WHEN 1 THEN 'S' WHEN 2 THEN 'H' WHEN 3 THEN 'F' WHEN 4 THEN 'M' ELSE NULL END AS pstrttext,
       CASE WHEN {k} % 9 = 0 THEN NULL ELSE CAST({k} % 6 AS INT) END AS uxclx, CAST({k} % 8 AS INT) - 6 AS xbldg, CAST(CASE WHEN {k} % 31 = 0 THEN 1 ELSE 0 END AS INT) AS xlrt,
       CAST(CASE WHEN {k} % 29 = 0 THEN 1 ELSE NULL END AS INT) AS xrail, CAST(CASE WHEN {k} % 37 = 0 THEN 2 ELSE 0 END AS INT) AS xfrwy,
       CAST({k} % 40 - 10 AS DOUBLE) / 1000 AS xpipslope, CAST({k} % 4 AS BIGINT) AS lateral_count
"""

# Segments and whole pipes with everything the cost formulas read.
VIEWS["site"] = (
    "SELECT s.id, s.compkey, s.cutno, s.fm, s.to_, s.length, CAST(s.diamwidth AS DOUBLE) AS diamwidth, "
    "CAST(s.diamwidth AS DOUBLE) / 2 AS udepth, CAST(s.diamwidth AS DOUBLE) * 0.75 AS ddepth, "
    "CAST(4 + 4 * (s.id % 2) AS DOUBLE) AS base_hours, CAST(4 + s.id % 6 AS DOUBLE) AS mob_hours,"
    + _XP_COLUMNS.format(k="s.id")
    + "FROM seg s"
)
VIEWS["wsite"] = (
    "SELECT w.id, w.compkey, 0 AS cutno, CAST(0 AS DOUBLE) AS fm, w.length AS to_, w.length, CAST(6 + w.compkey % 70 AS DOUBLE) AS diamwidth, "
    "CAST(5 + w.compkey % 25 AS DOUBLE) AS udepth, CAST(4 + w.compkey % 30 AS DOUBLE) AS ddepth, "
    "CAST(20 + w.compkey % 9 AS DOUBLE) AS base_hours, CAST(4 + w.compkey % 6 AS DOUBLE) AS mob_hours,"
    + _XP_COLUMNS.format(k="w.compkey")
    + "FROM whole w"
)
VIEWS["wholexp"] = """
SELECT w.compkey, w.udepth, w.ddepth, w.xbldg, w.xlrt, w.xrail, w.xfrwy AS countxfrwy,
       CAST(CASE WHEN w.compkey % 3 = 0 THEN NULL ELSE w.compkey % 2 END AS INT) AS countxart, CAST(w.compkey % 5 - 4 AS INT) AS countxmjart
FROM wsite w
"""


def _rates(columns: str, *rows: tuple[float, ...]) -> str:
    names = columns.split()
    body = ", ".join("(" + ", ".join(str(v) for v in row) + ")" for row in rows)
    picked = ", ".join(f"CAST({n} AS DOUBLE) AS {n}" for n in names)
    return f"SELECT {picked} FROM (VALUES {body}) AS t({', '.join(names)})"


VIEWS["diameters"] = _rates("inside outside", (6, 8), (12, 15), (21, 25), (36, 42), (48, 55), (80, 90))
VIEWS["trenches"] = _rates("max_outside width", (10, 3), (20, 4), (30, 5), (50, 7), (100, 11))
VIEWS["depth_rates"] = _rates("depth cost_per_yard", (4, 9), (8, 11), (12, 14), (20, 21), (30, 33), (60, 52))
VIEWS["prices"] = _rates("min_diameter price", (4, 20), (8, 31), (12, 44), (24, 97), (48, 210))
VIEWS["difficulty"] = _rates(
    "min_diameter min_depth factor", (6, 0, 1), (6, 10, 1.2), (6, 20, 1.5), (24, 0, 1.1), (24, 15, 1.6), (42, 10, 2)
)
VIEWS["mh_sizes"] = _rates("max_inside manhole_size", (12, 48), (24, 60), (36, 72), (60, 96))
VIEWS["mh_prices"] = _rates("max_size base_cost per_foot rim", (48, 10, 20, 500), (60, 12, 25, 600), (72, 15, 30, 700), (96, 20, 40, 900))
VIEWS["mh_factors"] = _rates("min_size min_depth factor", (48, 0, 1), (48, 12, 1.25), (72, 0, 1.5), (72, 15, 2))
VIEWS["bypass_rates"] = _rates("flow cost", (0, 100), (1, 250), (2, 400), (4, 900))
VIEWS["liner_prices"] = _rates("max_diameter price", (8, 40), (15, 66), (30, 140), (50, 260), (90, 480))
VIEWS["cleaning_prices"] = _rates("max_diameter price", (12, 3), (24, 5), (90, 9))

VIEWS["rosetta"] = """
SELECT DISTINCT p_type AS category, CASE WHEN p_type < 'F' THEN 'rigid' WHEN p_type < 'N' THEN 'flex' WHEN p_type < 'S' THEN 'lined' ELSE 'none' END AS curve
FROM part
"""
VIEWS["bands"] = """
SELECT curve, CAST(lo AS DOUBLE) AS score_lower_bound, CAST(hi AS DOUBLE) AS score_upper_bound, CAST(years AS DOUBLE) AS yearstofailure
FROM (VALUES ('rigid', 0, 100, 80.5), ('rigid', 100, 1000, 45.25), ('rigid', 1000, 1000000, 12.75), ('flex', 0, 500, 60), ('flex', 500, 1000000, 20),
             ('lined', 0, 1000, 33.9)) AS t(curve, lo, hi, years)
"""
VIEWS["sanitary"] = """
SELECT w.compkey, concat('s', w.hservstat) AS note, w.hservstat AS servstat,
       CASE w.compkey % 4 WHEN 0 THEN 'saml' WHEN 1 THEN 'CSML' WHEN 2 THEN 'lat' ELSE 'embpg' END AS unittype,
       CASE WHEN w.compkey % 5 = 0 THEN 'AB1234' WHEN w.compkey % 5 = 1 THEN 'abc123 ' ELSE 'ABC123' END AS unitid,
       CASE WHEN w.compkey % 11 = 0 THEN 'ABC123X' ELSE 'XYZ789' END AS unitid2, 'BES' AS own
FROM whole w WHERE w.grade_h5 < 3
"""
VIEWS["storm"] = """
SELECT w.compkey, 'TBAB' AS servstat, 'stml' AS unittype, 'ABC123' AS unitid, 'XYZ789' AS unitid2, CASE WHEN w.compkey % 2 = 0 THEN 'BES' ELSE 'PRIV' END AS own
FROM whole w WHERE w.grade_h5 = 4
UNION ALL
SELECT w.compkey, 'IN' AS servstat, 'stml' AS unittype, 'ABC123' AS unitid, 'XYZ789 ' AS unitid2, CASE WHEN w.compkey % 2 = 0 THEN 'BES' ELSE 'PRIV' END AS own
FROM whole w WHERE w.grade_h5 = 5
"""
VIEWS["grades"] = """
SELECT w.compkey, CASE WHEN w.compkey % 3 = 0 THEN 'OFID' ELSE 'XXXX' END AS altidtyp FROM whole w
"""
VIEWS["surch"] = """
SELECT w.compkey, CASE w.compkey % 6 WHEN 0 THEN '3.5' WHEN 1 THEN '4.0' WHEN 2 THEN 'n/a' WHEN 3 THEN '0' WHEN 4 THEN '12' ELSE NULL END AS ussurch FROM whole w
"""
VIEWS["idx"] = """
SELECT i.inspkey, CAST(i.inspkey % 9 AS INT) AS rating FROM insp i WHERE i.inspkey % 8 <> 0
"""
# Latest observations with the columns that later steps read.
VIEWS["latest"] = """
SELECT o.obskey, o.inspkey, o.obcode, o.obsevkey, o.distfrom, o.distto, CAST(o.obrating AS DOUBLE) AS newscore, o.obrating AS rating,
       i.compkey, i.startdttm, i.compdttm
FROM obs o JOIN insp i ON i.inspkey = o.inspkey
JOIN (SELECT compkey, max(startdttm) AS last FROM insp GROUP BY compkey) m ON m.compkey = i.compkey AND m.last = i.startdttm
"""
# Branches with nine ratios, notes and a chosen method.
VIEWS["ratios"] = """
SELECT w.compkey, CAST(w.compkey % 13 - 6 AS DOUBLE) / 4 AS nbcr_oc_oc, CAST(w.compkey % 7 - 3 AS DOUBLE) / 2 AS nbcr_oc_cipp,
       CAST(w.compkey % 11 - 5 AS DOUBLE) / 4 AS nbcr_oc_sp, CAST(w.compkey % 5 - 2 AS DOUBLE) / 2 AS nbcr_cipp_oc,
       CASE WHEN w.compkey % 10 = 0 THEN NULL ELSE CAST(w.compkey % 17 - 8 AS DOUBLE) / 4 END AS nbcr_cipp_cipp,
       CAST(w.compkey % 9 - 4 AS DOUBLE) / 4 AS nbcr_cipp_sp, CAST(w.compkey % 3 - 1 AS DOUBLE) AS nbcr_sp_oc,
       CASE WHEN w.compkey % 21 = 0 THEN NULL ELSE CAST(w.compkey % 19 - 9 AS DOUBLE) / 4 END AS nbcr_sp_cipp,
       CAST(w.compkey % 23 - 11 AS DOUBLE) / 4 AS nbcr_sp_sp,
       CASE w.compkey % 6 WHEN 0 THEN NULL WHEN 1 THEN ', extensive ovaling' WHEN 2 THEN ', Extensive Sagging' ELSE ', extensive surcharge' END AS problems,
       CASE w.compkey % 4 WHEN 0 THEN 'SP' WHEN 1 THEN 'CIPP' ELSE 'OC' END AS solution,
       CAST(w.compkey % 9 - 4 AS DOUBLE) / 2 AS solution_nbcr, CAST(2010 + w.compkey % 60 AS INT) AS first_failure, w.replacecost * 3 AS max_cof,
       w.replacecost AS bpw_oc, w.replacecost * 2 AS bpw_sp, w.replacecost * 4 AS bpw_cipp, w.replacecost * 0.5 AS apw_sp,
       w.replacecost * 0.25 AS apw_cipp, w.replacecost * 0.75 AS apw_oc
FROM whole w
"""
# The final table before and after the costs are joined: both grains.
VIEWS["fin"] = """
SELECT s.id, s.compkey, s.cutno, s.length, s.remarks, CAST(s.id % 6 AS INT) AS grade_h5, s.fail_yr_seg AS failure_year, s.action, s.spot_count, s.cof,
       CAST(s.id % 900 AS DOUBLE) AS lateral_cost
FROM scored s
UNION ALL
SELECT w.id, w.compkey, w.cutno, w.length, w.remarks, w.grade_h5, w.fail_yr AS failure_year, w.action, w.spot_count, w.cof,
       CAST(w.compkey % 900 AS DOUBLE) AS lateral_cost
FROM pipe w
"""
VIEWS["done"] = """
SELECT f.*, CAST(CASE WHEN f.id % 3 = 0 THEN NULL ELSE f.id % 8000 END AS DOUBLE) AS spot_only, CAST(f.id % 30000 AS DOUBLE) AS whole_only, CAST(f.id % 20000 AS DOUBLE) AS liner_only,
       f.cof * 0.5 AS max_cof,
       CASE f.id % 7 WHEN 0 THEN 'OC' WHEN 1 THEN 'SP' WHEN 2 THEN 'CIPP' WHEN 3 THEN 'OC Sandwich' WHEN 4 THEN 'Watch me' WHEN 5 THEN NULL ELSE 'Do Nothing' END AS recommended,
       CASE WHEN f.cutno > 0 THEN NULL WHEN f.id % 4 = 0 THEN 'Do nothing' ELSE NULL END AS failure_action,
       CAST(f.id % 9 - 4 AS DOUBLE) AS recommended_nbcr, CAST(f.id % 5 AS DOUBLE) AS spot_nbcr, CAST(f.id % 6 AS DOUBLE) AS liner_nbcr, CAST(f.id % 7 AS DOUBLE) AS whole_nbcr,
       CAST(f.id % 100 AS DOUBLE) AS bpw, CAST(f.id % 101 AS DOUBLE) AS apw_spot, CAST(f.id % 102 AS DOUBLE) AS apw_liner, CAST(f.id % 103 AS DOUBLE) AS apw_whole
FROM fin f
"""


def _uses(text: str, names: list[str]) -> list[str]:
    return [n for n in names if re.search(rf"(?i)\b(?:from|join)\s+\(?{n}\b", text)]


def prelude(sql: str) -> str:
    """``sql`` with the stand-in views it needs as leading common table expressions.

    Tables that nothing reads are left out; those that are read more than once are materialized, so that the plan of a
    comparison doesn't repeat them.
    """
    order = list(VIEWS)
    needed: set[str] = set()

    def visit(text: str) -> None:
        for name in _uses(text, order):
            if name not in needed:
                needed.add(name)
                visit(VIEWS[name])

    own, body = _common_tables(sql.strip())
    visit(sql)
    tables = {name: VIEWS[name].strip() for name in order if name in needed} | own
    read: dict[str, int] = {}

    def count(text: str) -> None:
        for name in tables:
            uses = len(re.findall(rf"\b(?:FROM|JOIN)\s+{name}\b", text))
            if uses and name not in read:
                read[name] = uses
                count(tables[name])
            elif uses:
                read[name] += uses

    count(body)
    parts = [f"{name} AS {'MATERIALIZED ' if read[name] > 1 else ''}({text})" for name, text in tables.items() if name in read]
    return "WITH " + ",\n".join(parts) + "\n" + body if parts else body


def _common_tables(sql: str) -> tuple[dict[str, str], str]:
    """The leading common tables of a statement by name, and what follows them."""
    tables: dict[str, str] = {}
    rest = sql[5:] if sql[:5].upper() == "WITH " else ""
    while rest:
        name, text = re.match(r"\s*(\w+) AS \((.*)", rest, re.S).groups()
        depth, end = 1, 0
        quoted = False
        while depth:
            letter = text[end]
            quoted ^= letter == "'"
            depth += 0 if quoted else (letter == "(") - (letter == ")")
            end += 1
        tables[name], after = text[: end - 1], text[end:].lstrip()
        if not after.startswith(","):
            return tables, after
        rest = after[1:]
    return tables, sql


class Inputs:
    """Stand-in inputs of one scale folder as DataFrames, made on demand."""

    def __init__(self, spark: SparkSession, folder: str) -> None:
        self.spark = spark
        self.folder = folder
        self._made: dict[str, DataFrame] = {}
        self._hot: dict[tuple[str, ...], HotKeys] = {}

    def hot(self, name: str, *keys: str) -> HotKeys:
        """Hot keys of a view, counted once."""
        wanted = keys or ("compkey",)
        if (name, *wanted) not in self._hot:
            self._hot[(name, *wanted)] = hot_keys(self(name), list(wanted))
        return self._hot[(name, *wanted)]

    def __call__(self, name: str) -> DataFrame:
        if name not in self._made:
            self._made[name] = self._make(name)
        return self._made[name]

    def written_once(self, *names: str, only: list[str] | None = None) -> None:
        """From now on these views, and those that read them, read a written copy: for runs that read them in many steps.

        The copy has all columns, or ``only`` those that the run reads.
        """
        for name in names:
            made = self(name)
            self._made[name] = written(made.select(*only) if only else made, name)

    def read_from(self, name: str, source: str, columns: list[str]) -> None:
        """From now on the view ``name`` reads these columns of ``source``, which has the same rows and values."""
        self._made[name] = self(source).select(*columns)

    def _make(self, name: str) -> DataFrame:
        if name in TABLES:
            df = self.spark.read.schema(TABLES[name]).parquet(f"{self.folder}/{name}.parquet")
        else:
            text = VIEWS[name]
            for used in _uses(text, [*TABLES, *VIEWS]):
                self(used).createOrReplaceTempView(used)
            df = self.spark.sql(text)
        return df
