"""Registered queries of proximity, crossings and areas.

The comparison SQL uses that the stand-in segments are level and run from left to
right, and that areas are boxes, so it shares no formula with the operators.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from mainstay.checks.common import Query, rounded
from mainstay.operators import proximity as X
from mainstay.plans.proximity_run import Features, crossing_run

Q: dict[str, Query] = {}
SQL: dict[str, str] = {}


def _polygons(v, name="zone"):
    corner = [("x1", "y1"), ("x2", "y1"), ("x2", "y2"), ("x1", "y2"), ("x1", "y1")]
    ring = F.array(*[F.struct(F.col(a).alias("x"), F.col(b).alias("y")) for a, b in corner])
    return v(name).select("feature_id", F.array(ring).alias("parts"))


# Distance of a point p to a level segment s, and of a line l to it.
PD = "sqrt(pow(greatest(s.x1 - p.x, p.x - s.x2, 0), 2) + pow(p.y - s.y1, 2))"
_CUT = "(l.y1 <= s.y1 AND s.y1 <= l.y2 AND (s.y1 - l.y1) * (l.x2 - l.x1) BETWEEN (s.x1 - l.x1) * (l.y2 - l.y1) AND (s.x2 - l.x1) * (l.y2 - l.y1))"
_TA = "greatest(0, least(1, (({px} - l.x1) * (l.x2 - l.x1) + ({py} - l.y1) * (l.y2 - l.y1)) / (pow(l.x2 - l.x1, 2) + pow(l.y2 - l.y1, 2))))"


def _to_line(px):
    t = _TA.format(px=px, py="s.y1")
    return f"sqrt(pow({px} - (l.x1 + {t} * (l.x2 - l.x1)), 2) + pow(s.y1 - (l.y1 + {t} * (l.y2 - l.y1)), 2))"


def _end(x, y):
    return f"sqrt(pow(greatest(s.x1 - {x}, {x} - s.x2, 0), 2) + pow({y} - s.y1, 2))"


LD = f"(CASE WHEN {_CUT} THEN 0 ELSE least({_to_line('s.x1')}, {_to_line('s.x2')}, {_end('l.x1', 'l.y1')}, {_end('l.x2', 'l.y2')}) END)"


def _near_points(d, extra="p.layer"):
    return f"""
near AS (SELECT s.id, {extra}, p.feature_id, {PD} AS d FROM edge s JOIN poi p ON p.y BETWEEN s.y1 - {d} AND s.y1 + {d} AND p.x BETWEEN s.x1 - {d} AND s.x2 + {d} WHERE {PD} <= {d})
"""


def _near_lines(d):
    return f"""
near AS (SELECT s.id, l.*, {LD} AS d FROM edge s JOIN line l ON l.y1 <= s.y1 + {d} AND l.y2 >= s.y1 - {d} AND least(l.x1, l.x2) <= s.x2 + {d} AND greatest(l.x1, l.x2) >= s.x1 - {d} WHERE {LD} <= {d})
"""


MET = """
met AS (SELECT s.id, z.feature_id, least(s.x2, z.x2) - greatest(s.x1, z.x1) AS inside FROM edge s JOIN zone z ON s.y1 BETWEEN z.y1 AND z.y2 AND s.x1 <= z.x2 AND s.x2 >= z.x1)
"""

Q["x1_near_extent"] = lambda v: X.near_extent(v("zone"), X.extent(v("edge")), 50.0).select("feature_id")
SQL["x1_near_extent"] = """
WITH e AS (SELECT min(least(x1, x2)) AS ax, min(least(y1, y2)) AS ay, max(greatest(x1, x2)) AS bx, max(greatest(y1, y2)) AS byy FROM edge)
SELECT z.feature_id FROM zone z CROSS JOIN e WHERE z.x2 >= e.ax - 50 AND z.x1 <= e.bx + 50 AND z.y2 >= e.ay - 50 AND z.y1 <= e.byy + 50
"""
Q["a10_extent"] = lambda v: X.extent(v("edge"))
SQL["a10_extent"] = "SELECT min(least(x1, x2)) AS min_x, min(least(y1, y2)) AS min_y, max(greatest(x1, x2)) AS max_x, max(greatest(y1, y2)) AS max_y FROM edge"
Q["x2_count_within"] = lambda v: X.count_within(v("edge"), v("poi"), 120.0).select("id", "near")
SQL["x2_count_within"] = f"WITH {_near_points(120)} SELECT id, count(*) AS near FROM near GROUP BY id"
Q["x3_count_crossing"] = lambda v: X.count_crossing(v("edge"), v("line"))
SQL["x3_count_crossing"] = f"WITH {_near_lines(0)} SELECT id, count(*) AS crossing FROM near GROUP BY id"
Q["x4_nearest_distance"] = lambda v: rounded(X.nearest_distance(X.line_pairs(v("edge"), v("line"), 60.0)), ["nearest"], 6)
SQL["x4_nearest_distance"] = f"WITH {_near_lines(60)} SELECT id, round(min(d), 6) AS nearest FROM near GROUP BY id"
Q["x5_hydrants"] = lambda v: rounded(X.hydrants(v("edge"), v("poi")), ["xft2hyd"], 6)
SQL["x5_hydrants"] = f"WITH {_near_points(25)} SELECT id, count(*) AS xhyd, round(min(d), 6) AS xft2hyd FROM near GROUP BY id"
_BUILDINGS = [c for n in X.BUILDING_LAYERS.values() for c in (f"x{n}", f"xft2{n}")]
Q["x6_public_buildings"] = lambda v: rounded(X.public_buildings(v("edge"), v("poi")), [c for c in _BUILDINGS if "ft2" in c], 6)
SQL["x6_public_buildings"] = f"WITH {_near_points(250)} SELECT id, " + ", ".join(
    f"CAST(nullif(sum(CASE WHEN layer = '{k}' THEN 1 ELSE 0 END), 0) AS BIGINT) AS x{n}, round(min(CASE WHEN layer = '{k}' THEN d END), 6) AS xft2{n}" for k, n in X.BUILDING_LAYERS.items()
) + " FROM near GROUP BY id"
_UTILITY = [f"pft2{n}" for n in X.UTILITY_DISTANCES]
Q["x7_utility_layers"] = lambda v: rounded(X.utility_layers(v("edge"), v("line")), _UTILITY, 6)
SQL["x7_utility_layers"] = f"WITH {_near_lines(50)} SELECT id, " + ", ".join(
    f"""CAST(nullif(sum(CASE WHEN layer = '{n}' AND d = 0 THEN 1 ELSE 0 END), 0) AS BIGINT) AS x{n}, CAST(nullif(sum(CASE WHEN layer = '{n}' AND d <= {d} THEN 1 ELSE 0 END), 0) AS BIGINT) AS p{n},
  round(min(CASE WHEN layer = '{n}' AND d <= {d} THEN d END), 6) AS pft2{n}""" for n, d in X.UTILITY_DISTANCES.items()
) + " FROM near GROUP BY id"
Q["x8_area_counts"] = lambda v: X.area_counts(v("edge"), _polygons(v), "hardarea")
SQL["x8_area_counts"] = f"WITH {MET} SELECT e.id, count(m.feature_id) AS hardarea FROM edge e LEFT JOIN met m ON m.id = e.id GROUP BY e.id"
Q["x9_contaminated"] = lambda v: rounded(X.contaminated(v("edge"), _polygons(v)), ["xecsilen"], 5)
SQL["x9_contaminated"] = f"WITH {MET} SELECT id, count(*) AS xecsi, round(sum(inside), 5) AS xecsilen FROM met GROUP BY id"
Q["x10_zones"] = lambda v: rounded(X.zones(v("edge"), _polygons(v), "p"), ["xftezonp"], 5)
SQL["x10_zones"] = f"WITH {MET} SELECT id, count(*) AS xezonp, round(sum(inside), 5) AS xftezonp, CAST(0 AS DOUBLE) AS xezareap FROM met GROUP BY id"
Q["x11_residential"] = lambda v: X.residential(v("edge"), _polygons(v))
SQL["x11_residential"] = f"WITH {MET} SELECT DISTINCT id, CAST(1 AS INT) AS xsfr FROM met"
Q["x12_start_point_in"] = lambda v: X.start_point_in(v("edge").select("id", F.col("x1").alias("x"), F.col("y1").alias("y")), _polygons(v))
SQL["x12_start_point_in"] = "SELECT DISTINCT s.id FROM edge s JOIN zone z ON s.x1 >= z.x1 AND s.x1 <= z.x2 AND s.y1 >= z.y1 AND s.y1 <= z.y2"


def _legs(v):
    return v("poi").withColumn("count_streets", (F.col("feature_id") % 4 + 2).cast("int"))


Q["x13_intersections"] = lambda v: rounded(X.intersections(v("edge"), _legs(v)), ["uxft2clx"], 6)
SQL["x13_intersections"] = f"WITH {_near_points(30)} SELECT id, CAST(sum(feature_id % 4 + 2) AS BIGINT) AS uxclx, round(min(d), 6) AS uxft2clx FROM near GROUP BY id"
Q["x14_street_class"] = lambda v: rounded(X.street_class(v("edge"), v("line"), v("streetname")), ["pft2strt"], 6)
SQL["x14_street_class"] = f"""
WITH {_near_lines(30)}, n AS (SELECT id, min(value) AS pstrttyp, min(d) AS d FROM near GROUP BY id)
SELECT n.id, n.pstrttyp, CAST(1 AS INT) AS pstrt, t.type AS pstrttext, round(n.d, 6) AS pft2strt FROM n JOIN streetname t ON t.value = n.pstrttyp
"""
Q["x15_street_crossings"] = lambda v: X.street_crossings(v("edge"), v("line"))
SQL["x15_street_crossings"] = f"WITH {_near_lines(0)} SELECT id, " + ", ".join(
    f"CAST(nullif(sum(CASE WHEN type = '{t}' THEN 1 ELSE 0 END), 0) AS BIGINT) AS {n}" for t, n in X.STREET_CROSSINGS.items()
) + " FROM near GROUP BY id"


def _node_columns(us, ds):
    # Some segments share a node with the sewers that cross them, in other case and with blanks.
    return F.concat(F.lit(" n"), (F.col("id") % 2000).cast("string")).alias(us), F.concat(F.lit("N"), (F.col("cutno") * 100).cast("string")).alias(ds)


def _nodes(v):
    return v("seg").select("id", *_node_columns("usnode", "dsnode"))


def _six(sizes, cross, near):
    return f"""CAST(nullif(sum(CASE WHEN d = 0 THEN 1 ELSE 0 END), 0) AS BIGINT) AS x{cross}, max(CASE WHEN d = 0 THEN {sizes[0]} END) AS {sizes[1]}maxd, min(CASE WHEN d = 0 THEN {sizes[0]} END) AS {sizes[1]}mind,
 CAST(nullif(sum(CASE WHEN d > 0 THEN 1 ELSE 0 END), 0) AS BIGINT) AS p{cross}, max(CASE WHEN d > 0 THEN {sizes[0]} END) AS p{near}maxd, round(min(CASE WHEN d > 0 THEN d END), 6) AS pft2{near}"""


Q["x16_sewer_crossings"] = lambda v: rounded(X.sewer_crossings(v("edge"), _nodes(v), v("line")), ["pft2swr"], 6)
SQL["x16_sewer_crossings"] = f"""
WITH {_near_lines(12)}, nd AS (SELECT id, 'n' || CAST(id % 2000 AS VARCHAR) AS u, 'n' || CAST(cutno * 100 AS VARCHAR) AS dn FROM seg)
SELECT n.id, {_six(('pipesize', 'xswr'), 'sewer', 'swr')} FROM near n JOIN nd q ON q.id = n.id
WHERE trim(lower(n.us_node)) NOT IN (q.u, q.dn) AND trim(lower(n.ds_node)) NOT IN (q.u, q.dn) GROUP BY n.id
"""
Q["x17_water_crossings"] = lambda v: rounded(X.water_crossings(v("edge"), v("line")), ["pft2wtr"], 6)
SQL["x17_water_crossings"] = f"WITH {_near_lines(12)} SELECT id, {_six(('mainsize', 'xw'), 'wtr', 'wtr')} FROM near WHERE status <> 'ABN' GROUP BY id"
Q["x18_buildings"] = lambda v: X.buildings(v("edge"), _polygons(v))
SQL["x18_buildings"] = f"""
WITH {MET} SELECT e.id, count(m.feature_id) AS xbldg, CASE WHEN count(m.feature_id) > 0 THEN CAST(0 AS DOUBLE) END AS xft2bldg FROM edge e LEFT JOIN met m ON m.id = e.id GROUP BY e.id
"""


def _elevations(v, sites="wsite"):
    return v(sites).select(
        "id", F.when(F.col("id") % 50 == 0, 0.0).otherwise(F.col("length")).alias("length"), F.col("udepth").alias("frm_depth"), F.col("ddepth").alias("to_depth"),
        F.when(F.col("id") % 17 == 0, None).otherwise(F.col("id") % 300 + 0.5).alias("frm_elev"), (F.col("id") % 280).cast("double").alias("to_elev"),
    )


Q["x19_slopes"] = lambda v: rounded(X.slopes(_elevations(v)), ["gslope", "xpipslope"], 8)
def _slopes_sql(sites):
    return f"""
WITH e AS (SELECT id, CASE WHEN id % 50 = 0 THEN NULL ELSE length END AS len, udepth, ddepth, CASE WHEN id % 17 = 0 THEN NULL ELSE id % 300 + 0.5 END AS a, id % 280 AS b FROM {sites})
SELECT id, udepth, ddepth, round(((a + udepth) - (b + ddepth)) / len, 8) + 0.0 AS gslope, round(CAST(a - b AS DOUBLE) / len, 8) + 0.0 AS xpipslope FROM e
"""


SQL["x19_slopes"] = _slopes_sql("wsite")
Q["x20_lateral_count"] = lambda v: X.lateral_count(v("seg"), v("latest").filter("obcode = 'LT'"), v.hot("seg"))
SQL["x20_lateral_count"] = """
SELECT s.id, s.compkey, l.n AS lateralcount FROM seg s LEFT JOIN (SELECT compkey, count(*) AS n FROM latest WHERE obcode = 'LT' GROUP BY compkey) l ON l.compkey = s.compkey
"""


AREAS = [*X.AREA_COUNTS, "contaminated", "residential", *X.AREA_ZONES]


def _areas(v):
    """The stand-in areas dealt to the area layers, each area to two of them."""
    return _polygons(v).withColumn("layer", F.explode(F.array(
        F.element_at(F.lit(AREAS), (F.col("feature_id") % 6 + 1).cast("int")),
        F.element_at(F.lit(AREAS), ((F.col("feature_id") + 2) % 6 + 1).cast("int")),
    )))


_LENGTHS = ["xecsilen", "xftezonc", "xftezonp"]


def _wide(v):
    # Most layers and the base itself read the segments.
    v.written_once("seg", only=["id", "compkey", "cutno", "fm", "to_", "length", "diamwidth"])
    base = v("seg").select("id", "compkey", "cutno", "length", *_node_columns("us_node_id", "ds_node_id"))
    features = Features(
        hydrants=v("poi"), points=v("poi"), lines=v("line"), streets=v("line"), street_names=v("streetname"),
        intersections=_legs(v), sewers=v("line"), mains=v("line"), areas=_areas(v),
        starts_in={"uxuic": _polygons(v), "uxms4": _polygons(v).filter("feature_id % 2 = 0")},
        elevations=_elevations(v, "site"), laterals=v("latest").filter("obcode = 'LT'"),
    )
    wide = crossing_run(base, v("edge"), features)
    feet = [c for c in wide.columns if "ft2" in c]
    return rounded(rounded(rounded(wide, feet, 6), _LENGTHS, 5), ["gslope", "xpipslope"], 8)


def _area_sql(layer):
    place = AREAS.index(layer)
    return f"(feature_id % 6 = {place} OR (feature_id + 2) % 6 = {place})"


def _area_columns():
    parts = [f"CAST(coalesce(count(CASE WHEN {_area_sql(k)} THEN 1 END), 0) AS BIGINT) AS {n}" for k, n in X.AREA_COUNTS.items()]
    parts += [f"nullif(count(CASE WHEN {_area_sql('contaminated')} THEN 1 END), 0) AS xecsi", f"sum(CASE WHEN {_area_sql('contaminated')} THEN inside END) AS xecsilen"]
    for k, n in X.AREA_ZONES.items():
        parts += [f"nullif(count(CASE WHEN {_area_sql(k)} THEN 1 END), 0) AS xezon{n}", f"sum(CASE WHEN {_area_sql(k)} THEN inside END) AS xftezon{n}", f"max(CASE WHEN {_area_sql(k)} THEN CAST(0 AS DOUBLE) END) AS xezarea{n}"]
    return ", ".join([*parts, f"CAST(max(CASE WHEN {_area_sql('residential')} THEN 1 END) AS INT) AS xsfr"])


# What each layer's own comparison fills; columns of the table that no layer fills stay NULL.
_WIDE_SQL = {
    "x5_hydrants": "xhyd xft2hyd", "x6_public_buildings": " ".join(_BUILDINGS),
    "x7_utility_layers": " ".join(f"x{n} p{n} pft2{n}" for n in X.UTILITY_DISTANCES),
    "x13_intersections": "uxclx uxft2clx", "x14_street_class": "pstrttyp pstrt pstrttext pft2strt",
    "x15_street_crossings": "xstrt xart xmjart xfrwy", "x16_sewer_crossings": "xsewer xswrmaxd xswrmind psewer pswrmaxd pft2swr",
    "x17_water_crossings": "xwtr xwmaxd xwmind pwtr pwtrmaxd pft2wtr", "x19_slopes": "udepth ddepth gslope xpipslope",
    "x20_lateral_count": "lateralcount",
}
_FROM = {c: k for k, names in _WIDE_SQL.items() for c in names.split()}
_AREA_NAMES = ["hardarea", "poverty", "xecsi", "xecsilen", "xezonc", "xftezonc", "xezareac", "xezonp", "xftezonp", "xezareap", "xsfr"]


def _wide_column(c):
    if c in ("id", "compkey", "cutno", "length"):
        return f"s.{c}"
    if c in ("us_node_id", "ds_node_id"):
        return f"{'\' n\' || CAST(s.id % 2000 AS VARCHAR)' if c == 'us_node_id' else '\'N\' || CAST(s.cutno * 100 AS VARCHAR)'} AS {c}"
    if c in ("uxuic", "uxms4"):
        return f"CAST(CASE WHEN {c}.id IS NOT NULL THEN 1 END AS INT) AS {c}"
    if c in _AREA_NAMES or c in _FROM:
        table = "areas" if c in _AREA_NAMES else _FROM[c].split("_")[0]
        if c in _LENGTHS:
            return f"round({table}.{c}, 5) AS {c}"
        return f"{table}.{c} AS {c}"
    return f"CAST(NULL AS DOUBLE) AS {c}"


_START = "(SELECT DISTINCT s.id FROM edge s JOIN zone z ON s.x1 >= z.x1 AND s.x1 <= z.x2 AND s.y1 >= z.y1 AND s.y1 <= z.y2{where})"
Q["x21_crossing_table"] = _wide
SQL["x21_crossing_table"] = (
    f"SELECT {', '.join(map(_wide_column, X.WIDE_COLUMNS))} FROM seg s\n"
    + "".join(f"LEFT JOIN ({_slopes_sql('site') if k == 'x19_slopes' else SQL[k]}) {k.split('_')[0]} ON {k.split('_')[0]}.id = s.id\n" for k in _WIDE_SQL)
    + f"LEFT JOIN (WITH {MET} SELECT e.id, {_area_columns()} FROM edge e LEFT JOIN met ON met.id = e.id GROUP BY e.id) areas ON areas.id = s.id\n"
    + f"LEFT JOIN {_START.format(where='')} uxuic ON uxuic.id = s.id LEFT JOIN {_START.format(where=' WHERE z.feature_id % 2 = 0')} uxms4 ON uxms4.id = s.id"
)
