"""Price of replacing, lining or spot-repairing a pipe, from its size, depth and surroundings.

The functions work on one frame that holds pipe columns (id, compkey, cutno, length,
diamwidth) and crossing columns of the same row. Everything is a Column, so the whole
estimate runs in one pass over that frame.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mainstay import params as P
from mainstay.functions.scalar import factor_power, flag, mean_depth, total, zero
from mainstay.operators.intervals import point_in_segment
from mainstay.operators.lookups import ceiling_lookup, floor_lookup
from mainstay.operators.skew import HotKeys, attach
from mainstay.operators.tables import bid_from, give_to, latest_inspections

CUBIC_FEET_PER_YARD = 27.0
SQUARE_FEET_PER_YARD = 9.0
SQUARE_FEET_PER_ACRE = 43_560.0
INCHES_PER_FOOT = 12.0
INCHES_PER_YARD = 36.0

# Components in the order they are added.
TIMED = ["traffic", "bypass"]
FIXED = [
    "shoring", "excavation", "haul", "pipe", "fill", "backfill", "saw", "asphalt_removal", "patch",
    "base_course", "water", "crossing", "hazard", "mitigation",
]


def job_rows(pipes: DataFrame) -> DataFrame:
    """One row per job: Spot for a segment, Line and Dig for a whole pipe. One pass over the pipes."""
    kinds = F.when(
        F.col("id") >= P.FIRST_SEGMENT_ID, F.array(F.lit("Spot"))
    ).otherwise(F.array(F.lit("Line"), F.lit("Dig")))
    return pipes.select("id", "compkey", F.explode(kinds).alias("type"))


def pipe_dimensions(df: DataFrame, diameters: DataFrame, trenches: DataFrame) -> DataFrame:
    """Outside diameter (in) and trench width (ft) by size."""
    sized = ceiling_lookup(df, "diamwidth", diameters, "inside", {"outside": "outside"})
    return ceiling_lookup(sized, "outside", trenches, "max_outside", {"width": "trench_width"})


def _volume() -> Column:
    return mean_depth() * F.col("trench_width") / CUBIC_FEET_PER_YARD


def excavation_volume(df: DataFrame) -> DataFrame:
    """Cubic yards to dig per foot of pipe."""
    return df.withColumn("volume", _volume())


def _water(unit: P.UnitCosts) -> Column:
    return F.when(F.col("pwtr") > 0, unit.water_per_inch * F.col("pwtrmaxd") + unit.water_base)


def water_relocation(df: DataFrame, unit: P.UnitCosts = P.UnitCosts()) -> DataFrame:
    return df.withColumn("water", _water(unit))


def _crossing(unit: P.UnitCosts) -> Column:
    return unit.crossing * total("xsewer", "xwtr", "xgas", "xfiber")


def crossing_relocation(df: DataFrame, unit: P.UnitCosts = P.UnitCosts()) -> DataFrame:
    return df.withColumn("crossing", _crossing(unit))


def _hazard(unit: P.UnitCosts, any_site: bool) -> Column:
    near = F.col("xecsi") > 0 if any_site else F.col("xecsi") == 1
    length = F.when(F.col("length") > unit.hazard_length, unit.hazard_length).otherwise(F.col("length"))
    return F.when(near, length * F.col("volume") * unit.hazard)


def hazardous_material(df: DataFrame, unit: P.UnitCosts = P.UnitCosts(), any_site: bool = False) -> DataFrame:
    """For segments exactly one site counts; for whole pipes (``any_site``) one or more."""
    return df.withColumn("hazard", _hazard(unit, any_site))


def _mitigation(unit: P.UnitCosts) -> Column:
    inside = (F.col("xftezonc") > 0) | (F.col("xftezonp") > 0)
    price = unit.mitigation * total("xftezonc", "xftezonp") * unit.mitigation_width / SQUARE_FEET_PER_ACRE
    return F.when(inside, price)


def environmental_mitigation(df: DataFrame, unit: P.UnitCosts = P.UnitCosts()) -> DataFrame:
    return df.withColumn("mitigation", _mitigation(unit))


def patch_rate(unit: P.UnitCosts = P.UnitCosts()) -> Column:
    """Price of a trench patch by thickness: hard areas and arterials eight inches."""
    street = F.col("pstrttext")
    return (
        F.when(zero("hardarea") > 0, unit.patch_eight_inch)
        .when(street == "A", unit.patch_eight_inch)
        .when(street == "S", unit.patch_six_inch)
        .when(street == "H", unit.patch_four_inch)
    )


def _asphalt(unit: P.UnitCosts) -> dict[str, Column]:
    width = F.col("trench_width") + unit.extra_width
    yards = width / SQUARE_FEET_PER_YARD
    return {
        "asphalt_removal": unit.asphalt_removal * yards * F.col("length"),
        "base_course": width * unit.base_depth / CUBIC_FEET_PER_YARD * unit.base_course * F.col("length"),
        "patch": yards * patch_rate(unit) * F.col("length"),
    }


def asphalt(df: DataFrame, unit: P.UnitCosts = P.UnitCosts()) -> DataFrame:
    """Removal, base course and trench patch over the widened trench."""
    return df.withColumns(_asphalt(unit))


def _backfill(unit: P.UnitCosts) -> dict[str, Column]:
    width, outside = F.col("trench_width"), F.col("outside")
    zone = width * ((outside + unit.zone_inches) / INCHES_PER_FOOT) / CUBIC_FEET_PER_YARD
    covered = width * ((unit.base_depth + outside + unit.zone_inches) / INCHES_PER_FOOT) / CUBIC_FEET_PER_YARD
    body = outside * outside * INCHES_PER_FOOT * (math.pi / 4.0) / INCHES_PER_YARD**3
    return {
        "fill": (F.col("volume") - covered) * F.col("length") * unit.fill,
        "backfill": (zone - body) * F.col("length") * unit.backfill,
    }


def backfill(df: DataFrame, unit: P.UnitCosts = P.UnitCosts()) -> DataFrame:
    """Fill above the pipe zone and backfill of the zone less the pipe itself.

    The fill adds the base depth (feet) to inches before converting; this is the
    documented formula.
    """
    return df.withColumns(_backfill(unit))


def _excavation(unit: P.UnitCosts, rate: str) -> dict[str, Column]:
    spoil = F.col("volume") * unit.spoil_factor
    shoring = mean_depth() * unit.shoring_area * unit.shoring_cost * F.col("length")
    return {
        "saw": unit.saw_length * unit.saw_cost * F.col("length"),
        "excavation": F.col(rate) * spoil * F.col("length"),
        "haul": spoil * unit.haul * F.col("length"),
        "shoring": F.when(mean_depth() > unit.shoring_depth, shoring),
    }


def _with_dig_rate(df: DataFrame, depth_rates: DataFrame) -> DataFrame:
    return ceiling_lookup(df, mean_depth(), depth_rates, "depth", {"cost_per_yard": "__rate"})


def excavation_costs(df: DataFrame, depth_rates: DataFrame, unit: P.UnitCosts = P.UnitCosts()) -> DataFrame:
    """Saw cut, excavation, truck haul, and shoring of deep trenches."""
    return _with_dig_rate(df, depth_rates).withColumns(_excavation(unit, "__rate")).drop("__rate")


def _pipe() -> Column:
    return F.col("depth_factor") * F.col("pipe_price") * F.col("length")


def _with_pipe_rates(df: DataFrame, prices: DataFrame, difficulty: DataFrame) -> DataFrame:
    priced = floor_lookup(df, ["diamwidth"], prices, ["min_diameter"], {"price": "pipe_price"}, {"price": 0.0})
    return floor_lookup(
        priced, ["diamwidth", mean_depth()], difficulty, ["min_diameter", "min_depth"],
        {"factor": "depth_factor"}, {"factor": 1.0},
    )


def pipe_material(df: DataFrame, prices: DataFrame, difficulty: DataFrame) -> DataFrame:
    """Price per foot by diameter times a factor by diameter and depth."""
    return _with_pipe_rates(df, prices, difficulty).withColumn("pipe", _pipe())


def manhole_detail(
    df: DataFrame, sizes: DataFrame, prices: DataFrame, depth_factors: DataFrame, add: bool = False,
    free_depth: float = 8.0,
) -> DataFrame:
    """Manhole price: factor * (base * per foot * extra depth + rim).

    ``add`` gives base + per foot * extra depth.
    """
    sized = ceiling_lookup(df, "diamwidth", sizes, "max_inside", {"manhole_size": "manhole_size"}, {"manhole_size": 0.0})
    priced = ceiling_lookup(
        sized, "manhole_size", prices, "max_size",
        {"base_cost": "__base", "per_foot": "__foot", "rim": "__rim"},
        {"base_cost": 0.0, "per_foot": 0.0, "rim": 0.0},
    )
    factored = floor_lookup(
        priced, ["manhole_size", mean_depth()], depth_factors, ["min_size", "min_depth"],
        {"factor": "__factor"}, {"factor": 0.0},
    )
    extra = mean_depth() - free_depth
    # An unknown depth leaves the price unknown.
    extra = F.when(extra <= 0, 0.0).otherwise(extra)
    body = F.col("__base") + F.col("__foot") * extra if add else F.col("__base") * F.col("__foot") * extra
    price = F.col("__factor") * (body + F.col("__rim"))
    return factored.withColumn("manhole", price).drop("__base", "__foot", "__rim", "__factor")


def manhole(seg: DataFrame, whole_priced: DataFrame) -> DataFrame:
    """First segments take the manhole price of their whole pipe, later ones 0."""
    prices = whole_priced.select("compkey", F.col("manhole").alias("__price"))
    joined = give_to(seg, prices, F.col("cutno") == 1)
    value = F.when(F.col("cutno") == 1, F.col("__price")).when(F.col("cutno") > 1, 0.0)
    return joined.withColumn("manhole", value).drop("__price")


def bypass_flow(flow: P.FlowRules = P.FlowRules()) -> Column:
    """Flow to pump around the site by Manning's formula."""
    slope = F.when(F.col("xpipslope") > 0, F.col("xpipslope")).otherwise(flow.default_slope)
    radius = zero("diamwidth") / (4.0 * INCHES_PER_FOOT)
    return flow.fraction * flow.unit_factor / flow.roughness * F.pow(radius, F.lit(2.0 / 3.0)) * F.sqrt(slope)


def bypass_rate(df: DataFrame, rates: DataFrame, flow: P.FlowRules = P.FlowRules()) -> DataFrame:
    """Rate of the largest listed flow below the pipe's flow, 0 if none."""
    flowing = df.withColumn("bypass_flow", bypass_flow(flow))
    return floor_lookup(
        flowing, ["bypass_flow"], rates, ["flow"], {"cost": "bypass_rate"}, {"cost": 0.0}, strict=True
    )


def _traffic_rate(costs: P.TrafficCosts) -> Column:
    street = F.lower("pstrttext")
    rate = (
        F.when(street == "f", costs.freeway).when(street == "a", costs.arterial)
        .when(street == "m", costs.major).when(street == "s", costs.street).otherwise(0.0)
    )
    legs = F.when(zero("uxclx") < 2, 0).otherwise(F.col("uxclx") - 2)
    return rate * (legs / 2.0 + 1.0)


def traffic_rate(df: DataFrame, costs: P.TrafficCosts = P.TrafficCosts()) -> DataFrame:
    """Rate by street class; each leg beyond two at an intersection adds a half."""
    return df.withColumn("traffic_rate", _traffic_rate(costs))


def _time_costs() -> dict[str, Column]:
    hours = F.col("base_hours") + F.col("mob_hours")
    return {"bypass": F.col("bypass_rate") * hours, "traffic": F.col("traffic_rate") * hours}


def time_costs(df: DataFrame) -> DataFrame:
    """Bypass pumping and traffic control over all construction hours."""
    return df.withColumns(_time_costs())


def _mob_rate(add_bypass: bool) -> Column:
    return total("bypass_rate", "traffic_rate") if add_bypass else zero("traffic_rate")


def mobilization_rate(df: DataFrame, add_bypass: bool) -> DataFrame:
    """Daily rate: for segments traffic replaces bypass; for whole pipes (``add_bypass``) both count."""
    return df.withColumn("mob_rate", _mob_rate(add_bypass))


def needs_boring(freeway: Column, unit: P.UnitCosts = P.UnitCosts()) -> Column:
    return (
        (mean_depth() > unit.bore_depth) | freeway
        | (F.col("xbldg") > 0) | (F.col("xlrt") > 0) | (F.col("xrail") > 0)
    )


def _boring(unit: P.UnitCosts, is_whole: bool) -> Column:
    freeway = F.col("xfrwy") > 0 if is_whole else F.col("pstrttyp").isin(*P.FREEWAY_STREET_CODES)
    price = (
        unit.boring * (unit.base_index / unit.jacking_index)
        * F.exp(unit.boring_growth * F.col("diamwidth")) * F.col("length")
    )
    return F.when(needs_boring(freeway, unit), price)


def boring_jacking(df: DataFrame, unit: P.UnitCosts = P.UnitCosts(), is_whole: bool = False) -> DataFrame:
    """Boring price where digging is not possible; a detail that is part of no sum."""
    return df.withColumn("boring", _boring(unit, is_whole))


def _steep() -> Column:
    return flag(F.abs(zero("gslope")) >= 0.1)


def _difficult(is_whole: bool, whole_factor: float = 1.0, exact: bool = False) -> Column:
    n = flag(F.col("hardarea") > 0) + flag(F.col("prail") > 0) + flag(F.col("plrt") > 0) + _steep()
    if is_whole:
        hit = (F.col("hardarea") > 0) | (F.col("prail") > 0) | (F.col("plrt") > 0)
        value = F.pow(F.lit(whole_factor), n)
    else:
        hit = (F.col("hardarea") == 1) | (F.col("prail") > 0) | (F.col("plrt") == 1)
        value = factor_power(n, exact)
    return F.when(hit, value)


def difficult_area(df: DataFrame, is_whole: bool = False, whole_factor: float = 1.0, exact: bool = False) -> DataFrame:
    """1.5 per difficult condition; a slope counts only beside another condition.

    For whole pipes the factor is 1 by default.
    """
    return df.withColumn("difficult", _difficult(is_whole, whole_factor, exact))


def laterals(
    insp: DataFrame, obs: DataFrame, code: str = "obkey", lateral: int | str = P.LATERAL_CODE,
    excluded: tuple[int, ...] = P.LATERAL_EXCLUDED, hot: HotKeys | None = None,
    hot_inspections: HotKeys | None = None,
) -> DataFrame:
    """Lateral observations of each pipe's latest inspection.

    Only inspections with at least one observation outside the excluded severities
    take part in the choice.
    """
    usable = obs.filter(~F.col("obsevkey").isin(*excluded)).select("inspkey").distinct()
    latest = latest_inspections(insp.join(usable, "inspkey", "left_semi"), hot)
    found = obs.filter(F.col(code) == lateral).select("inspkey", "distfrom", "obsevkey", "obskey")
    return attach(found, latest.select("inspkey", "compkey", "compdttm"), "inspkey", "inner", hot_inspections)


def lateral_unit(unit: P.UnitCosts = P.UnitCosts()) -> float:
    """Price of one lateral; the configured price counts in whole dollars."""
    return int(unit.lateral) * unit.lateral_emergency * unit.lateral_index


def lateral_counts(seg: DataFrame, lateral_rows: DataFrame) -> DataFrame:
    """Laterals per segment, counted at equal places first."""
    places = lateral_rows.groupBy("compkey", "distfrom").agg(F.count(F.lit(1)).alias("__n"))
    pairs = point_in_segment(seg.select("id", "compkey", "fm", "to_"), places)
    return pairs.groupBy("id").agg(F.sum("__n").alias("lateral_count"))


def lateral_cost(seg: DataFrame, lateral_rows: DataFrame, unit: P.UnitCosts = P.UnitCosts(), exact: bool = False) -> DataFrame:
    """Lateral price per segment, dearer beside rail, on slopes and in hard areas."""
    counted = seg.drop("lateral_count").join(lateral_counts(seg, lateral_rows), "id", "left")
    n = flag(F.col("prail") > 0) + flag(F.col("plrt") > 0) + _steep()
    rail = F.when((F.col("prail") > 0) | (F.col("plrt") == 1), factor_power(n, exact)).otherwise(1.0)
    hard = F.when(F.col("hardarea") == 1, 4.0).otherwise(1.0)
    return counted.withColumn("lateral", lateral_unit(unit) * zero("lateral_count") * rail * hard)


def lateral_cost_whole(whole_pipes: DataFrame, seg: DataFrame) -> DataFrame:
    sums = seg.groupBy("compkey").agg(F.sum("lateral").alias("lateral"))
    return whole_pipes.drop("lateral").join(sums, "compkey", "left")


def _site_factor(unit: P.UnitCosts) -> Column:
    return F.coalesce("difficult", F.lit(1.0)) * (unit.current_index / unit.base_index)


def direct_cost(df: DataFrame, unit: P.UnitCosts = P.UnitCosts(), is_whole: bool = False) -> DataFrame:
    """All components at today's prices; the manhole counts for whole pipes only."""
    items = [*TIMED, *FIXED, *(["manhole"] if is_whole else [])]
    return df.withColumn("direct", _site_factor(unit) * total(*items))


def marked_up(amount: Column, markups: P.Markups = P.Markups()) -> Column:
    return amount * markups.conditions * markups.reserve * markups.delivery


def capital_cost(df: DataFrame, markups: P.Markups = P.Markups()) -> DataFrame:
    """Three markups one after the other."""
    standard = F.col("direct") * markups.conditions
    return df.withColumns({
        "standard_cost": standard, "contingency_cost": standard * markups.reserve,
        "capital": marked_up(F.col("direct"), markups),
    })


def capital_nonmob(
    df: DataFrame, kind: str, unit: P.UnitCosts = P.UnitCosts(), markups: P.Markups = P.Markups()
) -> DataFrame:
    """Fixed capital and daily capital rate of one job type, marked up."""
    items = {"Spot": FIXED, "Dig": [*FIXED, "manhole"], "Line": ["liner_material", "liner_cleaning"]}[kind]
    return df.withColumns({
        "type": F.lit(kind),
        "capitalnonmobilization": marked_up(_site_factor(unit) * total(*items), markups),
        "capitalmobilizationrate": marked_up(_site_factor(unit) * zero("mob_rate"), markups),
    })


def liner_cost(
    df: DataFrame, liner_prices: DataFrame, cleaning_prices: DataFrame, unit: P.UnitCosts = P.UnitCosts(),
    markups: P.Markups = P.Markups(),
) -> DataFrame:
    """Liner price: traffic and bypass for the lining days, material and cleaning by size."""
    priced = ceiling_lookup(df, "diamwidth", liner_prices, "max_diameter", {"price": "__liner"})
    priced = ceiling_lookup(priced, "diamwidth", cleaning_prices, "max_diameter", {"price": "__clean"})
    parts = (
        priced.withColumn("liner_traffic", unit.liner_days * F.col("traffic_rate"))
        .withColumn("liner_bypass", unit.liner_days * F.col("bypass_rate"))
        .withColumn("liner_material", F.col("__liner") * F.col("length"))
        .withColumn("liner_cleaning", F.col("__clean") * F.col("length"))
        .drop("__liner", "__clean")
    )
    items = total("liner_traffic", "liner_bypass", "liner_material", "liner_cleaning")
    direct = parts.withColumn("liner_direct", _site_factor(unit) * items)
    return direct.withColumn("liner_capital", marked_up(F.col("liner_direct"), markups))


# Extra cost of a spot repair up to a diameter, and above the last one.
SPOT_EXTRA = ((12.0, 5121.0), (21.0, 7058.0), (36.0, 11280.0))
SPOT_EXTRA_LARGE = 17784.0


def spot_shim(jobs: DataFrame) -> DataFrame:
    """Extra cost by diameter on spot jobs of segments."""
    size = F.col("diamwidth")
    (first, amount), *rest = SPOT_EXTRA
    extra = F.when(size <= first, amount)
    for limit, amount in rest:
        extra = extra.when(size <= limit, amount)
    cost = F.col("capitalnonmobilization")
    is_spot = (F.col("type") == "Spot") & (F.col("cutno") > 0)
    return jobs.withColumn(
        "capitalnonmobilization", F.when(is_spot, zero(cost) + extra.otherwise(SPOT_EXTRA_LARGE)).otherwise(cost)
    )


def line_shim(jobs: DataFrame, unit: P.UnitCosts = P.UnitCosts()) -> DataFrame:
    """Factor on liner jobs of whole pipes."""
    cost = F.col("capitalnonmobilization")
    is_line = (F.col("type") == "Line") & (F.col("cutno") == 0)
    return jobs.withColumn(
        "capitalnonmobilization", F.when(is_line, zero(cost) * unit.liner_adjustment).otherwise(cost)
    )


def simplified_costs(jobs: DataFrame) -> DataFrame:
    """One total and duration per job: S for segments, W and L for whole pipes. One pass."""
    is_segment = F.col("id") >= P.FIRST_SEGMENT_ID
    kind = (
        F.when(is_segment, "S").when(F.col("type") == "Dig", "W").when(F.col("type") == "Line", "L")
    )
    hours = F.col("basetime") + F.col("mobilizationtime")
    price = bid_from(
        F.col("capitalnonmobilization"), F.col("capitalmobilizationrate"), F.col("basetime"), F.col("mobilizationtime")
    )
    return jobs.select(
        "id", "compkey", kind.alias("type"), price.alias("total_cost"), (hours / 8.0).alias("build_days")
    ).filter(F.col("type").isNotNull())


def cost_components(
    df: DataFrame, tables: dict[str, DataFrame], unit: P.UnitCosts = P.UnitCosts(),
    flow: P.FlowRules = P.FlowRules(), traffic: P.TrafficCosts = P.TrafficCosts(), is_whole: bool = False,
) -> DataFrame:
    """All components for one frame of pipes with crossings and construction hours.

    The lookups come first; the formulas then follow in two projections.
    """
    out = pipe_dimensions(df, tables["diameters"], tables["trenches"])
    out = _with_dig_rate(out, tables["depth_rates"])
    out = _with_pipe_rates(out, tables["prices"], tables["difficulty"])
    out = bypass_rate(out, tables["bypass_rates"], flow)
    out = out.withColumns({"volume": _volume(), "traffic_rate": _traffic_rate(traffic)})
    return out.withColumns({
        "water": _water(unit), "crossing": _crossing(unit), "hazard": _hazard(unit, is_whole),
        "mitigation": _mitigation(unit), **_asphalt(unit), **_backfill(unit), **_excavation(unit, "__rate"),
        "pipe": _pipe(), **_time_costs(), "mob_rate": _mob_rate(is_whole), "boring": _boring(unit, is_whole),
        "difficult": _difficult(is_whole),
    }).drop("__rate")


def _priced(df: DataFrame, simple: DataFrame, kind: str, into: str) -> DataFrame:
    costs = simple.filter(F.col("type") == kind).select("id", F.col("total_cost").alias("__cost"))
    old = F.col(into) if into in df.columns else F.lit(None).cast("double")
    return df.join(costs, "id", "left").withColumn(into, F.coalesce("__cost", old)).drop("__cost")


def _with_laterals(df: DataFrame, unit: P.UnitCosts) -> DataFrame:
    price = lateral_unit(unit) * F.col("lateral_count")
    return (
        df.withColumn("lateral_count", zero("lateral_count").cast("long"))
        .withColumn("lateral_total", price)
        .withColumn("lateral_segment", price)
        .withColumn("line_total", F.col("linercost") + price)
        .withColumn("line_alone", F.col("linercost"))
    )


def apply_segment_costs(
    seg: DataFrame, simple: DataFrame, lateral_rows: DataFrame, unit: P.UnitCosts = P.UnitCosts()
) -> DataFrame:
    """Replacement and lateral costs on segments; all joins are by id."""
    segs = _priced(seg, simple, "S", "replacecost")
    segs = segs.drop("lateral_count").join(lateral_counts(seg, lateral_rows), "id", "left")
    return _with_laterals(segs, unit)


def apply_whole_costs(
    whole_pipes: DataFrame, segs: DataFrame, simple: DataFrame, lateral_rows: DataFrame, unit: P.UnitCosts = P.UnitCosts()
) -> DataFrame:
    """Replacement, liner, lateral and spot costs on whole pipes; ``segs`` are the priced segments."""
    pipes = _priced(_priced(whole_pipes, simple, "W", "replacecost"), simple, "L", "linercost")
    spots = segs.filter((F.col("spot_count") == 1) & (F.col("cutno") > 0)).groupBy("compkey").agg(
        F.sum(F.col("replacecost") * F.col("spot_count")).alias("spot_sum")
    )
    counts = lateral_rows.groupBy("compkey").agg(F.count(F.lit(1)).alias("lateral_count"))
    pipes = pipes.drop("lateral_count").join(spots, "compkey", "left").join(counts, "compkey", "left")
    return (
        _with_laterals(pipes, unit)
        .withColumn("replace_total", F.col("replacecost") + F.col("lateral_total"))
        .withColumn("spot_total", F.col("spot_sum") + F.col("lateral_total"))
    )


def apply_costs(
    seg: DataFrame, whole_pipes: DataFrame, simple: DataFrame, lateral_rows: DataFrame,
    unit: P.UnitCosts = P.UnitCosts(),
) -> tuple[DataFrame, DataFrame]:
    """Replacement, liner, lateral and spot costs on segments and whole pipes."""
    segs = apply_segment_costs(seg, simple, lateral_rows, unit)
    return segs, apply_whole_costs(whole_pipes, segs, simple, lateral_rows, unit)


def finish_segment_costs(seg: DataFrame, manholes: DataFrame) -> DataFrame:
    """Manhole prices of segments, liner price with the spots that must go first, net line cost; see ``finish_costs``."""
    segs = seg.join(manholes.select("id", F.col("manhole").alias("manhole_cost")), "id", "left")
    own = F.col("spot_total") if "spot_total" in segs.columns else F.lit(None).cast("double")
    return segs.withColumns({
        "linercost": F.when(F.col("action") == P.ACTION_SPOT, F.col("linercost") + F.col("replacecost")).otherwise(F.col("linercost")),
        "spot_total": own * F.col("spot_count"),
        "line_total": F.col("line_total") + F.col("spotcost") - F.col("lateral_segment") * F.col("spot_count"),
    })


def finish_whole_costs(whole_pipes: DataFrame, segs: DataFrame, manholes: DataFrame) -> DataFrame:
    """The same on whole pipes; ``segs`` are the finished segments with ``spotcost`` as it stood when they were."""
    pipes = whole_pipes.join(manholes.select("id", F.col("manhole").alias("manhole_cost")), "id", "left")
    is_spot = F.col("action") == P.ACTION_SPOT
    # One pass over the segments gives all sums a pipe needs; only the spot totals reach pipe 0 and below.
    counted = F.col("compkey") > 0
    sums = segs.groupBy("compkey").agg(
        F.sum(F.when(counted & is_spot, F.col("replacecost"))).alias("__spots"),
        F.max(F.when(counted & is_spot, F.lit(True))).alias("__any"),
        F.sum(F.col("lateral_segment") * F.col("spot_count")).alias("__laterals"),
        F.sum(F.col("spotcost") * F.col("spot_count")).alias("__spotcost"),
        F.sum(F.col("spot_total") * F.col("spot_count")).alias("__totals"),
        F.max(counted).alias("__known"),
        F.lit(True).alias("__has"),
    )
    pipes = pipes.join(sums, "compkey", "left")
    pipes = pipes.withColumn(
        "linercost", F.when(F.col("__any"), F.col("linercost") + F.col("__spots")).otherwise(F.col("linercost"))
    ).withColumn(
        "line_total",
        F.when(F.col("__known"), F.col("line_total") + F.col("__spotcost") - F.col("__laterals")).otherwise(
            F.col("line_total")
        ),
    )
    if "spot_total" in pipes.columns:
        pipes = pipes.withColumn("spot_total", F.when(F.col("__has"), F.col("__totals")).otherwise(F.col("spot_total")))
    return pipes.drop("__spots", "__any", "__laterals", "__spotcost", "__totals", "__known", "__has")


def finish_costs(
    seg: DataFrame, whole_pipes: DataFrame, manholes: DataFrame
) -> tuple[DataFrame, DataFrame]:
    """Manhole prices on both grains; liner price with the spots that must go first; net line cost.

    ``seg`` brings ``spotcost`` as it stands at this point of the run, and may bring ``spot_total``: it is
    multiplied by the spots of the segment, and pipes with segments take the sum, again by spots.
    """
    segs = finish_segment_costs(seg, manholes)
    return segs, finish_whole_costs(whole_pipes, segs, manholes)
