"""Consequence of failure as layers of (pipe, amount, reason)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from mainstay.params import ConsequenceCosts
from mainstay.operators.tables import accumulate_layers

# Reason, scenario (sfm) and impact class (tblf) of each layer.
REPLACEMENT = ("REPLACEMENT", 1, 3)
EMERGENCY_REPAIR = ("EMERGENCYREPAIR", 1, 2)
EMERGENCY_LATERAL = ("EMERGENCYLATERALREPAIR", 2, 2)
SEPARATED_AREA = ("SEPARATEDAREA", 1, 9)
FLOODING = ("BASEMENTFLOODING", 1, 10)
FLOODING_HEALTH = ("PUBHEALTHBSMT", 1, 12)
SINKHOLE_FREEWAY = ("PUBHEALTHSINKFRWY", 1, 12)
SINKHOLE_MAJOR = ("PUBHEALTHSINKMJRART", 1, 12)
SINKHOLE_RESIDENTIAL = ("PUBHEALTHSINKRES", 1, 12)
NEAR_BUILDING = ("PUBHEALTHNEARPUBBLDG", 1, 12)
SPILL = ("PUBHEALTHSPILLNEARSCH", 1, 12)
HEALTH_SAFETY = ("PUBHEALTHSAFETY", 1, 12)
LATERAL_FLOODING = ("BASEMENTFLOODING", 2, 10)
LATERAL_FLOODING_HEALTH = ("BASEMENTFLOODING", 2, 12)
FREEWAY, MAJOR_ARTERIAL, ARTERIAL, STREET = "Frwy", "MjrArt", "Art", "Strt"
SEPARATED_TYPE = "S"
BUILDING_FLAGS = ["xschl", "xhosp", "xpol", "xfire"]


def _layer(df: DataFrame, label: tuple[str, int, int]) -> DataFrame:
    reason, scenario, impact = label
    return df.select(
        "compkey", F.col("consequence").cast("double").alias("consequence"), F.lit(scenario).alias("sfm"),
        F.lit(impact).alias("tblf"), F.lit(reason).alias("reason"),
    )


def _sum_of(rows: DataFrame, amount: Column | float, label: tuple[str, int, int], keys: tuple[str, ...] = ("compkey",)) -> DataFrame:
    value = amount if isinstance(amount, Column) else F.lit(float(amount))
    return _layer(rows.groupBy(*keys).agg(F.sum(value).alias("consequence")), label)


def trace(links: DataFrame) -> DataFrame:
    return links.select("mlinkid", "compkey", "usnode", "dsnode")


# Rows sorted by link are dealt to more tasks than a shuffle has by itself, so that the sorts of a task stay small.
SPLIT = 4


def _dealt(df: DataFrame, *keys: str) -> DataFrame:
    return df.repartition(SPLIT * int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), *keys)


def _pipes_of_links(links: DataFrame) -> DataFrame:
    """(mlinkid, compkey, __own, __all, __length): the pipes of each link, how often it is listed there and in all, its length in all.

    One shuffle and one sort by link; nothing is joined or kept in a table of groups.
    """
    listed = _dealt(links.filter(F.col("mlinkid").isNotNull()).select("mlinkid", "compkey", "length"), "mlinkid")
    by_pipe = Window.partitionBy("mlinkid").orderBy("compkey")
    whole = by_pipe.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    alike = by_pipe.rangeBetween(Window.currentRow, Window.currentRow)
    counted = listed.select(
        "mlinkid", "compkey", F.count(F.lit(1)).over(alike).alias("__own"), F.count(F.lit(1)).over(whole).alias("__all"),
        F.sum("length").over(whole).alias("__length"),
        (F.row_number().over(by_pipe) == F.rank().over(by_pipe)).alias("__first"),
    )
    return counted.filter("__first").drop("__first")


def trace_totals(links: DataFrame) -> DataFrame:
    """Length and number of links per pipe; a link listed twice counts for each pair of its rows."""
    return _pipes_of_links(links).groupBy("compkey").agg(
        F.sum(F.col("__length") * F.col("__own")).alias("sum_length"), F.sum(F.col("__all") * F.col("__own")).alias("links")
    )


def _weighted_crossings(links: DataFrame, xp: DataFrame) -> DataFrame:
    """Crossing rows with the pipe of their link and ``copies``: how often the row counts.

    A link listed n times meets each of its n trace rows n times. The number is kept
    as a weight, so copies are never spelled out before a sum.
    """
    weighted = _pipes_of_links(links).select("mlinkid", "compkey", (F.col("__own") * F.col("__all")).alias("copies"))
    return xp.drop("compkey").join(weighted, "mlinkid")


def crossings(links: DataFrame, xp: DataFrame) -> DataFrame:
    """Crossing rows with the pipe of their link; repeated links repeat the row."""
    rows = _weighted_crossings(links, xp)
    numbered = rows.withColumn("__copy", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))))
    return numbered.drop("copies", "__copy")


def capital_replacement(links: DataFrame, link_costs: DataFrame) -> DataFrame:
    return trace(links).join(link_costs, "mlinkid").select(
        "mlinkid", "compkey", F.col("totalconstructioncost").alias("cost")
    )


def replacement_cost(links: DataFrame, link_costs: DataFrame, xp: DataFrame) -> DataFrame:
    """Replacement cost per pipe; a link counts once per crossing row and per trace row."""
    crossed = xp.groupBy("mlinkid").agg(F.count(F.lit(1)).alias("__x"))
    listed = links.groupBy("mlinkid").agg(F.count(F.lit(1)).alias("__n"))
    costs = capital_replacement(links, link_costs).join(crossed, "mlinkid").join(listed, "mlinkid")
    # Crossing rows exist once per pair of link and trace rows, and meet each trace row again.
    times = F.col("__x") * F.col("__n") * F.col("__n") * F.col("__n")
    return _sum_of(costs, F.col("cost") * times, REPLACEMENT)


def emergency_repair(
    links: DataFrame, link_costs: DataFrame, costs: ConsequenceCosts
) -> DataFrame:
    """Emergency factor times the cost of at most ten feet; no amount for a pipe of length 0."""
    per_pipe = capital_replacement(links, link_costs).groupBy("compkey").agg(F.sum("cost").alias("__cost"))
    joined = per_pipe.join(trace_totals(links), "compkey")
    share = F.try_divide(F.least("sum_length", F.lit(costs.repair_length)), F.col("sum_length"))
    return _layer(
        joined.withColumn("consequence", costs.emergency_factor * F.col("__cost") * share), EMERGENCY_REPAIR
    )


def emergency_lateral_repair(links: DataFrame, costs: ConsequenceCosts) -> DataFrame:
    return _sum_of(trace_totals(links), costs.lateral_repair, EMERGENCY_LATERAL)


def separated_area_fine(links: DataFrame, systems: DataFrame, costs: ConsequenceCosts) -> DataFrame:
    """One fine per link of a separated system."""
    separated = systems.filter(F.lower("type") == SEPARATED_TYPE.lower())
    return _sum_of(trace(links).join(separated, "mlinkid"), costs.regulatory_fine, SEPARATED_AREA)


def _flooding(costs: ConsequenceCosts) -> float:
    return costs.flooding_events * costs.flooding_cost * 0.5


def basement_flooding(links: DataFrame, costs: ConsequenceCosts) -> DataFrame:
    return _sum_of(trace_totals(links), _flooding(costs), FLOODING)


FLOOD, FREEWAY_LAYER, MAJOR_LAYER, RESIDENTIAL_LAYER, BUILDING_LAYER, NEAR_SCHOOL, FAR_SCHOOL = (
    "flood", "freeway", "major", "residential", "building", "near_school", "far_school",
)
HEALTH_LABELS = {
    FLOOD: FLOODING_HEALTH, FREEWAY_LAYER: SINKHOLE_FREEWAY, MAJOR_LAYER: SINKHOLE_MAJOR,
    RESIDENTIAL_LAYER: SINKHOLE_RESIDENTIAL, BUILDING_LAYER: NEAR_BUILDING, NEAR_SCHOOL: SPILL, FAR_SCHOOL: SPILL,
}


def health_layers(
    links: DataFrame, xp: DataFrame, streets: DataFrame, costs: ConsequenceCosts,
    wanted: list[str] = list(HEALTH_LABELS), major: str = MAJOR_ARTERIAL,
) -> DataFrame:
    """The health and safety layers in one pass over the crossing rows.

    Every crossing row is labelled with the layers it falls in and the group it
    counts for there; one aggregation then sums all layers. Every crossing row with
    a known pipe has exactly one row in the trace totals, so that join is left out.
    """
    rows = _weighted_crossings(links, xp).filter(F.col("compkey").isNotNull())
    groups = streets.groupBy("street_number").agg(F.collect_list(F.lower("street_grp")).alias("__streets"))
    rows = rows.join(groups, F.col("pstrttyp") == F.col("street_number"), "left")
    amounts = {
        FLOOD: _flooding(costs), FREEWAY_LAYER: costs.sinkhole_freeway, MAJOR_LAYER: costs.sinkhole_major,
        RESIDENTIAL_LAYER: costs.sinkhole_residential, BUILDING_LAYER: costs.public_building,
        NEAR_SCHOOL: costs.spill_near_school, FAR_SCHOOL: costs.spill_far_school,
    }

    def entry(layer: str, group: Column) -> Column:
        return F.struct(F.lit(layer).alias("layer"), group.cast("string").alias("group"), F.lit(float(amounts[layer])).alias("amount"))

    def listed(test: Column, layer: str, group: Column) -> Column:
        return F.when(test, F.array(entry(layer, group)))

    def beside(layer: str, names: list[str]) -> Column:
        hits = F.filter("__streets", lambda s: s.isin([n.lower() for n in names]))
        return F.transform(hits, lambda s: entry(layer, s))

    any_near = reduce(lambda a, b: a | b, [F.col(c) > 0 for c in BUILDING_FLAGS])
    flags = F.concat_ws(",", *[F.coalesce(F.col(c).cast("string"), F.lit("-")) for c in BUILDING_FLAGS])
    choices = {
        FLOOD: listed(F.lit(True), FLOOD, F.lit("")),
        FREEWAY_LAYER: beside(FREEWAY_LAYER, [FREEWAY]),
        MAJOR_LAYER: beside(MAJOR_LAYER, [major]),
        RESIDENTIAL_LAYER: beside(RESIDENTIAL_LAYER, [ARTERIAL, STREET]),
        BUILDING_LAYER: listed(any_near, BUILDING_LAYER, flags),
        NEAR_SCHOOL: listed(F.col("xschl") > 0, NEAR_SCHOOL, F.col("xschl")),
        FAR_SCHOOL: listed(F.col("xschl") == 0, FAR_SCHOOL, F.col("xschl")),
    }
    entries = F.flatten(F.array_compact(F.array(*[choices[w] for w in wanted])))
    labelled = rows.select("compkey", "copies", F.explode(entries).alias("__e"))
    sums = labelled.groupBy("compkey", "__e.layer", "__e.group").agg(
        F.sum(F.col("__e.amount") * F.col("copies")).alias("consequence")
    )

    def label(place: int) -> Column:
        chosen = F.when(F.lit(False), None)
        for layer in wanted:
            chosen = chosen.when(F.col("layer") == layer, HEALTH_LABELS[layer][place])
        return chosen

    return sums.select("compkey", "consequence", label(1).alias("sfm"), label(2).alias("tblf"), label(0).alias("reason"))


def flooding_health(links: DataFrame, xp: DataFrame, streets: DataFrame, costs: ConsequenceCosts) -> DataFrame:
    """The flooding amount once per crossing row."""
    return health_layers(links, xp, streets, costs, [FLOOD])


def sinkholes(links: DataFrame, xp: DataFrame, streets: DataFrame, costs: ConsequenceCosts) -> DataFrame:
    """One amount per crossing row beside a freeway, major arterial or smaller street; one row per street group."""
    return health_layers(links, xp, streets, costs, [FREEWAY_LAYER, MAJOR_LAYER, RESIDENTIAL_LAYER])


def near_public_building(links: DataFrame, xp: DataFrame, streets: DataFrame, costs: ConsequenceCosts) -> DataFrame:
    """One result row per combination of the four building counts with any above 0."""
    return health_layers(links, xp, streets, costs, [BUILDING_LAYER])


def spill_and_school(links: DataFrame, xp: DataFrame, streets: DataFrame, costs: ConsequenceCosts) -> DataFrame:
    """Spill near a school (per count of schools) and far from any; both carry the same reason."""
    return health_layers(links, xp, streets, costs, [NEAR_SCHOOL, FAR_SCHOOL])


_LINK, _COST, _SYSTEM, _CROSSING = range(4)


def _pipe_facts(
    links: DataFrame, link_costs: DataFrame, systems: DataFrame, xp: DataFrame | None = None,
) -> DataFrame:
    """What the layers without crossings read, one row per pipe, from one shuffle of all tables by link.

    sum_length and links are those of ``trace_totals``; cost and fined count a link once per trace row, replacement
    as ``replacement_cost`` does. priced, fined and replaced tell how many rows there were to add up.
    """
    parts = [
        links.select("mlinkid", "compkey", F.col("length").cast("double").alias("length"), F.lit(_LINK).alias("kind")),
        link_costs.select("mlinkid", F.col("totalconstructioncost").cast("double").alias("cost"), F.lit(_COST).alias("kind")),
        systems.filter(F.lower("type") == SEPARATED_TYPE.lower()).select("mlinkid", F.lit(_SYSTEM).alias("kind")),
    ]
    if xp is not None:
        parts.append(xp.select("mlinkid", F.lit(_CROSSING).alias("kind")))
    rows = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    by_pipe = Window.partitionBy("mlinkid").orderBy("kind", "compkey")
    whole = by_pipe.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    alike = by_pipe.rangeBetween(Window.currentRow, Window.currentRow)

    def number(kind: int) -> Column:
        return F.sum(F.when(F.col("kind") == kind, 1).otherwise(0)).over(whole)

    counted = _dealt(rows.filter(F.col("mlinkid").isNotNull()), "mlinkid").select(
        "compkey", "kind", F.count(F.lit(1)).over(alike).alias("own"), F.sum("length").over(whole).alias("length"),
        F.sum("cost").over(whole).alias("cost"), number(_LINK).alias("all"), number(_COST).alias("costs"),
        number(_SYSTEM).alias("systems"), number(_CROSSING).alias("crossed"),
        (F.row_number().over(by_pipe) == F.rank().over(by_pipe)).alias("first"),
    )
    own, n = F.col("own"), F.col("all")
    replaced = F.col("costs") * F.col("crossed") * own
    return counted.filter((F.col("kind") == _LINK) & F.col("first")).groupBy("compkey").agg(
        F.sum(F.col("length") * own).alias("sum_length"), F.sum(n * own).alias("links"),
        F.sum(F.col("cost") * own).alias("cost"), F.sum(F.col("costs") * own).alias("priced"),
        F.sum(F.col("systems") * own).alias("fined"), F.sum(replaced).alias("replaced"),
        F.sum(F.when(replaced > 0, F.col("cost") * F.col("crossed") * n * n * n * own)).alias("replacement"),
    )


def _emergency(costs: ConsequenceCosts) -> Column:
    share = F.try_divide(F.least("sum_length", F.lit(costs.repair_length)), F.col("sum_length"))
    return costs.emergency_factor * F.col("cost") * share


def _laid_out(facts: DataFrame, *choices: tuple[Column, Column | float, tuple[str, int, int]]) -> DataFrame:
    """A row of each layer for every pipe that passes the layer's test."""

    def entry(test: Column, amount: Column | float, label: tuple[str, int, int]) -> Column:
        value = amount if isinstance(amount, Column) else F.lit(float(amount))
        reason, scenario, impact = label
        return F.when(test, F.struct(
            value.cast("double").alias("consequence"), F.lit(scenario).alias("sfm"), F.lit(impact).alias("tblf"),
            F.lit(reason).alias("reason"),
        ))

    entries = F.array_compact(F.array(*[entry(*c) for c in choices]))
    return facts.select("compkey", F.explode(entries).alias("e")).select("compkey", "e.*")


def _mortality_choices(costs: ConsequenceCosts) -> list[tuple[Column, Column | float, tuple[str, int, int]]]:
    return [
        (F.col("compkey").isNotNull() & (F.col("priced") > 0), _emergency(costs), EMERGENCY_REPAIR),
        (F.col("fined") > 0, costs.regulatory_fine * F.col("fined"), SEPARATED_AREA),
        (F.lit(True), _flooding(costs), FLOODING),
    ]


def all_health_safety(links: DataFrame, xp: DataFrame, streets: DataFrame, costs: ConsequenceCosts) -> DataFrame:
    """All health and safety layers; identical rows merge."""
    found = health_layers(links, xp, streets, costs)
    return _dealt(found, *found.columns).distinct()


def health_safety(links: DataFrame, xp: DataFrame, streets: DataFrame, costs: ConsequenceCosts) -> DataFrame:
    return _sum_of(all_health_safety(links, xp, streets, costs), F.col("consequence"), HEALTH_SAFETY)


def lateral_flooding(links: DataFrame, costs: ConsequenceCosts) -> DataFrame:
    rows = trace_totals(links).withColumn("consequence", F.lit(costs.flooding_cost))
    return _layer(rows.select("compkey", "consequence"), LATERAL_FLOODING)


def lateral_flooding_health(links: DataFrame, costs: ConsequenceCosts) -> DataFrame:
    rows = trace_totals(links).withColumn("consequence", F.lit(costs.flooding_cost))
    return _layer(rows, LATERAL_FLOODING_HEALTH)


def all_mortality(links, link_costs, systems, xp, streets, costs: ConsequenceCosts) -> DataFrame:
    """The layers by pipe and the sum of health and safety; no two rows of a pipe are alike, as their labels differ."""
    facts = _pipe_facts(links, link_costs, systems)
    return _laid_out(facts, *_mortality_choices(costs)).unionByName(health_safety(links, xp, streets, costs))


def all_mortality_components(links, link_costs, systems, xp, streets, costs: ConsequenceCosts) -> DataFrame:
    facts = _pipe_facts(links, link_costs, systems, xp)
    layers = _laid_out(
        facts, (F.col("replaced") > 0, F.col("replacement"), REPLACEMENT), *_mortality_choices(costs),
        (F.lit(True), costs.lateral_repair, EMERGENCY_LATERAL), (F.lit(True), costs.flooding_cost, LATERAL_FLOODING),
        (F.lit(True), costs.flooding_cost, LATERAL_FLOODING_HEALTH),
    )
    return layers.unionByName(all_health_safety(links, xp, streets, costs))


def total_mortality(links, link_costs, systems, xp, streets, costs: ConsequenceCosts) -> DataFrame:
    rows = all_mortality(links, link_costs, systems, xp, streets, costs)
    return rows.groupBy("compkey").agg(F.sum("consequence").alias("consequence"))


def consequence_layer(df: DataFrame, applies: Column, unit_cost: Column | float, key: str = "id") -> DataFrame:
    """Generic layer: an amount for every row the condition holds for."""
    amount = unit_cost if isinstance(unit_cost, Column) else F.lit(float(unit_cost))
    return df.filter(applies).select(key, amount.alias("consequence"))


def total_consequence(
    seg: DataFrame, layers: list[DataFrame], key: str = "id", add_emergency: bool = False, factor: float = 1.4,
) -> DataFrame:
    """Sum of all layers per segment; a segment in no layer keeps NULL.

    ``add_emergency`` adds the emergency price of replacement.
    """
    summed = accumulate_layers(seg.drop("cof"), layers, key, into="cof")
    if add_emergency:
        summed = summed.withColumn("cof", F.col("cof") + factor * F.col("replacecost"))
    return summed


def whole_consequence(whole_pipes: DataFrame, seg: DataFrame) -> DataFrame:
    """Whole pipes take the largest consequence of their segments."""
    worst = seg.filter(F.col("compkey") > 0).groupBy("compkey").agg(F.max("cof").alias("cof"))
    return whole_pipes.drop("cof").join(worst, "compkey", "left")
