"""Hours of construction by method."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mainstay import params as P
from mainstay.functions.scalar import flag, mean_depth, strict_total, total, zero
from mainstay.operators.costs import CUBIC_FEET_PER_YARD
from mainstay.operators.tables import give_to

# Street groups as the time rates name them.
STREET, ARTERIAL, MAJOR_ARTERIAL = "Strt", "Art", "MajArt"


def _is_whole() -> Column:
    return F.col("id") < P.FIRST_SEGMENT_ID


def base_durations(df: DataFrame, rates: P.TimeRates = P.TimeRates()) -> DataFrame:
    """Hours of the work itself: open cut, bore/jack, liner and pipe burst for whole pipes, spot for segments.

    The bore time adds days per foot to hours; this is the documented formula.
    """
    hours, size, length = rates.hours_per_day, F.col("diamwidth"), F.col("length")
    dig = mean_depth() * F.col("trench_width") / CUBIC_FEET_PER_YARD / rates.excavate_per_day
    crossings = rates.crossing_days * hours * total("xwtr", "xgas", "xfiber", "xsewer")
    grout = rates.grout_days * hours
    bore = (
        F.when(size < rates.small_bore, length / rates.fast_bore + grout)
        .when((size >= rates.small_bore) & (size <= rates.large_bore), length / rates.slow_bore + grout)
        .when(size > rates.large_bore, length / rates.slow_bore)
    )
    spot = F.when(mean_depth() < rates.spot_depth, rates.shallow_spot).when(
        mean_depth() >= rates.spot_depth, rates.deep_spot
    )
    first = F.col("cutno") == 0
    return df.withColumns({
        "open_cut": F.when(_is_whole(), (dig + length / rates.pave_per_day) * hours + crossings),
        "pipe_burst": F.when(first, F.lit(hours)),
        "bore_jack": F.when(_is_whole(), bore),
        "cipp": F.when(first, F.lit(rates.cipp_days * hours)),
        "spot": F.when(~_is_whole(), spot),
    })


def _traffic_hours(rates: P.TimeRates) -> Column:
    group = F.lower("street_grp")
    return F.when(
        group.isNotNull(),
        F.when(group == STREET.lower(), rates.traffic_street)
        .when(group == ARTERIAL.lower(), rates.traffic_arterial)
        .when(group == MAJOR_ARTERIAL.lower(), rates.traffic_major)
        .otherwise(0.0),
    )


def _beside_streets(df: DataFrame, streets: DataFrame, rates: P.TimeRates) -> DataFrame:
    beside = df.join(streets, F.col("pstrttyp") == F.col("street_number"), "left")
    hours = F.when(~_is_whole(), _traffic_hours(rates))
    return beside.withColumn("traffic", hours).drop("street_number", "street_grp")


def _manhole_hours(rates: P.TimeRates) -> Column:
    dug = rates.manhole_min_depth
    depth = F.when(mean_depth() < dug, dug).otherwise(mean_depth())
    return F.when(F.col("cutno") == 0, depth / rates.manhole_per_day * rates.hours_per_day)


def traffic_mobilization(df: DataFrame, streets: DataFrame, rates: P.TimeRates = P.TimeRates()) -> DataFrame:
    """Hours to set up traffic control: by street group for segments, the largest of them for whole pipes."""
    marked = _beside_streets(df, streets, rates)
    worst = marked.groupBy("compkey").agg(F.max("traffic").alias("__traffic"))
    joined = give_to(marked, worst, _is_whole())
    return joined.withColumn("traffic", F.coalesce("traffic", "__traffic")).drop("__traffic")


def _own_setup(df: DataFrame, rates: P.TimeRates) -> DataFrame:
    """Setup hours that need the row itself only."""
    hours, depth = rates.hours_per_day, mean_depth()
    small = (depth < rates.shallow_trench) & (F.col("diamwidth") <= rates.small_bypass)
    per_yard = CUBIC_FEET_PER_YARD * rates.excavate_per_day
    lateral = (
        rates.lateral_width * rates.lateral_length * depth / per_yard + rates.lateral_length / rates.pave_per_day
    )
    pit = F.col("lateral_count") * (rates.pit_area * depth / per_yard)
    return df.withColumns({
        "bypass": F.when(small, hours / 2.0).otherwise(hours),
        "lateral_bypass": F.col("lateral_count") * lateral,
        "bore_pit": F.when(F.col("cutno") == 0, pit),
    })


def mobilization_durations(df: DataFrame, rates: P.TimeRates = P.TimeRates()) -> DataFrame:
    """Hours for mainline bypass, manholes, lateral bypass and bore pits.

    The first segment copies the manhole hours of its pipe.
    """
    marked = _own_setup(df, rates).withColumn("manhole", _manhole_hours(rates))
    source = marked.filter(F.col("cutno") == 0).groupBy("compkey").agg(F.max("manhole").alias("__manhole"))
    joined = give_to(marked, source, F.col("cutno") == 1)
    return joined.withColumn("manhole", F.coalesce("manhole", "__manhole")).drop("__manhole")


def setup_durations(df: DataFrame, streets: DataFrame, rates: P.TimeRates = P.TimeRates()) -> DataFrame:
    """Traffic and mobilization hours together: one aggregation and one join for both."""
    marked = _beside_streets(_own_setup(df, rates), streets, rates).withColumn("manhole", _manhole_hours(rates))
    per_pipe = marked.groupBy("compkey").agg(
        F.max("traffic").alias("__traffic"), F.max("manhole").alias("__manhole")
    )
    first = F.col("cutno") == 1
    joined = give_to(marked, per_pipe, _is_whole() | first, split=True)
    return (
        joined.withColumn("traffic", F.when(_is_whole(), F.col("__traffic")).otherwise(F.col("traffic")))
        .withColumn("manhole", F.when(first, F.col("__manhole")).otherwise(F.col("manhole")))
        .drop("__traffic", "__manhole")
    )


def bore_required(rates: P.TimeRates = P.TimeRates()) -> Column:
    """Too deep to dig, or under a building, rail or freeway."""
    return (
        (mean_depth() > rates.bore_depth) | (F.col("xbldg") > 0) | (F.col("xlrt") > 0)
        | (F.col("xrail") > 0) | (F.col("countxfrwy") > 0)
    )


def bore_needless(rates: P.TimeRates = P.TimeRates(), null_as_zero: bool = True) -> Column:
    """Shallow enough, and known to be under nothing. With ``null_as_zero`` an unknown count is none."""
    names = ["xbldg", "xlrt", "xrail", "countxfrwy"]
    test = mean_depth() <= rates.bore_depth
    for name in names:
        test = test & ((zero(name) if null_as_zero else F.col(name)) == 0)
    return test


def method_durations(df: DataFrame, whole_xp: DataFrame, rates: P.TimeRates = P.TimeRates()) -> DataFrame:
    """Total hours by method; a missing part leaves the total missing.

    Open cut is removed from whole pipes that need boring and boring from the others.
    """
    first = F.col("cutno") == 0
    totals = df.withColumns({
        "open_cut_total": strict_total("open_cut", "manhole", "traffic", "bypass"),
        "bore_jack_total": F.when(
            first, strict_total("bore_jack", "traffic", "bypass", "lateral_bypass", "bore_pit")
        ),
        "cipp_total": F.when(first, strict_total("cipp", "spot", "traffic", "bypass", "lateral_bypass")),
        "spot_total": strict_total("spot", "traffic", "bypass"),
    })
    rules = whole_xp.groupBy("compkey").agg(
        F.max(flag(bore_required(rates))).alias("__bore"), F.max(flag(bore_needless(rates))).alias("__dig")
    )
    return _remove(give_to(totals, rules, _is_whole(), split=True), F.col("__bore") == 1, F.col("__dig") == 1)


def _remove(pipes: DataFrame, bore: Column, dig: Column) -> DataFrame:
    rules = {"open_cut": bore, "open_cut_total": bore, "bore_jack": dig, "bore_jack_total": dig, "bore_pit": dig}
    blanked = {name: F.when(test, None).otherwise(F.col(name)) for name, test in rules.items()}
    return pipes.withColumns(blanked).drop("__bore", "__dig")


def durations(
    df: DataFrame, streets: DataFrame, whole_xp: DataFrame | None = None, rates: P.TimeRates = P.TimeRates(),
    null_as_zero: bool = False,
) -> DataFrame:
    """All hours in one frame. ``null_as_zero`` is the desktop form: a missing part counts 0."""
    out = base_durations(df, rates)
    out = setup_durations(out, streets, rates)
    if not null_as_zero:
        return method_durations(out, whole_xp if whole_xp is not None else out.filter(_is_whole()), rates)
    return desktop_totals(out, rates)


def desktop_totals(df: DataFrame, rates: P.TimeRates = P.DESKTOP_TIMES) -> DataFrame:
    """Totals where a missing part counts 0; a removed method and a total of 0 become missing."""
    first = F.col("cutno") == 0
    totals = (
        df.withColumn("open_cut_total", F.when(first, total("open_cut", "manhole", "traffic", "bypass")))
        .withColumn(
            "bore_jack_total", F.when(first, total("bore_jack", "traffic", "bypass", "lateral_bypass", "bore_pit"))
        )
        .withColumn("cipp_total", F.when(first, total("cipp", "spot", "traffic", "bypass", "lateral_bypass")))
        .withColumn("spot_total", total("spot", "traffic", "bypass"))
    )
    no_dig = (first & bore_required(rates)) | (F.col("open_cut_total") == 0)
    no_bore = (first & bore_needless(rates, null_as_zero=False)) | (F.col("bore_jack") == 0)
    marked = totals.withColumn("__bore", flag(no_dig)).withColumn("__dig", flag(no_bore))
    return _remove(marked, F.col("__bore") == 1, F.col("__dig") == 1)
