"""Risk table, failure counts and action flags."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from mainstay import params as P
from mainstay.functions.scalar import flag, has_replacement_prefix, upper_tail
from mainstay.operators.intervals import clipped_length, overlap_join, point_in_segment
from mainstay.operators.reach import may_match
from mainstay.operators.skew import HotKeys, attach
from mainstay.operators.tables import copy_segments_to_whole


def risk_multiplier(spark: SparkSession, as_of_year: int, rules: P.LifeRules = P.LifeRules()) -> DataFrame:
    """Discounted chance of failure per failure year and standard deviation.

    Each row is the sum over the planning years of the chance to fail in that year,
    given survival until now, discounted to now. The sum is taken over survival
    chances (each year's chance is a difference of two of them), so every tail is
    computed once. The table has one row per (year, sd) pair: its size depends on
    the rules only.
    """
    years = as_of_year + rules.risk_horizon - rules.risk_start_year + 1
    pairs = spark.range(years * rules.risk_max_sd).select(
        (F.lit(rules.risk_start_year) + F.floor(F.col("id") / rules.risk_max_sd)).cast("int").alias("failure_year"),
        (F.col("id") % rules.risk_max_sd + 1).cast("double").alias("std_dev"),
    )
    last = rules.risk_horizon + 1
    k = F.col("__k")
    terms = pairs.withColumn("__k", F.explode(F.sequence(F.lit(0), F.lit(last))))

    def discount(step: Column) -> Column:
        return F.pow(F.lit(rules.discount), -step)

    weight = (
        F.when(k == 0, F.lit(1.0)).when(k == last, -discount(k - 1)).otherwise(discount(k) - discount(k - 1))
    )
    survival = upper_tail((F.lit(as_of_year) + k - F.col("failure_year")) / F.col("std_dev"))
    sums = terms.withColumn("__alive", survival).groupBy("failure_year", "std_dev").agg(
        F.sum(weight * F.col("__alive")).alias("__sum"), F.max(F.when(k == 0, F.col("__alive"))).alias("__now")
    )
    value = F.when(F.col("__now") <= 0, F.lit(1.0)).otherwise(F.col("__sum") / F.col("__now"))
    return sums.select("failure_year", "std_dev", value.alias("unit_multiplier"))


RISK = "__risk"


def with_risk_table(df: DataFrame, risk: DataFrame) -> DataFrame:
    """Give every row the risk table as one ordered array, for ``risk_at``.

    The array goes to each task once (about 14,600 numbers); any number of lookups
    then needs no further join.
    """
    return df.withColumn(RISK, risk_table(risk))


def risk_table(risk: DataFrame) -> Column:
    """The array itself, a scalar of the plan: for chains of steps, where a column of it would be copied from row to row."""
    ordered = F.array_sort(F.collect_list(F.struct("failure_year", "std_dev", "unit_multiplier")))
    return risk.agg(F.transform(ordered, lambda r: r["unit_multiplier"]).alias(RISK)).scalar()


def risk_at(
    year: Column, sd: Column | float, rules: P.LifeRules = P.LifeRules(), table: Column | None = None
) -> Column:
    """Multiplier for an exact (year, sd) pair; NULL where the table has no such row. ``table`` stands for the rows' own column."""
    sd = sd if isinstance(sd, Column) else F.lit(float(sd))
    whole_sd = (sd == F.floor(sd)) & (sd >= 1) & (sd <= rules.risk_max_sd)
    place = (year - rules.risk_start_year) * rules.risk_max_sd + sd - 1
    return F.when(whole_sd & (year >= rules.risk_start_year), F.get(F.col(RISK) if table is None else table, place.cast("int")))


def is_severe(codes: list[int], code: str = "obsevkey") -> Column:
    """Observation of a severe code; codes below 0 never match."""
    return F.col(code).isin([c for c in codes if c >= 0])


def severe_touched(
    seg: DataFrame, obs: DataFrame, codes: list[int], variant: str, hot: HotKeys | None = None
) -> DataFrame:
    """Distinct segments that a severe observation touches."""
    places = obs.filter(is_severe(codes)).select("compkey", "distfrom", "distto").distinct()
    narrow = seg.select("id", "compkey", "cutno", "fm", "to_")
    return overlap_join(narrow, places, variant, hot=hot).select("id", "compkey", "cutno").distinct()


def broken_segments(seg: DataFrame, obs: DataFrame, codes: list[int], hot: HotKeys | None = None) -> DataFrame:
    """Number of segments per pipe that a severe observation touches."""
    touched = severe_touched(seg, obs, codes, "half_open", hot)
    return touched.select("compkey", "cutno").distinct().groupBy("compkey").agg(
        F.count(F.lit(1)).alias("broken")
    )


def repaired_segments(seg: DataFrame) -> DataFrame:
    """Number of segments per pipe with a material stamped as a repair."""
    repaired = seg.filter(has_replacement_prefix("material"))
    return repaired.groupBy("compkey").agg(F.count(F.lit(1)).alias("fixed"))


def defect_ledger(seg: DataFrame, obs: DataFrame, peak: DataFrame, hot: HotKeys | None = None) -> DataFrame:
    """One row per segment and defect: linear part by clipped score, point part by own score."""
    narrow = seg.select("id", "compkey", "cutno", "fm", "to_", "length", "seg_count")
    marks = ["obskey", "inspkey", "obsevkey"]
    defects = obs.select("compkey", "distfrom", "distto", "newscore", *marks)
    scored = defects.join(peak, "obsevkey")
    columns = ["id", "compkey", "cutno", *marks, "distfrom", "distto"]
    lines = overlap_join(narrow, scored, "mixed", hot=hot).select(
        *columns, (clipped_length() * F.col("peak_score")).alias("score")
    )
    points = defects.filter(F.col("distfrom") == F.col("distto"))
    is_last = F.coalesce(F.col("cutno") == F.col("seg_count"), F.lit(False))
    inner = point_in_segment(narrow.filter(~is_last), points)
    last = may_match(narrow.filter(is_last), points, "compkey")
    overrun = attach(points, last, "compkey", "inner", hot).filter(F.col("distfrom") >= F.col("fm"))
    picked = [*columns, F.col("newscore").alias("score")]
    return lines.unionByName(inner.select(*picked)).unionByName(overrun.select(*picked))


def failed_segments(seg: DataFrame, ledger: DataFrame, codes: list[int]) -> DataFrame:
    """Number of segments per pipe that are repaired or hold a severe defect."""
    severe = ledger.filter(is_severe(codes)).select("compkey", "cutno").distinct().withColumn("__severe", F.lit(True))
    joined = seg.select("compkey", "cutno", "material").join(severe, ["compkey", "cutno"], "left")
    failed = joined.filter(has_replacement_prefix("material") | F.col("__severe"))
    return failed.select("compkey", "cutno").distinct().groupBy("compkey").agg(F.count(F.lit(1)).alias("failed"))


def pipe_summary(
    seg: DataFrame, obs: DataFrame, ledger: DataFrame, codes: list[int], hot: HotKeys | None = None
) -> DataFrame:
    """Per pipe: largest consequence and costs, and the counted segments."""
    base = seg.filter(F.col("compkey").isNotNull()).groupBy("compkey").agg(
        F.count(F.lit(1)).alias("segments"), F.max("cof").alias("cof"),
        F.max("replacecost").alias("replacecost"), F.max("linercost").alias("linercost"),
    )
    counted = base
    for part in (broken_segments(seg, obs, codes, hot), repaired_segments(seg), failed_segments(seg, ledger, codes)):
        counted = counted.join(part, "compkey", "left")
    return counted.fillna(0, ["broken", "fixed", "failed"])


def rollup_failure(seg: DataFrame, whole_pipes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Segments keep failure year and deviation when both are set; whole pipes take the least of each."""
    known = (F.col("failure_year") != 0) & (F.col("std_dev") != 0)
    kept = seg.withColumn("fail_yr_seg", F.when(known, F.col("failure_year"))).withColumn(
        "std_dev_seg", F.when(known, F.col("std_dev"))
    )
    least = {
        "failure_year": F.min("fail_yr_seg"),
        "std_dev": F.min("std_dev_seg"),
    }
    rolled = copy_segments_to_whole(whole_pipes, kept.filter(known), least)
    return kept, rolled


def action_flags(seg: DataFrame, obs: DataFrame, codes: list[int], hot: HotKeys | None = None) -> DataFrame:
    """Spot repair where a severe defect overlaps; a spot is also counted for a total score of 1,000 or more."""
    severe = severe_touched(seg, obs, codes, "closed", hot).select("id").withColumn("__severe", F.lit(True))
    joined = seg.join(severe, "id", "left")
    spot = F.col("__severe") | (F.col("total_score") >= P.BAD_SCORE)
    return (
        joined.withColumn("action", F.when(F.col("__severe"), P.ACTION_SPOT).otherwise(P.ACTION_NOTHING))
        .withColumn("spot_count", flag(spot))
        .drop("__severe")
    )


def whole_spot_counts(whole_pipes: DataFrame, seg: DataFrame) -> DataFrame:
    """Whole pipes start with action 1 and the sum of their segments' spots."""
    base = whole_pipes.withColumn("action", F.lit(P.ACTION_NOTHING))
    return copy_segments_to_whole(base, seg, {"spot_count": F.sum("spot_count")})


def in_replacement(whole_pipes: DataFrame, as_of_year: int, rules: P.LifeRules = P.LifeRules()) -> DataFrame:
    """Old pipes without a usable inspection count as being replaced."""
    old = (as_of_year - F.year("instdate") > rules.replacement_age) | F.col("instdate").isNull()
    stale = F.col("insp_curr").isin(P.INSPECTION_BEFORE_INSTALL, P.INSPECTION_NONE)
    hit = stale & (F.lower("hservstat") != P.STATUS_NEW.lower()) & old
    share = rules.replacement_sd_share * F.col("rulife")
    # A missing remaining life leaves the deviation missing.
    spread = F.when(share < rules.replacement_sd_floor, rules.replacement_sd_floor).otherwise(share)
    return whole_pipes.withColumn("std_dev", F.when(hit, spread).otherwise(F.col("std_dev"))).withColumn(
        "action", F.when(hit, P.ACTION_IN_REPLACEMENT).otherwise(F.col("action"))
    )


def failure_percent(pipes: DataFrame, summary: DataFrame, hot: HotKeys | None = None) -> DataFrame:
    """Counts of the pipe on each of its rows, with the failed share in percent.

    Takes segments and whole pipes in one frame. Pipe 0 gets no share, and its whole
    row no counts; its segments keep the segment count they bring.
    """
    counts = summary.select(
        "compkey", F.col("segments").alias("seg_count"), F.col("broken").alias("fail_near"),
        F.col("fixed").alias("fail_prev"), F.col("failed").alias("fail_tot"),
    )
    old = F.col("seg_count") if "seg_count" in pipes.columns else F.lit(None)
    plain = pipes.withColumn("__old_count", old.cast("long")).drop("seg_count", "fail_near", "fail_prev", "fail_tot", "fail_pct")
    joined = attach(plain, counts, "compkey", "left", hot)
    is_segment = F.col("id") >= P.FIRST_SEGMENT_ID
    kept = {n: F.when(is_segment | (F.col("compkey") != 0), F.col(n)) for n in counts.columns[1:]}
    kept["seg_count"] = F.when(F.col("compkey") != 0, F.col("seg_count")).when(is_segment, F.col("__old_count"))
    share = F.when(F.col("seg_count") == 0, 0.0).otherwise(100.0 * F.col("fail_tot") / F.col("seg_count"))
    return joined.withColumns(kept).withColumn("fail_pct", F.when(F.col("compkey") != 0, share)).drop("__old_count")


def repaired_material(seg: DataFrame, base: DataFrame) -> DataFrame:
    """Note of the found material where it differs from the base table."""
    joined = seg.join(base.select("id", F.col("material").alias("__base")), "id", "left")
    return material_note(joined, "__base").drop("__base")


def material_note(seg: DataFrame, base: str) -> DataFrame:
    """The same where the rows bring the material of the base table in column ``base``."""
    differs = F.lower(base) != F.lower("material")
    return seg.withColumn("mat_note", F.when(differs, F.col("material")))


def spot_cost(seg: DataFrame) -> DataFrame:
    return seg.withColumn("spotcost", F.col("replacecost") * F.col("spot_count"))


def publish_grain(
    base: DataFrame, part: DataFrame, columns: list[str], whole: bool, rules: P.LifeRules = P.LifeRules()
) -> DataFrame:
    """Write the result columns of one grain back to its rows of the base table, by id.

    Whole pipes also get the failure year after replacement and its deviation.
    """
    own = [c for c in base.columns if c not in columns]
    joined = base.select(*own).join(part.select("id", *columns, F.lit(whole).alias("__whole")), "id", "left")
    after = F.when(F.col("__whole"), F.col("failure_year") + rules.whole_years)
    return (
        joined.withColumn("fail_yr_whole", after)
        .withColumn("std_dev_whole", F.when(F.col("__whole"), rules.whole_sd))
        .drop("__whole")
    )


def publish(base: DataFrame, seg: DataFrame, whole_pipes: DataFrame, columns: list[str], rules: P.LifeRules = P.LifeRules()) -> DataFrame:
    """Write result columns back to the base table: segments and whole pipes by their id."""
    is_segment = F.coalesce(F.col("id") >= P.FIRST_SEGMENT_ID, F.lit(False))
    return publish_grain(base.filter(is_segment), seg, columns, False, rules).unionByName(
        publish_grain(base.filter(~is_segment), whole_pipes, columns, True, rules)
    )
