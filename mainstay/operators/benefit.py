"""Net benefit-cost ratios of replacing, lining and spot-repairing each pipe."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mainstay import params as P
from mainstay.functions.scalar import total, zero
from mainstay.operators.intervals import point_in_segment
from mainstay.operators.lifespan import risk_at, risk_table
from mainstay.operators.skew import HotKeys, attach
from mainstay.operators.tables import bid_from, job_cost_agg, latest_inspections

LENGTH_LIMIT = 0.1
SAG_NOTE = ", extensive sagging"
OVAL_NOTE = ", extensive ovaling"
SURCHARGE_NOTE = ", extensive surcharge"
RATIO_NAMES = [f"nbcr_{a}_{b}" for a in ("oc", "cipp", "sp") for b in ("oc", "cipp", "sp")]


def branches(whole_pipes: DataFrame) -> DataFrame:
    """One row per pipe: first failure year, deviation and costs."""
    return whole_pipes.filter(F.col("cutno") == 0).select(
        "compkey", F.col("fail_yr").alias("first_failure"), "std_dev", "replacecost", "spotcost",
        F.col("line_alone").alias("linecost"), F.lit(None).cast("string").alias("problems"),
    )


def surcharged(surcharge: DataFrame, limit: float) -> DataFrame:
    """Pipes whose surcharge, stored as text, reaches the limit in feet."""
    feet = F.expr("try_cast(ussurch AS DOUBLE)")
    return surcharge.filter(feet >= limit).select("compkey").distinct()


def observations_with_severity(
    insp: DataFrame, obs: DataFrame, severities: tuple[str, ...], hot: HotKeys | None = None,
    hot_inspections: HotKeys | None = None,
) -> DataFrame:
    """Latest-inspection observations of the severities, with a length of at least ten feet."""
    inspected = insp.join(obs.select("inspkey").distinct(), "inspkey", "left_semi")
    latest = latest_inspections(inspected, hot).select("inspkey", "compkey")
    length = F.col("distto") - F.col("distfrom")
    found = obs.filter(F.lower("severity").isin([s.lower() for s in severities])).select(
        "inspkey", "distfrom", F.when(length < 10, 10.0).otherwise(length).alias("defect_length")
    )
    return attach(found, latest, "inspkey", "inner", hot_inspections)


def defect_fraction(
    insp: DataFrame, obs: DataFrame, seg: DataFrame, whole_pipes: DataFrame, severities: tuple[str, ...],
    limit: float = LENGTH_LIMIT, hot: HotKeys | None = None, hot_inspections: HotKeys | None = None,
) -> DataFrame:
    """Pipes where defects of the severities cover more than ``limit`` of the length.

    Each owned segment counts its longest defect once.
    """
    found = observations_with_severity(insp, obs, severities, hot, hot_inspections)
    places = found.groupBy("compkey", "distfrom").agg(F.max("defect_length").alias("defect_length"))
    owned = seg.filter(F.col("remarks").isin(*P.OWNER_REMARKS)).select("id", "compkey", "fm", "to_")
    longest = point_in_segment(owned, places).groupBy("id", "compkey").agg(
        F.max("defect_length").alias("defect_length")
    )
    sums = longest.groupBy("compkey").agg(F.sum("defect_length").alias("defect_length"))
    share = F.try_divide(F.col("defect_length"), F.col("length"))
    joined = sums.join(whole_pipes.select("compkey", "length"), "compkey")
    return joined.withColumn("fraction", share).filter(F.col("fraction") > limit)


def with_notes(branch: DataFrame, flagged: DataFrame, text: str) -> DataFrame:
    """Append a note to the flagged pipes."""
    marks = flagged.select("compkey").distinct().withColumn("__mark", F.lit(True))
    joined = branch.join(marks, "compkey", "left")
    noted = F.concat(F.coalesce("problems", F.lit("")), F.lit(text))
    return joined.withColumn("problems", F.when(F.col("__mark"), noted).otherwise(F.col("problems"))).drop("__mark")


def present_value_lost(
    branch: DataFrame, seg: DataFrame, as_of_year: int, rules: P.LifeRules = P.LifeRules()
) -> DataFrame:
    """Value given up by replacing or lining a pipe whose segments are still good."""
    score = F.col("def_tot")
    quality = F.when(score >= P.BAD_SCORE, 0.0).otherwise((P.BAD_SCORE - score) / P.BAD_SCORE)
    quality = quality * F.when(F.col("action") == P.ACTION_SPOT, 0.0).otherwise(1.0)
    late = rules.liner_late_factor
    early = F.when(F.col("fail_yr") < as_of_year + rules.liner_years * rules.liner_early_share, 1.0).otherwise(late)
    long = F.when(F.col("fail_yr") < as_of_year + rules.liner_years, 1.0).otherwise(late)
    sums = seg.filter(F.col("cutno") > 0).groupBy("compkey").agg(
        F.sum(rules.whole_weight * F.col("replacecost") * quality).alias("__whole"),
        F.sum(rules.liner_weight * F.col("replacecost") * quality * early * long).alias("__liner"),
        F.lit(True).alias("__known"),
    )
    cap = rules.present_value_cap * F.col("replacecost")

    def capped(amount: str) -> Column:
        value = F.when(F.col(amount) > cap, cap).otherwise(F.col(amount))
        return F.when(F.col("__known"), value)

    deformed = F.lower("problems").contains("sagging") | F.lower("problems").contains("ovaling")
    joined = branch.join(sums, "compkey", "left")
    return (
        joined.withColumn("pv_whole", F.when(deformed, 0.0).otherwise(capped("__whole")))
        .withColumn("pv_liner", capped("__liner"))
        .withColumn("pv_spot", F.lit(None).cast("double"))
        .drop("__whole", "__liner", "__known")
    )


def max_cof_without_replacement(branch: DataFrame, seg: DataFrame, rules: P.LifeRules = P.LifeRules()) -> DataFrame:
    worst = seg.filter(F.col("cutno") > 0).groupBy("compkey").agg(
        F.max(F.col("cof") - rules.emergency_factor * F.col("replacecost")).alias("max_cof")
    )
    return branch.join(worst, "compkey", "left")


def spot_jobs(seg: DataFrame, jobs: DataFrame) -> DataFrame:
    """Segments with their spot job."""
    spots = jobs.filter(F.col("type") == "Spot").select(
        "id", "capitalnonmobilization", "capitalmobilizationrate", "basetime", "mobilizationtime"
    )
    rows = seg.filter(F.col("cutno") > 0).select("id", "compkey", "def_tot", "fail_yr_seg", "action")
    return rows.join(spots, "id")


def spot_sums(
    branch: DataFrame, seg: DataFrame, jobs: DataFrame, as_of_year: int, rules: P.LifeRules = P.LifeRules(),
    hot: HotKeys | None = None,
) -> DataFrame:
    """All spot sums a pipe needs, from one join and one aggregation.

    The four bids (now, later, at failure, after failure) and the spot parts of
    the combined bids are conditional sums over the same rows.
    """
    failures = branch.select("compkey", "first_failure")
    rows = attach(spot_jobs(seg, jobs), failures, "compkey", "inner", hot)
    bad, spot = F.col("def_tot") >= P.BAD_SCORE, F.col("action") == P.ACTION_SPOT
    fail, turn = F.col("fail_yr_seg"), rules.spot_years
    soon, late = fail <= as_of_year + turn, fail > as_of_year + turn
    first = F.col("first_failure")
    near, far = fail <= first + turn, fail > first + turn
    # Line years are the spot years in both branches of the rule that sets them.
    after_line, after_line_now = fail > first + rules.line_at_year, fail > as_of_year + rules.line_at_year
    tests = {
        "now": (soon & bad) | spot,
        "later": late & bad,
        "fail": near & (bad | spot),
        "after": far & (bad | spot),
        "with_liner": spot | (bad & near),
        "after_line": after_line & (bad | spot),
        "after_line_now": after_line_now & (bad | spot),
    }
    amounts = {
        "nonmob": (F.sum, "capitalnonmobilization"), "rate": (F.max, "capitalmobilizationrate"),
        "base": (F.sum, "basetime"), "mob": (F.max, "mobilizationtime"),
    }
    aggs = []
    for name, test in tests.items():
        aggs += [how(F.when(test, F.col(c))).alias(f"{name}_{part}") for part, (how, c) in amounts.items()]
        aggs.append(F.max(F.when(test, F.lit(True))).alias(f"{name}_any"))
    return rows.groupBy("compkey").agg(*aggs)


def _bid(name: str) -> Column:
    return bid_from(*[F.col(f"{name}_{p}") for p in ("nonmob", "rate", "base", "mob")])


def spot_bids(branch: DataFrame, sums: DataFrame) -> DataFrame:
    """Spot bid now and later, and at and after the first failure; NULL where no segment qualifies."""
    joined = branch.join(sums, "compkey", "left")
    names = {"now": "spot_now", "later": "spot_later", "fail": "spot_fail", "after": "spot_after"}
    return joined.withColumns({
        target: F.when(F.col(f"{source}_any"), zero(_bid(source))) for source, target in names.items()
    })


def line_jobs(jobs: DataFrame) -> DataFrame:
    return jobs.filter((F.col("type") == "Line") & (F.col("id") < P.FIRST_SEGMENT_ID)).select(
        "compkey", F.col("capitalnonmobilization").alias("line_nonmob"),
        F.col("capitalmobilizationrate").alias("line_rate"), F.col("basetime").alias("line_base"),
        F.col("mobilizationtime").alias("line_mob"), F.lit(True).alias("has_line"),
    )


def combined_bid(spot: str) -> Column:
    """Bid for spots and liner as one job; missing spot parts count 0."""

    def part(name: str) -> Column:
        return zero(f"{spot}_{name}")

    nonmob = part("nonmob") + F.col("line_nonmob")
    rate = F.greatest(part("rate"), zero("line_rate"))
    mob = F.greatest(part("mob"), zero("line_mob"))
    return bid_from(nonmob, rate, part("base") + F.col("line_base"), mob)


def _failure_cost(rules: P.LifeRules) -> Column:
    return F.col("replacecost") * rules.emergency_factor + F.col("max_cof")


def bpw_open_cut(df: DataFrame, rules: P.LifeRules = P.LifeRules(), table: Column | None = None) -> DataFrame:
    """Replace at failure, and again one pipe life later. Like all stages: cost times risk at (year, sd)."""
    first, cost = F.col("first_failure"), _failure_cost(rules)
    return df.withColumns({
        "bpw_oc1": cost * risk_at(first, F.col("std_dev"), rules, table),
        "bpw_oc2": cost * risk_at(first + rules.whole_years, rules.whole_sd, rules, table),
    })


def bpw_liner(df: DataFrame, rules: P.LifeRules = P.LifeRules(), table: Column | None = None) -> DataFrame:
    """Line at failure; where that is dearer than open cut, open cut takes its place."""
    first, cost = F.col("first_failure"), _failure_cost(rules)
    bid = F.when(
        F.col("with_liner_any") & F.col("has_line"),
        combined_bid("with_liner") * rules.emergency_factor + F.col("max_cof"),
    )
    lined = first + rules.liner_years
    staged = df.withColumns({
        "__l1": bid * risk_at(first, F.col("std_dev"), rules, table),
        "__l2": cost * risk_at(lined, rules.liner_sd, rules, table),
        "__l3": cost * risk_at(lined + rules.whole_years, rules.whole_sd, rules, table),
    })
    dearer = F.col("__l1") > F.col("bpw_oc1")
    return staged.withColumns({
        "bpw_cipp1": F.when(dearer, F.col("bpw_oc1")).otherwise(F.col("__l1")),
        "bpw_cipp2": F.when(dearer, F.col("bpw_oc2")).otherwise(F.col("__l2")),
        "bpw_cipp3": F.when(dearer, 0.0).otherwise(F.col("__l3")),
    }).drop("__l1", "__l2", "__l3")


def _spot_stages(df: DataFrame, start: Column, spot: str, prefix: str, rules: P.LifeRules, table: Column | None) -> DataFrame:
    """Stages 2 to 4 of a spot strategy that lines at ``start`` + 30.

    Where the second stage costs more than replacing the pipe then, all three go
    to 0; any 0 is then refilled with replacement stages. Where the risk table has
    no row for a test, the stage stays as it is.
    """
    cost, line = _failure_cost(rules), start + rules.line_at_year
    bid = F.when(F.col("has_line"), combined_bid(spot) * rules.emergency_factor + F.col("max_cof"))
    relined = line + rules.liner_years
    refills = {"2": 0, "3": rules.whole_years, "4": 2 * rules.whole_years}
    staged = df.withColumns({
        "__s2": bid * risk_at(line, rules.spot_sd, rules, table),
        "__s3": cost * risk_at(relined, rules.liner_sd, rules, table),
        "__s4": cost * risk_at(relined + rules.whole_years, rules.whole_sd, rules, table),
        **{f"__r{stage}": cost * risk_at(line + years, rules.whole_sd, rules, table) for stage, years in refills.items()},
    })
    dearer = F.col("__s2") > F.col("__r2")

    def refilled(stage: str) -> Column:
        reset = F.when(dearer, 0.0).otherwise(F.col(f"__s{stage}"))
        return F.when((reset == 0) & F.col(f"__r{stage}").isNotNull(), F.col(f"__r{stage}")).otherwise(reset)

    done = staged.withColumns({f"{prefix}{stage}": refilled(stage) for stage in refills})
    return done.drop(*[f"__s{s}" for s in refills], *[f"__r{s}" for s in refills])


def bpw_spot(df: DataFrame, rules: P.LifeRules = P.LifeRules(), table: Column | None = None) -> DataFrame:
    """Spots at failure, liner later, then as for the liner."""
    first = F.col("first_failure")
    repair = F.col("spot_fail") * rules.emergency_factor + F.col("max_cof")
    df = df.withColumn("bpw_sp1", repair * risk_at(first, F.col("std_dev"), rules, table))
    return _spot_stages(df, first, "after_line", "bpw_sp", rules, table)


def apw_open_cut(df: DataFrame, as_of_year: int, rules: P.LifeRules = P.LifeRules(), table: Column | None = None) -> DataFrame:
    later = F.lit(as_of_year + rules.whole_years)
    return df.withColumns({
        "apw_oc1": total("replacecost", "pv_whole"),
        "apw_oc2": _failure_cost(rules) * risk_at(later, rules.whole_sd, rules, table),
    })


def apw_liner(df: DataFrame, as_of_year: int, rules: P.LifeRules = P.LifeRules(), table: Column | None = None) -> DataFrame:
    """Line now. The bid holds no spots: spot jobs exist for segments only, and this asks whole pipes."""
    alone = bid_from(F.col("line_nonmob"), zero("line_rate"), F.col("line_base"), zero("line_mob"))
    cost, lined = _failure_cost(rules), F.lit(as_of_year + rules.liner_years)
    return df.withColumns({
        "apw_cipp1": zero(F.when(F.col("has_line"), alone)) + zero("pv_liner"),
        "apw_cipp2": cost * risk_at(lined, rules.liner_sd, rules, table),
        "apw_cipp3": cost * risk_at(lined + rules.whole_years, rules.whole_sd, rules, table),
    })


def apw_spot(df: DataFrame, as_of_year: int, rules: P.LifeRules = P.LifeRules(), table: Column | None = None) -> DataFrame:
    df = df.withColumn("apw_sp1", total("spot_now", "pv_spot"))
    return _spot_stages(df, F.lit(as_of_year), "after_line_now", "apw_sp", rules, table)


def nbcr(df: DataFrame) -> DataFrame:
    """Stage sums, base risk and the nine ratios.

    The three rows of the matrix are equal here; later gates blank some of them. All
    but the first ratio read an unknown value as -10.
    """
    c = F.col
    df = df.withColumns({
        "__own": c("bpw_oc1") + zero("bpw_oc2"),
        "bpw_cipp": c("bpw_cipp1") + c("bpw_cipp2") + zero("bpw_cipp3"),
        "bpw_sp": c("bpw_sp1") + c("bpw_sp2") + zero("bpw_sp3") + zero("bpw_sp4"),
        "apw_oc": c("apw_oc1") + zero("apw_oc2"),
        "apw_cipp": c("apw_cipp1") + c("apw_cipp2") + zero("apw_cipp3"),
        "apw_sp": c("apw_sp1") + c("apw_sp2") + zero("apw_sp3") + zero("apw_sp4"),
    })
    df = df.withColumn("bpw_oc", F.least("__own", "bpw_cipp", "bpw_sp")).drop("__own")

    def ratio(name: str) -> Column:
        cost = c("apw_" + name.rsplit("_", 1)[1])
        value = F.try_divide(c("bpw_oc") - cost, cost)
        return value if name == "nbcr_oc_oc" else F.coalesce(value, F.lit(-10.0))

    return df.withColumns({name: ratio(name) for name in RATIO_NAMES})


def with_present_value(target: DataFrame, branch: DataFrame) -> DataFrame:
    """Present value lost copied to the result rows."""
    return target.join(branch.select("compkey", "pv_whole", "pv_liner", "pv_spot"), "compkey", "left")


def benefit(
    branch: DataFrame, seg: DataFrame, jobs: DataFrame, risk: DataFrame, as_of_year: int,
    rules: P.LifeRules = P.LifeRules(), hot: HotKeys | None = None,
) -> DataFrame:
    """All benefit-cost columns for noted branches."""
    out = present_value_lost(branch, seg, as_of_year, rules)
    out = max_cof_without_replacement(out, seg, rules)
    out = spot_bids(out, spot_sums(branch, seg, jobs, as_of_year, rules, hot))
    out = out.join(line_jobs(jobs), "compkey", "left")
    table = risk_table(risk)
    out = bpw_open_cut(out, rules, table)
    out = bpw_liner(out, rules, table)
    out = bpw_spot(out, rules, table)
    out = apw_open_cut(out, as_of_year, rules, table)
    out = apw_liner(out, as_of_year, rules, table)
    out = apw_spot(out, as_of_year, rules, table)
    return nbcr(out)
