"""Choice of one method per pipe, the gates on it, and the final tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mainstay import params as P
from mainstay.functions.scalar import flag, is_unit_id, zero
from mainstay.operators.benefit import RATIO_NAMES, combined_bid, line_jobs, spot_jobs, with_notes
from mainstay.operators.skew import HotKeys, attach
from mainstay.operators.tables import give_to, job_cost_agg, sandwich

# Actions and notes that results are compared by.
OPEN_CUT, SPOT, LINER, SANDWICH = "OC", "SP", "CIPP", "OC Sandwich"
DO_NOTHING, DO_NOTHING_FIRST, WATCH, PENDING = "Do Nothing", "Do nothing", "Watch me", "(PEND)"
NOT_LINABLE = "Not linable"
NOT_MAINTAINED = f"Not a {P.OWNER} maintained rehab pipe"
NOTE_NOT_MAINTAINED = f", not a {P.OWNER} maintained rehab pipe"
NOTE_FEW_SPOTS = ", only one or two bad spots"
NOTE_SANDWICH = ", in between two OC"
NOTE_NO_ASSET = ", no match in COMPSMN OR COMPSTMN"
NOTE_REPLACED = ", pipe was replaced after last inspection"
NOTE_NO_INSPECTION = ", no valid inspection"
NOTE_NO_INSTALL = ", pipe has no install date and is tbab or aban"
NOTE_INCOMPLETE = ", inspection not completed in one pass"
NOTE_TOO_LONG = ", inspection is longer than known length of pipe"
FAIL_HORIZON = 20
SURCHARGE_BLANKS = ["nbcr_oc_cipp", "nbcr_cipp_oc", "nbcr_cipp_cipp", "nbcr_cipp_sp", "nbcr_sp_cipp"]
DEFORMED_BLANKS = [n for n in RATIO_NAMES if n != "nbcr_oc_oc"]


def _mark(df: DataFrame, keys: DataFrame, name: str) -> DataFrame:
    return df.join(keys.select("compkey").distinct().withColumn(name, F.lit(True)), "compkey", "left")


def trim_matrix(branch: DataFrame, surcharge: DataFrame, sagging: DataFrame, ovaling: DataFrame) -> DataFrame:
    """Blank ratios that are not possible: lining under surcharge, all but open cut when deformed."""
    marked = _mark(_mark(branch, surcharge, "__wet"), sagging.select("compkey").union(ovaling.select("compkey")), "__bent")
    wet, bent = F.coalesce("__wet", F.lit(False)), F.coalesce("__bent", F.lit(False))

    def kept(name: str) -> Column:
        blank = F.lit(False)
        if name in SURCHARGE_BLANKS:
            blank = blank | wet
        if name in DEFORMED_BLANKS:
            blank = blank | bent
        return F.when(~blank, F.col(name))

    return marked.withColumns({name: kept(name) for name in RATIO_NAMES}).drop("__wet", "__bent")


FAMILIES = ("oc", "sp", "cipp")
ACTIONS = {"oc": OPEN_CUT, "sp": SPOT, "cipp": LINER}


def _target_of(best: Column) -> dict[str, Column]:
    """Per method: does any ratio of that target method equal the best one?"""
    return {
        target: reduce(lambda a, b: a | b, [F.coalesce(best == F.col(f"nbcr_{row}_{target}"), F.lit(False)) for row in FAMILIES])
        for target in FAMILIES
    }


def _first(tests: dict[str, Column], values: dict[str, Column]) -> Column:
    (name, test), *rest = tests.items()
    chosen = F.when(test, values[name])
    for name, test in rest:
        chosen = chosen.when(test, values[name])
    return chosen


def choose_action(branch: DataFrame) -> DataFrame:
    """Best of nine names a method; the best ratio of that method's row names the action.

    Ties go to open cut, then spot, then liner.
    """
    best = F.greatest(*RATIO_NAMES)
    rows = {f: F.greatest(*[f"nbcr_{f}_{t}" for t in FAMILIES]) for f in FAMILIES}
    ranked = branch.withColumn("__best", best)
    ranked = ranked.withColumn("solution_nbcr", _first(_target_of(F.col("__best")), rows))
    names = {f: F.lit(ACTIONS[f]) for f in FAMILIES}
    return ranked.withColumn("solution", _first(_target_of(F.col("solution_nbcr")), names)).drop("__best")


def gate_few_spots(branch: DataFrame, seg: DataFrame, bad_score: float = 100.0) -> DataFrame:
    """One or two bad spots are repaired as spots; the pipe must have a note without deformation."""
    bad = (F.col("action") == P.ACTION_SPOT) | (F.col("def_tot") > bad_score)
    counts = seg.filter((F.col("cutno") > 0) & bad).groupBy("compkey").agg(F.count(F.lit(1)).alias("__n"))
    few = counts.filter(F.col("__n").between(1, 2))
    note = F.lower("problems")
    # Without a note both tests are unknown and the pipe is left as it is.
    hit = F.col("__few") & ~note.contains("oval") & ~note.contains("sagg")
    marked = _mark(branch, few, "__few").withColumn("__hit", F.coalesce(hit, F.lit(False)))
    return _overrule(marked, SPOT, NOTE_FEW_SPOTS)


def _overrule(marked: DataFrame, solution: str, note: str) -> DataFrame:
    noted = F.concat(F.coalesce("problems", F.lit("")), F.lit(note))
    return marked.withColumns({
        "solution": F.when(F.col("__hit"), solution).otherwise(F.col("solution")),
        "problems": F.when(F.col("__hit"), noted).otherwise(F.col("problems")),
    }).drop("__hit", "__few")


def gate_sandwich(branch: DataFrame, whole_pipes: DataFrame, min_grade: int = 4) -> DataFrame:
    """A bad pipe between two pipes to be dug is dug as well."""
    graded = whole_pipes.filter((F.col("cutno") == 0) & (F.col("grade_h5") >= min_grade)).select(
        "compkey", "usnode", "dsnode"
    ).join(branch.select("compkey", "solution"), "compkey")
    middle = graded.filter((F.col("solution") != OPEN_CUT) & (F.col("solution") != SANDWICH))
    between = sandwich(middle, graded.filter(F.col("solution") == OPEN_CUT))
    marked = _mark(branch, between, "__few").withColumn("__hit", F.coalesce("__few", F.lit(False)))
    return _overrule(marked, SANDWICH, NOTE_SANDWICH)


def problem_notes(
    branch: DataFrame, pipes: DataFrame, sanitary: DataFrame, storm: DataFrame, observations: DataFrame
) -> DataFrame:
    """Append notes on assets and inspections; a pipe without any note stays without.

    ``pipes`` holds whole pipes and segments with ``insp_curr``; a note applies if
    any of a pipe's rows has the flag.
    """
    known = sanitary.select("compkey").union(storm.select("compkey")).distinct().withColumn("__asset", F.lit(True))
    flags = pipes.groupBy("compkey").agg(
        F.max(flag(F.col("insp_curr") == P.INSPECTION_BEFORE_INSTALL)).alias("__replaced"),
        F.max(flag(F.col("insp_curr") == P.INSPECTION_NONE)).alias("__none"),
        F.max(flag(F.col("insp_curr") == P.INSPECTION_NO_INSTALL_DATE)).alias("__noinstall"),
    )
    lengths = pipes.filter(F.col("cutno") == 0).groupBy("compkey").agg(F.min("length").alias("__length"))
    reach = observations.groupBy("compkey").agg(
        F.max(flag(F.col("compdttm").isNull())).alias("__open"),
        F.max(F.greatest("distfrom", "distto")).alias("__far"),
    )
    joined = branch
    for part in (known, flags, lengths, reach):
        joined = joined.join(part, "compkey", "left")
    rules = [
        (F.col("__asset").isNull(), NOTE_NO_ASSET),
        (F.col("__replaced") == 1, NOTE_REPLACED),
        (F.col("__none") == 1, NOTE_NO_INSPECTION),
        (F.col("__noinstall") == 1, NOTE_NO_INSTALL),
        (F.col("__open") == 1, NOTE_INCOMPLETE),
        (F.col("__far") > F.col("__length"), NOTE_TOO_LONG),
    ]
    notes = [F.when(test, text).otherwise("") for test, text in rules]
    return joined.withColumn("problems", F.concat("problems", *notes)).drop(
        "__asset", "__replaced", "__none", "__noinstall", "__length", "__open", "__far"
    )


def maintained_pipes(sanitary: DataFrame, storm: DataFrame, storm_grades: DataFrame) -> DataFrame:
    """Pipes of a maintained type and status whose unit ids are well formed.

    Storm pipes also need the owner and an alternate grade id. ``storm_grades`` is
    (compkey, altidtyp).
    """

    def usable(asset: DataFrame, units: tuple[str, ...]) -> DataFrame:
        status = F.lower("servstat")
        return asset.filter(
            F.lower("unittype").isin(*units) & (status != P.STATUS_ABAN.lower())
            & (status != P.STATUS_TBAB.lower()) & is_unit_id("unitid") & is_unit_id("unitid2")
        )

    graded = storm_grades.filter((F.col("altidtyp") == P.ALTERNATE_GRADE) & (F.col("compkey") > 1))
    owned = usable(storm, P.MAINTAINED_UNITS_STORM).filter(F.col("own") == P.OWNER)
    owned = owned.join(graded.select("compkey").distinct(), "compkey", "left_semi")
    return usable(sanitary, P.MAINTAINED_UNITS_SANITARY).select("compkey").union(owned.select("compkey")).distinct()


def gate_maintained(branch: DataFrame, maintained: DataFrame) -> DataFrame:
    marked = _mark(branch, maintained, "__few").withColumn("__hit", F.col("__few").isNull())
    return _overrule(marked, NOT_MAINTAINED, NOTE_NOT_MAINTAINED)


def final_table(pipes: DataFrame) -> DataFrame:
    """Start of the final table: spots to repair before lining, summed on whole pipes."""
    marked = pipes.withColumn("spots_before_lining", flag(F.col("action") == P.ACTION_SPOT))
    sums = marked.filter(F.col("cutno") > 0).groupBy("compkey").agg(F.sum("spots_before_lining").alias("__spots"))
    joined = give_to(marked, sums, F.col("cutno") == 0, split=True)
    return joined.withColumn(
        "spots_before_lining", F.coalesce("__spots", F.col("spots_before_lining").cast("long"))
    ).drop("__spots")


def wide_costs(final: DataFrame, jobs: DataFrame) -> DataFrame:
    """Costs and times of the three job types side by side, and the price of each alone."""
    kinds = {"Spot": "spot", "Dig": "whole", "Line": "liner"}
    parts = {
        "cost": F.col("capitalnonmobilization"), "rate": F.col("capitalmobilizationrate"),
        "base_days": F.col("basetime") / 8.0, "mob_days": F.col("mobilizationtime") / 8.0,
    }
    aggs = [
        F.max(F.when(F.col("type") == kind, value)).alias(f"{name}_{part}")
        for kind, name in kinds.items() for part, value in parts.items()
    ]
    wide = final.join(jobs.groupBy("id").agg(*aggs), "id", "left")

    def alone(name: str) -> Column:
        days = F.col(f"{name}_base_days") + F.col(f"{name}_mob_days")
        return F.col(f"{name}_cost") + F.col(f"{name}_rate") * days

    return wide.withColumns({f"{name}_only": alone(name) for name in kinds.values()})


def _by_solution(values: dict[str, str]) -> Column:
    chosen = None
    for solution, column in values.items():
        test = F.lower("solution") == solution.lower()
        chosen = F.when(test, F.col(column)) if chosen is None else chosen.when(test, F.col(column))
    return chosen


def recommend(final: DataFrame, branch: DataFrame, as_of_year: int, horizon: int = FAIL_HORIZON, hot: HotKeys | None = None) -> DataFrame:
    """Failure action and recommended action with its ratios and benefit.

    Whole pipes of a bad grade that are owned, fail within the horizon and have
    spots take the chosen method; all others do nothing.
    """
    limit = as_of_year + horizon
    results = branch.select(
        "compkey", "solution", "solution_nbcr", "first_failure", "problems", "max_cof", *RATIO_NAMES,
        "bpw_oc", "bpw_sp", "bpw_cipp", "apw_sp", "apw_cipp", "apw_oc",
    )
    whole_years = final.filter(F.col("cutno") == 0).groupBy("compkey").agg(F.max("failure_year").alias("__whole_year"))
    # Segments need the pipe's year and notes, whole pipes the rest; one salted join brings both.
    per_pipe = results.join(whole_years, "compkey", "full")
    joined = attach(final.drop("problems", "max_cof"), per_pipe, "compkey", "left", hot)
    owned = F.col("remarks") == P.OWNER
    bad = F.col("grade_h5") > 3
    late = (F.col("cutno") > 0) & (F.col("__whole_year") > limit)
    cleared = bad & owned & (F.col("failure_year") <= limit)
    chosen = (
        bad & owned & (F.col("first_failure") <= limit) & (F.col("spot_count") > 0) & (F.col("cutno") == 0)
    )
    picked = {
        "recommended_nbcr": F.col("solution_nbcr"),
        "spot_nbcr": _by_solution({OPEN_CUT: "nbcr_oc_sp", SPOT: "nbcr_sp_sp", LINER: "nbcr_cipp_sp", NOT_LINABLE: "nbcr_oc_sp"}),
        "liner_nbcr": _by_solution({OPEN_CUT: "nbcr_oc_cipp", SPOT: "nbcr_sp_cipp", LINER: "nbcr_cipp_cipp"}),
        "whole_nbcr": _by_solution({
            SANDWICH: "nbcr_oc_oc", OPEN_CUT: "nbcr_oc_oc", SPOT: "nbcr_sp_oc", LINER: "nbcr_cipp_oc", NOT_LINABLE: "nbcr_oc_oc",
        }),
        "bpw": _by_solution({OPEN_CUT: "bpw_oc", SPOT: "bpw_sp", LINER: "bpw_cipp", NOT_LINABLE: "bpw_oc", SANDWICH: "bpw_oc"}),
        "apw_spot": F.col("apw_sp"), "apw_liner": F.col("apw_cipp"), "apw_whole": F.col("apw_oc"),
    }
    out = joined.withColumns({
        "failure_action": F.when(F.coalesce(cleared, F.lit(False)), None).when(late, DO_NOTHING_FIRST),
        "recommended": F.when(chosen, F.col("solution")).otherwise(F.lit(DO_NOTHING)),
        **{name: F.when(chosen, value) for name, value in picked.items()},
    })
    return out.select(*final.drop("problems", "max_cof").columns, "problems", "max_cof", "failure_action", "recommended", *picked)


def watch_list(final: DataFrame, pipes: DataFrame, as_of_year: int, horizon: int = FAIL_HORIZON, hot: HotKeys | None = None) -> DataFrame:
    """Mark pending pipes; bad pipes that are pending, or that fail late at a loss, are watched."""
    pending = pipes.filter(F.lower("hservstat") == P.STATUS_PEND.lower()).select("compkey").distinct()
    marked = attach(final, pending.withColumn("__pending", F.lit(True)), "compkey", "left", hot)
    action = F.when(
        F.col("__pending"), F.concat(F.coalesce("failure_action", F.lit("")), F.lit(PENDING))
    ).otherwise(F.col("failure_action"))
    out = marked.withColumn("failure_action", action).drop("__pending")
    loss = (F.col("recommended_nbcr") < 0) & (F.col("failure_year") > as_of_year + horizon)
    watched = (F.col("grade_h5") > 3) & (loss | F.lower("failure_action").contains(PENDING.lower()))
    return out.withColumn("recommended", F.when(watched, WATCH).otherwise(F.col("recommended")))


RESULT_COLUMNS = [
    "recommended", "recommended_nbcr", "spot_nbcr", "liner_nbcr", "whole_nbcr", "bpw", "apw_spot", "apw_liner", "apw_whole",
]


def propagate(final: DataFrame, hot: HotKeys | None = None) -> DataFrame:
    """Segments take the results of their whole pipe."""
    results = final.filter(F.col("cutno") == 0).select(
        "compkey", F.lit(True).alias("__hit"), *[F.col(c).alias(f"__{c}") for c in RESULT_COLUMNS]
    )
    joined = attach(final, results, "compkey", "left", hot)
    takes = (F.col("cutno") > 0) & F.coalesce("__hit", F.lit(False))
    values = {c: F.when(takes, F.col(f"__{c}")).otherwise(F.col(c)) for c in RESULT_COLUMNS}
    return joined.withColumns(values).select(*final.columns)


def restate_consequence(final: DataFrame, factor: float = 1.4, priced: DataFrame | None = None) -> DataFrame:
    """Consequence of whole pipes by the chosen action: emergency price plus the rest of the consequence.

    ``priced`` has the same segments with the same spot prices, where they are cheaper to read than from ``final``.
    """
    seg = (final if priced is None else priced).filter(F.col("cutno") > 0).groupBy("compkey").agg(
        F.sum(F.col("spot_only") * F.col("spot_count")).alias("__sum"), F.max("spot_only").alias("__max"),
        F.lit(True).alias("__seg"),
    )
    # Only whole pipes are joined: rows of segments, which are many and wide, aren't shuffled again.
    joined = give_to(final, seg, F.col("cutno") == 0, split=True)
    action = F.col("recommended")
    rest = F.col("max_cof")
    value = (
        F.when(action == LINER, F.col("liner_only") * factor + rest)
        .when(action.isin(OPEN_CUT, SANDWICH), F.col("whole_only") * factor + rest)
        .when((action == SPOT) & F.col("__seg"), F.col("__sum") * factor + rest)
        .when(((action != SPOT) | action.isNull()) & F.col("__seg"), F.col("__max") * factor + rest)
        .otherwise(F.col("cof"))
    )
    is_whole = F.col("cutno") == 0
    return joined.withColumn("cof", F.when(is_whole, value).otherwise(F.col("cof"))).select(*final.columns)


def view_costs(
    final: DataFrame, seg: DataFrame, jobs: DataFrame, as_of_year: int, rotation: int = 30
) -> DataFrame:
    """Cost of the recommended action per pipe: open cut, spot or liner."""
    pipes = final.filter(F.col("cutno") == 0)
    dug = pipes.filter(F.col("recommended").isin(OPEN_CUT, SANDWICH)).select(
        "compkey", F.col("whole_only").alias("cost"), "lateral_cost"
    )
    now = ((F.col("fail_yr_seg") <= as_of_year + rotation) & (F.col("def_tot") >= P.BAD_SCORE)) | (
        F.col("action") == P.ACTION_SPOT
    )
    bids = spot_jobs(seg, jobs).filter(now).groupBy("compkey").agg(job_cost_agg().alias("cost"))
    spots = pipes.filter(F.col("recommended") == SPOT).join(bids, "compkey").select("compkey", "cost", "lateral_cost")
    alone = {f"none_{part}": F.lit(0.0) for part in ("nonmob", "rate", "base", "mob")}
    lined = pipes.filter(F.col("recommended") == LINER).join(line_jobs(jobs), "compkey").withColumns(alone)
    liners = lined.select("compkey", combined_bid("none").alias("cost"), "lateral_cost")
    return dug.unionByName(spots).unionByName(liners)
