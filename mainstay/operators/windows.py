"""Failure windows of segments and the hours of the work they call for."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mainstay import params as P
from mainstay.functions.scalar import flag, total, zero
from mainstay.operators.skew import HotKeys, attach
from mainstay.operators.tables import give_to, masked_max, masked_sum

NOW, SMALL, LATER, RETURN = "A", "small", "B", "returns"


def _windows(rows: DataFrame, start: Column, span: P.Windows) -> DataFrame:
    """One row per segment and window it belongs to, from a single pass over the segments."""
    fail, score = F.col("fail_yr_seg"), F.col("def_tot")
    soon = (fail > 0) & (fail <= start + span.spot_years)
    bad = score >= P.BAD_SCORE

    def entry(test: Column, name: str, year: Column) -> Column:
        return F.when(test, F.struct(F.lit(name).alias("window"), year.cast("int").alias("year")))

    entries = F.array(
        entry(soon & bad, NOW, fail),
        entry(soon & (score < P.BAD_SCORE), SMALL, start + span.spot_years + 1),
        entry((fail > 0) & (fail > start + span.spot_years) & (fail <= start + 2 * span.spot_years), LATER, fail),
        entry(soon & bad, RETURN, start + span.line_years),
    )
    found = rows.filter(F.col("cutno") > 0).withColumn("__w", F.explode(F.array_compact(entries)))
    return found.select("compkey", "cutno", "__w.window", "__w.year")


def windows_proactive(seg: DataFrame, as_of_year: int, span: P.Windows = P.Windows()) -> DataFrame:
    """Windows counted from this year."""
    return _windows(seg, F.lit(as_of_year), span)


def first_failure(seg: DataFrame, as_of_year: int, span: P.Windows = P.Windows()) -> DataFrame:
    """First year a bad segment of the pipe fails, for pipes where that is soon."""
    fail = F.col("fail_yr_seg")
    soon = (fail > 0) & (fail <= as_of_year + span.spot_years) & (F.col("def_tot") >= P.BAD_SCORE)
    return seg.filter((F.col("cutno") > 0) & soon).groupBy("compkey").agg(F.min("fail_yr_seg").alias("start_year"))


def windows_reactive(
    seg: DataFrame, as_of_year: int, span: P.Windows = P.Windows(), hot: HotKeys | None = None
) -> DataFrame:
    """Windows counted from each pipe's own first failure year."""
    starts = first_failure(seg, as_of_year, span)
    narrow = seg.select("compkey", "cutno", "fail_yr_seg", "def_tot")
    return _windows(attach(narrow, starts, "compkey", "inner", hot), F.col("start_year"), span)


def _after(windows: DataFrame) -> DataFrame:
    return windows.filter(F.col("window") != NOW)


def window_totals(windows: DataFrame) -> DataFrame:
    """Segments in window A, and all later rows less those of A, per pipe with a window A."""
    counts = windows.groupBy("compkey").agg(
        F.sum(flag(F.col("window") == NOW)).alias("window_a"),
        F.sum(flag(F.col("window") != NOW)).alias("__later"),
    )
    return counts.filter((F.col("window_a") > 0) & (F.col("__later") > 0)).select(
        "compkey", "window_a", (F.col("__later") - F.col("window_a")).alias("window_b")
    )


def action_years(windows: DataFrame, span: P.Windows = P.Windows(), hot: HotKeys | None = None) -> DataFrame:
    """Line in the first later year of the pipe, replace one liner life after."""
    later = _after(windows)
    first = later.groupBy("compkey").agg(F.min("year").alias("line_at_year"))
    joined = attach(later, first, "compkey", "inner", hot)
    return joined.select(
        "compkey", "cutno", F.col("year").alias("window_b_year"), "line_at_year",
        (F.col("line_at_year") + span.liner_life).alias("replace_at_year"),
    )


def line_at_year(
    windows: DataFrame, as_of_year: int | None, span: P.Windows = P.Windows(), hot: HotKeys | None = None
) -> DataFrame:
    """Rows of windows A and B on pipes with a window A, with the year to line.

    Proactive: this year + 40 or the first failure in window B. Reactive
    (``as_of_year`` None): 40 years after the first failure in window A, or the same.
    """
    now = F.col("window") == NOW
    base = F.lit(as_of_year) if as_of_year is not None else F.col("year")
    candidate = F.when(now, base + span.line_years).otherwise(F.col("year"))
    used = windows.filter(F.col("window").isin(NOW, LATER))
    years = used.groupBy("compkey").agg(
        F.min(candidate).alias("line_at_year"), F.max(now).alias("__has_a")
    ).filter("__has_a").drop("__has_a")
    joined = attach(used, years, "compkey", "inner", hot)
    return joined.select(
        "compkey", "cutno", F.when(now, F.col("year")).alias("window_a_year"),
        F.when(~now, F.col("year")).alias("window_b_year"), "line_at_year",
    )


def window_spot_durations(years: DataFrame, durations: DataFrame) -> DataFrame:
    """Spot hours added up and the longest setup, per pipe and window."""
    hours = durations.select("compkey", "cutno", "spot", "traffic", "bypass")
    joined = years.join(hours, ["compkey", "cutno"])
    parts = []
    for name in ("a", "b"):
        marker = f"window_{name}_year"
        parts += [
            masked_sum(marker, "spot").alias(f"spot_{name}"),
            masked_max(marker, "traffic").alias(f"traffic_{name}"),
            masked_max(marker, "bypass").alias(f"bypass_{name}"),
        ]
    return joined.groupBy("compkey").agg(*parts)


def crosses_arterial(whole_xp: DataFrame) -> DataFrame:
    crosses = F.col("countxart").isNotNull() | F.col("countxmjart").isNotNull()
    count = zero("countxart") + zero("countxmjart")
    return whole_xp.groupBy("compkey").agg(F.max(flag(crosses & (count > 0))).alias("arterial"))


def job_times(jobs: DataFrame, durations: DataFrame, whole_xp: DataFrame) -> DataFrame:
    """Base and setup hours of every job by its type."""
    parts = durations.select("id", job_hours(), F.lit(True).alias("__known"))
    # Only liner jobs need the crossing flag: one row per pipe.
    joined = give_to(jobs.join(parts, "id", "left"), crosses_arterial(whole_xp), F.col("type") == "Line")
    return own_times(joined, F.col("__known")).select(*jobs.columns, "basetime", "mobilizationtime")


def job_hours() -> Column:
    """The hours that base and setup time of a job are made of."""
    return F.struct(
        "spot", "cipp", "open_cut", "bore_jack", "bore_pit", "traffic", "bypass", "lateral_bypass"
    ).alias("job_hours")


def own_times(jobs: DataFrame, known: Column | None = None) -> DataFrame:
    """The same for jobs that bring the hours of their row as ``job_hours``, and liner jobs the flag ``arterial``."""
    known = F.lit(True) if known is None else known
    joined = jobs.select("*", "job_hours.*")
    kind, setup = F.col("type"), total("traffic", "bypass")
    digging = F.when(F.col("open_cut").isNull(), 0.0).otherwise(zero("lateral_bypass"))
    base = (
        F.when(kind == "Spot", F.col("spot")).when(kind == "Line", F.col("cipp"))
        .when(kind == "Dig", F.coalesce("open_cut", "bore_jack") + zero("bore_pit"))
    )
    mob = (
        F.when(kind == "Spot", setup)
        .when(kind == "Line", zero("arterial") * F.col("lateral_bypass") + setup)
        .when(kind == "Dig", setup + digging)
    )
    return joined.select(
        *[c for c in jobs.columns if c not in ("job_hours", "arterial")], F.when(known, base).alias("basetime"),
        F.when(known, mob).alias("mobilizationtime"),
    )


def final_times(
    windows: DataFrame, years: DataFrame, durations: DataFrame, whole_xp: DataFrame
) -> DataFrame:
    """Hours of spots in window A, liner with the spots of A or B, and the whole pipe."""
    spots = window_spot_durations(years, durations)
    valid = window_totals(windows).select("compkey")
    pipes = durations.filter(F.col("cutno") == 0).join(valid, "compkey", "left_semi")
    joined = pipes.join(spots, "compkey").join(crosses_arterial(whole_xp), "compkey", "left")

    def larger(own: str, window: str) -> Column:
        # Without a comparison the window's value stands, known or not.
        return F.when(F.col(own) > F.col(window), F.col(own)).otherwise(F.col(window))

    def lined(name: str) -> Column:
        laterals = F.col("lateral_bypass") * zero("arterial")
        return (
            total("cipp", f"spot_{name}") + zero(larger("traffic", f"traffic_{name}"))
            + zero(larger("bypass", f"bypass_{name}")) + zero(laterals)
        )

    digging = F.when(F.col("open_cut").isNull(), 0.0).otherwise(zero("lateral_bypass"))
    whole_time = (
        F.coalesce("open_cut", "bore_jack") + total("manhole", "traffic", "bypass", "bore_pit") + digging
    )
    return joined.select(
        "compkey", total("spot_a", "traffic_a", "bypass_a").alias("spot_time_a"), lined("b").alias("line_time_b"),
        whole_time.alias("whole_time"), lined("a").alias("line_time_a"),
    )
