"""Inspection selection, defect scores, inspection currency and remaining life."""

from __future__ import annotations

import datetime as dt
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mainstay import params as P
from mainstay.functions.scalar import same_text
from mainstay.operators.intervals import clipped_length, overlap_join, point_in_segment
from mainstay.operators.lookups import band_lookup
from mainstay.operators.reach import may_match
from mainstay.operators.skew import HotKeys, attach, hot_keys
from mainstay.operators.tables import rows_at_max

NEVER = -1


def whole(df: DataFrame) -> DataFrame:
    """Rows that stand for a whole pipe."""
    return df.filter(F.col("id") < P.FIRST_SEGMENT_ID)


def segments(df: DataFrame) -> DataFrame:
    """Rows that stand for one short piece of a pipe."""
    return df.filter(F.col("id") >= P.FIRST_SEGMENT_ID)


def as_of(df: DataFrame, when: dt.date | dt.datetime, column: str = "startdttm") -> DataFrame:
    """Rows that started on or before the given date."""
    return df.filter(F.col(column) <= F.lit(when))


def resolve_codes(lookup: DataFrame, description: str, key: str, wanted: list[str]) -> DataFrame:
    """Code keys whose description is in the list, compared without case."""
    names = [w.lower() for w in wanted]
    return lookup.filter(F.lower(description).isin(names)).select(key).distinct()


def with_service_status(df: DataFrame, sanitary: DataFrame, storm: DataFrame, hot: HotKeys | None = None) -> DataFrame:
    """Status from the asset tables: storm over sanitary over the row's own."""

    def one_per_pipe(asset: DataFrame, name: str) -> DataFrame:
        return asset.groupBy("compkey").agg(
            F.max("servstat").alias(name), F.lit(True).alias(f"{name}_hit")
        )

    joined = attach(df, one_per_pipe(sanitary, "__san"), "compkey", "left", hot)
    joined = attach(joined, one_per_pipe(storm, "__stm"), "compkey", "left", hot)
    status = (
        F.when(F.col("__stm_hit"), F.col("__stm"))
        .when(F.col("__san_hit"), F.col("__san"))
        .otherwise(F.col("hservstat"))
    )
    return joined.withColumn("hservstat", status).drop("__san", "__stm", "__san_hit", "__stm_hit")


def valid_inspections(
    asset: DataFrame,
    insp: DataFrame,
    obs: DataFrame,
    index_history: DataFrame,
    structural_codes: list,
    when: dt.date,
    subset: DataFrame | None = None,
    code: str = "obcode",
    hot: HotKeys | None = None,
    hot_inspections: HotKeys | None = None,
) -> DataFrame:
    """Observations of inspections that have an asset and a structural index, up to a date.

    The score is the rating of structural codes and 0 for all others.
    """
    dated = as_of(insp, when)
    if subset is not None:
        dated = dated.join(subset.select("compkey").distinct(), "compkey", "left_semi")
    known = attach(dated, asset, "compkey", "inner", hot)
    rated = known.join(index_history, "inspkey")
    score = F.when(F.col(code).isin(structural_codes), F.col("obrating").cast("double")).otherwise(0.0)
    return attach(obs, rated, "inspkey", "inner", hot_inspections).withColumn("newscore", score)


def latest_observations(*sources: DataFrame) -> DataFrame:
    """Observations of each pipe's latest inspection, per source, then united.

    Hot pipes are found among the observations themselves: a pipe with few inspections may hold most of them.
    """
    latest = [rows_at_max(s, ["compkey"], "startdttm", hot_keys(s, ["compkey"])) for s in sources]
    return reduce(DataFrame.unionByName, latest)


def observations_of_latest(
    insp: DataFrame, obs: DataFrame, hot: HotKeys | None = None, hot_inspections: HotKeys | None = None
) -> DataFrame:
    """Observations joined to the latest inspections only; older ones never reach the join."""
    latest = rows_at_max(insp, ["compkey"], "startdttm", hot)
    return attach(obs, latest, "inspkey", "inner", hot_inspections)


def scored_places(obs: DataFrame, peak: DataFrame) -> DataFrame:
    """Peak scores added up per pipe and place.

    A score counts in proportion to its peak, so copies of a defect can be added
    before any join with segments.
    """
    return (
        obs.join(peak, "obsevkey")
        .groupBy("compkey", "distfrom", "distto")
        .agg(F.sum("peak_score").alias("peak_score"))
    )


def point_defect_scores(seg: DataFrame, obs: DataFrame, peak: DataFrame, hot: HotKeys | None = None) -> DataFrame:
    """Sum of peak scores of the point defects in each segment.

    The last segment of a pipe also takes every defect at or beyond its start.
    """
    places = scored_places(obs, peak)
    is_last = F.coalesce(F.col("cutno") == F.col("seg_count"), F.lit(False))
    keys = ["id", "compkey", "cutno", "fm", "to_", "seg_count"]
    narrow = seg.select(*keys)
    point = F.col("distto").isNull() | (F.col("distto") == 0) | (F.col("distto") == F.col("distfrom"))
    inner = point_in_segment(narrow.filter(~is_last), places.filter(point))
    last = may_match(narrow.filter(is_last), places, "compkey")
    overrun = attach(places, last, "compkey", "inner", hot).filter(F.col("distfrom") >= F.col("fm"))
    cols = ["id", "compkey", "cutno", "peak_score"]
    both = inner.select(*cols).unionByName(overrun.select(*cols))
    return both.groupBy("id", "compkey", "cutno").agg(
        F.coalesce(F.sum("peak_score"), F.lit(0.0)).alias("point_score")
    )


def linear_defect_scores(seg: DataFrame, obs: DataFrame, peak: DataFrame, hot: HotKeys | None = None) -> DataFrame:
    """Overlap length times peak score, added per segment."""
    narrow = seg.select("id", "compkey", "cutno", "fm", "to_", "length")
    pairs = overlap_join(narrow, scored_places(obs, peak), "closed", hot=hot)
    return pairs.groupBy("id", "compkey", "cutno").agg(
        F.sum(clipped_length() * F.col("peak_score")).alias("linear_score")
    )


def apply_scores(seg: DataFrame, points: DataFrame, lines: DataFrame) -> DataFrame:
    """Segments with point, linear and total score; 0 where no defect was found."""
    joined = seg.join(points.select("id", "point_score"), "id", "left").join(
        lines.select("id", "linear_score"), "id", "left"
    )
    return _totals(joined)


def apply_scores_whole(whole_pipes: DataFrame, points: DataFrame, lines: DataFrame) -> DataFrame:
    """Whole pipes with the sums over their segments."""
    parts = points.select("compkey", "point_score", F.lit(None).cast("double").alias("linear_score")).unionByName(
        lines.select("compkey", F.lit(None).cast("double").alias("point_score"), "linear_score")
    )
    sums = parts.groupBy("compkey").agg(
        F.sum("point_score").alias("point_score"), F.sum("linear_score").alias("linear_score")
    )
    return _totals(whole_pipes.join(sums, "compkey", "left"))


def _totals(df: DataFrame) -> DataFrame:
    return (
        df.withColumn("point_score", F.coalesce("point_score", F.lit(0.0)))
        .withColumn("linear_score", F.coalesce("linear_score", F.lit(0.0)))
        .withColumn("total_score", F.col("point_score") + F.col("linear_score"))
    )


def inspection_recency(
    pipes: DataFrame, latest: DataFrame, report_year: int, hot: HotKeys | None = None
) -> DataFrame:
    """Last inspection date, years since then and rating (the largest when several match)."""
    one = latest.groupBy("compkey").agg(
        F.max("startdttm").alias("last_inspection"), F.max("rating").alias("rating")
    )
    joined = attach(pipes, one, "compkey", "left", hot)
    return joined.withColumn("years_since", F.lit(report_year) - F.year("last_inspection"))


def inspection_flag(df: DataFrame) -> DataFrame:
    """Currency of the inspection: 4 none, 3 older than the pipe, 2 no install date on a retired pipe, 1 current."""
    last, built, status = F.col("last_inspection"), F.col("instdate"), F.col("hservstat")
    retired = same_text(status, P.STATUS_TBAB) | same_text(status, P.STATUS_ABAN)
    old = F.col("insp_curr") if "insp_curr" in df.columns else F.lit(None).cast("int")
    rule = (
        F.when(last.isNull(), P.INSPECTION_NONE)
        .when(built > last, P.INSPECTION_BEFORE_INSTALL)
        .when(built.isNull() & retired, P.INSPECTION_NO_INSTALL_DATE)
        .when((last >= built) | built.isNull() | same_text(status, P.STATUS_PEND), P.INSPECTION_CURRENT)
        .otherwise(old)
    )
    return df.withColumn("insp_curr", rule)


def clear_stale_rating(df: DataFrame) -> DataFrame:
    """A pipe without inspection has rating 0."""
    return df.withColumn("rating", F.when(F.col("insp_curr") == P.INSPECTION_NONE, 0).otherwise(F.col("rating")))


def whole_takes_segment_flags(whole_pipes: DataFrame, seg: DataFrame) -> DataFrame:
    """Whole pipes take currency flag and rating of their segments."""
    one = seg.groupBy("compkey").agg(
        F.max("insp_curr").alias("insp_curr"), F.max("rating").alias("rating")
    )
    return whole_pipes.drop("insp_curr", "rating").join(one, "compkey", "left")


def remaining_years(
    seg: DataFrame, crosswalk: DataFrame, bands: DataFrame, score: str = "total_score", keep: bool = False
) -> DataFrame:
    """Whole years to failure by score band and material curve; segments without a band drop out, or stay with ``keep``."""
    found = band_lookup(seg, score, "material", bands, crosswalk, keep=keep)
    return found.withColumn("years", F.col("yearstofailure").cast("int")).drop("yearstofailure")


def _usable() -> Column:
    return F.col("insp_curr").isin(P.INSPECTION_CURRENT, P.INSPECTION_NO_INSTALL_DATE)


def failure_year(seg: DataFrame, rules: P.LifeRules = P.LifeRules()) -> DataFrame:
    """Expected failure year and its standard deviation, for usable inspections only."""
    spread = F.greatest(
        F.lit(rules.sd_floor), rules.sd_years * F.col("years") + rules.sd_age * F.col("years_since")
    )
    return seg.withColumn(
        "failure_year", F.when(_usable(), F.year("last_inspection") + F.col("years"))
    ).withColumn("std_dev", F.when(_usable() & F.col("years").isNotNull(), spread))
