"""Material of segments from the history of material intervals."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mainstay import params as P
from mainstay.functions.scalar import same_text
from mainstay.operators.intervals import overlap_join
from mainstay.operators.skew import HotKeys, attach
from mainstay.operators.tables import rows_at_max


def varies_segments(seg: DataFrame) -> DataFrame:
    return seg.filter(same_text("material", P.MATERIAL_VARIES))


def material_changes(chg: DataFrame) -> DataFrame:
    return chg.filter(same_text("chtype", P.MATERIAL_CHANGE))


def _touching(seg: DataFrame, chg: DataFrame, hot: HotKeys | None) -> DataFrame:
    narrow = varies_segments(seg).select("id", "compkey", "fm", "to_")
    spans = chg.select("compkey", "chdetail", "distfrom", "distto")
    pairs = overlap_join(narrow, spans, "straddle", hot=hot, few=False)
    return pairs.select("id", "compkey", "fm", "distfrom", "to_", "distto", "chdetail")


def segments_with_material(
    seg: DataFrame, chg: DataFrame, material: str = P.MATERIAL_VSP, hot: HotKeys | None = None
) -> DataFrame:
    """Unknown-material segments that touch an interval of the given material."""
    return _touching(seg, material_changes(chg).filter(same_text("chdetail", material)), hot)


def patch_segments(
    seg: DataFrame, chg: DataFrame, material: str = P.MATERIAL_VSP, hot: HotKeys | None = None
) -> DataFrame:
    """Other-material intervals touched on pipes that hold the given material."""
    pipes = segments_with_material(seg, chg, material, hot).select("compkey").distinct()
    others = material_changes(chg).filter(~same_text("chdetail", material))
    return _touching(seg, attach(others, pipes, "compkey", "left_semi", hot), hot)


def pipes_without_material(
    seg: DataFrame, chg: DataFrame, material: str = P.MATERIAL_VSP, hot: HotKeys | None = None
) -> DataFrame:
    """Pipes with unknown-material segments of which none touches the given material."""
    pipes = segments_with_material(seg, chg, material, hot).select("compkey").distinct()
    return varies_segments(seg).select("compkey").distinct().join(pipes, "compkey", "left_anti")


def other_material_segments(
    seg: DataFrame, chg: DataFrame, material: str = P.MATERIAL_VSP, hot: HotKeys | None = None
) -> DataFrame:
    """Segments of such pipes with the material intervals they touch."""
    rest = pipes_without_material(seg, chg, material, hot)
    return _touching(seg, attach(material_changes(chg), rest, "compkey", "left_semi", hot), hot)


def dominant_material(chg: DataFrame) -> DataFrame:
    """Material with the largest total length per pipe; equal totals give several rows."""
    sums = (
        material_changes(chg)
        .groupBy("compkey", "chdetail")
        .agg(F.sum(F.abs(F.col("distto") - F.col("distfrom"))).alias("total_length"))
    )
    # One row per pipe and material: a pipe has few, so none is hot.
    return rows_at_max(sums, ["compkey"], "total_length")


def _stamp(prefix: str, detail: str) -> Column:
    # The prefix is removed wherever it stands and in any case of letters.
    return F.concat(F.lit(prefix), F.regexp_replace(detail, f"(?i){P.MATERIAL_PREFIX}", ""))


def stamp_material(
    seg: DataFrame, chg: DataFrame, material: str = P.MATERIAL_VSP, keep_original: bool = False,
    hot: HotKeys | None = None,
) -> DataFrame:
    """Write the found material on unknown-material segments.

    In order: replaced material on pipes that hold ``material``; the dominant
    material of the pipe; any other material where still unknown. With several
    matches the first name in alphabetical order wins. By default the stamp of the
    original material does not survive, because the working copy is taken before
    it; ``keep_original`` lets it stand where nothing else matched.
    """
    base = segments_with_material(seg, chg, material, hot)
    spans = material_changes(chg)
    touching = _touching(seg, spans, hot)
    # One overlap join serves all rules: each touched interval is sorted into its rule.
    held = base.select("compkey").distinct().withColumn("__held", F.lit(True))
    main = dominant_material(chg).select("compkey", "chdetail").withColumn("__main", F.lit(True))
    sorted_rows = attach(touching, held, "compkey", "left", hot)
    sorted_rows = attach(sorted_rows, main, ["compkey", "chdetail"], "left")
    is_base = same_text("chdetail", material)
    is_held = F.coalesce(F.col("__held"), F.lit(False))
    patch = F.min(F.when(is_held & ~is_base, F.col("chdetail")))
    dominant = F.min(F.when(~is_held & F.col("__main"), F.col("chdetail")))
    other = F.min(F.when(~is_held, F.col("chdetail")))
    found = sorted_rows.groupBy("id").agg(
        patch.alias("__patch"), dominant.alias("__dominant"), other.alias("__other"),
        F.max(is_base).alias("__base"),
    )
    joined = seg.join(found, "id", "left")
    original = F.when(F.col("__base"), F.lit(P.STAMP_ORIGINAL_VSP)) if keep_original else F.lit(None)
    stamped = F.coalesce(
        _stamp(P.STAMP_REPLACED, "__patch"), _stamp(P.STAMP_ORIGINAL, "__dominant"),
        _stamp(P.STAMP_REPLACED, "__other"), original, F.col("material"),
    )
    is_varies = same_text("material", P.MATERIAL_VARIES)
    return joined.withColumn("material", F.when(is_varies, stamped).otherwise(F.col("material"))).drop(
        "__patch", "__dominant", "__other", "__base"
    )
