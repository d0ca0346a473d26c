"""Joins of positions and intervals along the same pipe.

Every join here has three equi keys: the pipe, a level and a position cell. Cells of level k are 2^k times as wide as
those of level 0. A range lies on the level whose cells are about its length, so it makes two or three rows there, however
long it is; the other side comes to that level only where its pipe has ranges on it. Cells split a pipe that owns a
large share of the rows over many tasks, and keep the number of compared pairs close to the number of results.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mainstay.operators.reach import may_match
from mainstay.operators.skew import HotKeys, attach, hot_keys

CELL_FEET = 50.0
# Positions beyond this lie in its cell; ranges that meet still do.
FARTHEST = 1e15
_CELL, _LEVEL = "__cell", "__level"


def closed(fm: Column, to: Column, a: Column, b: Column) -> Column:
    """Segment end in [a, b], or the segment covers [a, b]."""
    return ((fm >= a) & (fm <= b)) | ((to >= a) & (to <= b)) | ((fm <= a) & (to >= b))


def half_open(fm: Column, to: Column, a: Column, b: Column) -> Column:
    """As closed with the upper end left out; a point at the segment start counts."""
    return (
        ((fm >= a) & (fm < b)) | ((to >= a) & (to < b)) | ((fm <= a) & (to > b)) | ((fm == a) & (fm == b))
    )


def straddle(fm: Column, to: Column, a: Column, b: Column) -> Column:
    """Segment inside the interval, or across its start, or across its end."""
    return ((fm >= a) & (to <= b)) | ((fm <= a) & (to >= a)) | ((fm <= b) & (to >= b))


def mixed(fm: Column, to: Column, a: Column, b: Column) -> Column:
    """Closed at the segment start, open at its end, never a point."""
    return (((fm >= a) & (fm <= b)) | ((to > a) & (to < b)) | ((fm <= a) & (to > b))) & (a != b)


VARIANTS = {"closed": closed, "half_open": half_open, "straddle": straddle, "mixed": mixed}


def _place(position: Column) -> Column:
    return F.least(F.greatest(position, F.lit(-FARTHEST)), F.lit(FARTHEST))


def _level(low: Column, high: Column, cell: float) -> Column:
    """The lowest level whose cells are at least as wide as the range."""
    return F.ceil(F.log2(F.greatest(_place(high) - _place(low), F.lit(cell)) / cell)).cast("int")


def _bit(level: Column) -> Column:
    return F.call_function("shiftleft", F.lit(1).cast("long"), level)


def _levels_above(levels: Column, own: Column) -> Column:
    """The levels in a set of bits that are above one's own."""
    rest = F.call_function("shiftright", levels, own + 1)
    bits = F.sequence(F.lit(0), F.ceil(F.log2(rest.cast("double") + 1)).cast("int"))
    above = F.filter(bits, lambda k: F.call_function("shiftright", rest, k) % 2 == 1)
    return F.when(rest > 0, F.transform(above, lambda k: own + 1 + k)).otherwise(F.array().cast("array<int>"))


def _in_level_cells(df: DataFrame, low: Column, high: Column, own: Column, levels: Column, cell: float, prefix: str) -> DataFrame:
    """Rows once per cell of their own level and of the higher ``levels``; the first cell and the own level are kept."""
    spread = df.withColumns({f"__{prefix}level": own, "__low": _place(low), "__high": _place(high)}).withColumn(
        _LEVEL, F.explode(F.concat(F.array(f"__{prefix}level"), _levels_above(levels, F.col(f"__{prefix}level"))))
    )
    width = cell * F.pow(F.lit(2.0), F.col(_LEVEL))
    ends = {f"__{prefix}first": F.floor(F.col("__low") / width), "__last": F.floor(F.col("__high") / width)}
    cells = F.explode(F.sequence(f"__{prefix}first", "__last"))
    return spread.withColumns(ends).withColumn(_CELL, cells).drop("__low", "__high", "__last")


def pipe_extent(seg: DataFrame, key: str = "compkey", cell: float = CELL_FEET) -> DataFrame:
    """One row per pipe: first and last position that any of its segments reaches, and the levels they lie on."""
    low, high = F.least("fm", "to_"), F.greatest("fm", "to_")
    return seg.filter(low.isNotNull()).groupBy(key).agg(
        F.min(low).alias("__from"), F.max(high).alias("__to"), F.bit_or(_bit(_level(low, high, cell))).alias("__levels")
    )


def _join_levels(cells: DataFrame, spans: DataFrame, key: str) -> DataFrame:
    """Pairs that share a cell, each once: on the higher of their levels, in the first cell they share there.

    Both sides are plain shuffles, so Spark splits a crowded cell at run time.
    """
    level = F.col(_LEVEL) == F.greatest("__slevel", "__ilevel")
    first = F.col(_CELL) == F.greatest("__sfirst", "__ifirst")
    extra = [_LEVEL, _CELL, "__slevel", "__ilevel", "__sfirst", "__ifirst"]
    return spans.join(cells, [key, _LEVEL, _CELL]).filter(level & first).drop(*extra)


def overlap_join(
    seg: DataFrame,
    iv: DataFrame,
    variant: str = "closed",
    lo: str = "distfrom",
    hi: str = "distto",
    key: str = "compkey",
    cell: float = CELL_FEET,
    hot: HotKeys | None = None,
    few: bool = True,
) -> DataFrame:
    """Pairs of segment and interval on one pipe that overlap.

    All four variants imply that the closed ranges meet, so a pair shares at least
    one cell of the higher of their levels. The interval is first clipped to the extent
    of its pipe, so an overrun or a wrong far end does not lift it to a level where it would meet
    segments it doesn't reach; segments outside the extent of their pipe's intervals are left out.
    Segments of pipes without intervals are ruled out before the shuffle, unless ``few`` says that most pipes have some.
    ``hot`` names the pipes that own very many intervals and spreads that step; those that own very many segments are
    ``hot.other``, or else counted here.
    """
    test = VARIANTS[variant]
    low = F.greatest(F.least(lo, hi), F.col("__from"))
    high = F.least(F.greatest(lo, hi), F.col("__to"))
    # A missing end leaves a point: least() and greatest() skip NULL.
    known = iv.filter(F.coalesce(lo, hi).isNotNull())
    clipped = attach(known, pipe_extent(seg, key, cell), key, "inner", hot).filter(low <= high)
    own = _level(low, high, cell)
    spans = _in_level_cells(clipped, low, high, own, F.col("__levels"), cell, "i").drop("__from", "__to", "__levels")
    reach = clipped.groupBy(key).agg(F.min(low).alias("__ilow"), F.max(high).alias("__ihigh"), F.bit_or(_bit(own)).alias("__ilevels"))
    first, last = F.least("fm", "to_"), F.greatest("fm", "to_")
    crowded = hot and (hot.other or hot_keys(seg, [key]))
    asked = attach(may_match(seg, known, key) if few else seg, reach, key, "inner", crowded)
    met = asked.filter((first <= F.col("__ihigh")) & (last >= F.col("__ilow")))
    cells = _in_level_cells(met, first, last, _level(first, last, cell), F.col("__ilevels"), cell, "s")
    pairs = _join_levels(cells.drop("__ilow", "__ihigh", "__ilevels"), spans, key)
    return pairs.filter(test(F.col("fm"), F.col("to_"), F.col(lo), F.col(hi)))


def point_in_segment(
    seg: DataFrame, points: DataFrame, at: str = "distfrom", key: str = "compkey", cell: float = CELL_FEET,
) -> DataFrame:
    """Pairs of segment and point with fm <= point < to_. Segments of pipes without points are ruled out before the shuffle."""
    placed = points.filter(F.col(at).isNotNull())
    known = may_match(seg.filter(F.col("fm") < F.col("to_")), placed, key)
    located = placed.join(pipe_extent(known, key, cell), key)
    located = located.filter((F.col(at) >= F.col("__from")) & (F.col(at) < F.col("__to")))
    spots = _in_level_cells(located, F.col(at), F.col(at), F.lit(0), F.col("__levels"), cell, "i")
    none = F.lit(0).cast("long")
    cells = _in_level_cells(known, F.col("fm"), F.col("to_"), _level(F.col("fm"), F.col("to_"), cell), none, cell, "s")
    pairs = _join_levels(cells, spots.drop("__from", "__to", "__levels"), key)
    return pairs.filter((F.col("fm") <= F.col(at)) & (F.col(at) < F.col("to_")))


def clipped_length(length: Column | str = "length", lo: str = "distfrom", hi: str = "distto") -> Column:
    """Feet of a defect inside a segment, by the first rule that fits."""
    fm, to, a, b = F.col("fm"), F.col("to_"), F.col(lo), F.col(hi)
    length = F.col(length) if isinstance(length, str) else length
    return (
        F.when((fm >= a) & (to <= b), length)
        .when((fm < a) & (to > b), b - a)
        .when(to > b, b - fm)
        .when(fm < a, to - a)
        .otherwise(0.0)
    )
