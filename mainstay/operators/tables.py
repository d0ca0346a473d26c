"""Reusable table operators: latest rows, updates from joins, added layers, bids."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mainstay.functions.scalar import col
from mainstay.operators.skew import HotKeys, attach

HOURS_PER_DAY = 8.0


def rows_at_max(
    df: DataFrame, keys: list[str], order: str, hot: HotKeys | None = None, keep_unknown: bool = False
) -> DataFrame:
    """All rows that hold the largest ``order`` of their key; ties are kept.

    The maximum is combined before the shuffle and joined back, so no task sorts all
    rows of one key. With ``keep_unknown`` a key whose values are all NULL keeps its rows.
    """
    best = df.groupBy(*keys).agg(F.max(order).alias("__best"))
    joined = attach(df, best, keys, "inner", hot)
    test = F.col(order).eqNullSafe(F.col("__best")) if keep_unknown else F.col(order) == F.col("__best")
    return joined.filter(test).drop("__best")


def latest_inspections(insp: DataFrame, hot: HotKeys | None = None) -> DataFrame:
    """Inspections of the latest completion date per pipe; unknown dates come last, ties stay."""
    return rows_at_max(insp, ["compkey"], "compdttm", hot, keep_unknown=True)


def with_updates(
    df: DataFrame, updates: DataFrame, keys: list[str], columns: dict[str, str], hot: HotKeys | None = None
) -> DataFrame:
    """Overwrite ``columns`` (target: source) where a key matches; other rows keep their value.

    Several matches are reduced to the largest source value, so the result does not
    depend on the order of rows.
    """
    picked = updates.groupBy(*keys).agg(*[F.max(s).alias(f"__new_{t}") for t, s in columns.items()])
    picked = picked.withColumn("__matched", F.lit(True))
    joined = attach(df, picked, keys, "left", hot)
    for target in columns:
        old = F.col(target) if target in df.columns else F.lit(None)
        joined = joined.withColumn(target, F.when(F.col("__matched"), F.col(f"__new_{target}")).otherwise(old))
    return joined.drop("__matched", *[f"__new_{t}" for t in columns])


def accumulate_layers(
    base: DataFrame, layers: list[DataFrame], key: str = "id", amount: str = "consequence", into: str = "cost"
) -> DataFrame:
    """Add the amounts of all layers to ``base``: one union, one sum, one join.

    A row in no layer keeps NULL. Amounts are summed before the join, so a layer
    that repeats a key adds each of its amounts.
    """
    parts = [layer.select(key, F.col(amount).cast("double").alias("__amount")) for layer in layers]
    sums = reduce(DataFrame.unionByName, parts).groupBy(key).agg(F.sum("__amount").alias("__sum"))
    joined = base.join(sums, key, "left")
    if into not in base.columns:
        return joined.withColumnRenamed("__sum", into)
    added = F.when(F.col("__sum").isNull(), F.col(into)).otherwise(F.coalesce(into, F.lit(0.0)) + F.col("__sum"))
    return joined.withColumn(into, added).drop("__sum")


def masked(marker: Column | str, value: Column | str) -> Column:
    """The value where the marker is known, else 0; an unknown value stays unknown."""
    return F.when(col(marker).isNotNull(), col(value)).otherwise(col(value) * 0.0)


def masked_sum(marker: Column | str, value: Column | str) -> Column:
    return F.sum(masked(marker, value))


def masked_max(marker: Column | str, value: Column | str) -> Column:
    return F.max(masked(marker, value))


def bid_from(nonmob: Column, rate: Column, base: Column, mob: Column) -> Column:
    """Fixed cost plus the daily rate over all hours worked."""
    return nonmob + rate * (base + mob) / HOURS_PER_DAY


def job_cost_agg() -> Column:
    """One bid for a group of jobs: costs and base hours add up, the dearest rate and setup count once."""
    return bid_from(
        F.sum("capitalnonmobilization"), F.max("capitalmobilizationrate"), F.sum("basetime"), F.max("mobilizationtime")
    )


def sandwich(middle: DataFrame, ends: DataFrame) -> DataFrame:
    """Rows of ``middle`` with one of ``ends`` upstream and another downstream.

    Only node keys of ``ends`` travel, one row per node, and each join keeps or
    drops a row without multiplying it.
    """
    above = ends.select(F.col("dsnode").alias("usnode")).distinct()
    below = ends.select(F.col("usnode").alias("dsnode")).distinct()
    return middle.join(above, "usnode", "left_semi").join(below, "dsnode", "left_semi")


def give_to(
    df: DataFrame, values: DataFrame, takers: Column, key: str = "compkey", own: str = "id", split: bool = False
) -> DataFrame:
    """Join per-pipe ``values`` to the few rows of each pipe that take them.

    All other rows match nothing, whatever the keys are: a second key, their own id for
    them and 0 for takers, spreads them evenly, so a pipe with very many segments is
    not gathered in one task. ``split`` is for a ``df`` that is cheap to read twice: the takers alone are joined, and all
    other rows aren't shuffled.
    """
    taking = F.coalesce(takers, F.lit(False))
    if split:
        given = {f.name: f.dataType for f in values.schema.fields if f.name != key}
        joined = df.filter(taking).join(values, key, "left").select(*df.columns, *given)
        return joined.unionByName(df.filter(~taking).withColumns({n: F.lit(None).cast(t) for n, t in given.items()}))
    right = values.withColumnRenamed(key, "__key").withColumns({"__taker": F.lit(True), "__spread": F.lit(0).cast("long")})
    left = df.withColumns({
        "__key": F.col(key), "__taker": taking, "__spread": F.when(taking, 0).otherwise(F.col(own)).cast("long"),
    })
    return left.join(right, ["__key", "__taker", "__spread"], "left").drop("__key", "__taker", "__spread")


_CARRIED = "__carried"


def carried(df: DataFrame, used: list[str]) -> DataFrame:
    """The ``used`` columns, and all others as one: joins of wide rows then copy one value for all that they don't read."""
    rest = [c for c in df.columns if c not in used]
    return df.select(*[c for c in df.columns if c in used], F.struct(*rest).alias(_CARRIED))


def unpacked(df: DataFrame, columns: list[str]) -> DataFrame:
    """The ``columns`` of rows that went through ``carried``, in this order."""
    return df.select(*[F.col(c) if c in df.columns else F.col(_CARRIED)[c].alias(c) for c in columns])


def copy_whole_to_segments(
    seg: DataFrame, whole: DataFrame, columns: list[str], hot: HotKeys | None = None
) -> DataFrame:
    """Segments take the named columns of their whole pipe; without one they keep their own."""
    return with_updates(seg, whole, ["compkey"], {c: c for c in columns}, hot)


def copy_segments_to_whole(whole: DataFrame, seg: DataFrame, how: dict[str, Column]) -> DataFrame:
    """Whole pipes take aggregates of their segments; a pipe without segments keeps its own."""
    sums = seg.groupBy("compkey").agg(*[c.alias(f"__{n}") for n, c in how.items()]).withColumn("__hit", F.lit(True))
    joined = whole.join(sums, "compkey", "left")
    for name in how:
        old = F.col(name) if name in whole.columns else F.lit(None)
        joined = joined.withColumn(name, F.when(F.col("__hit"), F.col(f"__{name}")).otherwise(old))
    return joined.drop("__hit", *[f"__{n}" for n in how])


def shares_node(us: Column, ds: Column, other_us: Column, other_ds: Column) -> Column:
    """True where two lines meet in a node, compared without case and outer blanks."""

    def same(a: Column, b: Column) -> Column:
        return F.coalesce(F.lower(F.trim(a)) == F.lower(F.trim(b)), F.lit(False))

    return same(us, other_us) | same(ds, other_ds) | same(us, other_ds) | same(ds, other_us)
