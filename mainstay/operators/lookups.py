"""Lookups in rate, band and size tables.

A rate table is read as one ordered array, a scalar of the plan, by every task and searched by halves: a lookup reads as
many entries as the table's size has binary digits. The large side is never shuffled or joined, so a material or size
that covers a third of the rows costs nothing extra. Tables are rate tables: their size follows from the price list,
not from the data.

A run that looks up many times may read its tables first (``known``): a short table then becomes a tree of comparisons, which
is compiled with the rest of the formula; a long one stays an array.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from mainstay.functions.scalar import col

# Tables up to so many rows become trees, and so many leaves a tree has at most.
KNOWN_ROWS = 64
KNOWN_LEAVES = 512


@dataclass(frozen=True)
class Known:
    """A short rate table whose rows the driver has read, and the table itself."""

    table: DataFrame
    schema: StructType
    rows: tuple[Row, ...]

    @property
    def columns(self) -> list[str]:
        return self.schema.names

    def literal(self, value: object, name: str) -> Column:
        return F.lit(value).cast(self.schema[name].dataType)


def known(table: DataFrame) -> DataFrame | Known:
    """The table with its rows, read now; a table too long for a tree as it is."""
    rows = table.limit(KNOWN_ROWS + 1).collect()
    return table if len(rows) > KNOWN_ROWS else Known(table, table.schema, tuple(rows))


def _rising(table: Known, order: Sequence[str]) -> list[Row] | None:
    """The rows in the order of ``pack``, without those that lack a bound; None where a value has no place in Python's order."""
    fields = list(order) + [c for c in table.columns if c not in order]
    rows = [r for r in table.rows if all(r[n] is not None for n in order)]
    if any(v != v for r in rows for v in r if v is not None):
        return None
    return sorted(rows, key=lambda r: [(r[n] is not None, r[n]) if r[n] is not None else (False,) for n in fields])


def _branch(low: int, high: int, holds: Callable[[int], Column], pick: Callable[[int], Column]) -> Column:
    """``pick(n)``, where the first n of the bounds between ``low`` and ``high`` hold, as a tree of comparisons."""
    if low == high:
        return pick(low)
    middle = (low + high) // 2
    return F.when(holds(middle), _branch(middle + 1, high, holds, pick)).otherwise(_branch(low, middle, holds, pick))


_TABLE = "__table"


def _steps(rows: Column) -> Column:
    """The powers of two by which a search in ``rows`` advances, falling."""
    digits = F.ceil(F.log2(F.size(rows) + F.lit(1))).cast("int")
    return F.transform(F.sequence(digits - 1, F.lit(0), F.lit(-1)), lambda k: F.pow(F.lit(2), k).cast("int"))


def _packed(rows: Column, bound: str) -> Column:
    keys = F.transform(rows, lambda r: r[bound])
    return F.when(F.size(rows) > 0, F.struct(rows.alias("rows"), keys.alias("keys"), _steps(rows).alias("steps")))


def pack(table: DataFrame, order: Sequence[str]) -> Column:
    """The table as a scalar: its rows in rising order, their first bounds, and the steps of a search. Rows that lack a bound
    fit no value and are left out; an empty table is NULL."""
    fields = list(order) + [c for c in table.columns if c not in order]
    rows = table.dropna(subset=list(order)).agg(F.sort_array(F.collect_list(F.struct(*fields))).alias("rows"))
    return rows.select(_packed(F.col("rows"), order[0])).scalar()


def search(packed: Column, holds: Callable[[Column], Column], pick: Callable[[Column, Column], Column]) -> Column:
    """``pick(rows, n)``, where the first bounds of the first n rows hold; once one doesn't, no later one may.

    The table is named once, as what an outer function is given, so nothing of it is copied for a row.
    """

    def run(table: Column) -> Column:
        def advance(at: Column, step: Column) -> Column:
            return F.when(holds(F.get(table["keys"], at + step - 1)), at + step).otherwise(at)

        return F.aggregate(table["steps"], F.lit(0), advance, lambda at: pick(table["rows"], at))

    return F.get(F.transform(F.array(packed), run), F.lit(0))


def _row_after(rows: Column, at: Column) -> Column:
    return F.get(rows, at)


def _row_before(rows: Column, at: Column) -> Column:
    return F.get(rows, at - 1)


def ceiling_lookup(
    df: DataFrame, value: Column | str, table: DataFrame | Known, bound: str, outputs: dict[str, str],
    defaults: dict[str, float] | None = None,
) -> DataFrame:
    """Columns of the smallest table row whose bound is at or above the value.

    ``outputs`` maps table column to new column.
    """
    v = col(value)
    if isinstance(table, Known):
        rows = _rising(table, [bound])
        if rows is not None:
            def picked(source: str) -> Column:
                def pick(at: int) -> Column:
                    return table.literal(rows[at][source] if at < len(rows) else None, source)

                return F.when(v.isNotNull(), _branch(0, len(rows), lambda i: table.literal(rows[i][bound], bound) < v, pick))

            return _planted(df, picked, outputs, defaults)
        table = table.table
    found = search(F.col(_TABLE), lambda b: b < v, _row_after)
    return _finish(df, pack(table, [bound]), F.when(v.isNotNull(), found), outputs, defaults)


def floor_lookup(
    df: DataFrame, values: Sequence[Column | str], table: DataFrame | Known, bounds: Sequence[str],
    outputs: dict[str, str], defaults: dict[str, float] | None = None, strict: bool = False,
) -> DataFrame:
    """Columns of the largest table row whose bounds are all at or below the values.

    With several bounds the first one decides, then the next. ``strict`` leaves
    out a bound equal to the value.
    """

    def fits(bound: Column, which: int) -> Column:
        v = col(values[which])
        return (v > bound) if strict else (v >= bound)

    if isinstance(table, Known):
        planted = _floor_tree(table, bounds, fits)
        if planted is not None:
            return _planted(df, planted, outputs, defaults)
        table = table.table
    if len(bounds) == 1:
        found = search(F.col(_TABLE), lambda b: fits(b, 0), _row_before)
        return _finish(df, pack(table, bounds), found, outputs, defaults)
    if len(bounds) > 2:
        raise ValueError("a floor lookup has one bound or two")
    first, second = bounds
    rows = F.sort_array(F.collect_list(F.struct(second, *[c for c in table.columns if c not in bounds])))
    groups = table.dropna(subset=list(bounds)).groupBy(first).agg(F.min(second).alias("__least"), rows.alias("__rows"))
    packed = pack(groups.select(first, F.col("__least").alias(second), _packed(F.col("__rows"), second).alias("__group")), [first])

    def group_before(rows: Column, at: Column) -> Column:
        # The last group whose first bound fits holds the row, unless all its second bounds are too large.
        nearest = F.get(rows, at - 1)
        earlier = F.filter(F.slice(rows, F.lit(1), at), lambda g: fits(g[second], 1))
        return F.when(fits(nearest[second], 1), nearest).otherwise(F.get(earlier, F.size(earlier) - 1))["__group"]

    group = search(F.col(_TABLE), lambda b: fits(b, 0), group_before)
    return _finish(df, packed, search(group, lambda b: fits(b, 1), _row_before), outputs, defaults)


def _floor_tree(
    table: Known, bounds: Sequence[str], fits: Callable[[Column, int], Column]
) -> Callable[[str], Column] | None:
    """The row that ``floor_lookup`` finds, per output column, as a tree; None where the tree would be too large."""
    rows = _rising(table, bounds)
    if rows is None or len(bounds) > 2:
        return None

    def last_of(group: Sequence[Row], which: int, source: str) -> Column:
        def pick(at: int) -> Column:
            return table.literal(group[at - 1][source] if at else None, source)

        return _branch(0, len(group), lambda i: fits(table.literal(group[i][bounds[which]], bounds[which]), which), pick)

    if len(bounds) == 1:
        return lambda source: last_of(rows, 0, source)
    first, second = bounds
    groups = [[r for r in rows if r[first] == value] for value in sorted({r[first] for r in rows})]
    if len(groups) * len(rows) > KNOWN_LEAVES:
        return None

    def picked(source: str) -> Column:
        def pick(at: int) -> Column:
            # The last group whose first bound fits holds the row, unless all its second bounds are too large.
            found = table.literal(None, source)
            for group in groups[:at]:
                found = F.when(fits(table.literal(group[0][second], second), 1), last_of(group, 1, source)).otherwise(found)
            return found

        return _branch(0, len(groups), lambda i: fits(table.literal(groups[i][0][first], first), 0), pick)

    return picked


def _planted(
    df: DataFrame, picked: Callable[[str], Column], outputs: dict[str, str], defaults: dict[str, float] | None
) -> DataFrame:
    def value(source: str) -> Column:
        return F.coalesce(picked(source), F.lit(defaults[source])) if defaults and source in defaults else picked(source)

    kept = [c for c in df.columns if c not in outputs.values()]
    return df.select(*kept, *[value(source).alias(target) for source, target in outputs.items()])


def _finish(
    df: DataFrame, packed: Column, found: Column, outputs: dict[str, str], defaults: dict[str, float] | None
) -> DataFrame:
    def value(source: str) -> Column:
        hit = (found if len(outputs) == 1 else F.col("__hit"))[source]
        return F.coalesce(hit, F.lit(defaults[source])) if defaults and source in defaults else hit

    kept = [c for c in df.columns if c not in outputs.values()]
    picked = [value(source).alias(target) for source, target in outputs.items()]
    # ``found`` names the table once, so Spark puts the scalar there and makes no column of it.
    known = df.withColumn(_TABLE, packed)
    return (known if len(outputs) == 1 else known.withColumn("__hit", found)).select(*kept, *picked)


def band_lookup(
    df: DataFrame, score: str, category: str, bands: DataFrame, crosswalk: DataFrame,
    lower: str = "score_lower_bound", upper: str = "score_upper_bound", keep: bool = False,
) -> DataFrame:
    """Rows joined to every band [lower, upper) of their category's curve.

    ``crosswalk`` (category, curve) names the curve; ``bands`` is keyed by curve.
    Rows without a band drop out, or with ``keep`` stay with NULL. A row finds its category by halves and reads the bands of its own curve alone.
    """
    outputs = [c for c in bands.columns if c not in ("curve", lower, upper)]
    curves = crosswalk.join(bands, "curve").withColumn("__category", F.lower("category"))
    own = F.sort_array(F.collect_list(F.struct(lower, upper, *outputs))).alias("__bands")
    packed = pack(curves.groupBy("__category").agg(own), ["__category"])
    name = F.lower(category)

    def own_bands(rows: Column, at: Column) -> Column:
        return F.when(F.get(rows, at)["__category"] == name, F.get(rows, at)["__bands"])

    curve = search(F.col(_TABLE), lambda c: c < name, own_bands)
    hits = F.filter(curve, lambda r: (r[lower] <= F.col(score)) & (F.col(score) < r[upper]))
    joined = df.withColumn(_TABLE, packed).withColumn("__hit", (F.explode_outer if keep else F.explode)(hits))
    return joined.select(*df.columns, *[F.col("__hit")[c].alias(c) for c in outputs])


def code_map(table: DataFrame, key: str, value: str) -> Column:
    """A code table, one row per key, as a map: a scalar of the plan that a row reads without a join."""
    return table.dropna(subset=[key]).agg(F.map_from_entries(F.collect_list(F.struct(key, value)))).scalar()
