"""Rows whose key may have a partner, found before anything is shuffled.

Most pipes have no inspection, and most segments lie far from what a layer holds. ``may_match`` makes a map of bits from the
keys of the smaller side and drops the rows of the larger side that it rules out. The map has a fixed size whatever the data;
where it is crowded it rules out less, never wrongly. The join that follows stays exact.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ByteType, DataType, IntegerType, LongType, ShortType, StringType

# The map is an array of so many words of 64 bits (512 KB), a scalar of the plan.
WORDS = 1 << 16


_WHOLE = (ByteType, ShortType, IntegerType, LongType)


def _common(a: DataType, b: DataType) -> str | None:
    """The type in which equal keys have equal hashes; None where that isn't sure."""
    if isinstance(a, _WHOLE) and isinstance(b, _WHOLE):
        return "long"
    return "string" if a == b == StringType() else None


def _place(key: str, kind: str) -> Column:
    return F.pmod(F.xxhash64(F.col(key).cast(kind)), F.lit(WORDS * 64))


def _bits(other: DataFrame, key: str, kind: str) -> Column:
    place = other.select(_place(key, kind).alias("__place"))
    found = place.select(
        F.floor(F.col("__place") / 64).alias("__word"),
        F.call_function("shiftleft", F.lit(1).cast("long"), (F.col("__place") % 64).cast("int")).alias("__bits"),
    )
    empty = other.sparkSession.range(WORDS).select(F.col("id").alias("__word"), F.lit(0).cast("long").alias("__bits"))
    words = found.groupBy("__word").agg(F.bit_or("__bits").alias("__bits")).unionByName(empty)
    merged = words.groupBy("__word").agg(F.bit_or("__bits").alias("__bits"))
    rows = merged.agg(F.sort_array(F.collect_list(F.struct("__word", "__bits"))).alias("rows"))
    return rows.select(F.col("rows.__bits")).scalar()


def may_match(rows: DataFrame, other: DataFrame, key: str) -> DataFrame:
    """``rows`` without those whose ``key`` is NULL or surely not among the keys of ``other``."""
    kind = _common(rows.schema[key].dataType, other.schema[key].dataType)
    if kind is None:
        return rows.filter(F.col(key).isNotNull())
    place = _place(key, kind)
    word = F.get(_bits(other.filter(F.col(key).isNotNull()), key, kind), F.floor(place / 64).cast("int"))
    bit = F.call_function("shiftright", word, (place % 64).cast("int")).bitwiseAND(F.lit(1).cast("long"))
    return rows.filter(F.col(key).isNotNull() & (bit == 1))
