"""Joins that survive one key holding a large share of the rows.

A pipe, inspection or node may own a third of a table. Aggregations are safe
(Spark combines them before the shuffle); joins on that key with an aggregated
side are not split at run time, because only plain shuffles are. ``hot_keys``
finds such keys on a base table, and ``attach`` spreads their rows over many
tasks and repeats the matching side for them only. Both are lazy: the counts are
part of the plan that needs them, and building a plan starts no job.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# A key is hot above this part of an even partition's rows; so there are at most
# PARTS_PER_PARTITION keys for each shuffle partition, whatever the size of the data.
PARTS_PER_PARTITION = 4
_SALT = "__salt"
_SALTS = "__salts"


@dataclass(frozen=True)
class HotKeys:
    """The hot keys, and into how many parts to split the rows of each, as a lazy table; None: there are none.

    ``other`` has those of the rows that an overlap join puts on the other side, where they are known.
    """

    keys: tuple[str, ...]
    table: DataFrame | None
    other: HotKeys | None = None


def hot_keys(df: DataFrame, keys: list[str], parts: int | None = None) -> HotKeys:
    """Keys that own more than one of ``parts`` equal parts of all rows.

    There are fewer than ``parts`` such keys by counting, so their table is small enough
    to broadcast at any size of the data; no key is left out. Counts are exact, so
    both sides of a join see the same set.
    """
    if parts is None:
        parts = PARTS_PER_PARTITION * int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    known = df.select(*keys).dropna(subset=keys)
    counts = known.groupBy(*keys).agg(F.count(F.lit(1)).alias("__n"))
    share = F.col("__n") * F.lit(parts) / F.greatest(known.agg(F.count(F.lit(1))).scalar(), F.lit(1))
    table = counts.where(share > 1).select(*keys, F.ceil(share).cast("int").alias(_SALTS))
    return HotKeys(tuple(keys), table)


def settled(hot: HotKeys, cut: Callable[[DataFrame], DataFrame], other: HotKeys | None = None) -> HotKeys:
    """The same hot keys, counted now by ``cut``, for a run that reads them in many steps.

    Where no key is hot, joins are plain, so that joins on one key share a shuffle.
    """
    table = cut(hot.table)
    return HotKeys(hot.keys, None if table.isEmpty() else table, other)


def _row_hash(df: DataFrame) -> Column:
    # A hash of the row and its partition, not rand(): a re-run task must give the same salt.
    names = [f.name for f in df.schema.fields if f.dataType.typeName() not in ("map", "variant")]
    return F.xxhash64(F.spark_partition_id(), *names)


def salt_rows(rows: DataFrame, hot: HotKeys) -> DataFrame:
    """Number the rows of hot keys 0..parts-1; all other rows get 0."""
    marked = rows.withColumn("__mark", _row_hash(rows)).join(F.broadcast(hot.table), list(hot.keys), "left")
    salt = F.when(F.col(_SALTS).isNotNull(), F.pmod(F.col("__mark"), F.col(_SALTS))).otherwise(0)
    return marked.withColumn(_SALT, salt.cast("int")).drop(_SALTS, "__mark")


def repeat_rows(rows: DataFrame, hot: HotKeys) -> DataFrame:
    """Repeat the rows of hot keys once per part; all other rows appear once."""
    marked = rows.join(F.broadcast(hot.table), list(hot.keys), "left")
    last = F.coalesce(F.col(_SALTS) - 1, F.lit(0))
    return marked.withColumn(_SALT, F.explode(F.sequence(F.lit(0), last))).drop(_SALTS)


def attach(
    rows: DataFrame, other: DataFrame, on: str | list[str], how: str = "left", hot: HotKeys | None = None
) -> DataFrame:
    """Join ``rows`` (many per key) to ``other`` (few per key) on equal keys.

    Without hot keys (or where they were counted and none was found) this is a plain join: Spark broadcasts ``other`` only below its
    size limit and else shuffles, with run-time splitting of skewed partitions. The
    rows of hot keys are spread by salt first.
    """
    keys = [on] if isinstance(on, str) else list(on)
    if hot is None or hot.table is None:
        return rows.join(other, keys, how)
    left, right = salt_rows(rows, hot), repeat_rows(other, hot)
    return left.join(right, keys + [_SALT], how).drop(_SALT)
