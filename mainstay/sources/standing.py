"""A standing output table of which a run over some pipes renews those pipes only.

The table is stored by grain (whole pipe or segment) and by a bucket of the pipe. A run over a subset reads and
overwrites the buckets that hold its pipes; all other files stay as they are.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from mainstay.scratch import written

BUCKETS = 64
GRAIN, NUMBER, BUCKET = PARTITIONS = ["pipe_grain", "pipe_buckets", "pipe_bucket"]


def _bucket(buckets: Column) -> Column:
    # An unknown pipe has a hash too, so its rows have a bucket of their own.
    return F.pmod(F.xxhash64(F.col("compkey").cast("long")), buckets).cast("int")


def _placed(rows: DataFrame, grain: Column | str, buckets: int) -> DataFrame:
    number = F.lit(buckets)
    return rows.withColumns({
        GRAIN: F.when(F.expr(grain) if isinstance(grain, str) else grain, "whole").otherwise("segment"), NUMBER: number, BUCKET: _bucket(number),
    })


def _save(rows: DataFrame, path: str, mode: str) -> None:
    # Rebalancing gathers a bucket in few files and, unlike a plain shuffle, splits one that a hot pipe fills.
    writer = rows.hint("rebalance", GRAIN, BUCKET).write.mode("overwrite").partitionBy(*PARTITIONS)
    writer.option("partitionOverwriteMode", mode).parquet(path)


def publish(rows: DataFrame, path: str, grain: Column | str, buckets: int = BUCKETS) -> None:
    """Write the table anew. ``grain`` (a column or SQL) is true for whole pipes; the number of buckets is kept in the table."""
    clashing = [c for c in rows.columns if c.lower() in PARTITIONS]
    if clashing:
        raise ValueError(f"columns named like the table's partitions: {', '.join(clashing)}")
    _save(_placed(rows, grain, buckets), path, "static")


def _table(spark: SparkSession, path: str, columns: StructType) -> DataFrame:
    # A table without rows has no file to take a schema from, so it is declared.
    places = StructType.fromDDL(f"{GRAIN} string, {NUMBER} int, {BUCKET} int")
    return spark.read.schema(StructType([*columns.fields, *places.fields])).parquet(path)


def read_standing(spark: SparkSession, path: str, columns: StructType | None = None) -> DataFrame:
    """The table with the columns that were published; ``columns`` must be given where it may have no rows."""
    found = spark.read.parquet(path) if columns is None else _table(spark, path, columns)
    return found.drop(*PARTITIONS)


def _of_pipes(rows: DataFrame, keys: DataFrame, how: str) -> DataFrame:
    # A task holds its part of the keys alone; rows pass by and are never sorted, however many a pipe has.
    return rows.join(keys.hint("shuffle_hash"), "compkey", how)


def renew(rows: DataFrame, subset: DataFrame, path: str, grain: Column | str) -> None:
    """Put the rows of the pipes in ``subset`` in place of those the table has of them.

    Rows of other pipes stay, whether in the table or not given here; ``rows`` of pipes outside the subset are not taken. A
    pipe of the subset without rows loses those it had. ``rows`` have the table's columns and types. Unknown pipes are
    never in a subset. A table without rows is published anew.
    """
    spark = rows.sparkSession
    # Read three times: to choose the buckets, the rows that stay and those that come.
    keys = written(subset.select(F.col("compkey").cast("long").alias("compkey")).dropna().distinct(), "subset")
    taken = _of_pipes(rows, keys, "left_semi")
    standing = _table(spark, path, rows.schema)
    first = standing.select(NUMBER).first()
    if first is None:
        publish(taken, path, grain)
        return
    number = first[NUMBER]
    columns = rows.columns
    buckets = keys.select(_bucket(F.lit(number)).alias(BUCKET)).distinct()
    # One row for each bucket at most; without the hint the whole table is shuffled before Spark knows that.
    touched = standing.join(F.broadcast(buckets), BUCKET, "left_semi")
    kept = _of_pipes(touched, keys, "left_anti").select(*columns, *PARTITIONS)
    # The table can't be read while it is overwritten, so the new rows are written aside first.
    renewed = written(kept.unionByName(_placed(taken.select(*columns), grain, number)), "renewed")
    # At most two partitions for each bucket, so the lists are small.
    before = {tuple(r) for r in touched.select(*PARTITIONS).distinct().collect()}
    after = {tuple(r) for r in renewed.select(*PARTITIONS).distinct().collect()}
    _save(renewed, path, "dynamic")
    _remove(spark, path, before - after)


def _remove(spark: SparkSession, path: str, partitions: set[tuple]) -> None:
    """Delete partitions that have no rows any more; an overwrite leaves them alone."""
    for values in partitions:
        folder = "/".join(f"{n}={v}" for n, v in zip(PARTITIONS, values))
        target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{path}/{folder}")
        target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)
