"""Reading, checking and writing tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mainstay import schemas


def read_table(spark: SparkSession, path: str, name: str, format: str = "parquet", **options: str) -> DataFrame:
    """A base table, checked against its declared schema.

    Only the declared columns are read, so pruning and filters reach the scan.
    """
    raw = spark.read.format(format).options(**options).load(path)
    return conform(raw, name)


def read_jdbc(spark: SparkSession, url: str, table: str, name: str, column: str, parts: int, **properties: str) -> DataFrame:
    """A base table of a relational source, read in ``parts`` ranges of a numeric column.

    The bounds come from the source, so no range is left to a single reader.
    """
    reader = spark.read.format("jdbc").options(url=url, **properties)
    ends = reader.option("query", f"SELECT MIN({column}) AS lo, MAX({column}) AS hi FROM {table}").load().first()
    raw = reader.option("dbtable", table)
    if ends.lo is not None:
        raw = raw.options(
            partitionColumn=column, lowerBound=str(ends.lo), upperBound=str(ends.hi), numPartitions=str(parts)
        )
    return conform(raw.load(), name)


def conform(df: DataFrame, name: str) -> DataFrame:
    """Columns of the declared schema, found without regard to case and cast; a missing one is an error."""
    wanted = schemas.SCHEMAS[name]
    found = {c.lower(): c for c in df.columns}
    missing = [f.name for f in wanted.fields if f.name not in found]
    if missing:
        raise ValueError(f"{name}: missing columns {', '.join(missing)}")
    return df.select(*[F.col(f"`{found[f.name]}`").cast(f.dataType).alias(f.name) for f in wanted.fields])


def read_catalog(spark: SparkSession, alias: str, table: str) -> DataFrame:
    """A table of another attached catalog or database."""
    return spark.table(f"{alias}.{table}")


def copy_table(spark: SparkSession, alias: str, table: str, target: str) -> None:
    """Copy a table across catalogs."""
    read_catalog(spark, alias, table).write.mode("overwrite").saveAsTable(target)


def base_segments(df: DataFrame, columns: dict[str, str]) -> DataFrame:
    """Base columns under the names of the work table (new name: source column)."""
    return df.select(*[F.col(source).alias(name) for name, source in columns.items()])


def write_table(df: DataFrame, path: str, partition_by: list[str] | None = None) -> None:
    """Rebuild an output table."""
    writer = df.write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)


def create_table_as(df: DataFrame, name: str, bucket_by: str | None = None, buckets: int = 0) -> None:
    """Drop and create a catalog table; ``bucket_by`` keeps later joins on that key free of shuffles."""
    writer = df.write.mode("overwrite").format("parquet")
    if bucket_by:
        writer = writer.bucketBy(buckets, bucket_by).sortBy(bucket_by)
    writer.saveAsTable(name)


def export_csv(df: DataFrame, path: str) -> None:
    """CSV with header, one file per task."""
    df.write.mode("overwrite").option("header", True).csv(path)


def register_views(views: dict[str, DataFrame]) -> None:
    """Name lazy results so that SQL text can use them."""
    for name, df in views.items():
        df.createOrReplaceTempView(name)
