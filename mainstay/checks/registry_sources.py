"""Registered queries of sources and sinks: each writes a stand-in and reads it back."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame

from mainstay.checks.common import Query
from mainstay.scratch import shared_folder
from mainstay.sources import standing
from mainstay.sources import tables as S

Q: dict[str, Query] = {}
SQL: dict[str, str] = {}

_ROWS = "SELECT id, compkey, cutno, length FROM seg"


def _rows(v) -> DataFrame:
    return v("seg").select("id", "compkey", "cutno", "length")


def _path(v, name: str) -> str:
    """A new folder in the shared place, deleted when the driver ends."""
    path = f"{shared_folder(v.spark)}/mainstay-{name}-{uuid.uuid4().hex}"
    target = v.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(v.spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(target)
    return path


def _read(v):
    path = _path(v, "peak")
    S.write_table(v("peak").selectExpr("CAST(obsevkey AS STRING) AS OBSEVKEY", "peak_score AS Peak_Score", "1 AS other"), path)
    return S.read_table(v.spark, path, "peak_score")


Q["s1_read_table"] = _read
SQL["s1_read_table"] = "SELECT obsevkey, peak_score FROM peak"


def _copied(v):
    v.spark.sql("CREATE DATABASE IF NOT EXISTS mainstay_other")
    S.create_table_as(_rows(v), "mainstay_other.segments")
    S.copy_table(v.spark, "mainstay_other", "segments", "mainstay_copied")
    return v.spark.table("mainstay_copied")


Q["s2_copy_across_databases"] = _copied
SQL["s2_copy_across_databases"] = _ROWS


def _rebuilt(v):
    path = _path(v, "rebuilt")
    S.write_table(_rows(v).filter("cutno = 1"), path)
    S.write_table(_rows(v), path, ["cutno"])
    return v.spark.read.parquet(path)


Q["s4_rebuild_table"] = _rebuilt
SQL["s4_rebuild_table"] = _ROWS


def _created(v):
    S.create_table_as(_rows(v).filter("cutno = 1"), "mainstay_created")
    S.create_table_as(_rows(v), "mainstay_created", "compkey", 4)
    return v.spark.table("mainstay_created")


Q["s5_create_table_as"] = _created
SQL["s5_create_table_as"] = _ROWS


def _exported(v):
    path = _path(v, "csv")
    S.export_csv(_rows(v), path)
    return v.spark.read.option("header", True).schema(_rows(v).schema).csv(path)


Q["s6_export_csv"] = _exported
SQL["s6_export_csv"] = _ROWS


def _viewed(v):
    S.register_views({"mainstay_cuts": _rows(v), "mainstay_first": _rows(v).filter("cutno = 1")})
    S.register_views({"mainstay_joined": v.spark.sql(
        "SELECT c.id, c.compkey, f.length AS first_length FROM mainstay_cuts c JOIN mainstay_first f ON f.compkey = c.compkey"
    )})
    return v.spark.sql("SELECT compkey, count(*) AS cuts, max(first_length) AS first_length FROM mainstay_joined GROUP BY compkey")


Q["s7_views_on_views"] = _viewed
SQL["s7_views_on_views"] = """
SELECT s.compkey, count(*) AS cuts, max(f.length) AS first_length FROM seg s JOIN seg f ON f.compkey = s.compkey AND f.cutno = 1 GROUP BY s.compkey
"""


def _renewed(v):
    path = _path(v, "standing")
    standing.publish(_rows(v), path, "cutno = 0", buckets=16)
    # The run over the subset gives its pipes twice the length and no longer has their first piece.
    run = _rows(v).filter("cutno <> 1").selectExpr("id", "compkey", "cutno", "length * 2 AS length")
    standing.renew(run, v("chg").select("compkey"), path, "cutno = 0")
    return standing.read_standing(v.spark, path)


Q["s8_renew_subset"] = _renewed
SQL["s8_renew_subset"] = """
SELECT id, compkey, cutno, length FROM seg WHERE compkey NOT IN (SELECT compkey FROM chg WHERE compkey IS NOT NULL)
UNION ALL
SELECT id, compkey, cutno, length * 2 AS length FROM seg WHERE cutno <> 1 AND compkey IN (SELECT compkey FROM chg)
"""
