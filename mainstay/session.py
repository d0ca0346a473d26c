"""Session settings and lineage cuts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from mainstay.scratch import settings, written

# HotSpot compiles no method of more bytes of code than this; a longer one stays interpreted, row by row. Wide rows and long
# formulas make such code, which Spark then splits.
_COMPILED = {"spark.sql.codegen.hugeMethodLimit": "8000"}


def get_session(app: str = "mainstay", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the operators are designed for.

    On a cluster the master, memory and shuffle size come from spark-submit; only
    the adaptive settings matter here: they size shuffles and split skewed joins
    at run time.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.ui.enabled": "false",
        **conf,
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def cut_lineage(df: DataFrame) -> DataFrame:
    """Write ``df`` as Parquet to the shared folder and go on from there.

    The copy outlives the executors that made it, so a lost executor costs one
    stage and not the whole chain; it goes when the driver ends.
    """
    with settings(df.sparkSession, _COMPILED):
        return written(df, "run")
