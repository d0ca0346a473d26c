"""Registered query of the full run over the stand-in inputs."""

from __future__ import annotations

from pyspark.sql import functions as F

from mainstay.checks.common import AS_OF, Query, SEVERE
from mainstay.plans.full_run import Network, RunInputs, RunRules, run_all
from mainstay.scratch import written

Q: dict[str, Query] = {}
SQL: dict[str, str] = {}

RATES = [
    "diameters", "trenches", "depth_rates", "prices", "difficulty", "bypass_rates", "mh_sizes", "mh_prices", "mh_factors",
    "liner_prices", "cleaning_prices",
]


def inputs(v) -> RunInputs:
    """Base tables of a full run from the stand-in views. A run reads them in many steps, so those that join or sort are
    written first."""
    v.written_once("seg", "whole", "insp", "peak")
    whole = v("whole")
    status = whole.select("compkey", "instdate", "hservstat")
    seg = v("seg").drop("replacecost").join(status, "compkey").withColumns(
        {"usnode": F.lit(None).cast("long"), "dsnode": F.lit(None).cast("long")}
    )
    wholes = whole.select(
        "id", "compkey", F.lit(0).alias("cutno"), F.lit(0.0).alias("fm"), F.col("length").alias("to_"), "length",
        (F.col("compkey") % 60 + 6).cast("int").alias("diamwidth"), F.lit("VARIES").alias("material"),
        F.when(F.col("compkey") % 5 == 0, "OTH").otherwise("BES").alias("remarks"), F.lit(0).alias("seg_count"),
        "instdate", "hservstat", "usnode", "dsnode",
    )
    crossings = v("site").unionByName(v("wsite")).drop("fm", "to_", "base_hours", "mob_hours").withColumns({
        "countxfrwy": F.col("xfrwy"), "countxart": F.col("xsewer"), "countxmjart": F.col("xwtr"),
    })
    layers = [
        v("linkxp").filter("xschl > 0").select(F.col("mlinkid").alias("id"), F.lit(8000.0).alias("consequence")),
        v("linkcost").select(F.col("mlinkid").alias("id"), (F.col("totalconstructioncost") * 1.4).alias("consequence")),
    ]
    # Install dates before the inspections leave most inspected pipes current.
    network = Network(v("sanitary").withColumn("unittype", F.lit("saml")), v("insp"), v("obs"), v("idx"))
    return RunInputs(
        pipes=written(seg.unionByName(wholes), "pipes"), sanitary=network, storm=Network(v("storm"), v("insp"), v("obs"), v("idx")),
        peak=v("peak"), changes=v("chg"), crosswalk=v("rosetta"), bands=v("bands"), crossings=crossings,
        streets=v("street"), rates={n: v(n) for n in RATES}, surcharge=v("surch"), storm_grades=v("grades"), layers=layers,
    )


RULES = RunRules(
    structural_codes=("BP", "BRK", "CR", "DS"), severe_codes=tuple(SEVERE), lateral_code="LT", code_column="obcode"
)


def _run(v):
    final = run_all(inputs(v), AS_OF, RULES).final
    return final.groupBy("recommended", F.when(F.col("cutno") == 0, "whole").otherwise("segment").alias("grain")).agg(
        F.count(F.lit(1)).alias("rows"), F.round(F.sum("cof"), 0).alias("cof")
    )


Q["n8_full_run"] = _run
