"""A query whose steps all read the segments makes them once: no step sorts the order lines again."""

import __spark_entry__ as entry
from mainstay.checks.views import Inputs

FOLDER = "/root/testdata/sf0.001"


def test_finished_costs_sort_the_order_lines_once(spark):
    plan = entry.queries()["k37_finish_costs"](spark, FOLDER)._jdf.queryExecution().optimizedPlan().toString()
    assert "Window [" not in plan


def test_a_copy_has_the_rows_of_its_view(spark):
    v, plain = Inputs(spark, FOLDER), Inputs(spark, FOLDER)
    columns = ["id", "compkey", "cutno", "fm", "to_", "length", "diamwidth", "replacecost"]
    v.written_once("scored", only=[*columns, "action"])
    v.read_from("seg", "scored", columns)
    for name, wanted in (("seg", columns), ("scored", [*columns, "action"]), ("site", plain("site").columns)):
        found, whole = (sorted(map(str, x(name).select(*wanted).collect())) for x in (v, plain))
        assert found == whole
