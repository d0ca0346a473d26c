"""The rows of a run are written whole as seldom as can be, and the final table keeps its columns."""

import datetime as dt

from mainstay.checks.registry_run import RULES, inputs
from mainstay.checks.views import Inputs
from mainstay.operators import decision as D
from mainstay.plans.full_run import run_all
from mainstay.session import cut_lineage


def test_published_rows_are_written_once_by_grain_and_once_as_final_table(spark):
    cuts = []

    def cut(df):
        cuts.append(set(df.columns))
        return cut_lineage(df)

    run = run_all(inputs(Inputs(spark, "/root/testdata/sf0.001")), dt.date(2024, 1, 20), RULES, cut)
    assert sum({"mat_note", "replace_total", "usnode"} <= names for names in cuts) == 3
    assert run.final.columns[:3] == ["compkey", "id", "usnode"] and "spot_only" not in run.published.columns
    # The costs that came with the published rows are those of a join afterwards.
    names = ["id", "spot_cost", "whole_rate", "liner_base_days", "spot_only", "whole_only", "liner_only"]
    plain = D.wide_costs(run.published, run.jobs).select(*names)
    assert plain.exceptAll(run.final.select(*names)).count() == 0 and run.final.count() == plain.count()
