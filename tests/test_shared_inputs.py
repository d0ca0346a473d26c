"""Inputs that several steps read are made once: a plan scans the segments' table only so often."""

import re

import pytest

import __spark_entry__ as entry

FOLDER = "/root/testdata/sf0.001"
QUERIES = entry.queries()


@pytest.mark.parametrize("name, scans", [("k35_final_times", 4), ("d21_pipe_summary", 0), ("d29_failure_percent", 8)])
def test_segments_are_scanned_a_few_times(spark, name, scans):
    plan = QUERIES[name](spark, FOLDER)._jdf.queryExecution().optimizedPlan().toString()
    assert len(re.findall(r"Relation \[l_orderkey", plan)) <= scans
