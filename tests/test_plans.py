"""Plan checks: no cartesian / nested-loop joins, no row-at-a-time Python UDFs,
and column pruning down to the parquet scans."""

import re

import pytest

from conftest import SMALL
from hubcast.plans import catalog

FORBIDDEN = ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython")


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", ["submission_format", "score_table", "summary_table", "batch_runs",
                                  "criteria_quantiles", "weekly_truth", "truth_status",
                                  "submission_links"])
def test_no_cartesian_or_python_row_udf(spark, name):
    plan = _plan(catalog.QUERIES[name](spark, SMALL))
    assert not [f for f in FORBIDDEN if f in plan], plan


def test_fact_scans_read_only_needed_columns(spark):
    plan = _plan(catalog.truth_status(spark, SMALL))
    schemas = re.findall(r"ReadSchema: struct<([^>]*)>", plan)
    lineitem = [s for s in schemas if "l_shipdate" in s]
    assert lineitem and all(set(x.split(":")[0] for x in s.split(",")) <=
                            {"l_suppkey", "l_returnflag", "l_linestatus", "l_shipdate"}
                            for s in lineitem)
    events = re.findall(r"ReadSchema: struct<([^>]*)>", _plan(catalog.weekly_truth(spark, SMALL)))
    assert events and all(set(x.split(":")[0] for x in s.split(",")) <= {"ts", "event_type"}
                          for s in events)
