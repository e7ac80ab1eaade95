import os

import pytest

from conftest import SMALL

import __spark_entry__ as entry
from oracle_check import compare, duck


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.count() > 0
    assert df.columns == ["forecast_date", "target", "target_end_date", "location", "type",
                          "quantile", "value"]


def test_every_query_has_sql_unless_documented():
    q, o = entry.queries(), entry.oracle_sql()
    assert set(o) <= set(q)
    own = {k for k in q if k != "pipeline" and not k.startswith("op")}
    assert own == {k for k in o if k != "pipeline" and not k.startswith("op")}


# The full comparison of every query is tests/oracle_check.py; the suite keeps a sample.
ORACLE_SAMPLE = ["weekly_truth", "truth_status", "submission_format", "score_table",
                 "submission_links"]


@pytest.mark.parametrize("name", ORACLE_SAMPLE)
def test_matches_duckdb_oracle_small(spark, name):
    res = compare(spark, duck(SMALL), name, entry.queries()[name], entry.oracle_sql()[name], SMALL)
    assert res["spark_rows"] == res["duck_rows"] and res["cols"] and res["exact"], res
