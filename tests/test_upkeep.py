import datetime as dt

import pytest
from pyspark.sql import functions as F

from conftest import rows
from hubcast.operators import upkeep
from hubcast.operators.summary import evaluation_table
from test_summary import SCORES, _score_rows

D = dt.date
# L2 of B comes and goes, so the models with an "Overall" row change; C skips weeks.
PRESENT = {"hub-baseline": [("L1", range(1, 8)), ("L2", range(1, 8)), ("L3", range(4, 8))],
           "A": [("L1", [1, 2, 4, 5, 6, 7]), ("L2", [2, 3])], "B": [("L3", [4, 5, 7])],
           "C": [("L1", [3]), ("L2", [1, 2, 3, 6, 7]), ("L3", [5, 6, 7])], "D": [("L1", [6, 7])]}
DAYS = [D(2021, 3, 1) + dt.timedelta(days=7 * i) for i in range(1, 10)]


def _dates(spark, days):
    return spark.createDataFrame([(d,) for d in days], "report_date date")


@pytest.fixture(scope="module")
def scores(spark):
    return (spark.createDataFrame(_score_rows(PRESENT), SCORES)
            .withColumn("wis", F.round(F.pmod(F.xxhash64("model", "location", "forecast_date"), F.lit(9)) + 1.0))
            .withColumn("ae_median", F.col("wis") + 1).checkpoint())


def _same(got, want):
    assert set(got.columns) == set(want.columns)
    assert rows(got, *want.columns) == rows(want, *want.columns)


def test_weeks_added_one_by_one_equal_the_rebuild(spark, scores, tmp_path):
    want = evaluation_table(scores, report_dates=_dates(spark, DAYS)).checkpoint()
    store = upkeep.EvaluationStore(spark, str(tmp_path / "store"))
    store.start(scores, _dates(spark, DAYS[:4]))
    seen = upkeep.seen_on()
    for before, day in zip(DAYS[3:], DAYS[4:]):
        # earlier rows are not there to be read
        store.add(scores.filter((seen > F.lit(before)) & (seen <= F.lit(day))), day)
    _same(store.evaluation(), want)
    assert want.filter("location = 'Overall'").select("report_date", "model").distinct().count() > len(DAYS)
    store.add(scores, DAYS[5])  # a rerun day, with all rows offered
    _same(store.evaluation(), want)
    with pytest.raises(ValueError, match="can't be added before"):
        store.add(scores, DAYS[0])
    late = scores.filter(F.col("forecast_date") == D(2021, 3, 8)).withColumn("target_end_date", F.lit(DAYS[-1] + dt.timedelta(days=3)))
    with pytest.raises(ValueError, match="after a later one"):
        store.add(late, DAYS[-1] + dt.timedelta(days=7))
    _same(store.evaluation(), want)


def test_a_store_from_nothing_and_a_skipped_day(spark, scores, tmp_path):
    store = upkeep.EvaluationStore(spark, str(tmp_path / "store"))
    store.add(scores.filter("false"), D(2021, 2, 22))
    assert store._read("evaluation") is None and store._read("weeks") is None
    for day in (DAYS[1], DAYS[5]):
        store.add(scores, day)
    _same(store.evaluation(), evaluation_table(scores, report_dates=_dates(spark, [DAYS[1], DAYS[5]])))


def test_stored_scores_are_pruned_to_the_new_weeks(spark, scores, tmp_path):
    stored = upkeep.write_scores(scores, str(tmp_path / "scores"))
    store = upkeep.EvaluationStore(spark, str(tmp_path / "store"))
    new = store._new_rows(stored, DAYS[5], DAYS[4])
    files = {r[0].split("visible_on=")[1][:10] for r in new.select(F.input_file_name()).distinct().collect()}
    assert files == {str(DAYS[5])}
    plan = new._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(visible_on" in plan
    assert new.count() == scores.filter((upkeep.seen_on() > F.lit(DAYS[4])) & (upkeep.seen_on() <= F.lit(DAYS[5]))).count()
