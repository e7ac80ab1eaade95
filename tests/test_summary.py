import datetime as dt

import pytest

from conftest import rows
from pyspark.sql import functions as F

from conftest import SMALL
from hubcast.operators import history, pairwise
from hubcast.operators.summary import Parts, summarise_scores
from hubcast.plans import catalog

D = dt.date
CELL = ["target_variable", "horizon", "location"]
UNIT = ["location_name", "forecast_date"]
SCORES = ("model string, target_variable string, forecast_date date, target_end_date date, horizon int, "
          "location string, location_name string, wis double, sharpness double, underprediction double, "
          "overprediction double, ae_median double, bias double, cov_50 double, cov_95 double, n_quantiles long")


def _scores(spark, table):
    """table: {model: [score per unit or None]} -> score rows visible from one day on."""
    data = []
    for m, vals in table.items():
        for i, v in enumerate(vals):
            if v is not None:
                data.append(("inc case", 1, "L", "Land", D(2021, 3, 1 + 7 * i), m, v, D(2021, 6, 1), None))
    return spark.createDataFrame(data, "target_variable string, horizon int, location string, location_name string, "
                                       "forecast_date date, model string, wis double, enter date, leave date")


def _pc(spark, table):
    v = history.Visible(_scores(spark, table), F.lit("2021-06-01").cast("date"), None)
    events = pairwise.pair_changes(v.rows, CELL, UNIT, {"wis": F.col("wis")})
    sums = history.running(events, [*CELL, "a", "b"], pairwise.sum_names(["wis"]), v)
    got = pairwise.relative_skill(sums, ["report_date", *CELL], ["wis"], "base").filter("rel_wis IS NOT NULL")
    return dict(rows(got, "model", "rel_wis")), dict(rows(got, "model", "msr_wis"))


def _score_rows(present, names=None):
    """{model: [(location, forecast dates in weeks)]} -> rows for SCORES with target end dates five days on."""
    out = []
    for m, places in present.items():
        for loc, weeks in places:
            for w in weeks:
                fd = D(2021, 3, 1) + dt.timedelta(days=7 * (w - 1))
                out.append((m, "inc case", fd, fd + dt.timedelta(days=5), 1, loc, (names or str.lower)(loc),
                            4.0, 0.0, 0.0, 0.0, 4.0, 0.2, 1.0, 0.0, 23))
    return out


def test_pairwise_complete_overlap(spark):  # fixture 21 (and scaled == msr)
    own, msr = _pc(spark, {"A": [1.0, 1.0], "B": [4.0, 4.0], "base": [2.0, 2.0]})
    assert own == pytest.approx({"A": 0.5, "B": 2.0, "base": 1.0})
    assert msr == pytest.approx(own)


def test_pairwise_partial_overlap(spark):  # fixture 22
    own, _ = _pc(spark, {"A": [1.0, None], "B": [4.0, 8.0], "base": [2.0, 2.0]})
    assert own == pytest.approx({"A": 0.572357, "B": 2.620741, "base": 1.0}, abs=1e-6)


def test_pairwise_zero_score(spark):  # fixture 23
    own, _ = _pc(spark, {"A": [0.0, 0.0], "base": [2.0, 2.0]})
    assert own["A"] == 0.0


def test_pairwise_single_model_cell_has_no_rows(spark):
    assert _pc(spark, {"base": [1.0, 2.0]}) == ({}, {})


def test_duplicate_units_count_for_each_match(spark):
    rows2 = _scores(spark, {"A": [1.0], "base": [2.0]})
    twice = rows2.unionByName(rows2.filter("model = 'A'").withColumn("wis", F.lit(3.0)))
    v = history.Visible(twice, F.lit("2021-06-01").cast("date"), None)
    sums = history.running(pairwise.pair_changes(v.rows, CELL, UNIT, {"wis": F.col("wis")}), [*CELL, "a", "b"],
                           pairwise.sum_names(["wis"]), v)
    (r,) = sums.filter("a = 'A' AND b = 'base'").collect()
    assert (r.wis_a, r.wis_b, r.wis_n) == (4.0, 4.0, 2)


def test_continuous_weeks(spark):  # fixture 20
    present = {"A": [("L", [2, 3, 4])], "B": [("L", [1, 2, 4])], "C": [("L", [1, 2, 3])]}
    scores = spark.createDataFrame(_score_rows(present), SCORES)
    got = Parts(scores, report_date=D(2021, 6, 1)).continuous_weeks().filter("location = 'L'")
    assert dict(rows(got, "model", "continuous_weeks")) == {"A": 3, "B": 1, "C": 0}


def test_overall_needs_half_the_locations(spark):  # fixture 24
    places = {"A": ["L1", "L2"], "B": ["L3"], "C": ["L1", "L2", "L3", "L4"]}
    scores = spark.createDataFrame(_score_rows({m: [(p, [1]) for p in ps] for m, ps in places.items()}), SCORES)
    got = dict(rows(Parts(scores, report_date=D(2021, 6, 1)).flags, "model", "keep_overall"))
    assert got == {"A": True, "B": False, "C": True}


@pytest.mark.parametrize("settings", [{}, {"history_weeks": 3}, {"restrict_weeks": 2}])
def test_all_report_dates_at_once_equal_one_at_a_time(spark, settings):
    present = {"hub-baseline": [("L1", range(1, 9)), ("L2", range(1, 9)), ("L3", range(4, 9))],
               "A": [("L1", [1, 2, 4, 5, 6]), ("L2", [2, 3])], "B": [("L3", [5, 6, 8])],
               "C": [("L1", [3]), ("L2", [1, 2, 3, 7, 8]), ("L3", [6, 7, 8])]}
    scores = spark.createDataFrame(_score_rows(present), SCORES).withColumn(
        "wis", F.round(F.pmod(F.xxhash64("model", "location", "forecast_date"), F.lit(9)) + 1.0))
    days = [D(2021, 3, 1) + dt.timedelta(days=7 * i) for i in range(14)]
    all_days = spark.createDataFrame([(d,) for d in days], "report_date date")
    batch = summarise_scores(scores, report_dates=all_days, with_continuous_weeks=True, **settings)
    got = rows(batch, *batch.columns)
    assert len({r[0] for r in got}) > 5
    for d in (days[8],):
        one = summarise_scores(scores, report_date=d, with_continuous_weeks=True, **settings)
        assert [r for r in got if r[0] == d] == rows(one, *batch.columns)


def test_streaks_go_beyond_ten_weeks(spark):
    got = catalog.Hub(spark, SMALL).parts().continuous_weeks()
    assert got.agg(F.max("continuous_weeks")).first()[0] > 100


def test_summary_end_to_end_small(spark):
    # two models, two locations, two weeks; every score 2 vs 4 -> rel 0.5 / msr 0.5
    data = []
    for m, s in (("hub-baseline", 4.0), ("A", 2.0)):
        for loc in ("L1", "L2"):
            for w in range(2):
                fd = D(2021, 3, 1) + dt.timedelta(days=7 * w)
                data.append((m, "inc case", fd, fd + dt.timedelta(days=5), 1, loc, loc.lower(),
                             s, 0.0, 0.0, 0.0, s, 0.2, 1.0, 0.0, 23))
    scores = spark.createDataFrame(data, SCORES)
    out = summarise_scores(scores, report_date=D(2021, 4, 1))
    a = {r.location: r for r in out.filter("model = 'A'").collect()}
    assert set(a) == {"L1", "L2", "Overall"}
    assert a["Overall"].rel_wis == 0.5 and a["Overall"].msr_baseline == 0.5
    assert a["Overall"].n == 4 and a["Overall"].n_loc == 2 and a["Overall"].location_name is None
    assert a["L1"].bias == 0.2 and a["L1"].cov_50 == 1.0 and a["L1"].rel_ae == 0.5
