import datetime as dt

import pytest

from conftest import rows
from hubcast.operators.scoring import other_levels, point_to_median, score_forecasts

D = dt.date
SCHEMA = ("model string, location string, location_name string, target_variable string, "
          "forecast_date date, target_end_date date, horizon int, type string, quantile double, "
          "prediction double, true_value double")


def _fc(spark, preds, y, model="A", point=None):
    data = [(model, "L", "Land", "inc case", D(2021, 3, 8), D(2021, 3, 13), 1, "quantile", q, p, y)
            for q, p in preds]
    if point is not None:
        data.append((model, "L", "Land", "inc case", D(2021, 3, 8), D(2021, 3, 13), 1, "point", None, point, y))
    return spark.createDataFrame(data, SCHEMA)


def test_wis_golden(spark):  # fixtures 17, 18
    s = score_forecasts(_fc(spark, [(0.25, 8.0), (0.5, 11.0), (0.75, 14.0)], 10.0),
                        round_output=False, levels=(0.25, 0.5, 0.75)).collect()[0]
    assert s.wis == pytest.approx(4 / 3) and s.sharpness == pytest.approx(1.0)
    assert s.overprediction == pytest.approx(1 / 3) and s.underprediction == 0.0
    assert (s.ae_median, s.bias, s.cov_50, s.n_quantiles) == (1.0, 0.5, 1.0, 3)
    assert s.cov_95 is None and s.location_name == "Land"


def test_wis_equals_pinball_identity_and_parts(spark):
    levels = (0.01, 0.025, 0.05, 0.1, 0.25, 0.5, 0.75, 0.9, 0.95, 0.975, 0.99)
    for y in (-5.0, 12.0, 40.0):
        preds = [(q, float(i * 3)) for i, q in enumerate(levels)]
        s = score_forecasts(_fc(spark, preds, y), round_output=False, levels=levels).collect()[0]
        pinball = sum(((1.0 if y < p else 0.0) - q) * (p - y) for q, p in preds)
        assert s.wis == pytest.approx(2 * pinball / len(levels))
        assert s.wis == pytest.approx(s.sharpness + s.underprediction + s.overprediction)


def test_one_sided_interval_gives_null_score(spark):
    s = score_forecasts(_fc(spark, [(0.25, 8.0), (0.5, 11.0)], 10.0), round_output=False,
                        levels=(0.25, 0.5, 0.75)).collect()[0]
    assert s.wis is None and s.ae_median == 1.0


def test_point_fallback(spark):  # fixture 19
    no_median = _fc(spark, [(0.25, 5.0)], 10.0, point=7.0)
    with_median = _fc(spark, [(0.25, 5.0), (0.5, 6.0)], 10.0, point=7.0)
    for df, expected in ((no_median, 7.0), (with_median, 6.0)):
        assert rows(point_to_median(df).filter("quantile = 0.5"), "prediction") == [(expected,)]
        s = score_forecasts(df, round_output=False, levels=(0.25, 0.5, 0.75)).collect()[0]
        assert s.ae_median == abs(expected - 10.0)


def test_bias_outside_all_quantiles(spark):
    s_low = score_forecasts(_fc(spark, [(0.25, 8.0), (0.5, 11.0), (0.75, 14.0)], 1.0),
                            round_output=False, levels=(0.25, 0.5, 0.75)).collect()[0]
    s_high = score_forecasts(_fc(spark, [(0.25, 8.0), (0.5, 11.0), (0.75, 14.0)], 99.0),
                             round_output=False, levels=(0.25, 0.5, 0.75)).collect()[0]
    assert (s_low.bias, s_high.bias) == (1.0, -1.0)


def test_forecasts_without_truth_are_dropped(spark):
    assert score_forecasts(_fc(spark, [(0.5, 1.0)], None)).count() == 0


def test_levels_off_the_list_count_once(spark):
    odd = [(0.1234, 1.0), (0.1234, 1.0), (0.5, 3.0), (0.777, 4.0), (0.25, 2.0), (0.25, 2.0)]
    fc = _fc(spark, odd, 10.0).unionByName(_fc(spark, [(0.9, 5.0)], 10.0, model="B", point=3.0))
    found = other_levels(fc, (0.25, 0.9))
    assert found == [0.1234, 0.5, 0.777]  # a point forecast stands at 0.5
    assert other_levels(fc, (0.25, 0.9), at_most=2) is None
    for others in (found, None):
        got = score_forecasts(fc, round_output=False, levels=(0.25, 0.9), others=others)
        assert {r["model"]: r["n_quantiles"] for r in got.collect()} == {"A": 4, "B": 2}
