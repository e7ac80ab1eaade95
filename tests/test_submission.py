import datetime as dt

from conftest import rows
from hubcast.operators.submission import add_point_forecasts, format_ensemble

D = dt.date


def test_point_rows(spark):  # fixture 7
    df = spark.createDataFrame([("quantile", q, float(i)) for i, q in enumerate([0.25, 0.5, 0.75])],
                               "type string, quantile double, value double")
    out = add_point_forecasts(df)
    assert out.count() == 4
    assert rows(out.filter("type = 'point'"), "quantile", "value") == [(None, 1.0)]


def test_submission_rounding_and_label(spark):  # fixtures 8, 9
    vals = [0.5, 1.5, 2.5, 2.51]
    df = spark.createDataFrame([(1.0, "inc case", "L", 0.1 * (i + 1), v) for i, v in enumerate(vals)],
                               "horizon double, target_variable string, location string, quantile double, value double")
    out = format_ensemble(df, D(2021, 3, 8))
    got = rows(out, "quantile", "value", "target", "target_end_date", "type")
    assert [g[1] for g in got] == [0.0, 2.0, 2.0, 3.0]
    assert {g[2] for g in got} == {"1 wk ahead inc case"}
    assert {g[3] for g in got} == {D(2021, 3, 13)}
    assert {g[4] for g in got} == {"quantile"}
