import datetime as dt

from conftest import rows
from hubcast.operators.truth import add_status, attach_truth, convert_to_weekly

D = dt.date


def test_weekly_from_daily(spark):  # fixture 4
    data = [("L", "inc case", D(2021, 3, d), float(d)) for d in range(7, 18)]
    df = spark.createDataFrame(data, "location string, target_variable string, date date, value double")
    got = rows(convert_to_weekly(df), "location", "date", "value")
    assert got == [("L", D(2021, 3, 13), 13.0)]


def test_weekly_series_moves_to_saturday(spark):  # fixture 5
    data = [("L", "inc case", D(2021, 3, 7), 5.0), ("L", "inc case", D(2021, 3, 14), 6.0)]
    df = spark.createDataFrame(data, "location string, target_variable string, date date, value double")
    got = rows(convert_to_weekly(df), "date", "value")
    assert got == [(D(2021, 3, 13), 5.0), (D(2021, 3, 20), 6.0)]


def test_status_join(spark):  # fixture 6
    x = spark.createDataFrame(
        [("inc case", "A", D(2021, 3, 6)), ("inc case", "B", D(2021, 3, 6)), ("inc case", "C", D(2021, 3, 6))],
        "target_variable string, location string, target_end_date date")
    st = spark.createDataFrame(
        [("inc case", "B", D(2021, 3, 6), None), ("inc case", "C", D(2021, 3, 6), "near-final")],
        "target_variable string, location string, target_end_date date, status string")
    assert rows(add_status(x, st), "location", "status") == [
        ("A", "final"), ("B", "final"), ("C", "near-final")]


def test_attach_truth_leaves_unobserved_null(spark):
    fc = spark.createDataFrame([("inc case", "A", D(2021, 3, 6), 1.0), ("inc case", "A", D(2021, 3, 13), 2.0)],
                               "target_variable string, location string, target_end_date date, value double")
    tr = spark.createDataFrame([("inc case", "A", D(2021, 3, 6), 9.0)],
                               "target_variable string, location string, target_end_date date, value double")
    assert rows(attach_truth(fc, tr), "target_end_date", "prediction", "true_value") == [
        (D(2021, 3, 6), 1.0, 9.0), (D(2021, 3, 13), 2.0, None)]
