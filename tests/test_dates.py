import datetime as dt

from pyspark.sql import functions as F

from hubcast.functions.dates import default_target_end_date, week_end

D = dt.date


def _one(spark, dates, expr):
    df = spark.createDataFrame([(d,) for d in dates], "d date")
    return [r[0] for r in df.select(expr).collect()]


def test_week_end_saturday(spark):  # fixture 1
    got = _one(spark, [D(2021, 3, 6), D(2021, 3, 7), D(2021, 3, 12)], week_end("d", "Saturday"))
    assert got == [D(2021, 3, 6), D(2021, 3, 13), D(2021, 3, 13)]


def test_week_end_monday(spark):  # fixture 2
    got = _one(spark, [D(2021, 3, 1), D(2021, 3, 2)], week_end("d", "Monday"))
    assert got == [D(2021, 3, 1), D(2021, 3, 8)]


def test_week_end_idempotent_and_bounded(spark):
    days = [D(2021, 1, 1) + dt.timedelta(days=i) for i in range(30)]
    df = spark.createDataFrame([(d,) for d in days], "d date")
    out = df.select("d", week_end("d", "Saturday").alias("e")).select(
        "d", "e", week_end("e", "Saturday").alias("e2"), F.datediff("e", "d").alias("k")).collect()
    assert all(r.e == r.e2 and 0 <= r.k <= 6 and r.e.weekday() == 5 for r in out)


def test_unknown_weekday_raises():
    import pytest
    with pytest.raises(ValueError):
        week_end("d", "Samstag")


def test_default_target_end_date(spark):  # fixture 3
    df = spark.createDataFrame([(D(2021, 3, 8),), (D(2021, 3, 7),), (D(2021, 3, 6),)], "d date")
    got = [r[0] for r in df.select(default_target_end_date("d", F.lit(1))).collect()]
    assert got == [D(2021, 3, 13), D(2021, 3, 13), D(2021, 3, 6)]
