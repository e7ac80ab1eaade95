import datetime as dt
import glob
import os

from hubcast.plans.runs import windowed_forecasts
from hubcast.sources import store

MONDAY = dt.date(2021, 3, 1)
SCHEMA = "model string, forecast_date date, horizon int, value double"


def weeks(n, models=("A", "B")):
    return [(m, MONDAY + dt.timedelta(7 * i + j), 1, float(i)) for i in range(n) for j, m in enumerate(models)]


def dates(spark, *days):
    return spark.createDataFrame([(d,) for d in days], "run_date date")


def test_windows_of_a_batch_open_only_their_folders(spark, tmp_path):
    path = str(tmp_path / "fc")
    fc = spark.createDataFrame(weeks(12), SCHEMA)
    stored = store.write_forecasts(fc, path)
    asked = [MONDAY + dt.timedelta(7 * i + 2) for i in (3, 8)]
    # files of weeks that no window holds can't be read any more, between the asked ones too
    for f in glob.glob(f"{path}/*/*.parquet"):
        day = dt.date.fromisoformat(os.path.basename(os.path.dirname(f)).split("=")[1])
        if not any(0 <= (d - day).days < 6 for d in asked):
            with open(f, "wb") as out:
                out.write(b"torn")
    got = windowed_forecasts(stored, run_dates=store.bounded(dates(spark, *asked)))
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "dynamicpruning" in plan
    want = windowed_forecasts(fc, run_dates=dates(spark, *asked)).select(*got.columns)
    for ext in glob.glob(f"{path}/*/.*.crc"):
        os.remove(ext)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect())) and len(want.collect()) == 4


def test_a_date_written_again_replaces_its_rows(spark, tmp_path):
    path = str(tmp_path / "fc")
    store.write_forecasts(spark.createDataFrame(weeks(3), SCHEMA), path)
    late = spark.createDataFrame([("C", MONDAY, 1, 9.0), ("C", None, 1, 1.0)], SCHEMA)
    store.write_forecasts(late, path)
    all_rows = store.write_forecasts(late, path)
    assert all_rows.count() == 3 * 2 - 1 + 1
    assert [r["model"] for r in all_rows.filter(f"forecast_date = '{MONDAY}'").collect()] == ["C"]
    assert windowed_forecasts(all_rows, run_dates=store.bounded(dates(spark))).collect() == []


def test_windows_that_overlap_hold_a_row_each(spark):
    fc = spark.createDataFrame(weeks(1), SCHEMA)
    days = [MONDAY + dt.timedelta(i) for i in range(-1, 8)]
    got = windowed_forecasts(fc, run_dates=dates(spark, *days, days[0])).collect()
    want = [(m, d, r) for m, d, _, _ in weeks(1) for r in days if 0 <= (r - d).days <= 5]
    assert sorted((r["model"], r["forecast_date"], r["run_date"]) for r in got) == sorted(want)
