import datetime as dt

from conftest import rows
from hubcast.config import HubConfig
from hubcast.operators.criteria import completeness, ensemble_criteria, rel_wis_flags
from hubcast.plans.runs import windowed_forecasts

D = dt.date
FC = ("model string, forecast_date date, target_variable string, horizon int, "
      "temporal_resolution string, target_end_date date, location string, location_name string, "
      "type string, quantile double, value double")


def _row(model, h, q, ted=D(2021, 3, 13), fd=D(2021, 3, 8), loc="L"):
    return (model, fd, "inc case", h, "wk", ted, loc, "Land", "quantile", q, 1.0)


def test_all_quantiles_every_date(spark):  # fixture 25
    cfg = HubConfig(quantiles=(0.25, 0.5, 0.75), horizons=(1, 2))
    data = [_row("A", 1, q) for q in (0.25, 0.5, 0.75)] + \
           [_row("A", 2, q, ted=D(2021, 3, 20)) for q in (0.25, 0.5)] + \
           [_row("B", h, q, ted=D(2021, 3, 6) + dt.timedelta(7 * h)) for h in (1, 2) for q in (0.25, 0.5, 0.75)]
    got = dict(rows(completeness(spark.createDataFrame(data, FC), cfg), "model", "all_quantiles_all_horizons"))
    assert got == {"A": False, "B": True}


def test_horizon_fallback(spark):  # fixture 26
    cfg = HubConfig(quantiles=(0.5,), horizons=(1, 2, 3, 4), ensemble_horizons=None)
    data = [_row("A", h, 0.5, ted=D(2021, 3, 6) + dt.timedelta(7 * h)) for h in (1, 2, 3)]
    assert rows(completeness(spark.createDataFrame(data, FC), cfg), "all_horizons") == [(False,)]
    cfg3 = cfg.with_(ensemble_horizons=(1, 2, 3))
    assert rows(completeness(spark.createDataFrame(data, FC), cfg3), "all_horizons") == [(True,)]


def test_rel_wis_cutoff(spark):  # fixture 27
    grid = spark.createDataFrame([("A", "inc case", "L"), ("B", "inc case", "L"), ("C", "inc case", "L")],
                                 "model string, target_variable string, location string")
    fc = spark.createDataFrame([_row("A", 1, 0.5)], FC)
    ev = spark.createDataFrame(
        [(D(2021, 3, 8), m, "inc case", "L", h, v)
         for m, vs in (("A", (0.9, 0.95)), ("B", (0.9, 1.0))) for h, v in enumerate(vs)],
        "report_date date, model string, target_variable string, location string, horizon int, rel_wis double")
    got = dict(rows(rel_wis_flags(grid, fc, ev, 1.0), "model", "rel_wis"))
    assert got == {"A": True, "B": False, "C": False}
    assert dict(rows(rel_wis_flags(grid, fc, ev.limit(0), 1.0), "model", "rel_wis")) == \
        {"A": True, "B": True, "C": True}


def test_own_ensemble_and_designations(spark):  # fixture 28, C8
    cfg = HubConfig(quantiles=(0.5,), horizons=(1,))
    data = [_row(m, 1, 0.5) for m in ("hub-ensemble", "hub-baseline", "X-other", "Y-nometa")]
    des = spark.createDataFrame([("hub-ensemble", "primary"), ("hub-baseline", "secondary"),
                                 ("X-other", "other")], "model string, designation string")
    res = ensemble_criteria(spark.createDataFrame(data, FC), cfg, designations=des)
    assert rows(res.criteria, "model", "included_in_ensemble") == [("hub-baseline", True)]
    assert rows(res.forecasts, "model") == [("hub-baseline",)]


def test_manual_exclusion_by_date(spark):
    cfg = HubConfig(quantiles=(0.5,), horizons=(1,))
    d = D(2021, 3, 8)
    data = [_row(m, 1, 0.5, fd=d) for m in ("A", "B")]
    win = windowed_forecasts(spark.createDataFrame(data, FC), run_date=d)
    ex = spark.createDataFrame([("A", d), ("B", D(2021, 3, 1))], "model string, forecast_date date")
    res = ensemble_criteria(win, cfg, ("run_date",), exclude_models=ex, exclude_designated_other=False)
    assert dict(rows(res.criteria, "model", "not_excluded_manually")) == {"A": False, "B": True}


def test_six_day_window(spark):  # fixture 29
    d = D(2021, 3, 14)
    data = [_row("A", 1, 0.5, fd=d - dt.timedelta(days=k)) for k in (6, 5, 0)]
    fc = spark.createDataFrame(data, FC)
    single = rows(windowed_forecasts(fc, run_date=d), "forecast_date")
    batch = rows(windowed_forecasts(fc, run_dates=spark.createDataFrame([(d,)], "run_date date")),
                 "forecast_date")
    assert single == batch == [(d - dt.timedelta(days=5),), (d,)]
