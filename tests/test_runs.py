import datetime as dt

import pytest

from pyspark.sql import functions as F

from conftest import SMALL, rows
from hubcast.plans import catalog
from hubcast.plans.runs import run_ensemble, run_multiple_ensembles


@pytest.fixture(scope="module")
def hub(spark):
    return catalog.Hub(spark, SMALL)


def test_batch_equals_union_of_single_runs(hub, spark):
    h = hub
    dates = [r.run_date for r in h.run_dates.orderBy("run_date").limit(3).collect()]
    rd = spark.createDataFrame([(d,) for d in dates], "run_date date")
    kw = dict(exclude_models=h.exclusions, designations=h.designations)
    batch = run_multiple_ensembles(h.forecasts, ["mean", "median"], rd, **kw).ensemble
    singles = None
    for d in dates:
        for m in ("mean", "median"):
            part = run_ensemble(h.forecasts, m, d, **kw).ensemble.withColumn("method", F.lit(m))
            singles = part if singles is None else singles.unionByName(part)
    cols = batch.columns
    assert rows(batch, *cols) == rows(singles.select(*cols), *cols)


def test_mean_ensemble_within_member_range_and_monotone(hub, spark):
    h = hub
    ens = catalog.ensemble_mean(spark, SMALL)
    bad = (ens.groupBy("run_date", "target_variable", "location", "horizon", "target_end_date")
           .agg(F.array_sort(F.collect_list(F.struct("quantile", "value"))).alias("qs"))
           .filter(F.exists(F.sequence(F.lit(1), F.size("qs") - 1),
                            lambda i: F.element_at("qs", i)["value"] > F.element_at("qs", i + 1)["value"])))
    assert bad.count() == 0
    assert h.forecasts.count() > 0


def test_skill_weights_sum_to_one(hub):
    w = hub.skill().weights
    sums = w.groupBy("run_date", "target_variable", "location").agg(F.sum("weight").alias("s"))
    assert sums.filter(F.abs(F.col("s") - 1) > 1e-5).count() == 0


def test_single_relative_skill_run_by_hand(spark):
    d = dt.date(2021, 3, 8)
    cfg = catalog.HubConfig(quantiles=(0.5,), horizons=(1,))
    fc = spark.createDataFrame(
        [(m, d, "inc case", 1, "wk", dt.date(2021, 3, 13), "L", "Land", "quantile", 0.5, v)
         for m, v in (("A", 10.0), ("B", 40.0), ("C", 70.0))],
        "model string, forecast_date date, target_variable string, horizon int, "
        "temporal_resolution string, target_end_date date, location string, location_name string, "
        "type string, quantile double, value double")
    ev = spark.createDataFrame(
        [(d, m, "inc case", 1, "L", s, 5) for m, s in (("A", 0.5), ("B", 1.0))],
        "report_date date, model string, target_variable string, horizon int, location string, "
        "rel_wis double, continuous_weeks int")
    des = spark.createDataFrame([(m, "primary") for m in "ABC"], "model string, designation string")
    run = run_ensemble(fc, "relative_skill", d, cfg=cfg, designations=des, evaluation=ev)
    assert rows(run.ensemble, "type", "quantile", "value", "target", "target_end_date") == [
        ("point", None, 20.0, "1 wk ahead inc case", dt.date(2021, 3, 13)),
        ("quantile", 0.5, 20.0, "1 wk ahead inc case", dt.date(2021, 3, 13))]
    w = dict(rows(run.weights, "model", "weight"))
    assert abs(w["A"] - 2 / 3) < 1e-12 and abs(w["B"] - 1 / 3) < 1e-12 and "C" not in w
    assert dict(rows(run.criteria, "model", "included_in_ensemble")) == {"A": True, "B": True, "C": False}


def test_batch_of_skill_methods_equals_single_runs(hub, spark):
    """Ensembles, criteria (R11) and weights of every method, for dates with an evaluation."""
    h = hub
    d = h.run_dates.filter("run_date > '1996-06-01'").agg(F.min("run_date")).first()[0]
    rd = spark.createDataFrame([(d,)], "run_date date")
    methods = ["median", "relative_skill", "relative_skill_by_horizon_median"]
    kw = dict(exclude_models=h.exclusions, designations=h.designations, evaluation=h.evaluation, estimator="type7")
    batch = run_multiple_ensembles(h.forecasts, methods, rd, **kw)
    for m in methods:
        one = run_ensemble(h.forecasts, m, d, **kw)
        for part in ("ensemble", "criteria", "weights"):
            want = getattr(one, part)
            cols = want.columns
            assert rows(getattr(batch, part).filter(F.col("method") == m), *cols) == rows(want, *cols), (m, part)


def test_run_without_evaluation_stops(hub):
    h = hub
    first = h.run_dates.agg(F.min("run_date")).first()[0]
    run = run_ensemble(h.forecasts, "relative_skill", first, designations=h.designations, evaluation=h.evaluation)
    with pytest.raises(Exception, match="no evaluation dated"):
        run.ensemble.collect()
