"""Ensemble runs (X1) and batches of runs (X4) as one lazy plan.

A run is keyed by ``run_date``: the forecasts of the six days up to the run
date are tagged with it, and every operator groups by it. A batch of
dates is therefore the same plan with more keys, not a loop of jobs; methods are
branches of one union whose shared inputs (window, criteria) appear as
identical sub-plans that Spark's exchange reuse computes once.
"""

from __future__ import annotations

import datetime as dt
import math
from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import HubConfig
from ..operators.averaging import (ensemble_average, ensemble_averages, equal_weights, min_models,
                                   normalise_forecasts)
from ..operators.criteria import ensemble_criteria
from ..operators.skill import (relative_skill_ensemble, skill_weights, update_inclusion,
                               weighted_ensembles)
from ..operators.submission import format_ensemble

METHODS = ("mean", "median", "relative_skill", "relative_skill_by_horizon",
           "relative_skill_median", "relative_skill_by_horizon_median")
BY = ("run_date",)


class EnsembleRun(NamedTuple):
    ensemble: DataFrame
    criteria: DataFrame
    weights: DataFrame
    method: str
    forecast_date: object


def _date(d) -> dt.date:
    return d if isinstance(d, dt.date) else dt.date.fromisoformat(str(d)[:10])


def windowed_forecasts(forecasts: DataFrame, run_date=None, run_dates: DataFrame | None = None,
                       window_days: int = 6) -> DataFrame:
    """Forecasts of the ``window_days`` days up to each run date, tagged ``run_date``.

    Single date: a range filter (pushed to the scan / partition pruning).
    Many dates: each run date is exploded to the days of its window (six rows a run:
    bounded by the calendar, broadcast) and equi-joined on the forecast date, so forecasts
    stored by date are pruned to the windows while the plan runs. No range join, no forecast
    row is copied but to the runs that hold it.
    """
    if run_dates is None:
        d = _date(run_date)
        lo = d - dt.timedelta(days=window_days - 1)
        return (forecasts.filter(F.col("forecast_date").between(F.lit(lo.isoformat()).cast("date"),
                                                                 F.lit(d.isoformat()).cast("date")))
                .withColumn("run_date", F.lit(d.isoformat()).cast("date")))
    days = F.sequence(F.date_add("run_date", 1 - window_days), F.col("run_date"))
    windows = run_dates.select("run_date").distinct().select("run_date", F.explode(days).alias("forecast_date"))
    return forecasts.join(F.broadcast(windows), "forecast_date").select(*forecasts.columns, "run_date")


def _method_parts(method: str):
    if method in ("mean", "median"):
        return "average", False, method
    if method.startswith("relative_skill"):
        return "skill", "_by_horizon" in method, "median" if "_median" in method else "mean"
    raise ValueError(f"unknown ensemble method {method!r}; expected one of {METHODS}")


def ensemble_from_window(window: DataFrame, method: str, cfg: HubConfig = HubConfig(),
                         exclude_models=None, min_nmodels: int = 0,
                         exclude_designated_other: bool = True,
                         designations: DataFrame | None = None,
                         evaluation: DataFrame | None = None,
                         rel_wis_cutoff: float = math.inf, continuous_weeks: int = 4,
                         history="All", estimator: str = "harrell_davis",
                         identifier: str = "", on_missing: str = "error") -> EnsembleRun:
    """X1 body on forecasts already tagged with ``run_date`` (any number of runs)."""
    kind, by_horizon, average = _method_parts(method)
    crit = ensemble_criteria(window, cfg, BY, exclude_models, exclude_designated_other,
                             designations, evaluation, rel_wis_cutoff)
    fc = normalise_forecasts(crit.forecasts)                                         # E4
    fc = min_models(fc, min_nmodels, BY)                                             # E3
    criteria = crit.criteria
    if kind == "average":
        ens = ensemble_average(fc, average, BY)
        weights = equal_weights(fc, BY)
    else:
        if evaluation is None:
            raise ValueError("relative-skill ensembles need an evaluation table")
        res = relative_skill_ensemble(fc, evaluation, BY, continuous_weeks, average,
                                      history=history, by_horizon=by_horizon, estimator=estimator,
                                      on_missing=on_missing)
        ens, weights = res.ensemble, res.weights
        criteria = update_inclusion(criteria, weights, BY)                           # R11
    formatted = format_ensemble(ens, F.col("run_date"), cfg.temporal_resolution)
    label = f"{identifier}_{method}" if identifier else method
    return EnsembleRun(formatted, criteria, weights, label, None)


def run_ensemble(forecasts: DataFrame, method: str = "mean", forecast_date=None,
                 window_days: int = 6, **kw) -> EnsembleRun:
    """One ensemble for one run date (the submission window ends on it)."""
    d = _date(forecast_date)
    if isinstance(kw.get("exclude_models"), DataFrame):
        kw["exclude_models"] = kw["exclude_models"].filter(
            F.col("forecast_date") == F.lit(d.isoformat()).cast("date"))
    run = ensemble_from_window(windowed_forecasts(forecasts, d, window_days=window_days), method, **kw)
    return run._replace(forecast_date=d)


def run_multiple_ensembles(forecasts: DataFrame, methods, run_dates: DataFrame, cfg: HubConfig = HubConfig(),
                           window_days: int = 6, exclude_models=None, min_nmodels: int = 0,
                           exclude_designated_other: bool = True, designations: DataFrame | None = None,
                           evaluation: DataFrame | None = None, rel_wis_cutoff: float = math.inf,
                           continuous_weeks: int = 4, history="All",
                           estimator: str = "harrell_davis", on_missing: str = "error") -> EnsembleRun:
    """Every method for every run date in ONE plan, rows labelled ``method``.

    Equivalent to the single runs ``method-date``, with the criteria and weights of each. The
    included forecasts are built once: mean and median come from one aggregate, the relative-skill
    methods from one join that carries a weight for each way of weighting.
    """
    parts = [(m, *_method_parts(m)) for m in methods]
    window = windowed_forecasts(forecasts, run_dates=run_dates, window_days=window_days)
    crit = ensemble_criteria(window, cfg, BY, exclude_models, exclude_designated_other, designations,
                             evaluation, rel_wis_cutoff)
    fc = min_models(normalise_forecasts(crit.forecasts), min_nmodels, BY)
    ensembles, criteria, weights = [], [], []

    averages = [m for m, kind, _, _ in parts if kind == "average"]
    if averages:
        both = ensemble_averages(fc, averages, BY)
        ensembles.append(format_ensemble(both, F.col("run_date"), cfg.temporal_resolution, ("method",)))
        labels = F.explode(F.array(*[F.lit(m) for m in averages]))
        criteria.append(crit.criteria.withColumn("method", labels))
        weights.append(equal_weights(fc, BY).withColumn("method", labels))

    skilled = [x for x in parts if x[1] == "skill"]
    if skilled:
        if evaluation is None:
            raise ValueError("relative-skill ensembles need an evaluation table")
        tables = {h: skill_weights(fc, evaluation, BY, continuous_weeks, history=history, by_horizon=h,
                                   on_missing=on_missing) for h in sorted({x[2] for x in skilled})}
        out = weighted_ensembles(fc, tables, {(h, a): m for m, _, h, a in skilled}, BY, estimator)
        ensembles.append(format_ensemble(out, F.col("run_date"), cfg.temporal_resolution, ("method",)))
        for h, w in tables.items():
            labels = F.explode(F.array(*[F.lit(m) for m, _, own, _ in skilled if own == h]))
            criteria.append(update_inclusion(crit.criteria, w, BY).withColumn("method", labels))   # R11
            weights.append(w.withColumn("method", labels))

    def stack(tables: list[DataFrame]) -> DataFrame:
        out = tables[0]
        for t in tables[1:]:
            out = out.unionByName(t, allowMissingColumns=True)
        return out.select("method", *[c for c in out.columns if c != "method"])

    return EnsembleRun(stack(ensembles), stack(criteria), stack(weights), ",".join(methods), None)
