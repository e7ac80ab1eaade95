"""Relative-skill weighted ensembles."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.numeric import ordered_mean, safe_div
from .averaging import weighted_average
from .criteria import evaluation_dates


class SkillResult(NamedTuple):
    weights: DataFrame
    ensemble: DataFrame


def _evaluation_of_runs(evaluation: DataFrame, forecasts: DataFrame, by: tuple[str, ...],
                        on_missing: str) -> DataFrame:
    """Evaluation rows of every run, those dated with the run's latest forecast date.

    A run whose date has no evaluation fails the job (``on_missing="error"``) or takes
    no part (``"skip"``).
    """
    if "report_date" not in evaluation.columns:
        if by:
            raise ValueError("batch weighting needs a report_date column in the evaluation")
        return evaluation
    dates = evaluation_dates(forecasts, by)
    if on_missing == "error":
        dated = evaluation.select(F.col("report_date").alias("_dated")).distinct()
        stop = F.raise_error(F.concat(F.lit("there is no evaluation dated "), F.col("report_date").cast("string")))
        dates = (dates.join(dated, dates["report_date"] == dated["_dated"], "left")
                 .withColumn("report_date", F.when(F.col("_dated").isNull(), stop.cast("date"))
                             .otherwise(F.col("report_date"))).drop("_dated"))
    elif on_missing != "skip":
        raise ValueError(f"on_missing is 'error' or 'skip', not {on_missing!r}")
    return evaluation.join(dates, "report_date")


def skill_weights(forecasts: DataFrame, evaluation: DataFrame, by: tuple[str, ...] = (),
                  continuous_weeks: int = 4, skill: str = "wis", history="All",
                  by_horizon: bool = False, on_missing: str = "error") -> DataFrame:
    """Inverse relative skill normalised within target variable and location.

    Weights of 0/0 are NULL and dropped later (R7), like R's NaN. Sums run over
    horizons and members in their order, so weights don't depend on how rows arrive.
    """
    name = f"rel_{skill}"
    if name not in evaluation.columns:                                       # S2
        raise ValueError(f"evaluations have no column {name}")
    ev = evaluation
    if "weeks_included" in ev.columns:                                       # R2
        ev = ev.filter(F.col("weeks_included") == str(history)).drop("weeks_included")
    cell = [*by, "target_variable", "location"]
    rows = (_evaluation_of_runs(ev, forecasts, by, on_missing)
            .withColumn("relative_skill", F.col(name).try_cast("double"))
            .filter((F.col("continuous_weeks") >= continuous_weeks) & F.col("relative_skill").isNotNull())
            .join(forecasts.select(*by, "model").distinct(), [*by, "model"], "left_semi"))  # R3
    if by_horizon:
        cell = [*cell, "horizon"]
        skills = rows.select("model", *cell, "relative_skill")
    else:                                                                    # R4
        skills = rows.groupBy("model", *cell).agg(ordered_mean("relative_skill", "horizon").alias("relative_skill"))
    inverse = F.when(F.col("relative_skill") > 0, 1.0 / F.col("relative_skill")).otherwise(F.lit(0.0))  # R5
    members = Window.partitionBy(*cell).orderBy("model").rowsBetween(
        Window.unboundedPreceding, Window.unboundedFollowing)
    return (skills.withColumn("_inverse", inverse)
            .withColumn("weight", safe_div("_inverse", F.sum("_inverse").over(members)))  # R6
            .select("model", *cell, "weight"))


def relative_skill_ensemble(forecasts: DataFrame, evaluation: DataFrame,
                            by: tuple[str, ...] = (), continuous_weeks: int = 4,
                            average: str = "mean", skill: str = "wis", history="All",
                            by_horizon: bool = False,
                            estimator: str = "harrell_davis", on_missing: str = "error") -> SkillResult:
    """Weights, then the weighted average per (quantile, target, location, horizon).

    The ensemble ignores target_end_date (T16) and counts rows in ``n_models``,
    weight-0 members included.
    """
    weights = skill_weights(forecasts, evaluation, by, continuous_weeks, skill, history, by_horizon,
                            on_missing)
    join = [*by, "target_variable", "location"] + (["horizon"] if by_horizon else []) + ["model"]
    fs = (forecasts.join(weights, join, "inner")                             # R7
          .filter(F.col("weight").isNotNull() & ~F.isnan("weight")))
    keys = [*by, "quantile", "target_variable", "location", "horizon"]
    ens = weighted_average(keys, fs.select(*keys, "value", "weight"), average, estimator)  # R8
    return SkillResult(weights, ens)


def weighted_ensembles(forecasts: DataFrame, weights: dict[bool, DataFrame], methods: dict[tuple[bool, str], str],
                       by: tuple[str, ...] = (), estimator: str = "harrell_davis") -> DataFrame:
    """R7/R8 for several methods, rows labelled ``method``.

    ``weights``: by_horizon -> weights; ``methods``: (by_horizon, average) -> label. Each forecast
    meets its weights once and is repeated for every way of weighting that has one.
    """
    joined, found = forecasts, []
    for h, w in weights.items():
        keys = [*by, "model", "target_variable", "location", *(["horizon"] if h else [])]
        joined = joined.join(w.withColumnRenamed("weight", f"_w{int(h)}"), keys, "left")
        found.append(F.struct(F.lit(h).alias("by_horizon"), F.col(f"_w{int(h)}").alias("weight")))
    rows = (joined.withColumn("_f", F.explode(F.array(*found)))
            .select(*by, "quantile", "target_variable", "location", "horizon", "value", "_f.*")
            .filter(F.col("weight").isNotNull() & ~F.isnan("weight")))
    cell = [*by, "quantile", "target_variable", "location", "horizon", "by_horizon"]
    out = None
    for average in sorted({a for _, a in methods}):
        part = weighted_average(cell, rows, average, estimator)
        label = None
        for (h, a), m in methods.items():
            if a == average:
                test = F.col("by_horizon") == h
                label = F.when(test, m) if label is None else label.when(test, m)
        part = part.withColumn("method", label).filter(F.col("method").isNotNull()).drop("by_horizon")
        out = part if out is None else out.unionByName(part)
    return out


def update_inclusion(criteria: DataFrame, weights: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    """Models without any weight are marked as not included (by model only)."""
    weighted = weights.select(*by, "model").distinct().withColumn("_w", F.lit(True))
    return (criteria.join(weighted, [*by, "model"], "left")
            .withColumn("included_in_ensemble",
                        F.when(F.col("_w").isNull(), F.lit(False)).otherwise(F.col("included_in_ensemble")))
            .drop("_w"))
