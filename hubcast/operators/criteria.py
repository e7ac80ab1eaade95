"""Model-inclusion criteria.

The completeness checks (all quantiles at every target end date, all
horizons) are one two-level aggregate: the first level folds each
(model, target, location, target end date) into a bit mask of the required
quantile levels and horizons present, the second level ANDs and ORs those
masks. No distinct-count, no self join.
"""

from __future__ import annotations

import math
import warnings
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import HubConfig

GRID_KEYS = ("model", "target_variable", "location")


class CriteriaResult(NamedTuple):
    forecasts: DataFrame
    criteria: DataFrame


def _masks(values, col: Column, name: str) -> tuple[list[Column], Column]:
    """Aggregates that mark which ``values`` occur, 62 to a word, and the test that all do."""
    pos = F.array_position(F.array(*[F.lit(v) for v in values]), col) - 1
    words, full = [], F.lit(True)
    for lo in range(0, len(values), 62):
        n = min(62, len(values) - lo)
        bit = F.call_function("shiftleft", F.lit(1).cast("long"), (pos - lo).cast("int"))
        words.append(F.bit_or(F.when((pos >= lo) & (pos < lo + n), bit).otherwise(F.lit(0).cast("long"))).alias(f"{name}{lo}"))
        full = full & (F.col(f"{name}{lo}") == (1 << n) - 1)
    return words, full


def completeness(fc: DataFrame, cfg: HubConfig, by: tuple[str, ...] = ()) -> DataFrame:
    """``all_quantiles_all_horizons`` and ``all_horizons`` per grid key."""
    keys = [*by, *GRID_KEYS]
    levels, all_levels = _masks(cfg.quantiles, F.col("quantile"), "_q")
    horizons, all_horizons = _masks(cfg.required_horizons, F.col("horizon"), "_h")
    names = [f"_h{lo}" for lo in range(0, len(cfg.required_horizons), 62)]
    per_date = fc.groupBy(*keys, "target_end_date").agg(*levels, *horizons)
    return (per_date.withColumn("_all", all_levels).groupBy(*keys)
            .agg(F.bool_and("_all").alias("all_quantiles_all_horizons"), *[F.bit_or(n).alias(n) for n in names])
            .withColumn("all_horizons", all_horizons).drop(*names))


def manual_flags(grid: DataFrame, exclude_models=None, by: tuple[str, ...] = ()) -> DataFrame:
    """``not_excluded_manually``.

    A list excludes models on every run; a (model, forecast_date) table
    excludes a model only on the run dated ``forecast_date`` (needs
    ``run_date`` in ``by``).
    """
    if exclude_models is None:
        return grid.withColumn("not_excluded_manually", F.lit(True))
    if isinstance(exclude_models, DataFrame):
        if "run_date" not in by:
            raise ValueError("date-specific exclusions need run_date among the keys")
        ex = (exclude_models.select("model", F.col("forecast_date").alias("run_date"))
              .distinct().withColumn("_excluded", F.lit(True)))
        return (grid.join(ex, ["model", "run_date"], "left")
                .withColumn("not_excluded_manually", F.col("_excluded").isNull())
                .drop("_excluded"))
    names = list(exclude_models)
    flag = ~F.col("model").isin(names) if names else F.lit(True)
    return grid.withColumn("not_excluded_manually", flag)


def evaluation_dates(fc: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    """Evaluation date of a run = its latest forecast date (one row per run)."""
    return fc.groupBy(*by).agg(F.max("forecast_date").alias("report_date"))


def rel_wis_flags(grid: DataFrame, fc: DataFrame, evaluation: DataFrame | None,
                  cutoff: float, by: tuple[str, ...] = ()) -> DataFrame:
    """TRUE when every non-missing rel_wis of the cell is below ``cutoff``.

    No evaluation row for the cell gives FALSE; no evaluation at all for the
    run's date gives TRUE (the missing-file case); a non-finite cut-off gives TRUE.
    """
    if cutoff is None or not math.isfinite(cutoff):
        return grid.withColumn("rel_wis", F.lit(True))
    if evaluation is None:
        warnings.warn("no evaluation table; not excluding any model by relative WIS")
        return grid.withColumn("rel_wis", F.lit(True))
    single = not by
    if single:
        grid, fc, by = grid.withColumn("_run", F.lit(0)), fc.withColumn("_run", F.lit(0)), ("_run",)
    dates = evaluation_dates(fc, by)
    present = evaluation.select("report_date").distinct().withColumn("_has_eval", F.lit(True))
    runs = dates.join(present, "report_date", "left")
    ev = (evaluation.filter(F.col("rel_wis").isNotNull())
          .join(runs.select(*by, "report_date"), "report_date")
          .groupBy(*by, *GRID_KEYS)
          .agg(F.bool_and(F.col("rel_wis") < cutoff).alias("_below")))
    out = (grid.join(runs.select(*by, "_has_eval"), list(by), "left")
           .join(ev, [*by, *GRID_KEYS], "left"))
    flag = F.when(F.col("_has_eval").isNull(), F.lit(True)).otherwise(
        F.coalesce(F.col("_below"), F.lit(False)))
    out = out.withColumn("rel_wis", flag).drop("_has_eval", "_below")
    return out.drop("_run") if single else out


def ensemble_criteria(forecasts: DataFrame, cfg: HubConfig = HubConfig(),
                      by: tuple[str, ...] = (), exclude_models=None,
                      exclude_designated_other: bool = True,
                      designations: DataFrame | None = None,
                      evaluation: DataFrame | None = None,
                      rel_wis_cutoff: float = math.inf) -> CriteriaResult:
    """The criteria grid and the forecasts of included cells.

    Without run keys the whole input is one run, keyed by a constant column.
    """
    single = not by
    if single:
        forecasts, by = forecasts.withColumn("_run", F.lit(0)), ("_run",)
    fc = forecasts.filter(F.col("type") == "quantile")                      # C1
    grid = completeness(fc, cfg, by)                                         # C2-C4, C10
    fc = fc.filter(F.col("horizon").isin(list(cfg.required_horizons)))       # C5
    grid = manual_flags(grid, exclude_models, by)                            # C6
    grid = grid.filter(~F.col("model").rlike(cfg.ensemble_pattern))         # C7
    if exclude_designated_other:                                             # C8
        if designations is None:
            raise ValueError("designations are needed to drop models designated 'other'")
        keep = designations.filter(F.col("designation") != "other").select("model").distinct()
        grid = grid.join(F.broadcast(keep), "model", "left_semi")
    grid = rel_wis_flags(grid, fc, evaluation, rel_wis_cutoff, by)           # C9
    included = (F.col("all_quantiles_all_horizons") & F.col("all_horizons")
                & F.col("not_excluded_manually") & F.col("rel_wis"))
    grid = grid.withColumn("included_in_ensemble", F.coalesce(included, F.lit(False)))  # C11
    grid = grid.select(*by, *GRID_KEYS, "all_quantiles_all_horizons", "all_horizons",
                       "not_excluded_manually", "rel_wis", "included_in_ensemble")
    include = grid.filter("included_in_ensemble").select(*by, *GRID_KEYS, "included_in_ensemble")
    kept = fc.join(include, [*by, *GRID_KEYS], "inner")                      # C12
    if single:
        return CriteriaResult(kept.drop("_run"), grid.drop("_run"))
    return CriteriaResult(kept, grid)
