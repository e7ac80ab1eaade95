"""Registered queries: one per operator family of the blueprint, each over the
whole derived hub tables (every origin week, every run and report date).

Each function takes (spark, sf_dir) and returns a DataFrame whose column names
match the DuckDB oracle in ``hubcast.plans.oracle``. Ensembles run for every run
date in one plan, summaries for every report date over all history. Shared
tables (truth, scores, evaluation) are checkpointed while a query is built.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import HubConfig
from ..functions.dates import default_target_end_date, week_end
from ..functions.numeric import round_decimal
from .. import schemas
from ..session import cut_lineage, ensure_checkpoint_dir
from ..operators import averaging, criteria, scoring, skill, submission, summary, truth, upkeep
from ..sources import csvscan, files, hubdata, store
from . import runs

CFG = HubConfig()
# Relative-WIS cut-off and minimum model count used by the criteria queries.
REL_WIS_CUTOFF = 1.0
MIN_NMODELS = 5
# Weeks of the one summary with a limited history, and of the one that wants steady models.
WINDOW_WEEKS = 10
STEADY_WEEKS = 4
# Report weeks added one by one to a stored evaluation.
UPKEEP_WEEKS = 3
# Models left out by name, and horizons of the ensemble that takes fewer than the hub asks for.
LEFT_OUT = ("T-m1", "T-m6")
FEWER_HORIZONS = (1, 2)
# Levels of the scores on a subset of the quantiles.
SUBSET = (0.025, 0.25, 0.5, 0.75, 0.975)
# What is added to levels to move them off the hub's list; exact in binary.
OFF_LIST = (1 / 1024, 1 / 512)
# Rows of the truth series up to which it is broadcast to the forecasts; joined by key beyond.
BROADCAST_ROWS = 200_000
# Decimals of the Harrell-Davis medians: quadrature here, a power series in the SQL.
HD_DIGITS = 6


class Hub:
    """Hub tables of one scale factor, each made on first use.

    Truth, scores and evaluation are read by several branches of most plans;
    they are checkpointed when first asked for, which runs their jobs.
    Everything else is lazy.
    """

    def __init__(self, spark: SparkSession, sf_dir: str, cfg: HubConfig = CFG):
        self.spark, self.sf_dir, self.cfg = spark, sf_dir, cfg

    @cached_property
    def truth(self) -> DataFrame:
        return cut_lineage(hubdata.truth(self.spark, self.sf_dir, self.cfg))

    @cached_property
    def forecasts(self) -> DataFrame:
        return hubdata.forecasts(self.spark, self.sf_dir, self.cfg, truth_df=self.truth)

    @cached_property
    def designations(self) -> DataFrame:
        return hubdata.designations(self.spark)

    @cached_property
    def exclusions(self) -> DataFrame:
        return hubdata.exclusions(self.spark, self.sf_dir, self.cfg, truth_df=self.truth)

    @cached_property
    def run_dates(self) -> DataFrame:
        # forecast dates are origin weeks + 2 days: derived from the truth, not the forecasts
        return self.truth.select(F.date_add("target_end_date", 2).alias("run_date")).distinct()

    @property
    def report_dates(self) -> DataFrame:
        return self.run_dates.select(F.col("run_date").alias("report_date"))

    def window(self) -> DataFrame:
        return runs.windowed_forecasts(self.forecasts, run_dates=self.run_dates)

    def scoring_input(self) -> DataFrame:
        return truth.attach_truth(self.forecasts, self.truth, broadcast=self.truth.count() <= BROADCAST_ROWS)

    @cached_property
    def other_levels(self) -> list[float] | None:
        return scoring.other_levels(self.forecasts, self.cfg.quantiles)

    def scores(self, round_output: bool = True) -> DataFrame:
        return self._scores if round_output else scoring.score_forecasts(
            self.scoring_input(), round_output=False, levels=self.cfg.quantiles, others=self.other_levels)

    @cached_property
    def _scores(self) -> DataFrame:
        return cut_lineage(scoring.score_forecasts(self.scoring_input(), levels=self.cfg.quantiles,
                                                   others=self.other_levels))

    def parts(self) -> summary.Parts:
        return summary.Parts(self.scores(), report_dates=self.report_dates, cfg=self.cfg, bias_digits=1)

    def summary(self, history_weeks: int | None = None, restrict_weeks: int = 0) -> DataFrame:
        return summary.summarise_scores(self.scores(), report_dates=self.report_dates, history_weeks=history_weeks,
                                        restrict_weeks=restrict_weeks, cfg=self.cfg, bias_digits=1)

    @cached_property
    def evaluation(self) -> DataFrame:
        return cut_lineage(summary.evaluation_table(self.scores(), report_dates=self.report_dates, cfg=self.cfg,
                                                    bias_digits=1))

    def criteria(self, with_cutoff: bool = False, exclude_models=None,
                 cfg: HubConfig | None = None) -> criteria.CriteriaResult:
        return criteria.ensemble_criteria(
            self.window(), cfg or self.cfg, runs.BY,
            exclude_models=self.exclusions if exclude_models is None else exclude_models,
            designations=self.designations,
            evaluation=self.evaluation if with_cutoff else None,
            rel_wis_cutoff=REL_WIS_CUTOFF if with_cutoff else float("inf"))

    def ensemble_input(self, min_nmodels: int = 0) -> DataFrame:
        fc = averaging.normalise_forecasts(self.criteria().forecasts)
        return averaging.min_models(fc, min_nmodels, runs.BY)

    def skill(self, average: str = "mean", by_horizon: bool = False,
              estimator: str = "harrell_davis") -> skill.SkillResult:
        # the first weeks have no evaluation yet; their runs take no part
        return skill.relative_skill_ensemble(
            self.ensemble_input(), self.evaluation, runs.BY, continuous_weeks=4, average=average,
            by_horizon=by_horizon, estimator=estimator, on_missing="skip")

    def batch(self, methods=runs.METHODS) -> runs.EnsembleRun:
        return runs.run_multiple_ensembles(
            self.forecasts, methods, self.run_dates, cfg=self.cfg, exclude_models=self.exclusions,
            designations=self.designations, evaluation=self.evaluation, estimator="type7", on_missing="skip")


# --- dates and truth -------------------------------------------------------

def week_end_target(spark, sf):
    d = spark.read.parquet(f"{sf}/lineitem.parquet").select(F.to_date("l_shipdate").alias("date"))
    return d.distinct().select("date", week_end("date", CFG.week_end_day).alias("week_end"))


def week_end_forecast(spark, sf):
    d = spark.read.parquet(f"{sf}/lineitem.parquet").select(F.to_date("l_shipdate").alias("date"))
    return d.distinct().select("date", week_end("date", CFG.forecast_week_day).alias("week_end"))


def default_target_end(spark, sf):
    o = spark.read.parquet(f"{sf}/orders.parquet").select(F.to_date("o_orderdate").alias("forecast_date"))
    return (o.distinct().withColumn("horizon", F.explode(F.array(*[F.lit(h) for h in CFG.horizons])))
            .withColumn("target_end_date", default_target_end_date("forecast_date", "horizon")))


def weekly_truth(spark, sf):
    return truth.convert_to_weekly(hubdata.daily_truth(spark, sf), CFG.week_end_day)


def weekly_truth_mixed(spark, sf):
    """Daily series beside weekly ones that are dated six days before their week's end."""
    weekly = hubdata.truth(spark, sf, CFG).select(
        "location", "target_variable", F.date_sub("target_end_date", 6).alias("date"), "value")
    return truth.convert_to_weekly(hubdata.daily_truth(spark, sf).unionByName(weekly), CFG.week_end_day)


def truth_status(spark, sf):
    return truth.add_status(hubdata.truth(spark, sf, CFG), hubdata.status(spark, sf, CFG))


# --- submission layout and unweighted ensembles -------------------------------

def ensemble_mean(spark, sf):
    return averaging.ensemble_average(Hub(spark, sf).ensemble_input(), "mean", runs.BY)


def ensemble_median(spark, sf):
    return averaging.ensemble_average(Hub(spark, sf).ensemble_input(), "median", runs.BY)


def point_rows(spark, sf):
    return submission.add_point_forecasts(ensemble_mean(spark, sf))


def submission_format(spark, sf):
    ens = ensemble_median(spark, sf)
    return submission.format_ensemble(ens, F.col("run_date"), CFG.temporal_resolution)


def mean_submission(spark, sf):
    ens = ensemble_mean(spark, sf)
    return submission.format_ensemble(ens, F.col("run_date"), CFG.temporal_resolution)


def single_run(spark, sf):
    """The median ensemble of one run, the latest."""
    h = Hub(spark, sf)
    day = h.run_dates.agg(F.max("run_date")).first()[0]
    run = runs.run_ensemble(h.forecasts, "median", day, cfg=CFG, exclude_models=h.exclusions,
                            designations=h.designations)
    return run.ensemble


def min_models(spark, sf):
    fc = Hub(spark, sf).ensemble_input(MIN_NMODELS)
    return (fc.groupBy("run_date", *averaging.MIN_MODEL_KEYS)
            .agg(F.count_distinct("model").alias("n_models"), F.count(F.lit(1)).alias("n_rows")))


def equal_weights(spark, sf):
    return averaging.equal_weights(Hub(spark, sf).ensemble_input(), runs.BY)


# --- criteria ----------------------------------------------------------------

def criteria_quantiles(spark, sf):
    h = Hub(spark, sf)
    fc = h.window().filter(F.col("type") == "quantile")
    return criteria.completeness(fc, CFG, runs.BY).drop("all_horizons")


def criteria_horizons(spark, sf):
    h = Hub(spark, sf)
    fc = h.window().filter(F.col("type") == "quantile")
    return criteria.completeness(fc, CFG, runs.BY).drop("all_quantiles_all_horizons")


def criteria_grid(spark, sf):
    return Hub(spark, sf).criteria(with_cutoff=True).criteria


def criteria_rel_wis(spark, sf):
    return criteria_grid(spark, sf).select("run_date", *criteria.GRID_KEYS, "rel_wis")


def manual_exclusions_by_date(spark, sf):
    return Hub(spark, sf).criteria().criteria.select("run_date", *criteria.GRID_KEYS,
                                                     "not_excluded_manually")


def included_forecasts(spark, sf):
    fc = Hub(spark, sf).criteria(with_cutoff=True).forecasts
    return fc.select("run_date", "model", "forecast_date", "target_variable", "horizon", "target_end_date",
                     "location", "quantile", "value", "included_in_ensemble")


def criteria_left_out_by_name(spark, sf):
    return Hub(spark, sf).criteria(exclude_models=list(LEFT_OUT)).criteria


def included_fewer_horizons(spark, sf):
    fc = Hub(spark, sf).criteria(cfg=CFG.with_(ensemble_horizons=FEWER_HORIZONS)).forecasts
    return fc.select("run_date", "model", "target_variable", "horizon", "location", "quantile", "value")


# --- scoring -----------------------------------------------------------------

def point_to_median(spark, sf):
    fc = Hub(spark, sf).scoring_input()
    return (scoring.point_to_median(fc).filter(F.col("quantile") == 0.5)
            .select("model", "target_variable", "forecast_date", "target_end_date", "horizon",
                    "location", "location_name", "prediction", "true_value"))


def score_quantile_subset(spark, sf):
    h = Hub(spark, sf)
    s = scoring.score_forecasts(h.scoring_input(), quantiles=SUBSET, round_output=False, levels=CFG.quantiles,
                                others=h.other_levels)
    return s.select("model", "target_variable", "forecast_date", "target_end_date", "horizon", "location",
                    "wis", "ae_median", "cov_50", "cov_95", "n_quantiles")


def _unit_scores(spark, sf, cols):
    s = Hub(spark, sf).scores(round_output=False)
    return s.select("model", "target_variable", "forecast_date", "target_end_date", "horizon",
                    "location", *cols)


def interval_coverage(spark, sf):
    return _unit_scores(spark, sf, ["cov_50", "cov_95"])


def wis_components(spark, sf):
    return _unit_scores(spark, sf, ["wis", "sharpness", "underprediction", "overprediction"])


def ae_median(spark, sf):
    return _unit_scores(spark, sf, ["ae_median"])


def bias(spark, sf):
    return _unit_scores(spark, sf, ["bias"])


def n_quantiles(spark, sf):
    return _unit_scores(spark, sf, ["n_quantiles"])


def n_quantiles_off_list(spark, sf):
    """G13 where every level below the median also comes, twice, a little higher and off the hub's list."""
    fc = Hub(spark, sf).scoring_input()
    moved = F.when(F.col("quantile") < 0.5, F.array(*[F.lit(x) for x in (0.0, *OFF_LIST, *OFF_LIST)])).otherwise(F.array(F.lit(0.0)))
    fc = fc.withColumn("moved", F.explode(moved)).withColumn("quantile", F.col("quantile") + F.col("moved"))
    s = scoring.score_forecasts(fc, levels=CFG.quantiles, others=scoring.other_levels(fc, CFG.quantiles))
    return s.select("model", "target_variable", "forecast_date", "target_end_date", "horizon", "location", "n_quantiles")


def score_table(spark, sf):
    return Hub(spark, sf).scores()


# --- summaries ---------------------------------------------------------------

_CELL = ("report_date", "model", "target_variable", "horizon", "location")


def overall_rollup(spark, sf):
    return summary.rollup(Hub(spark, sf).parts().v)


def overall_half_locations(spark, sf):
    base = Hub(spark, sf).parts().base.filter(F.col("location") == summary.OVERALL)
    return base.select(*_CELL, F.col("n").alias("n_rows"))


def continuous_weeks(spark, sf):
    return Hub(spark, sf).parts().continuous_weeks()


def rel_ae(spark, sf):
    return Hub(spark, sf).summary().select(*_CELL, "rel_ae")


def rel_wis(spark, sf):
    return Hub(spark, sf).summary().select(*_CELL, "rel_wis")


def msr_baseline(spark, sf):
    return Hub(spark, sf).summary().select(*_CELL, "msr_baseline")


def summary_table(spark, sf):
    return Hub(spark, sf).summary()


def summary_window(spark, sf):
    return Hub(spark, sf).summary(history_weeks=WINDOW_WEEKS)


def summary_steady_models(spark, sf):
    return Hub(spark, sf).summary(restrict_weeks=STEADY_WEEKS)


def evaluation_table(spark, sf):
    return Hub(spark, sf).evaluation


def evaluation_upkeep(spark, sf):
    """The evaluation of all report days, of which the last weeks are added to a store one by one."""
    h = Hub(spark, sf)
    days = [r[0] for r in h.report_dates.orderBy("report_date").collect()]  # a row per week of the calendar
    folder = f"{ensure_checkpoint_dir(spark)}/evaluation-{uuid.uuid4().hex}"
    scores = upkeep.write_scores(h.scores(), f"{folder}/scores", CFG)
    store = upkeep.EvaluationStore(spark, f"{folder}/store", CFG, bias_digits=1)
    store.start(scores.drop(upkeep.VISIBLE_ON), spark.createDataFrame([(d,) for d in days[:-UPKEEP_WEEKS]], "report_date date"))
    for day in days[-UPKEEP_WEEKS:]:
        store.add(scores, day)
    return store.evaluation()


# --- relative-skill ensembles ----------------------------------------------------

def skill_weights(spark, sf):
    w = Hub(spark, sf).skill().weights
    return w.select("run_date", "model", "target_variable", "location", "weight")


def skill_weights_by_horizon(spark, sf):
    w = Hub(spark, sf).skill(by_horizon=True).weights
    return w.select("run_date", "model", "target_variable", "location", "horizon", "weight")


def _skill_ensemble(spark, sf, digits=None, **kw):
    e = Hub(spark, sf).skill(**kw).ensemble
    value = F.col("value") if digits is None else round_decimal("value", digits).alias("value")
    return e.select("run_date", "quantile", "target_variable", "location", "horizon", value, "n_models")


def ensemble_skill_mean(spark, sf):
    return _skill_ensemble(spark, sf)


def ensemble_skill_mean_by_horizon(spark, sf):
    return _skill_ensemble(spark, sf, by_horizon=True)


def ensemble_skill_type7_median(spark, sf):
    return _skill_ensemble(spark, sf, average="median", estimator="type7")


def ensemble_skill_hd_median(spark, sf):
    return _skill_ensemble(spark, sf, HD_DIGITS, average="median")


def ensemble_skill_hd_median_by_horizon(spark, sf):
    return _skill_ensemble(spark, sf, HD_DIGITS, average="median", by_horizon=True)


def skill_submission(spark, sf):
    e = Hub(spark, sf).skill().ensemble
    return submission.format_ensemble(e, F.col("run_date"), CFG.temporal_resolution)


def batch_runs(spark, sf):
    """Six methods for every run date in one plan (medians by the type-7 estimator).

    One row for each method, run, target and location with all its values, in the order of type and
    quantile.
    """
    rows = Hub(spark, sf).batch().ensemble
    ordered = F.array_sort(F.collect_list(F.struct("type", "quantile", "value")))
    text = F.transform(ordered, lambda r: F.coalesce(r["value"].cast("bigint").cast("string"), F.lit("NA")))
    return (rows.groupBy("method", "forecast_date", "target", "target_end_date", "location")
            .agg(F.count(F.lit(1)).alias("n_rows"), F.array_join(text, ",").alias("values")))


def batch_criteria(spark, sf):
    return Hub(spark, sf).batch().criteria


def batch_weights(spark, sf):
    """Weights of every method; horizon 0 stands for weights that hold for all horizons."""
    return Hub(spark, sf).batch().weights.withColumn("horizon", F.coalesce("horizon", F.lit(0)))


def stored_reruns(spark, sf):
    """The runs with a manual exclusion, computed again from forecasts stored by date."""
    h = Hub(spark, sf)
    stored = store.write_forecasts(h.forecasts, f"{ensure_checkpoint_dir(spark)}/forecasts-{uuid.uuid4().hex}")
    days = store.bounded(h.exclusions.select(F.col("forecast_date").alias("run_date")).distinct())
    run = runs.run_multiple_ensembles(stored, ("mean", "median"), days, cfg=CFG, exclude_models=h.exclusions,
                                      designations=h.designations)
    return run.ensemble


def csv_submissions(spark, sf):
    """All submissions written as CSV files in three layouts and read back by column name; a row per unit.

    Models take turns: the plain layout, one in another order, and one with a column of
    remarks that hold quotes, commas and line breaks.
    """
    fc = Hub(spark, sf).forecasts
    turn = F.pmod(F.crc32(F.col("model").cast("binary")), F.lit(3))
    label = submission.target_label("horizon", F.lit(CFG.temporal_resolution), "target_variable")
    plain = [f.name for f in schemas.SUBMISSION.fields]
    layouts = [plain, plain[::-1], ["remark", *plain[3:], *plain[:3]]]
    rows = cut_lineage(fc.select("model", turn.alias("turn"), label.alias("target"), *[c for c in plain if c != "target"],
                                 F.concat(F.lit('said "'), "location", F.lit('",\nthen left')).alias("remark")))
    folder = f"{ensure_checkpoint_dir(spark)}/submissions-{uuid.uuid4().hex}"
    for i, columns in enumerate(layouts):
        (rows.filter(F.col("turn") == i).select("model", *columns)
         .write.partitionBy("model").csv(f"{folder}/{i}", header=True, escape='"', nullValue="NA"))
    back = csvscan.read_by_name(spark, f"{folder}/*/*/*.csv", schemas.SUBMISSION)
    back = files.parse_target(back.withColumn("model", F.regexp_extract("_path", "/model=([^/]+)/", 1)))
    ordered = F.array_sort(F.collect_list(F.struct("type", "quantile", "value")))
    text = F.transform(ordered, lambda r: F.concat_ws(":", r["type"], r["quantile"].cast("decimal(4,3)").cast("string"),
                                                      r["value"].cast("bigint").cast("string")))
    return (back.groupBy("model", "forecast_date", "target_variable", "horizon", "temporal_resolution", "target_end_date", "location")
            .agg(F.count(F.lit(1)).alias("n_rows"), F.array_join(text, ",").alias("values")))


def csv_status(spark, sf):
    """Status files of three targets, statuses with line breaks and quotes, written and read back."""
    rows = cut_lineage(hubdata.status(spark, sf, CFG))
    text = F.when(F.col("status").isNotNull(), F.concat(F.lit('"open",\n'), "status"))
    folder = f"{ensure_checkpoint_dir(spark)}/status-{uuid.uuid4().hex}"
    paths = []
    for i, target in enumerate(("inc hosp", "inc case", "inc death")):
        columns = ["location", F.col("target_end_date").alias("date"), text.alias("status")]
        paths.append(f"{folder}/{i}")
        (rows.filter(F.col("target_variable") == target).select(*(columns[i:] + columns[:i]))
         .write.csv(paths[-1], header=True, escape='"'))
    return files.read_status(spark, *paths)


def submission_links(spark, sf):
    return files.preview_links(hubdata.changed_files(spark, sf), base_url=hubdata.PREVIEW_URL)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "week_end_target": week_end_target,
    "week_end_forecast": week_end_forecast,
    "default_target_end": default_target_end,
    "weekly_truth": weekly_truth,
    "weekly_truth_mixed": weekly_truth_mixed,
    "truth_status": truth_status,
    "point_rows": point_rows,
    "submission_format": submission_format,
    "mean_submission": mean_submission,
    "single_run": single_run,
    "ensemble_mean": ensemble_mean,
    "ensemble_median": ensemble_median,
    "min_models": min_models,
    "equal_weights": equal_weights,
    "criteria_quantiles": criteria_quantiles,
    "criteria_horizons": criteria_horizons,
    "criteria_rel_wis": criteria_rel_wis,
    "criteria_grid": criteria_grid,
    "included_forecasts": included_forecasts,
    "criteria_left_out_by_name": criteria_left_out_by_name,
    "included_fewer_horizons": included_fewer_horizons,
    "manual_exclusions_by_date": manual_exclusions_by_date,
    "point_to_median": point_to_median,
    "interval_coverage": interval_coverage,
    "wis_components": wis_components,
    "ae_median": ae_median,
    "bias": bias,
    "n_quantiles": n_quantiles,
    "n_quantiles_off_list": n_quantiles_off_list,
    "score_table": score_table,
    "score_quantile_subset": score_quantile_subset,
    "overall_rollup": overall_rollup,
    "overall_half_locations": overall_half_locations,
    "continuous_weeks": continuous_weeks,
    "rel_ae": rel_ae,
    "rel_wis": rel_wis,
    "msr_baseline": msr_baseline,
    "summary_table": summary_table,
    "summary_window": summary_window,
    "summary_steady_models": summary_steady_models,
    "evaluation_table": evaluation_table,
    "evaluation_upkeep": evaluation_upkeep,
    "skill_weights": skill_weights,
    "skill_weights_by_horizon": skill_weights_by_horizon,
    "ensemble_skill_mean": ensemble_skill_mean,
    "ensemble_skill_mean_by_horizon": ensemble_skill_mean_by_horizon,
    "ensemble_skill_type7_median": ensemble_skill_type7_median,
    "ensemble_skill_hd_median": ensemble_skill_hd_median,
    "ensemble_skill_hd_median_by_horizon": ensemble_skill_hd_median_by_horizon,
    "skill_submission": skill_submission,
    "batch_runs": batch_runs,
    "batch_criteria": batch_criteria,
    "batch_weights": batch_weights,
    "stored_reruns": stored_reruns,
    "submission_links": submission_links,
    "csv_submissions": csv_submissions,
    "csv_status": csv_status,
}
