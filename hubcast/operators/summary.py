"""Score summaries.

One plan summarises any number of report dates, over all history unless a number of
weeks is given: counts, coverage, bias and pair sums are running sums over report
weeks (``history``), so a score row is read and summed once however many reports
hold it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..config import HubConfig
from ..functions.numeric import round_decimal
from . import history, pairwise
from .history import Visible, visible

CELL = ("model", "target_variable", "location", "horizon")
SUMMARY_COLUMNS = ("model", "target_variable", "horizon", "location", "rel_ae", "rel_wis",
                   "msr_baseline", "cov_50", "cov_95", "bias", "n", "n_loc", "location_name")
ROUNDED = ("bias", "rel_wis", "msr_baseline", "rel_ae", "cov_50", "cov_95")
OVERALL = "Overall"
METRICS = ("ae", "wis")
PAIR = ["target_variable", "horizon", "location", "a", "b"]
PAIR_SUMS = pairwise.sum_names(METRICS)
SEP = "\u0001"  # joins model names to one key


def overall_flags(v: Visible) -> DataFrame:
    """M3/M4 for "Overall": per (report, model, target, horizon) the number of location names
    the model covers and whether it keeps an "Overall" row (at least half of the target's)."""
    per_model = history.distinct_count(v, v.rows, ["model", "target_variable", "horizon"], "location_name", "n_loc")
    nall = history.distinct_count(v, v.rows, ["target_variable"], "location_name", "_nall")
    return (per_model.join(nall, ["report_date", "target_variable"])
            .withColumn("keep_overall", F.col("n_loc") >= F.col("_nall") / 2).drop("_nall"))


def kept_models(flags: DataFrame) -> DataFrame:
    """(report_date, target_variable, horizon, kept): the models with an "Overall" row, as a sorted
    array; its length is bounded by the hub's members."""
    return (flags.filter("keep_overall").groupBy("report_date", "target_variable", "horizon")
            .agg(F.array_sort(F.collect_set("model")).alias("kept")))


def with_overall(events: DataFrame, keys: list[str], sums: list[str]) -> DataFrame:
    """M2: changes by location and, summed over locations, for "Overall"."""
    rest = [k for k in keys if k != "location"]
    whole = history.total(events, rest, sums).withColumn("location", F.lit(OVERALL))
    return events.unionByName(whole)


def keep_overall(df: DataFrame, kept: DataFrame, models: list[str]) -> DataFrame:
    """M4: drops "Overall" rows of models that don't keep one."""
    whole = F.col("location") == OVERALL
    test = ~whole
    inside = whole
    for m in models:
        inside = inside & F.coalesce(F.array_contains("kept", F.col(m)), F.lit(False))
    return (df.join(kept, ["report_date", "target_variable", "horizon"], "left")
            .filter(test | inside).drop("kept"))


def rollup(v: Visible) -> DataFrame:
    """M2: rows and WIS sum by report, location ("Overall" included) and target."""
    keys = ["location", "target_variable"]
    sums = {"n_rows": F.lit(1), "sum_wis": F.coalesce("wis", F.lit(0.0)), "_n": F.when(F.col("wis").isNull(), 0).otherwise(1)}
    events = with_overall(history.changes(v.rows, keys, sums), keys, list(sums))
    r = history.running(events, keys, list(sums), v).filter("n_rows > 0")
    return r.select("report_date", *keys, "n_rows", F.when(F.col("_n") > 0, F.col("sum_wis")).alias("sum_wis"))


def cell_columns(scores: DataFrame, n_levels: int, bias_digits: int | None) -> dict[str, Column]:
    """What M8, M12 and M13 sum over the score rows of a cell."""
    full = F.col("n_quantiles") == n_levels
    # bias rounded to ``bias_digits`` is summed in grid steps, which keeps the sum exact
    bias = F.col("bias") if bias_digits is None else F.bround(F.col("bias") * _scale(bias_digits), 0)
    sums = {"n": F.lit(1), "_full": F.when(full, 1).otherwise(0),
            "_bias_n": F.when(full & F.col("bias").isNotNull(), 1).otherwise(0),
            "_bias": F.when(full, F.coalesce(bias, F.lit(0.0))).otherwise(0.0)}
    for c in sorted(c for c in scores.columns if c.startswith("cov_")):
        sums |= {c: F.coalesce(c, F.lit(0.0)), f"_{c}": F.when(F.col(c).isNull(), 0).otherwise(1)}
    return sums


def _scale(bias_digits: int | None) -> Column:
    return F.lit(1.0 if bias_digits is None else 10.0 ** bias_digits)


def cell_means(sums: DataFrame, bias_digits: int | None) -> DataFrame:
    """M8, M12, M13 from the sums of ``cell_columns`` by (report_date, CELL)."""
    covs = sorted(c for c in sums.columns if c.startswith("cov_"))
    means = [F.when(F.col(f"_{c}") > 0, F.col(c) / F.col(f"_{c}")).alias(c) for c in covs]
    mean_bias = F.when((F.col("_full") > 0) & (F.col("_bias_n") == F.col("_full")),
                       F.col("_bias") / (F.col("_full") * _scale(bias_digits)))
    return sums.filter("n > 0").select("report_date", *CELL, "n", *means, mean_bias.alias("bias"))


def cell_sums(v: Visible, n_levels: int, bias_digits: int | None) -> DataFrame:
    """M8, M12, M13 as running sums by report and (model, target, location, horizon); "Overall"
    is summed over locations, whether a model keeps it or not."""
    sums = cell_columns(v.rows, n_levels, bias_digits)
    events = with_overall(history.changes(v.rows, list(CELL), sums), list(CELL), list(sums))
    return cell_means(history.running(events, list(CELL), list(sums), v), bias_digits)


def location_counts(v: Visible, flags: DataFrame) -> DataFrame:
    """M3: distinct location names per (model, target, location, horizon), "Overall" included."""
    return with_overall_counts(history.distinct_count(v, v.rows, list(CELL), "location_name", "n_loc"), flags)


def with_overall_counts(own: DataFrame, flags: DataFrame) -> DataFrame:
    """Counts of single locations with those of "Overall" beside them."""
    whole = flags.filter("keep_overall").select("report_date", "model", "target_variable",
                                                F.lit(OVERALL).alias("location"), "horizon", "n_loc")
    return own.unionByName(whole)


def _streaks(present: DataFrame, cell: list[str], v: Visible) -> DataFrame:
    """(report_date, cell, model, streak) from (cell, model, forecast_date, enter, leave).

    Forecast dates of the cell are numbered; a model's dates in a row of numbers are an
    island, and its streak on a report day is its place in the island at the cell's latest
    date, if it has that one. In a cell (one horizon) a later forecast date never
    becomes visible before an earlier one. Windows hold one row per model and week.
    """
    dates = Window.partitionBy(*cell).orderBy("forecast_date")
    d = present.withColumn("_i", F.dense_rank().over(dates))
    model = Window.partitionBy(*cell, "model").orderBy("forecast_date")
    d = d.withColumn("_island", F.col("_i") - F.row_number().over(model))
    island = Window.partitionBy(*cell, "model", "_island").orderBy("forecast_date")
    numbered = Window.partitionBy(*cell).orderBy("_i")
    d = d.withColumns({"streak": F.row_number().over(island),
                       "day": F.min("enter").over(numbered.rangeBetween(0, 0)),
                       "_next": F.min("enter").over(numbered.rangeBetween(1, 1))})
    out = v.on_dates(history.until_next(d, F.col("_next"), v.last).select("report_date", *cell, "model", "streak"))
    # with a limited history a streak is no longer than the cell's visible dates
    seen = d.select(*cell, "forecast_date", "enter", "leave").distinct()
    n = history.distinct_count(v, seen, cell, "forecast_date", "_dates")
    return (out.join(n, ["report_date", *cell])
            .select("report_date", *cell, "model", F.least("streak", F.col("_dates").cast("int")).alias("streak")))


def continuous_weeks(v: Visible, base: DataFrame, kept: DataFrame) -> DataFrame:
    """M5: consecutive most recent forecast dates of every model and cell of ``base``.

    An "Overall" cell counts the dates of the models that keep a row on that report
    day; the few sets of such models are cells of their own.
    """
    present = v.rows.groupBy(*CELL, "forecast_date").agg(F.min("enter").alias("enter"), F.max("leave").alias("leave"))
    own = _streaks(present, ["location", "target_variable", "horizon"], v)
    sets = kept.withColumn("_set", F.array_join("kept", SEP))
    members = (sets.select("target_variable", "horizon", "_set", "kept").distinct()
               .select("target_variable", "horizon", "_set", F.explode("kept").alias("model")))
    whole = (present.groupBy("model", "target_variable", "horizon", "forecast_date")
             .agg(F.min("enter").alias("enter"), F.max("leave").alias("leave"))
             .join(members, ["model", "target_variable", "horizon"]))
    keys = ["target_variable", "horizon", "_set"]
    overall = (_streaks(whole, keys, v).join(sets.select("report_date", *keys), ["report_date", *keys])
               .withColumn("location", F.lit(OVERALL)).drop("_set"))
    streaks = own.unionByName(overall)
    return (base.select("report_date", *CELL).join(streaks, ["report_date", *CELL], "left")
            .select("report_date", *CELL, F.coalesce("streak", F.lit(0)).alias("continuous_weeks")))


def pair_events(rows: DataFrame, cfg: HubConfig) -> DataFrame:
    """Pair sums of both metrics by (PAIR, day) from rows with ``enter`` and ``leave``."""
    full = F.col("n_quantiles") == cfg.n_quantiles
    metrics = {"ae": F.col("ae_median"), "wis": F.when(full, F.col("wis"))}
    return pairwise.pair_changes(rows, PAIR[:3], ["forecast_date", "location_name"], metrics)


class Parts:
    """The pieces that a summary is made of, each a lazy table over all report days."""

    def __init__(self, scores: DataFrame, report_date=None, report_dates: DataFrame | None = None,
                 history_weeks: int | None = None, cfg: HubConfig = HubConfig(), bias_digits: int | None = None):
        self.cfg = cfg
        self.v = visible(scores, report_date, report_dates, history_weeks, cfg.forecast_week_day)   # M1
        self.flags = overall_flags(self.v)                                                     # M3, M4
        self.kept = kept_models(self.flags)
        self.base = keep_overall(cell_sums(self.v, cfg.n_quantiles, bias_digits), self.kept, ["model"])  # M2, M8-M13

    def continuous_weeks(self) -> DataFrame:
        return continuous_weeks(self.v, self.base, self.kept)                                  # M5

    def pairs(self) -> DataFrame:
        """Pair sums by report day for every location and "Overall"."""
        events = pair_events(self.v.rows, self.cfg)
        running = history.running(with_overall(events, PAIR, PAIR_SUMS), PAIR, PAIR_SUMS, self.v)
        return keep_overall(running, self.kept, ["a", "b"])


def summarise_scores(scores: DataFrame, report_date=None, report_dates: DataFrame | None = None,
                     history_weeks: int | None = None, restrict_weeks: int = 0,
                     cfg: HubConfig = HubConfig(), with_continuous_weeks: bool = False,
                     round_output: bool = True, bias_digits: int | None = None) -> DataFrame:
    """M1-M16 (and M17 with ``with_continuous_weeks``): one row per report date and
    (model, target_variable, horizon, location).

    ``bias_digits`` is for scores whose bias is rounded to so many digits (1 in score
    tables of ``score_forecasts``): its mean is then free of summation error.
    """
    p = Parts(scores, report_date, report_dates, history_weeks, cfg, bias_digits)
    cw = p.continuous_weeks() if restrict_weeks > 0 or with_continuous_weeks else None
    return assemble(p.base, p.pairs(), location_counts(p.v, p.flags), scores.select("location", "location_name").distinct(),
                    cfg, cw, restrict_weeks, with_continuous_weeks, round_output)


def assemble(base: DataFrame, pairs: DataFrame, counts: DataFrame, locations: DataFrame, cfg: HubConfig,
             cw: DataFrame | None = None, restrict_weeks: int = 0, with_continuous_weeks: bool = False,
             round_output: bool = True) -> DataFrame:
    """The summary from its pieces, each keyed by report date."""
    keys = ["report_date", *CELL]
    if restrict_weeks > 0:                                                           # M6
        enough = cw.filter(F.col("continuous_weeks") >= restrict_weeks)
        base = base.join(enough.select(*keys), keys, "left_semi")
        rest = ["report_date", "target_variable", "horizon", "location"]
        models = enough.groupBy(*rest).agg(F.collect_set("model").alias("_in"))
        pairs = (pairs.join(models, rest)
                 .filter(F.array_contains("_in", F.col("a")) & F.array_contains("_in", F.col("b"))).drop("_in"))
    rel = pairwise.relative_skill(pairs, ["report_date", "target_variable", "horizon", "location"], list(METRICS),
                         cfg.baseline_model)
    rel = rel.select(*keys, "rel_ae", "rel_wis", F.col("msr_wis").alias("msr_baseline"))  # M9-M11
    out = (base.join(rel, keys, "left").join(counts, keys, "left")                   # M14
           .join(locations, "location", "left"))                                     # M15
    if round_output:                                                                 # M16
        out = out.withColumns({c: round_decimal(c, 2) for c in ROUNDED if c in out.columns})
    cols = ["report_date", *[c for c in SUMMARY_COLUMNS if c in out.columns]]
    if with_continuous_weeks:                                                        # M17
        out = (out.join(cw, keys, "left")
               .withColumn("continuous_weeks", F.coalesce(F.col("continuous_weeks"), F.lit(0))))
        cols.append("continuous_weeks")
    return out.select(*cols)


def evaluation_table(scores: DataFrame, report_dates: DataFrame | None = None, report_date=None,
                     history_weeks: int | None = None, cfg: HubConfig = HubConfig(),
                     bias_digits: int | None = None) -> DataFrame:
    """Summary plus ``continuous_weeks`` and ``weeks_included`` ("All" or k)."""
    s = summarise_scores(scores, report_date, report_dates, history_weeks, 0, cfg,
                         with_continuous_weeks=True, bias_digits=bias_digits)
    label = "All" if history_weeks is None else str(int(history_weeks))
    return s.withColumn("weeks_included", F.lit(label))
