"""Unweighted and weighted ensembles.

``by`` is a tuple of extra key columns (``run_date``, ``method``) that every
grouping carries, so one plan can build many ensembles at once.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.nulls import strict, strict_avg, strict_median
from ..functions.numeric import ordered_sum, round_half_even, safe_div
from ..functions.quantiles import harrell_davis, type7
from ..schemas import GROUP_KEYS_AVERAGE

ESTIMATORS = {"harrell_davis": harrell_davis, "type7": type7}
MIN_MODEL_KEYS = ("location", "horizon", "temporal_resolution", "target_variable", "target_end_date")


def normalise_forecasts(df: DataFrame) -> DataFrame:
    """Quantile rows only, levels rounded to 3 digits, integer horizon."""
    return (df.filter(F.col("type") == "quantile")
              .withColumn("quantile", round_half_even("quantile", 3))
              .withColumn("horizon", F.col("horizon").try_cast("int")))


def min_models(df: DataFrame, k: int, by: tuple[str, ...] = ()) -> DataFrame:
    """Keep groups with at least ``k`` distinct models.

    Counting happens on an aggregate (partial per partition, then merged), and
    the result filters the forecasts through a semi join chosen by AQE.
    """
    if k is None or k <= 1:
        return df
    keys = [*by, *MIN_MODEL_KEYS]
    ok = (df.groupBy(*keys).agg(F.count_distinct("model").alias("_n"))
            .filter(F.col("_n") >= k).drop("_n"))
    ok = ok.select(*[F.col(c).alias(f"_k_{c}") for c in keys])
    # groups with a missing key are groups too (null-safe match)
    cond = [df[c].eqNullSafe(ok[f"_k_{c}"]) for c in keys]
    return df.join(ok, cond, "left_semi")


def ensemble_average(df: DataFrame, method: str = "mean", by: tuple[str, ...] = ()) -> DataFrame:
    """Mean or exact median per ensemble cell; ``forecasts`` counts rows.

    A NULL value makes the cell NULL, as in R without ``na.rm``.
    """
    if method == "mean":
        agg = strict_avg("value")
    elif method == "median":
        agg = strict_median("value")
    else:
        raise ValueError(f"unknown average {method!r}; expected 'mean' or 'median'")
    return (df.groupBy(*by, *GROUP_KEYS_AVERAGE)
              .agg(F.count(F.lit(1)).alias("forecasts"), agg.alias("value")))


def ensemble_averages(df: DataFrame, methods: list[str], by: tuple[str, ...] = ()) -> DataFrame:
    """E1/E2 for several averages from one aggregate, rows labelled ``method``."""
    aggregates = {"mean": strict_avg, "median": strict_median}
    found = df.groupBy(*by, *GROUP_KEYS_AVERAGE).agg(
        F.count(F.lit(1)).alias("forecasts"), *[aggregates[m]("value").alias(f"_{m}") for m in methods])
    each = F.explode(F.array(*[F.struct(F.lit(m).alias("method"), F.col(f"_{m}").alias("value")) for m in methods]))
    return (found.withColumn("_e", each)
            .select(*by, *GROUP_KEYS_AVERAGE, "forecasts", "_e.method", "_e.value"))


def equal_weights(df: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    """E5: 1 / (distinct models) per target variable and location."""
    cell = [*by, "target_variable", "location"]
    models = df.select(*cell, "model").distinct()
    return models.withColumn("weight", 1.0 / F.count(F.lit(1)).over(Window.partitionBy(*cell)))


def weighted_mean(keys: list[str], df: DataFrame, x: str = "value", w: str = "weight") -> DataFrame:
    """sum(x*w)/sum(w) per group (at most one row per member), in the order of value and weight;
    NULL x propagates, weights that sum to 0 give NULL."""
    return df.groupBy(*keys).agg(
        strict(safe_div(ordered_sum(F.col(x) * F.col(w), x, w), ordered_sum(w, x, w)), x).alias(x),
        F.count(F.lit(1)).alias("n_models"))


def weighted_median(keys: list[str], df: DataFrame, x: str = "value", w: str = "weight",
                    estimator: str = "harrell_davis", p: float = 0.5) -> DataFrame:
    """Weighted quantile ``p`` per group.

    A group is one ensemble cell, so it holds at most one row per model: one aggregate
    gathers its members in the order of their values, and the estimate is a fold over them
    (``functions.quantiles``), with Kish's effective size of the weights.

    * ``harrell_davis``: beta masses with a = p(n*+1), b = (1-p)(n*+1), by quadrature.
    * ``type7``: F(c) = clamp(c*n* - h + 1, 0, 1), h = p(n*-1) + 1.

    Members of weight 0 add nothing; a group of only such members is NULL.
    """
    if estimator not in ESTIMATORS:
        raise ValueError(f"unknown weighted median estimator {estimator!r}")
    member = F.struct(F.col(x).cast("double").alias("x"), F.coalesce(F.col(w).cast("double"), F.lit(0.0)).alias("w"))
    d = df.groupBy(*keys).agg(F.array_sort(F.collect_list(member)).alias("_members"), F.count(F.lit(1)).alias("n_models"),
                              F.count(x).alias("_known"))
    total = F.aggregate("_members", F.lit(0.0), lambda s, m: s + m["w"])
    squares = F.aggregate("_members", F.lit(0.0), lambda s, m: s + m["w"] * m["w"])
    d = d.withColumns({"_total": total, "_squares": squares})
    d = d.withColumn("_size", safe_div(F.col("_total") * F.col("_total"), "_squares"))
    known = (F.col("_known") == F.col("n_models")) & (F.col("_total") > 0)
    return ESTIMATORS[estimator](d, "_members", "_total", "_size", p).select(
        *keys, F.when(known, F.col("estimate")).alias(x), "n_models")


def weighted_average(keys: list[str], df: DataFrame, average: str = "mean",
                     estimator: str = "harrell_davis") -> DataFrame:
    if average == "mean":
        return weighted_mean(keys, df)
    if average == "median":
        return weighted_median(keys, df, estimator=estimator)
    raise ValueError(f"unknown average {average!r}")
