"""Forecast scoring (G0-G15): weighted interval score and its parts, coverage,
absolute error of the median, bias and quantile count.

All metrics share one grouping (the forecast unit), so the whole table is ONE
hash aggregate: partial aggregation per input partition, one shuffle on the
unit keys, no joins between metric tables.

The interval score is decomposed per quantile row instead of pairing rows
into intervals first. For the central interval of level alpha with bounds
(l, u), the two rows together contribute alpha*(u-l) + 2(l-y)+ + 2(y-u)+
(each row carries alpha/2 * IS, and 2/alpha * alpha/2 = 1), so the lower row
can carry -alpha*l and 2(l-y)+, the upper row +alpha*u and 2(y-u)+. The
median row contributes (m-y)+ + (y-m)+. The unit's score is the mean over its
rows; a missing partner (one-sided interval) or a missing prediction makes
the unit's score NULL.

Sums are kept in hundredths: every interval level alpha is a whole percent,
so with integer-valued predictions each partial sum is an exact integer and
the score is one correctly rounded division (order of summation cannot change
the result, which keeps later half-even rounding stable).

Which interval sides are present and which configured levels a unit has are
kept as bit masks (ranges 0-99; the hub's levels), so the aggregate holds
only fixed-width numbers: a code-generated hash aggregate with partial
aggregation, no per-group collections.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import HUB_QUANTILES
from ..functions.numeric import round_half_even
from ..schemas import UNIT_KEYS

# Levels off the hub's list up to which they get a place in the bit masks.
MAX_OTHER_LEVELS = 256
SCORE_COLUMNS = ("model", "target_variable", "forecast_date", "target_end_date", "horizon",
                 "location", "location_name", "wis", "sharpness", "underprediction",
                 "overprediction", "ae_median", "bias", "cov_50", "cov_95", "n_quantiles")


def point_to_median(fc: DataFrame) -> DataFrame:
    """G2 as a row operator: quantile rows, with the 0.5 row taken from the point
    forecast when the median is missing (a present median wins).

    Only the 0.5/point rows go through an aggregate (on all other columns,
    null-safe by grouping semantics); other levels pass through.
    """
    other = [c for c in fc.columns if c not in ("type", "quantile", "prediction")]
    is_point = F.col("type") == "point"
    at_median = is_point | ((F.col("type") == "quantile") & (F.col("quantile") == 0.5))
    med = (fc.filter(at_median).groupBy(*other)
             .agg(F.coalesce(F.max(F.when(~is_point, F.col("prediction"))),
                             F.max(F.when(is_point, F.col("prediction")))).alias("prediction"))
             .withColumn("type", F.lit("quantile"))
             .withColumn("quantile", F.lit(0.5)))
    rest = fc.filter((F.col("type") == "quantile") & ~at_median)
    return rest.unionByName(med.select(*fc.columns))


def other_levels(fc: DataFrame, levels=HUB_QUANTILES, at_most: int = MAX_OTHER_LEVELS) -> list[float] | None:
    """The quantile levels of ``fc`` that are not among ``levels``, in order; None if more than ``at_most``.

    A census of one column, summed up before it is shuffled; the driver gets a bounded list.
    """
    tau = F.when(F.col("type") == "point", F.lit(0.5)).otherwise(F.col("quantile"))
    found = (fc.filter(F.col("type").isin("quantile", "point")).select(tau.alias("tau"))
             .filter(~F.col("tau").isin([float(x) for x in levels])).distinct().limit(at_most + 1).collect())
    return sorted(r.tau for r in found) if len(found) <= at_most else None


def score_forecasts(fc: DataFrame, quantiles=None, round_output: bool = True,
                    levels=HUB_QUANTILES, others: Sequence[float] | None = None) -> DataFrame:
    """G1-G15 on the scoring input F4 (``prediction``, ``true_value``).

    ``levels`` are the hub's quantile levels and ``others`` all further ones that occur
    (``other_levels``): a unit's distinct levels are counted with bit masks over both. Without
    ``others`` (None) levels off the list are counted by a distinct aggregate, which sorts every row by its
    level first. The location's name is a key of the unit like its code (G1, G14).
    """
    distinct, levels = others is None, [*levels, *(others or [])]
    y, q = F.col("true_value"), F.col("prediction")
    is_point = F.col("type") == "point"
    d = fc.filter(F.col("true_value").isNotNull()                                  # G3
                  & F.col("type").isin("quantile", "point"))
    d = d.withColumn("_tau", F.when(is_point, F.lit(0.5)).otherwise(F.col("quantile")))  # G2
    if quantiles is not None:                                                      # G4
        d = d.filter(F.bround("_tau", 3).isin([round(float(x), 3) for x in quantiles]))
    tau = F.col("_tau")
    rng = F.bround(F.abs(F.lit(1.0) - 2 * tau) * 100, 0)                          # G5
    alpha_pct = F.lit(100.0) - rng
    interval_row = ~is_point & (rng > 0)
    lower = interval_row & (tau < 0.5)
    upper = interval_row & (tau > 0.5)
    med_q = ~is_point & (rng == 0)

    rng_i = rng.cast("int")
    level_pos = F.array_position(F.array(*[F.lit(float(x)) for x in levels]), tau)

    def bits(cond, pos, lo, hi):
        """bit_or of 1 << (pos - lo) over rows with ``cond`` and lo <= pos < hi."""
        return F.bit_or(F.when(cond & (pos >= lo) & (pos < hi),
                               F.call_function("shiftleft", F.lit(1).cast("long"), pos - lo)))

    side_masks = [bits(side, rng_i, lo, lo + 50).alias(f"_{name}{lo}")
                  for name, side in (("lo", lower), ("up", upper)) for lo in (0, 50)]
    words = range(0, len(levels), 62)
    level_masks = [bits(level_pos > 0, (level_pos - 1).cast("int"), lo, lo + 62).alias(f"_lv{lo}") for lo in words]
    if distinct:
        level_masks.append(F.count_distinct(F.when(level_pos == 0, tau)).alias("_lvother"))
    g = d.groupBy(*UNIT_KEYS, "location_name").agg(
        F.max(y).alias("_y"),
        F.max(F.when(med_q, q)).alias("_mq"),
        F.max(F.when(is_point, q)).alias("_mp"),
        F.count(F.when(med_q | is_point, 1)).alias("_nmed"),
        F.count(F.when(interval_row, 1)).alias("_nint"),
        F.count(F.when(interval_row & q.isNull(), 1)).alias("_nnull"),
        F.sum(F.when(lower, -alpha_pct * q).when(upper, alpha_pct * q)).alias("_disp"),
        F.sum(F.when(lower, 200 * F.greatest(q - y, F.lit(0.0)))).alias("_over"),
        F.sum(F.when(upper, 200 * F.greatest(y - q, F.lit(0.0)))).alias("_under"),
        F.count(F.when(lower, 1)).alias("_nlo"),
        F.count(F.when(upper, 1)).alias("_nup"),
        *side_masks,
        F.max(F.when(lower & (rng == 50), q)).alias("_l50"),
        F.max(F.when(upper & (rng == 50), q)).alias("_u50"),
        F.max(F.when(lower & (rng == 95), q)).alias("_l95"),
        F.max(F.when(upper & (rng == 95), q)).alias("_u95"),
        F.max(F.when(interval_row & (q <= y), tau)).alias("_below"),
        F.min(F.when(interval_row & (q >= y), tau)).alias("_above"),
        F.min_by(F.when(lower, q), F.when(lower, rng)).alias("_lin"),
        F.min_by(F.when(upper, q), F.when(upper, rng)).alias("_uin"),
        *level_masks,
    )
    n_levels = F.col("_lvother") if distinct else F.lit(0)
    for lo in words:
        n_levels = n_levels + F.coalesce(F.bit_count(f"_lv{lo}"), F.lit(0))
    n_levels = n_levels.cast("long")                                              # G13
    paired = ((F.col("_nlo") == F.col("_nup"))
              & F.col("_lo0").eqNullSafe(F.col("_up0"))
              & F.col("_lo50").eqNullSafe(F.col("_up50")))
    yv = F.col("_y")
    has_med = F.col("_nmed") > 0
    m = F.coalesce(F.col("_mq"), F.col("_mp"))
    med_over = F.when(has_med, 100 * F.greatest(m - yv, F.lit(0.0))).otherwise(F.lit(0.0))
    med_under = F.when(has_med, 100 * F.greatest(yv - m, F.lit(0.0))).otherwise(F.lit(0.0))
    n_rows = F.col("_nint") + F.when(has_med, 1).otherwise(0)
    valid = (paired & (F.col("_nnull") == 0) & (n_rows > 0)
             & (~has_med | m.isNotNull()))

    def mean_part(total_pct):
        return F.when(valid, total_pct / (n_rows * 100.0))

    disp = F.coalesce(F.col("_disp"), F.lit(0.0))
    over = F.coalesce(F.col("_over"), F.lit(0.0)) + med_over
    under = F.coalesce(F.col("_under"), F.lit(0.0)) + med_under

    def cov(lo, hi):
        return F.when(F.col(lo).isNull() | F.col(hi).isNull(), F.lit(None).cast("double")) \
                .otherwise(((F.col(lo) <= yv) & (yv <= F.col(hi))).cast("double"))

    centre = F.when(has_med, m).otherwise((F.col("_lin") + F.col("_uin")) / 2)     # G12
    below = F.greatest(F.col("_below"), F.when(has_med & (m <= yv), F.lit(0.5)))
    above = F.least(F.col("_above"), F.when(has_med & (m >= yv), F.lit(0.5)))
    bias = (F.when(centre.isNull(), F.lit(None).cast("double"))
             .when(yv == centre, F.lit(0.0))
             .when(yv < centre, 1 - 2 * F.coalesce(below, F.lit(0.0)))
             .otherwise(1 - 2 * F.coalesce(above, F.lit(1.0))))

    scored = g.select(
        *UNIT_KEYS, "location_name",
        mean_part(disp + over + under).alias("wis"),                               # G7
        mean_part(disp).alias("sharpness"),                                        # G8
        mean_part(under).alias("underprediction"),                                 # G9
        mean_part(over).alias("overprediction"),                                   # G10
        F.when(has_med, F.abs(m - yv)).alias("ae_median"),                        # G11
        bias.alias("bias"),
        cov("_l50", "_u50").alias("cov_50"),                                       # G6
        cov("_l95", "_u95").alias("cov_95"),
        n_levels.alias("n_quantiles"))
    if round_output:                                                               # G15
        scored = scored.withColumns({
            "bias": round_half_even("bias", 1),
            **{c: round_half_even(c, 0) for c in ("wis", "sharpness", "underprediction",
                                                  "overprediction")}})
    return scored.select(*SCORE_COLUMNS)
