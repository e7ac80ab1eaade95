"""Submission layout: point rows (P1) and ensemble formatting."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.dates import default_target_end_date
from ..functions.numeric import round_decimal

SUBMISSION_COLUMNS = ("forecast_date", "target", "target_end_date", "location", "type",
                      "quantile", "value")


def add_point_forecasts(df: DataFrame) -> DataFrame:
    """Every quantile-0.5 row is repeated as type "point" with a NULL quantile.

    One scan: each row explodes into one or two (type, quantile) variants, so
    there is no union and no second read of the input.
    """
    own = F.struct(F.col("type").alias("type"), F.col("quantile").alias("quantile"))
    point = F.struct(F.lit("point").alias("type"), F.lit(None).cast("double").alias("quantile"))
    variants = F.when(F.col("quantile") == 0.5, F.array(point, own)).otherwise(F.array(own))
    cols = [F.col(f"_tq.{c}").alias(c) if c in ("type", "quantile") else F.col(c)
            for c in df.columns]
    return df.withColumn("_tq", F.explode(variants)).select(*cols)


def _as_col(v) -> Column:
    if isinstance(v, Column):
        return v
    if isinstance(v, (dt.date, dt.datetime)):
        return F.lit(v.isoformat()[:10]).cast("date")
    if isinstance(v, str) and len(v) == 10 and v[4] == "-":
        return F.lit(v).cast("date")
    return F.col(v)


def target_label(horizon: str, resolution: Column, target_variable: str) -> Column:
    """``"<h> <res> ahead <variable>"``."""
    return F.concat_ws(" ", F.col(horizon).cast("int").cast("string"), resolution, F.lit("ahead"), F.col(target_variable))


def format_ensemble(ensemble: DataFrame, forecast_date, temporal_resolution: str = "wk",
                    by: tuple[str, ...] = ()) -> DataFrame:
    """Standard submission rows, values rounded half-to-even, point rows added.

    Rounding is half-even on the decimal value (``round_decimal``): a weighted
    mean that is exactly k + 0.5 rounds to even however its float sum was ordered.

    ``forecast_date`` is a date, an ISO string or a column (``run_date`` in
    batch runs). A ``temporal_resolution`` column wins over the argument, and
    ``target_end_date`` defaults to D11 when the ensemble has none.
    """
    fd = _as_col(forecast_date)
    cols = set(ensemble.columns)
    df = ensemble.withColumn("_fd", fd)
    if "target_end_date" not in cols:
        df = df.withColumn("target_end_date", default_target_end_date("_fd", "horizon"))
    if "type" not in cols:
        df = df.withColumn("type", F.lit("quantile"))
    res = F.col("temporal_resolution") if "temporal_resolution" in cols else F.lit(temporal_resolution)
    target = target_label("horizon", res, "target_variable")
    out = df.select(*[F.col(b) for b in by],
                    F.col("_fd").alias("forecast_date"), target.alias("target"),
                    "target_end_date", "location", "type", "quantile",
                    round_decimal("value", 0).alias("value"))
    return add_point_forecasts(out)
