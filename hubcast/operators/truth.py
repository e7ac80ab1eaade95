"""Truth transforms: daily-to-weekly conversion (D2-D8), status (D9), truth join."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.dates import saturday_of_week, week_end

AGGREGATION_VARS = ("date", "value", "status", "snapshot_date", "type")


def convert_to_weekly(df: DataFrame, week_end_day: str = "Saturday", tail_rows: int = 7) -> DataFrame:
    """One row per series and week; the latest observation stands for the week.

    Ids are all columns except date/value/status/snapshot_date/type (plan-time).
    Windows run over one series or one of its weeks. For the last rows of a location every
    task sends its own ``tail_rows`` only (Spark limits the ranked groups before the shuffle).

    Row order matters in the original ("last 7 rows of a location"); here the
    order is explicit: date descending, then ids descending (T6).
    """
    agg_vars = [c for c in df.columns if c in AGGREGATION_VARS]
    ids = [c for c in df.columns if c not in agg_vars]
    if "location" not in ids:
        raise ValueError("convert_to_weekly needs a location column")
    d = df.withColumn("sat_date", week_end("date", week_end_day))
    week = Window.partitionBy(*ids, "sat_date")
    series = Window.partitionBy(*ids)
    d = d.withColumn("n", F.count(F.lit(1)).over(week))                                  # D3
    d = d.withColumn("frequency", F.when(F.max("n").over(series) == 1, "weekly")         # D4
                     .otherwise("daily"))
    recent = Window.partitionBy("location").orderBy(F.col("date").desc(), *[F.col(c).desc() for c in ids])
    tails = (d.withColumn("_rn", F.row_number().over(recent)).filter(F.col("_rn") <= tail_rows)
             .groupBy("location").agg(F.max("n").alias("_tailmax")))
    d = d.join(tails.withColumnRenamed("location", "_of"), F.col("location").eqNullSafe(F.col("_of"))).drop("_of")
    d = d.filter((F.col("n") == F.col("_tailmax")) | (F.col("frequency") == "weekly"))  # D5
    moved = (F.col("frequency") == "weekly") & (F.date_add("date", 6) == F.col("sat_date"))
    d = d.withColumn("date", F.when(moved, F.date_add("date", 6)).otherwise(F.col("date")))  # D6
    d = d.withColumn("_last", F.max("date").over(week))
    d = d.filter(F.col("date") == F.col("_last"))                                       # D7
    d = d.withColumn("date", saturday_of_week("date"))                                  # D8
    return d.drop("sat_date", "n", "frequency", "_tailmax", "_last")


def add_status(df: DataFrame, status: DataFrame) -> DataFrame:
    """Left join on (target_variable, location, target_end_date); missing -> "final".

    The status table is truth-sized, so the join strategy is left to AQE.
    Duplicate status keys fan out, as in the original.
    """
    keys = ["target_variable", "location", "target_end_date"]
    st = status.select(*keys, "status")
    return df.join(st, keys, "left").fillna("final", subset=["status"])


def attach_truth(forecasts: DataFrame, truth: DataFrame, broadcast: bool = False) -> DataFrame:
    """Scoring input (F4): ``prediction`` plus ``true_value`` (NULL when not yet observed).

    ``broadcast`` is for a caller that has checked the size of the truth series
    (location x target x week): the forecasts then stay where they are.
    """
    keys = ["target_variable", "location", "target_end_date"]
    t = truth.select(*keys, F.col("value").alias("true_value"))
    return (forecasts.withColumnRenamed("value", "prediction")
            .join(F.broadcast(t) if broadcast else t, keys, "left"))
