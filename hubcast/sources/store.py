"""Forecasts stored by date (S1, D10): runs and batches read the days of their windows only.

One folder per ``forecast_date``. Writing replaces the dates that come in and leaves the others,
so a week's submissions are one write. ``bounded`` gives a table of run dates the range that it covers as
a filter: a batch that joins the windows of these dates prunes the other folders while it runs.

Defined cases: rows without a forecast date take part in no window and are not stored; a date
that is written again replaces its earlier rows, also with the same rows; no run dates: no rows are read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def write_forecasts(forecasts: DataFrame, path: str) -> DataFrame:
    """Store ``forecasts`` by date and return the whole store. Dates with many rows are split over tasks."""
    (forecasts.filter(F.col("forecast_date").isNotNull()).hint("rebalance", F.col("forecast_date"))
     .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("forecast_date").parquet(path))
    return read_forecasts(forecasts.sparkSession, path, forecasts.schema)


def read_forecasts(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """The store at ``path``; with the schema given no file is opened before the dates are pruned."""
    return spark.read.schema(schema).parquet(path)


def bounded(run_dates: DataFrame) -> DataFrame:
    """``run_dates`` with the range they cover as a filter, which lets a join on their windows prune the store."""
    first, last = run_dates.agg(F.min("run_date"), F.max("run_date")).first()
    return run_dates.filter(F.col("run_date").between(F.lit(first).cast("date"), F.lit(last).cast("date")))
