"""Running state over report weeks.

A score row becomes visible on a report day and, with a limited history, leaves
again on a later one. Everything a report needs is therefore a running sum: rows are
summed once per (key, day), a window over those sums carries them forward, and a
value holds until the next day on which its key changes. No score is copied to the
report dates that include it, however long the history.

Sums that leave again are subtracted, so they are exact where the summed values are
(counts, and the rounded scores of a score table, are whole numbers).
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.dates import week_end




class Visible(NamedTuple):
    """Score rows with ``enter`` and ``leave`` (first report day without the row, or NULL)."""
    rows: DataFrame
    last: Column  # last report day
    dates: DataFrame | None  # the report days asked for; None: the one day ``last``

    def on_dates(self, df: DataFrame) -> DataFrame:
        if self.dates is None:
            return df
        # one row per report week: bounded by the calendar, not by the data
        return df.join(F.broadcast(self.dates), "report_date", "left_semi")


def visible(scores: DataFrame, report_date=None, report_dates: DataFrame | None = None,
            history_weeks: int | None = None, report_weekday: str = "Monday") -> Visible:
    """M1: a report of day R holds rows with forecast_date <= R-7 and target_end_date <= R.

    ``history_weeks`` = k keeps only target end dates in the k weeks up to R
    (target_end_date > R - 7k); None is all history. ``report_dates`` are days on
    ``report_weekday``; a single ``report_date`` can be any day.
    """
    seen = F.greatest(F.date_add("forecast_date", 7), F.col("target_end_date"))
    never = F.lit(None).cast("date")
    gone = never if history_weeks is None else F.date_add("target_end_date", 7 * int(history_weeks))
    if report_dates is None:
        day = F.lit(str(report_date)[:10]).cast("date")
        rows = scores.filter((seen <= day) & (gone.isNull() | (gone > day)))
        return Visible(rows.withColumns({"enter": day, "leave": never}), day, None)
    dates = report_dates.select("report_date").distinct()
    rows = scores.withColumns({"enter": week_end(seen, report_weekday),
                               "leave": never if history_weeks is None else week_end(gone, report_weekday)})
    rows = rows.filter(F.col("leave").isNull() | (F.col("enter") < F.col("leave")))
    return Visible(rows, dates.agg(F.max("report_date")).scalar(), dates)


def changes(rows: DataFrame, keys: list[str], sums: dict[str, Column]) -> DataFrame:
    """(keys, day, sums): what enters and what leaves, summed by day."""
    per = rows.groupBy(*keys, "enter", "leave").agg(*[F.sum(c).alias(n) for n, c in sums.items()])
    both = F.array(F.struct(F.col("enter").alias("day"), F.lit(1).alias("sign")),
                   F.struct(F.col("leave").alias("day"), F.lit(-1).alias("sign")))
    steps = F.explode(F.filter(both, lambda s: s["day"].isNotNull()))
    return (per.withColumn("_s", steps).groupBy(*keys, F.col("_s.day").alias("day"))
            .agg(*[F.sum(F.col(n) * F.col("_s.sign")).alias(n) for n in sums]))


def total(events: DataFrame, keys: list[str], sums: list[str]) -> DataFrame:
    """Changes of coarser keys."""
    return events.groupBy(*keys, "day").agg(*[F.sum(n).alias(n) for n in sums])


def until_next(df: DataFrame, following: Column, last: Column) -> DataFrame:
    """One row per report day from ``day`` to the week before ``following`` (or ``last``)."""
    end = F.coalesce(F.date_sub(following, 7), last)
    days = F.when(F.col("day") <= end, F.sequence(F.col("day"), end, F.expr("INTERVAL 7 DAYS")))
    return df.withColumn("report_date", F.explode(days))


def running(events: DataFrame, keys: list[str], sums: list[str], v: Visible) -> DataFrame:
    """(report_date, keys, sums): running sums of ``events`` on every report day."""
    order = Window.partitionBy(*keys).orderBy("day")
    upto = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    state = events.select(*keys, "day", *[F.sum(n).over(upto).alias(n) for n in sums],
                          F.lead("day").over(order).alias("_next"))
    return v.on_dates(until_next(state, F.col("_next"), v.last).select("report_date", *keys, *sums))


def distinct_count(v: Visible, rows: DataFrame, keys: list[str], member: str, name: str) -> DataFrame:
    """(report_date, keys, ``name``): distinct visible values of ``member`` (NULL not counted).

    A member counts from the day its rows become more than none until they are none.
    """
    of = [*keys, member]
    counts = changes(rows.filter(F.col(member).isNotNull()), of, {"_n": F.lit(1)})
    order = Window.partitionBy(*of).orderBy("day")
    now = F.sum("_n").over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    state = counts.withColumn("_now", (now > 0).cast("int"))
    state = state.withColumn("_step", F.col("_now") - F.coalesce(F.lag("_now").over(order), F.lit(0)))
    steps = state.groupBy(*keys, "day").agg(F.sum("_step").cast("long").alias(name))
    return running(steps, keys, [name], v)
