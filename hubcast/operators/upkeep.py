"""An evaluation that is kept up report by report.

A full evaluation reads all scores. The store keeps, beside the finished evaluation, what
the next report needs of the past: sums by cell, the location names met, pair sums, streaks
(one partition a report day, each the whole state of that day), and the forecast dates that
became visible (one partition a report day, only the new ones). A report day adds the scores that became visible since the
day before it, so the work of a week grows with the week's scores and with the number of cells and
pairs, not with the history.

Every table is partitioned by ``report_date`` and a day's partitions are overwritten
together, the day's mark in ``weeks`` last. A day that was interrupted counts as not done;
it is added again from the last marked day before it, and so is a day that is rerun.

Defined cases: a report covers all history. Forecast dates of a target and horizon must become
visible in their order, each on one report day (they do where the target end date follows
from forecast date and horizon); a date that comes later than that is an error, since pairs with earlier
rows would be missed. Scores that change after their day need ``start``. Null names of
locations count for no location. Without visible scores nothing is stored.
"""

from __future__ import annotations

import datetime as dt

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..config import HubConfig
from ..functions.dates import week_end
from . import summary
from .summary import CELL, OVERALL, PAIR, PAIR_SUMS

OWN = ["target_variable", "horizon", "location"]
WHOLE = ["target_variable", "horizon"]
VISIBLE_ON = "visible_on"  # partition column of stored scores: the report week of a row


def seen_on() -> Column:
    """M1: the first day on which a report holds a score row."""
    return F.greatest(F.date_add("forecast_date", 7), F.col("target_end_date"))


def write_scores(scores: DataFrame, path: str, cfg: HubConfig = HubConfig()) -> DataFrame:
    """Scores stored by the report week in which they become visible; ``add`` then reads the files of its weeks only."""
    (scores.withColumn(VISIBLE_ON, week_end(seen_on(), cfg.forecast_week_day)).repartition(VISIBLE_ON)
     .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(VISIBLE_ON).parquet(path))
    return scores.sparkSession.read.parquet(path)


def trailing(present: DataFrame, cell: list[str]) -> DataFrame:
    """(cell, model, streak, dates) from distinct (cell, model, forecast_date): the forecast dates that
    the model has without a gap up to the cell's latest, and the number of the cell's dates."""
    latest = Window.partitionBy(*cell).orderBy(F.col("forecast_date").desc())
    own = Window.partitionBy(*cell, "model").orderBy(F.col("forecast_date").desc())
    d = present.withColumns({"_r": F.dense_rank().over(latest), "_o": F.row_number().over(own)})
    d = d.withColumn("dates", F.max("_r").over(Window.partitionBy(*cell)))
    return d.groupBy(*cell, "model").agg(F.count(F.when(F.col("_r") == F.col("_o"), 1)).cast("int").alias("streak"),
                                         F.max("dates").alias("dates"))


class EvaluationStore:
    def __init__(self, spark: SparkSession, path: str, cfg: HubConfig = HubConfig(), bias_digits: int | None = None):
        self.spark, self.path, self.cfg, self.bias_digits = spark, path.rstrip("/"), cfg, bias_digits

    def evaluation(self) -> DataFrame:
        """The evaluations of all stored report days (columns of ``summary.evaluation_table``)."""
        return self.spark.read.parquet(f"{self.path}/evaluation")

    def start(self, scores: DataFrame, report_dates: DataFrame) -> None:
        """Evaluates all ``report_dates`` from the whole scores and stores the state of the last of them."""
        days = report_dates.select("report_date").distinct()
        last = days.agg(F.max("report_date")).first()[0]
        table = summary.evaluation_table(scores, report_dates=days.filter(F.col("report_date") < last), cfg=self.cfg,
                                         bias_digits=self.bias_digits)
        self._write("evaluation", table)
        self._add(scores, last, None)

    def add(self, scores: DataFrame, report_date: dt.date) -> None:
        """One report day; of ``scores`` only rows that became visible after the stored day before it are used."""
        weeks = self._read("weeks")
        before = None
        if weeks is not None:
            day = F.col("report_date")
            before, first = weeks.agg(F.max(F.when(day < F.lit(report_date), day)), F.min(day)).first()
            if before is None and first > report_date:
                raise ValueError(f"the store's first day is {first}: {report_date} can't be added before it")
        self._add(scores, report_date, before)

    def _read(self, table: str, day: dt.date | None = None) -> DataFrame | None:
        try:
            df = self.spark.read.parquet(f"{self.path}/{table}")
        except AnalysisException as e:
            if e.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
                return None
            raise
        return df if day is None else df.filter(F.col("report_date") == F.lit(day)).drop("report_date")

    def _write(self, table: str, df: DataFrame) -> None:
        (df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("report_date")
         .parquet(f"{self.path}/{table}"))

    def _put(self, table: str, df: DataFrame, day: dt.date) -> DataFrame:
        """Stores ``df`` as the table's partition of the day and goes on from the files."""
        self._write(table, df.withColumn("report_date", F.lit(day)))
        back = self._read(table, day)
        return df if back is None else back

    def _sum(self, table: str, new: DataFrame, keys: list[str], sums: list[str], day, before) -> DataFrame:
        old = None if before is None else self._read(table, before)
        if old is not None:
            new = old.unionByName(new).groupBy(*keys).agg(*[F.sum(c).alias(c) for c in sums])
        return self._put(table, new, day)

    def _new_rows(self, scores: DataFrame, day: dt.date, before: dt.date | None) -> DataFrame:
        rows = scores.filter(seen_on() <= F.lit(day))
        if before is not None:
            rows = rows.filter(seen_on() > F.lit(before))
        if VISIBLE_ON in scores.columns:  # prunes files: the report week of a row is not before the row is seen
            week = week_end(F.lit(day), self.cfg.forecast_week_day)
            rows = rows.filter(F.col(VISIBLE_ON) <= week)
            if before is not None:
                rows = rows.filter(F.col(VISIBLE_ON) > F.lit(before))
            rows = rows.drop(VISIBLE_ON)
        return rows.withColumns({"enter": F.lit(day), "leave": F.lit(None).cast("date")})

    def _in_order(self, dates: DataFrame, day: dt.date, before: dt.date | None) -> None:
        """Refuses forecast dates that are not after all those of earlier report days."""
        stored = None if before is None else self._read("dates")
        if stored is None:
            return
        known = stored.filter(F.col("report_date") <= F.lit(before)).groupBy(*WHOLE).agg(F.max("forecast_date").alias("_last"))
        late = dates.join(known, WHOLE).filter(F.col("forecast_date") <= F.col("_last")).first()
        if late is not None:
            raise ValueError(f"forecast date {late['forecast_date']} became visible on {day}, after a later one: use start")

    def _streaks(self, present: DataFrame, day: dt.date, before: dt.date | None) -> DataFrame:
        new = trailing(present, OWN)
        old = None if before is None else self._read("streaks", before)
        if old is not None:
            cells = new.select(*OWN, F.col("dates").alias("_dates")).distinct()
            both = (old.withColumnRenamed("streak", "_old").join(new, [*OWN, "model"], "full").join(cells, OWN, "left"))
            own = F.coalesce("streak", F.lit(0))
            new = both.withColumn("streak", F.when(F.col("_dates").isNull(), F.col("_old"))
                                  .when(own == F.col("_dates"), own + F.coalesce("_old", F.lit(0))).otherwise(own))
        return self._put("streaks", new.filter("streak > 0").select(*OWN, "model", "streak"), day)

    def _add(self, scores: DataFrame, day: dt.date, before: dt.date | None) -> None:
        rows = self._new_rows(scores, day, before)
        present = rows.select(*OWN, "model", "forecast_date").distinct()
        dates = present.select(*WHOLE, "model", "forecast_date").distinct()
        self._in_order(dates, day, before)

        columns = summary.cell_columns(scores, self.cfg.n_quantiles, self.bias_digits)
        cells = rows.groupBy(*CELL).agg(*[F.sum(c).alias(n) for n, c in columns.items()])
        cells = self._sum("cells", cells, list(CELL), list(columns), day, before)
        names = rows.groupBy(*CELL, "location_name").agg(F.count(F.lit(1)).alias("n"))
        names = self._sum("names", names, [*CELL, "location_name"], ["n"], day, before)
        pairs = summary.pair_events(rows, self.cfg).groupBy(*PAIR).agg(*[F.sum(c).alias(c) for c in PAIR_SUMS])
        pairs = self._sum("pairs", pairs, PAIR, PAIR_SUMS, day, before)
        streaks = self._streaks(present, day, before)
        self._put("dates", dates, day)
        if self._read("cells") is None:
            return  # no score is visible yet
        self._write("evaluation", self._evaluate(day, cells, names, pairs, streaks))
        self._write("weeks", cells.agg(F.sum("n").alias("n")).withColumn("report_date", F.lit(day)))

    def _evaluate(self, day: dt.date, cells: DataFrame, names: DataFrame, pairs: DataFrame, streaks: DataFrame) -> DataFrame:
        """The evaluation of one day from its state."""
        def report(state: DataFrame, keys: list[str]) -> DataFrame:
            sums = [c for c in state.columns if c not in keys]
            whole = summary.with_overall(state.withColumn("day", F.lit(day)), keys, sums)
            return whole.withColumnRenamed("day", "report_date")

        def of_day(df: DataFrame) -> DataFrame:
            return df.withColumn("report_date", F.lit(day))

        named = names.filter(F.col("location_name").isNotNull())
        count = F.count_distinct("location_name")
        everywhere = named.groupBy("target_variable").agg(count.alias("_all"))
        flags = of_day(named.groupBy("model", *WHOLE).agg(count.alias("n_loc")).join(everywhere, "target_variable")
                       .withColumn("keep_overall", F.col("n_loc") >= F.col("_all") / 2).drop("_all"))     # M3, M4
        kept = summary.kept_models(flags)
        base = summary.keep_overall(summary.cell_means(report(cells, list(CELL)), self.bias_digits), kept, ["model"])
        members = kept.select(*WHOLE, F.explode("kept").alias("model"))
        dates = self._read("dates").filter(F.col("report_date") <= F.lit(day)).drop("report_date")
        whole = trailing(dates.join(members, [*WHOLE, "model"], "left_semi"), WHOLE).withColumn("location", F.lit(OVERALL))
        cw = (base.select("report_date", *CELL)                                                     # M5
              .join(streaks.unionByName(whole.drop("dates")), list(CELL), "left")
              .select("report_date", *CELL, F.coalesce("streak", F.lit(0)).alias("continuous_weeks")))
        counts = of_day(named.groupBy(*CELL).agg(count.alias("n_loc")))
        out = summary.assemble(base, summary.keep_overall(report(pairs, PAIR), kept, ["a", "b"]),
                               summary.with_overall_counts(counts, flags), names.select("location", "location_name").distinct(),
                               self.cfg, cw, with_continuous_weeks=True)
        return out.withColumn("weeks_included", F.lit("All"))
