"""File sources of a hub repository (S1, S2/S3, S4, S6) and the link filter.

All readers take explicit schemas; CSV files are scanned by layout (``csvscan``), whose
census of headers runs when a reader is called. File names that carry a date or a model
are parsed from ``_metadata.file_path``.
"""

from __future__ import annotations

import datetime as dt
import os
from collections.abc import Iterable

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import schemas
from .csvscan import read_by_name

# Layout of a submission file path, of a valid one (the folder name "<team>-<model>"
# repeats in the file name), of an evaluation file and of a target label.
SUBMISSION_PATH_RX = r"/([^/]+)/(\d{4}-\d{2}-\d{2})-([^/]+)\.csv$"
TARGET_RX = r"^(\d+) (\w+) ahead (.+)$"
VALID_FILE_RX = r"/([a-zA-Z0-9_+]+-[a-zA-Z0-9_+]+)/\d{4}-\d{2}-\d{2}-\1.csv$"
EVALUATION_PATH_RX = r"evaluation-(\d{4}-\d{2}-\d{2})\.csv$"


def _dates(dates) -> list[str]:
    return [d.isoformat() if isinstance(d, (dt.date, dt.datetime)) else str(d) for d in dates]


def window_dates(run_date, window_days: int = 6) -> list[str]:
    """D, D-1, ..., D-(window_days-1) as ISO strings (D10, single run)."""
    d = dt.date.fromisoformat(str(run_date)[:10])
    return [(d - dt.timedelta(days=i)).isoformat() for i in range(window_days)]


def parse_target(df: DataFrame, col: str = "target") -> DataFrame:
    """Split ``"<h> <res> ahead <variable>"`` into horizon, temporal_resolution, target_variable."""
    t = F.col(col)
    return (df.withColumn("horizon", F.regexp_extract(t, TARGET_RX, 1).try_cast("int"))
              .withColumn("temporal_resolution", F.regexp_extract(t, TARGET_RX, 2))
              .withColumn("target_variable", F.regexp_extract(t, TARGET_RX, 3)))


def rows_by_name(files: DataFrame, schema: T.StructType, required: Iterable[str] | None = None) -> DataFrame:
    """(_path, _missing, schema) from whole files (_path, value) of a stream: columns by the names in each header.

    ``_missing`` lists the required columns (all of ``schema`` unless given) that a file
    lacks. A value that doesn't fit its type is NULL, as are ``NA`` and empty fields.
    """
    required = [f.name for f in schema.fields] if required is None else list(required)

    def cells(line: Column) -> Column:  # split at commas outside quotes
        parts = F.split(line, r',(?=(?:[^"]*"[^"]*")*[^"]*$)')
        return F.transform(parts, lambda c: F.regexp_replace(F.regexp_replace(F.trim(c), '^"|"$', ""), '""', '"'))

    # pieces between quotes alternate; only those outside break lines
    pieces = F.transform(F.split(F.regexp_replace("value", "^\uFEFF", ""), '"', -1),
                         lambda p, i: F.when(i % 2 == 0, F.regexp_replace(p, "\r\n|\n|\r", "\u001e")).otherwise(p))
    lines = F.split(F.array_join(pieces, '"'), "\u001e")
    files = files.select("_path", lines.alias("_lines")).withColumn("_names", cells(F.col("_lines")[0]))
    missing = F.array_except(F.array(*[F.lit(c) for c in required]), F.col("_names"))
    rows = files.select("_path", "_names", missing.alias("_missing"),
                        F.explode(F.slice("_lines", F.lit(2), F.size("_lines"))).alias("_line"))
    rows = rows.filter(F.trim("_line") != "").withColumn("_cells", cells(F.col("_line")))

    def value(name: str, kind: T.DataType) -> Column:
        at = F.array_position("_names", F.lit(name))
        text = F.when(at > 0, F.get("_cells", at.cast("int") - 1))
        text = F.when(~text.isin("NA", ""), text)
        return text if isinstance(kind, T.StringType) else text.try_cast(kind)

    return rows.select("_path", "_missing", *[value(f.name, f.dataType).alias(f.name) for f in schema.fields])


def read_submissions(spark: SparkSession, data_dir: str,
                     dates: Iterable | None = None) -> DataFrame:
    """Scan ``<data_dir>/<team-model>/<date>-<team-model>.csv`` for the given dates.

    With ``dates`` only the matching files are globbed (file-level pruning), and dates
    without a submission give no rows; a folder without any submission is an error. The
    model comes from the folder name. Output follows schema F2 (plus ``target``), with
    ``location_name`` NULL as submissions do not carry it.
    """
    every = os.path.join(data_dir, "*", "*.csv")
    path = every if dates is None else os.path.join(data_dir, "*", "{" + ",".join(_dates(dates)) + "}-*.csv")
    try:
        raw = read_by_name(spark, path, schemas.SUBMISSION)
    except AnalysisException as e:
        if dates is None or e.getCondition() != "PATH_NOT_FOUND":
            raise
        spark.read.text(every)  # raises where there is no submission at all
        raw = spark.createDataFrame([], T.StructType([T.StructField("_path", T.StringType()), *schemas.SUBMISSION.fields]))
    df = parse_target(raw.withColumn("model", F.regexp_extract("_path", SUBMISSION_PATH_RX, 1))
                      .withColumn("location_name", F.lit(None).cast("string")))
    return df.select("model", "forecast_date", "target", "target_variable", "horizon",
                     "temporal_resolution", "target_end_date", "location", "location_name",
                     "type", "quantile", "value")


def read_evaluation(spark: SparkSession, eval_dir: str, evaluation_date=None) -> DataFrame:
    """Evaluation CSVs named ``evaluation-<date>.csv``; adds ``report_date``.

    Columns are found by name in every file; those that a file lacks are NULL, except
    for its keys. With ``evaluation_date`` only that file is read; a missing file
    raises at plan time (S2).
    """
    name = "evaluation-*.csv" if evaluation_date is None else f"evaluation-{_dates([evaluation_date])[0]}.csv"
    raw = read_by_name(spark, os.path.join(eval_dir, name), schemas.EVALUATION,
                           required=("model", "target_variable", "horizon", "location"))
    return raw.select(*[f.name for f in schemas.EVALUATION.fields],
                      F.to_date(F.regexp_extract("_path", EVALUATION_PATH_RX, 1)).alias("report_date"))


def read_status(spark: SparkSession, hosp_path: str, case_path: str, death_path: str) -> DataFrame:
    """Stack three status files by column name, tagging each with its target variable.

    Each file is read once; the death status comes from its own file (T11).
    """
    parts = []
    for tv, path in (("inc hosp", hosp_path), ("inc case", case_path), ("inc death", death_path)):
        parts.append(read_by_name(spark, path, schemas.STATUS_FILE)
                     .select(F.lit(tv).alias("target_variable"), "location",
                             F.col("date").alias("target_end_date"), "status"))
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


def read_designations(spark: SparkSession, metadata_dir: str) -> DataFrame:
    """(model, designation) from every metadata YAML under ``metadata_dir``.

    Each document is one row (``wholetext``); the two top-level keys are
    pulled with anchored multi-line patterns and stripped of quotes.
    """
    docs = spark.read.text(metadata_dir, wholetext=True)

    def key(name):
        v = F.trim(F.regexp_extract("value", rf"(?m)^{name}:[ \t]*([^\r\n#]*)", 1))
        return F.regexp_replace(v, r"^['\"]|['\"]$", "")

    return docs.select(key("model_abbr").alias("model"),
                       key("team_model_designation").alias("designation"))


def submission_link_pattern(data_folder: str = "data-processed") -> str:
    """Valid submission path: folder name repeated in the file name (backreference)."""
    return data_folder + VALID_FILE_RX


def preview_links(urls: DataFrame, base_url: str, url_col: str = "url",
                  data_folder: str = "data-processed") -> DataFrame:
    """Keep changed-file URLs that are valid submissions and prefix the preview address.

    Returns an empty DataFrame (not NULL) when nothing matches.
    """
    rx = submission_link_pattern(data_folder)
    return (urls.filter(F.col(url_col).rlike(rx))
                .withColumn("link", F.concat(F.lit(base_url), F.col(url_col))))
