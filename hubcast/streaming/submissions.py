"""Incremental intake of submission files with Structured Streaming.

The batch reader (S1) scans a folder of ``<team-model>/<date>-<team-model>.csv``
files. A hub receives those files continuously, so the same parsing and the
same file-name rule as the link check (S7) run here as a file-stream source.
Each micro-batch writes its valid rows, partitioned by ``forecast_date`` (which
batch run windows prune on), to a folder of its epoch, and rows of other
files to one of rejects: a repeated micro-batch replaces what it wrote before. Progress
lies beside the tables, so a restarted intake goes on where the last one stopped.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from .. import schemas
from ..sources.files import SUBMISSION_PATH_RX, VALID_FILE_RX, parse_target, rows_by_name


def submission_stream(spark: SparkSession, data_dir: str, max_files_per_trigger: int = 1000) -> DataFrame:
    """Streaming rows with ``model``, parsed target and ``valid_file``: the file's name follows the
    rule and it has all columns."""
    files = (spark.readStream.format("text").option("wholetext", True)
             .option("maxFilesPerTrigger", max_files_per_trigger)
             .option("recursiveFileLookup", True).option("pathGlobFilter", "*.csv").load(data_dir)
             .select(F.col("_metadata.file_path").alias("_path"), "value"))
    rows = rows_by_name(files, schemas.SUBMISSION)
    df = parse_target(rows.withColumn("model", F.regexp_extract("_path", SUBMISSION_PATH_RX, 1)))
    return df.withColumn("valid_file", F.col("_path").rlike(VALID_FILE_RX) & (F.size("_missing") == 0))


def start_intake(spark: SparkSession, data_dir: str, table_dir: str, name: str = "intake",
                 available_now: bool = False, progress_dir: str | None = None) -> StreamingQuery:
    """Valid submissions to ``table_dir/forecasts``, the rest to ``table_dir/rejects``.

    ``progress_dir`` (``table_dir/_progress``) must stay the same from start to start.
    """
    cols = ["model", "forecast_date", "target", "target_variable", "horizon",
            "temporal_resolution", "target_end_date", "location", "type", "quantile", "value"]

    def write_batch(batch: DataFrame, epoch_id: int) -> None:
        good = batch.filter("valid_file").select(*cols)
        (good.write.mode("overwrite").partitionBy("forecast_date")
         .parquet(os.path.join(table_dir, "forecasts", f"epoch={epoch_id}")))
        (batch.filter(~F.col("valid_file")).select("_path", "_missing", *cols)
         .write.mode("overwrite").parquet(os.path.join(table_dir, "rejects", f"epoch={epoch_id}")))

    writer = (submission_stream(spark, data_dir).writeStream.foreachBatch(write_batch).queryName(name)
              .option("checkpointLocation", progress_dir or os.path.join(table_dir, "_progress")))
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    return writer.start()
