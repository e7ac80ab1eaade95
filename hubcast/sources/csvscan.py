"""CSV files of many layouts, read by column name.

A census of the files comes first: one text scan gives each file's header line and whether a
line holds an odd number of quotes, which means that a quoted cell goes on in the next line.
Files of the same header are then one native CSV scan with an explicit schema: splittable
where no cell is torn, ``multiLine`` where one is. The scans are joined by name, so a
query's column pruning reaches each of them.

The driver holds the distinct headers and, where there is more than one layout, the names of
the files of each, as Spark's own file index does.
"""

from __future__ import annotations

import csv
from collections.abc import Iterable
from functools import reduce
from typing import NamedTuple
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


class Layout(NamedTuple):
    names: list[str]
    torn: bool  # a cell holds a line break
    files: list[str]


def census(spark: SparkSession, path) -> list[Layout]:
    """The layouts of the files under ``path``; files without a line have none."""
    lines = spark.read.text(path).select(
        F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("at"), "value")
    quotes = F.length("value") - F.length(F.replace("value", F.lit('"'), F.lit("")))
    # the lines of a file's first split are in one task and in order, so its first value is the header
    files = lines.groupBy("path").agg(
        F.first(F.when(F.col("at") == 0, F.col("value")), ignorenulls=True).alias("header"), F.max(quotes % 2 == 1).alias("torn"))
    groups = files.groupBy("header", "torn").agg(F.sort_array(F.collect_list("path")).alias("files")).collect()
    return [Layout([n.strip() for n in next(csv.reader([g["header"].removeprefix("﻿")]), [])], g["torn"], g["files"])
            for g in sorted(groups, key=lambda g: (g["header"], g["torn"]))]


def _typed(text: Column, kind: T.DataType) -> Column:
    text = F.when(~text.isin("NA", ""), text)
    return text if isinstance(kind, T.StringType) else text.try_cast(kind)


def _scan(spark: SparkSession, path, layout: Layout, schema: T.StructType) -> DataFrame:
    # positions instead of names, as files may repeat a name; the first one counts
    cells = T.StructType([T.StructField(f"c{i}", T.StringType()) for i in range(len(layout.names))])
    raw = spark.read.csv(path, schema=cells, header=True, multiLine=layout.torn, escape='"',
                         ignoreLeadingWhiteSpace=True, ignoreTrailingWhiteSpace=True)
    columns = [(_typed(F.col(f"c{layout.names.index(f.name)}"), f.dataType) if f.name in layout.names
                else F.lit(None).cast(f.dataType)).alias(f.name) for f in schema.fields]
    return raw.select(F.col("_metadata.file_path").alias("_path"), *columns)


def read_by_name(spark: SparkSession, path, schema: T.StructType, required: Iterable[str] | None = None) -> DataFrame:
    """(_path, schema) of all files under ``path`` (a glob or a list of them).

    Files may order their columns differently and have more of them. One that lacks a column
    of ``required`` (all of ``schema`` unless given) is an error that names it; others it lacks are
    NULL, as are ``NA``, empty cells and values that don't fit their type.
    """
    required = [f.name for f in schema.fields] if required is None else list(required)
    layouts = census(spark, path)
    for layout in layouts:
        missing = [c for c in required if c not in layout.names]
        if missing:
            raise ValueError(f"{layout.files[0]} has no column {', '.join(missing)} ({len(layout.files)} files of this layout)")
    if not layouts:
        return spark.createDataFrame([], T.StructType([T.StructField("_path", T.StringType()), *schema.fields]))
    if len(layouts) == 1:
        return _scan(spark, path, layouts[0], schema)
    return reduce(DataFrame.unionByName, [_scan(spark, [unquote(f) for f in x.files], x, schema) for x in layouts])
