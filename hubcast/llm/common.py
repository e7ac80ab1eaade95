"""Helpers shared by the text operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hubcast.session import cut_lineage

# Words are maximal runs of characters other than the six ASCII white-space characters.
WORD = r"[^\x20\x09-\x0D]+"
SPACE = r"[\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def cut(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared checkpoint folder and continue from the copy."""
    return cut_lineage(df)


def word_count(text: Column) -> Column:
    """Number of words of ``text`` as a long; a null text has none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def words(text: str | None) -> list[bytes]:
    """Words of ``text`` as UTF-8; ``bytes.split()`` splits on the same six characters as WORD."""
    return text.encode().split() if text else []


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def lower_ascii(word: Column) -> Column:
    """A-Z lower-cased, everything else unchanged; text of ASCII alone takes the short way."""
    return F.when(F.octet_length(word) == F.length(word), F.lower(word)).otherwise(F.translate(word, UPPER, LOWER))


def small(df: DataFrame, limit: int = 32 << 20) -> DataFrame:
    """``df`` (checkpointed) with a broadcast hint if its rows, summed, stay below ``limit`` bytes; else unchanged."""
    strings = [f.name for f in df.schema.fields if f.dataType.typeName() in ("string", "binary")]
    arrays = [f.name for f in df.schema.fields if f.dataType.typeName() == "array"]
    width = F.lit(16 * len(df.columns)).cast("long")
    for c in strings:
        width = width + F.coalesce(F.octet_length(c), F.lit(0))
    for c in arrays:
        width = width + 32 * F.size(c) + F.octet_length(F.col(c).cast("string"))
    return F.broadcast(df) if (df.agg(F.sum(width)).first()[0] or 0) <= limit else df
