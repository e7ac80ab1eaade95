"""Exact deduplication against a persistent digest index.

The index is a table bucketed and sorted by digest. New rows are reduced to one
row per digest, a sort-merge anti-join keeps the digests that the index lacks,
and those are appended. Only built-in functions run here.

Defined cases: a null text counts as empty; texts are equal when identical after
each run of the six ASCII white-space characters becomes one space; of equal
texts the smallest doc_id stays (null counts as greatest); a digest that the index
already holds keeps the doc_id stored there, and its group_size is the number of rows in the
batch that brought it (later batches don't raise it). Rows that repeat doc_id and text are
one document: the decision is the same for each, ``unique`` returns one of them.
"""

from __future__ import annotations

import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hubcast.llm import common

NO_ID = -(1 << 63)  # stands for a null doc_id in joins
INDEX_COLUMNS = "text_digest binary, keep_id bigint, group_size bigint"


def digest(text: Column) -> Column:
    """SHA-256 (32 bytes) of the text with white space normalised."""
    one_space = F.regexp_replace(F.coalesce(text, F.lit("")), common.SPACE, " ")
    return F.unhex(F.sha2(one_space.cast("binary"), 256))


def _stored(spark: SparkSession, path: str) -> DataFrame | None:
    try:
        return spark.read.parquet(path)
    except AnalysisException as e:
        if e.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise


def _buckets(spark: SparkSession, path: str, wanted: int | None) -> int:
    """The number of buckets of the index at ``path``; stored there if the index is new."""
    beside = path.rstrip("/") + ".buckets"
    record = _stored(spark, beside)
    if record is not None:
        (n,) = record.first()
        if wanted not in (None, n):
            raise ValueError(f"the index at {path} has {n} buckets, not {wanted}")
        return n
    if wanted is None and _stored(spark, path) is not None:
        raise ValueError(f"the index at {path} has no stored number of buckets: name it")
    n = wanted or common.partitions(spark)
    spark.range(1).select(F.lit(n).alias("buckets")).write.parquet(beside)
    return n


class DigestIndex:
    """Digests seen so far: table ``name``, bucketed and sorted by digest.

    With ``path`` the files lie there, and a later session that names the same
    table and path goes on with them; without, the table lies in the warehouse.
    Appends commit once per job, and a repeated ``add`` after a failure appends
    nothing twice, since the anti-join drops what was stored.

    The number of buckets belongs to the files: it is stored in ``<path>.buckets`` when the
    index is made and holds from then on, whatever the session's shuffle setting. Asking for
    another number is an error (``copy`` makes an index with other buckets), and so are files
    without a stored number, unless ``buckets`` names it.
    """

    def __init__(self, spark: SparkSession, name: str, path: str | None = None,
                 buckets: int | None = None):
        self.spark, self.name = spark, name
        self.buckets = _buckets(spark, path, buckets) if path else buckets or common.partitions(spark)
        at = f" LOCATION '{path}'" if path else ""
        spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({INDEX_COLUMNS}) USING parquet "
                  f"CLUSTERED BY (text_digest) SORTED BY (text_digest) INTO {self.buckets} BUCKETS{at}")

    def rows(self) -> DataFrame:
        return self.spark.table(self.name)

    def add(self, digests: DataFrame) -> DataFrame:
        """Append the unseen digests of (doc_id, text_digest) rows; returns the index."""
        batch = digests.groupBy("text_digest").agg(F.min("doc_id").alias("keep_id"),
                                                   F.count(F.lit(1)).alias("group_size"))
        fresh = batch.join(self.rows().select("text_digest").hint("merge"), "text_digest", "left_anti")
        fresh.select("text_digest", "keep_id", "group_size").write.insertInto(self.name)
        self.spark.catalog.refreshTable(self.name)
        return self.rows()

    def copy(self, name: str, path: str | None = None, buckets: int | None = None) -> DigestIndex:
        """A new index with the same rows, one sorted file a bucket: merges the files that each ``add``
        left, or changes the number of buckets. This one stays as it is until it is dropped."""
        new = DigestIndex(self.spark, name, path, buckets or self.buckets)
        # by bucket number, not by digest: Spark leaves that step out where the old buckets seem to serve
        bucket = F.pmod(F.hash("text_digest"), F.lit(new.buckets))
        self.rows().repartition(new.buckets, bucket).write.insertInto(name)
        self.spark.catalog.refreshTable(name)
        return new

    def drop(self) -> None:
        self.spark.sql(f"DROP TABLE IF EXISTS {self.name}")


def decide(docs: DataFrame, index: DigestIndex) -> DataFrame:
    """One row per row of ``docs``: doc_id, keep_id, group_size, kept, text_sha256.

    Adds the batch to the index first. The index rows are re-dealt for the last
    join (not read by bucket), so that AQE can split the rows of a digest that
    very many documents share.
    """
    digests = common.cut(docs.select("doc_id", digest(F.col("text")).alias("text_digest")))
    known = common.cut(index.add(digests))
    return digests.join(known, "text_digest").select(
        "doc_id", "keep_id", "group_size",
        F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"),
        F.lower(F.hex("text_digest")).alias("text_sha256"))


def unique(docs: DataFrame, index: DigestIndex) -> DataFrame:
    """The rows of ``docs`` that stay, all columns, one for each text.

    The last step groups by the keys of the join before it, so the texts move once.
    """
    own_id = lambda c: F.coalesce(F.col(c), F.lit(NO_ID))
    marked = docs.withColumns({"__digest": digest(F.col("text")), "__id": own_id("doc_id")})
    first = common.cut(index.add(marked.select("doc_id", F.col("__digest").alias("text_digest"))))
    keep = first.select(F.col("text_digest").alias("__digest"), own_id("keep_id").alias("__id"))
    stay = marked.join(keep, ["__digest", "__id"], "left_semi")
    return stay.dropDuplicates(["__digest", "__id"]).select(*docs.columns)


def fresh_index(spark: SparkSession) -> DigestIndex:
    """An empty index under a name of its own in the warehouse."""
    return DigestIndex(spark, f"digest_index_{uuid.uuid4().hex}")
