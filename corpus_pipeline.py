"""Corpus pipeline: quality rules, exact and near deduplication, mixing, tokenisation.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run`` writes it as
Parquet in the shared checkpoint folder and reads it again as the next stage's docs, so
no stage is computed twice and a lost executor costs one stage at most.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from hubcast.llm import bpe, exact_dedup, mixing, ngram_join, quality_rules
from hubcast.llm.queries import TOKENIZER
from hubcast.session import ensure_checkpoint_dir


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and the learned decision list."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return quality_rules.keep(docs, quality_rules.fit(docs, labels))


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document for each text."""
    index = exact_dedup.fresh_index(spark)
    out = exact_dedup.unique(docs, index)
    index.drop()  # its rows are checkpointed by then
    return out


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document for each class of similar sets of 5-word shingles (Jaccard 0.8 or more)."""
    return ngram_join.representatives(docs, n=5, percent=80)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix repeats them."""
    return mixing.mix(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document that is left, as digests."""
    return bpe.encode(docs, TOKENIZER)


STAGES = [("quality rules", quality), ("exact dedup", exact), ("n-gram Jaccard join", near),
          ("mixing", mixture), ("tokens", tokens)]

# The learned rules of the first stage have no SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = f"{ensure_checkpoint_dir(spark)}/{name.replace(' ', '-')}-{uuid.uuid4().hex}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
