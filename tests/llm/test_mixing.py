import random

import pytest
from llm_cases import DOCS, SMALL, edge, empty  # noqa: F401
from pyspark.sql import functions as F

from hubcast.llm import mixing as M, queries
from oracle_check import compare, duck


def test_matches_sql(spark):
    n = "op8_mix_sources"
    got = compare(spark, duck(SMALL), n, queries.QUERIES[n], queries.ORACLE_SQL[n], SMALL)
    assert got["exact"] and got["spark_rows"] == got["duck_rows"]


def iterated(sizes, weights, share, cap):
    """Excess handed on by weight, again and again, until no source is above its cap."""
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    w = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    left, open_, target = share * sum(sizes.values()), {s for s in names if sizes[s]}, {s: 0.0 for s in names}
    while open_:
        level = left / sum(w[s] for s in open_)
        over = [s for s in open_ if level * w[s] > cap * sizes[s]]
        if not over:
            return target | {s: level * w[s] for s in open_}
        for s in over:
            target[s] = cap * sizes[s]
            left -= target[s]
            open_.remove(s)
    return target


@pytest.mark.parametrize("seed", range(3))
def test_targets_match_the_iteration(spark, seed):
    r = random.Random(seed)
    sizes = {None: 40, **{f"s{i}": r.choice([0, 3, 50, 700, 9000]) for i in range(9)}}
    df = spark.createDataFrame(list(sizes.items()), "source string, source_size long")
    for share in (0.5, 1.5, 2.0):
        got = {x.source: x.target for x in M.fill(df, (3, 1, 2), share, 2.0).collect()}
        assert got == pytest.approx(iterated(sizes, (3, 1, 2), share, 2.0))


def test_taken_words_come_near_the_targets(spark):
    got = queries.op8_mix_sources(spark, SMALL.replace("0.001", "0.1"))
    docs = spark.read.parquet(SMALL.replace("0.001", "0.1") + "/documents.parquet").select("doc_id", "source")
    rows = got.join(docs, "doc_id").groupBy("source").agg(F.sum("taken").alias("t"), F.first("target").alias("of"),
                                                         F.max(F.col("taken") - 2 * F.col("size")).alias("over")).collect()
    assert all(abs(r.t - r.of) <= 0.02 * r.of and r.over <= 0 for r in rows)


@pytest.mark.parametrize("sf", ["0.001", "0.01"])
def test_small_sources_miss_by_half_a_document_at_most(spark, sf):
    docs = spark.read.parquet(SMALL.replace("0.001", sf) + "/documents.parquet")
    rows = M.repetitions(docs).groupBy("source").agg(
        F.sum(F.col("size") * F.col("repeats")).alias("t"), F.first("target").alias("of"),
        F.max("size").alias("most"), F.max("repeats").alias("times")).collect()
    assert all(abs(r.t - r.of) <= max(0.02 * r.of, r.most / 2) and r.times <= 2 for r in rows)


def test_a_document_of_half_the_words_is_decided_first(spark):
    rows = [(i, " ".join("w" * (1000 if i == 7 else 10)), "en", "a") for i in range(101)]
    rows += [(1000 + i, "w " * 100, "en", "b") for i in range(100)]
    got = M.repetitions(spark.createDataFrame(rows, DOCS), weights=(1, 1), share=0.85).groupBy("source").agg(
        F.sum(F.col("size") * F.col("repeats")).alias("t"), F.first("target").alias("of")).collect()
    assert {r.source: (r.t, abs(r.t - r.of) <= 5) for r in got}["a"][1]


def test_edge_rows(spark, edge, empty):
    got = M.repetitions(edge).collect()
    assert len(got) == edge.count()
    assert {r["size"] for r in got if r.doc_id in (2, 3, 4)} == {0}
    mixed = M.mix(edge)
    assert mixed.columns == edge.columns
    times = {(r.doc_id, r.source): r["repeats"] for r in got}
    n = {}
    for r in mixed.collect():
        n[r.doc_id, r.source] = n.get((r.doc_id, r.source), 0) + 1
    assert n == {k: v * (2 if k[0] == 6 else 1) for k, v in times.items() if v}
    assert sorted(map(tuple, M.repetitions(edge).collect()), key=str) == sorted(map(tuple, got), key=str)
    assert M.repetitions(empty).collect() == [] and M.mix(empty).collect() == []
