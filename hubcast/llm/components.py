"""Connected components of a link table by alternating star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hubcast.llm import common

MIN_PARTS, EDGES_A_PART = 6, 500_000


def _both(edges: DataFrame) -> DataFrame:
    return edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))


def _star(edges: DataFrame, large: bool, parts: int) -> DataFrame:
    """One contraction: neighbours on one side of a node move to its smallest neighbour.

    The smallest neighbour comes from a partial aggregation and returns by a join, so no
    node's neighbours are ever gathered.
    """
    sides = _both(edges).filter("b > a") if large else edges.select(
        F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    seen = _both(edges) if large else sides
    least = seen.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("of"), F.least("a", "m").alias("m"))
    moved = sides.join(least, sides["a"] == least["of"]).select(F.col("b").alias("a"), F.col("m").alias("b"))
    if not large:
        moved = moved.unionByName(least.select(F.col("of").alias("a"), F.col("m").alias("b")))
    return moved.filter("a <> b").coalesce(parts).distinct()


def components(links: DataFrame) -> DataFrame:
    """(node, component): the smallest node reachable; only nodes with links appear.

    Large and small stars alternate until the edges stay the same, in a number of
    rounds that grows with the logarithm of the nodes. Links are few next to what
    they were found in, so a round runs in as many tasks as its edges need.
    """
    edges = common.cut(links.select("a", "b").filter("a <> b").select(
        F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    last = None
    while True:
        state = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state == last or not state[0]:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(
                edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())
        last, parts = state, max(MIN_PARTS, state[0] // EDGES_A_PART)
        stars = _star(_star(edges.coalesce(parts), True, parts), False, parts)
        edges = common.cut(stars.coalesce(parts))
