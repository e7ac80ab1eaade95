"""Mix sources to target weights by capped water-filling.

Each source gets a share of the wanted words in proportion to its weight, at
most ``max_epochs`` times its own size; what is above a cap goes to the other
sources by weight until none is above. A source then gives every document whole
repetitions and some of them, chosen by a seeded digest of doc_id, one more.

Only built-in functions. Defined cases: a null or blank text has size 0; sources
order by code point, null last, and null is a source of its own; rows that repeat
a doc_id are drawn alike; an empty table gives no rows; a source of size 0 gets
target 0.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hubcast.llm import common

DRAWS = 3  # hexadecimal digits of a document's draw: 4096 classes for each source
HEAVY = 16  # a class with more than this part of its source's words is decided on before the others


def draw(doc_id: Column, seed: int) -> Column:
    """The seeded class of a document, DRAWS hexadecimal digits."""
    return F.substring(F.md5(F.concat_ws("/", F.lit(str(seed)), F.coalesce(doc_id.cast("string"), F.lit("")))
                             .cast("binary")), 1, DRAWS)


def fill(sizes: DataFrame, weights: Sequence[float], share: float, max_epochs: float) -> DataFrame:
    """(source, source_size) -> with ``target``; weights repeat over the ordered sources.

    Level form of the redistribution: with sources in the order of cap / weight,
    those before the first one that fits below the common level are at their cap.
    The windows run over one row per source.
    """
    n = len(weights)
    order = Window.partitionBy(F.lit(0)).orderBy(F.col("source").asc_nulls_last())
    everything = Window.partitionBy(F.lit(0))
    w = F.element_at(F.array(*[F.lit(float(x)) for x in weights]),
                     (F.pmod(F.row_number().over(order) - 1, F.lit(n)) + 1).cast("int"))
    s = sizes.withColumn("weight", w).withColumn("cap", F.col("source_size") * F.lit(float(max_epochs)))
    by_ratio = everything.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last())
    before = by_ratio.rowsBetween(Window.unboundedPreceding, -1)
    after = by_ratio.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    wanted = F.sum("source_size").over(everything) * F.lit(float(share))
    s = s.withColumn("level", (wanted - F.coalesce(F.sum("cap").over(before), F.lit(0.0)))
                     / F.sum("weight").over(after))
    fits = F.col("level") <= F.col("cap") / F.col("weight")
    level = F.max(F.when(fits, F.col("level"))).over(everything)  # null: all are at their cap
    return s.withColumn("level", level).select(
        "source", "source_size", F.when(F.col("source_size") == 0, 0.0).otherwise(
            F.least("cap", F.coalesce(F.col("level") * F.col("weight"), F.col("cap")))).alias("target"))


def plan(sized: DataFrame, weights: Sequence[float] = (3, 1, 2), share: float = 1.5,
         max_epochs: float = 2.0) -> DataFrame:
    """(of, of_draw, source_size, target, repeats) from (source, size, draw) rows.

    Documents with one more repetition: a source's classes are gone through in order of
    their draw, those with more than a ``HEAVY``-th of its words first, and each joins that
    fits in what the target still lacks; in the end the smallest class left joins if that
    comes nearer. So a source misses its target by at most half of its smallest class left
    out. Sizes are summed by (source, class) before anything is ordered, so
    the lists have at most 4096 entries for each source, the marks as many characters.
    """
    classes = common.cut(sized.groupBy("source", "draw").agg(F.sum("size").alias("class_size")))
    targets = fill(classes.groupBy("source").agg(F.sum("class_size").alias("source_size")),
                   weights, share, max_epochs).withColumnRenamed("source", "of")
    listed = (classes.join(targets, F.col("source").eqNullSafe(F.col("of")))
              .withColumn("light", HEAVY * F.col("class_size") <= F.col("source_size"))
              .groupBy("of", "source_size", "target")
              .agg(F.array_sort(F.collect_list(F.struct("light", "draw", "class_size"))).alias("classes")))
    whole = F.when(F.col("source_size") == 0, F.lit(0)).otherwise(F.floor(F.col("target") / F.col("source_size")))
    lacking = F.col("target") - whole * F.col("source_size")

    def step(state: Column, entry: Column) -> Column:
        joins = (state["gap"] > 0) & (entry["class_size"] <= state["gap"])
        return F.struct((state["gap"] - F.when(joins, entry["class_size"].cast("double")).otherwise(0.0)).alias("gap"),
                        F.concat(state["marks"], F.when(joins, "1").otherwise("0")).alias("marks"))

    drawn = listed.withColumn("state", F.aggregate("classes", F.struct(lacking.alias("gap"), F.lit("").alias("marks")), step))
    mark = lambda i: F.substring(F.col("state.marks"), i + 1, F.lit(1))
    least = F.array_min(F.transform(F.filter("classes", lambda c, i: mark(i) == "0"),
                                    lambda c: F.struct(c["class_size"], c["draw"])))
    drawn = drawn.withColumn("least", least).select("*", F.posexplode("classes").alias("i", "entry"))
    nearest = (F.col("entry.draw") == F.col("least.draw")) & (F.col("least.class_size") < 2 * F.col("state.gap"))
    more = F.when((mark(F.col("i")) == "1") | F.coalesce(nearest, F.lit(False)), 1).otherwise(0)
    return drawn.select("of", F.col("entry.draw").alias("of_draw"), "source_size", "target",
                        (whole.cast("long") + more).alias("repeats"))


def repetitions(docs: DataFrame, seed: int = 17, **settings) -> DataFrame:
    """doc_id, source, size, source_size, target, repeats: one row per row of ``docs``."""
    sized = common.cut(docs.select("doc_id", "source", common.word_count(F.col("text")).alias("size"),
                                   draw(F.col("doc_id"), seed).alias("draw")))
    of = plan(sized, **settings)
    return sized.join(of, sized["source"].eqNullSafe(of["of"]) & (sized["draw"] == of["of_draw"])).select(
        "doc_id", "source", "size", "source_size", "target", "repeats")


def mix(docs: DataFrame, seed: int = 17, **settings) -> DataFrame:
    """The rows of ``docs``, each as often as its source's plan repeats it."""
    of = plan(docs.select("source", common.word_count(F.col("text")).alias("size"),
                          draw(F.col("doc_id"), seed).alias("draw")), **settings).select(
        F.col("of").alias("__of"), F.col("of_draw").alias("__of_draw"), F.col("repeats").alias("__repeats"))
    drawn = docs.withColumn("__draw", draw(F.col("doc_id"), seed))
    joined = drawn.join(of, drawn["source"].eqNullSafe(of["__of"]) & (F.col("__draw") == F.col("__of_draw")))
    times = F.explode(F.sequence(F.lit(1), F.col("__repeats").cast("int"))).alias("__time")
    return joined.filter("__repeats > 0").select(*docs.columns, times).drop("__time")
