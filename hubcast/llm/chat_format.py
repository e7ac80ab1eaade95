"""Reply trees to conversations.

Messages point at the message that they answer. Self-joins that double their
reach at each round list, for every leaf, all messages from root to leaf; the
leaves of a tree are ranked by the score of their path, and each chosen path
becomes one formatted conversation with the places of its loss mask.

Template of a turn: ``<turn ROLE>TEXT</turn>`` and a newline. Inside role and
text the characters ``\\``, ``<`` and ``>`` are written ``\\b``, ``\\l`` and
``\\g``, so control strings occur only where the template puts them, and
``unescape`` restores every text.

Only built-in functions. Defined cases: null role or text counts as empty; turns
of a conversation order by turn (null first), then role and text, so ties and
repeated rows each stay a turn; a null conv_id is a conversation of its own; a
message whose parent is missing starts a tree; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hubcast.llm import common

TURN, END = "<turn ", "</turn>\n"


def escape(text: Column) -> Column:
    return F.replace(F.replace(F.replace(text, F.lit("\\"), F.lit("\\b")), F.lit("<"), F.lit("\\l")),
                     F.lit(">"), F.lit("\\g"))


def unescape(text: Column) -> Column:
    return F.replace(F.replace(F.replace(text, F.lit("\\l"), F.lit("<")), F.lit("\\g"), F.lit(">")),
                     F.lit("\\b"), F.lit("\\"))


def messages_of(turns: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text) rows as a chain of messages; every turn answers the one before."""
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    key = F.coalesce(F.col("conv_id").cast("string"), F.lit("-"))
    return (turns.select("conv_id", "role", "text", F.row_number().over(order).alias("n"))
            .select("conv_id", F.concat_ws(":", key, F.col("n")).alias("message_id"),
                    F.when(F.col("n") > 1, F.concat_ws(":", key, F.col("n") - 1)).alias("parent_id"),
                    "role", "text", F.lit(0.0).alias("score")))


def heads(messages: DataFrame) -> DataFrame:
    """(message_id, parent_id, score), one row per message; a null score is 0."""
    first = F.min(F.struct("parent_id", F.coalesce("score", F.lit(0.0)).alias("score"))).alias("first")
    return (messages.filter("message_id IS NOT NULL").groupBy("message_id").agg(first)
            .select("message_id", "first.parent_id", "first.score"))


def bodies(messages: DataFrame) -> DataFrame:
    """(message_id, conv_id, role, text): of rows that repeat an id, the one that ``heads`` takes."""
    order = Window.partitionBy("message_id").orderBy("parent_id", F.coalesce("score", F.lit(0.0)), "conv_id", "role", "text")
    return (messages.filter("message_id IS NOT NULL").select(
        "message_id", "conv_id", "role", "text", F.row_number().over(order).alias("nth"))
            .filter("nth = 1").drop("nth"))


def paths(messages: DataFrame) -> DataFrame:
    """(leaf, message_id, above): the messages from every leaf up to its root.

    ``up`` holds a jump of 2^k ancestors; a round joins the paths with it and
    ``up`` with itself, so a tree of depth d takes log2(d) rounds.
    """
    ids = heads(messages).select("message_id", "parent_id")
    present = ids.select(F.col("message_id").alias("there"))
    up = common.cut(ids.join(present, ids["parent_id"] == present["there"], "left").select(
        "message_id", F.col("there").alias("above_id")))
    leaves = up.join(up.select(F.col("above_id").alias("message_id")).filter("message_id IS NOT NULL"),
                     "message_id", "left_anti")
    found = common.cut(leaves.select(F.col("message_id").alias("leaf"), "message_id", F.lit(0).alias("above")))
    reach, before = 1, None
    step = up.filter("above_id IS NOT NULL")
    left = step.count()
    # As long as some jump still has to end at a root, a round ends some; what stays has none.
    while left and left != before:
        higher = found.join(step, "message_id").select(
            "leaf", F.col("above_id").alias("message_id"), (F.col("above") + reach).alias("above"))
        found = common.cut(found.unionByName(higher))
        second = step.select(F.col("message_id").alias("above_id"), F.col("above_id").alias("next_id"))
        step = common.cut(step.join(second, "above_id").select("message_id", F.col("next_id").alias("above_id")))
        reach, before, left = 2 * reach, left, step.count()
    if left:
        alone = step.select(F.col("message_id").alias("leaf"))
        found = found.join(alone, "leaf", "left_anti").unionByName(
            alone.select("leaf", F.col("leaf").alias("message_id"), F.lit(0).alias("above")))
    return found


def conversations(messages: DataFrame, per_tree: int = 1) -> DataFrame:
    """One row per chosen path: conv_id, leaf, rank, n_turns, formatted, loss_spans.

    ``messages``: conv_id, message_id, parent_id, role, text, score. A path's score
    is the mean of its messages' (null: 0); the best ``per_tree`` of a root stay,
    ties go to the smaller leaf id. ``loss_spans`` are (start, length) code points of the
    assistant texts in ``formatted``.
    """
    on = paths(messages).withColumnRenamed("message_id", "mid")
    scored = on.join(heads(messages).select("message_id", "score"), F.col("mid") == F.col("message_id"))
    leaves = scored.groupBy("leaf").agg(F.avg("score").alias("path_score"),
                                        F.max_by("mid", "above").alias("root"))
    rank = F.row_number().over(Window.partitionBy("root").orderBy(F.desc("path_score"), "leaf"))
    chosen = leaves.withColumn("rank", rank).filter(F.col("rank") <= per_tree).select("leaf", "rank")
    turn = (on.join(chosen, "leaf").join(bodies(messages), F.col("mid") == F.col("message_id"))
            .withColumn("head", F.concat(F.lit(TURN), escape(F.coalesce("role", F.lit(""))), F.lit(">")))
            .withColumn("body", escape(F.coalesce("text", F.lit(""))))
            .withColumn("block", F.concat("head", "body", F.lit(END))))
    before = Window.partitionBy("leaf").orderBy(F.desc("above")).rowsBetween(Window.unboundedPreceding, -1)
    turn = turn.withColumn("start", F.coalesce(F.sum(F.length("block")).over(before), F.lit(0))
                           + F.length("head"))
    span = F.when(F.col("role") == "assistant",
                  F.struct(F.col("start").cast("long").alias("start"),
                           F.length("body").cast("long").alias("length"))).alias("span")
    rows = F.array_sort(F.collect_list(F.struct((-F.col("above")).alias("at"), "block", span)))
    return (turn.groupBy("conv_id", "leaf", "rank").agg(rows.alias("rows"))
            .select("conv_id", "leaf", "rank", F.size("rows").cast("long").alias("n_turns"),
                    F.array_join(F.col("rows.block"), "").alias("formatted"),
                    F.filter("rows.span", lambda s: s.isNotNull()).alias("loss_spans")))


def read_back(formatted: Column) -> Column:
    """The turns of a formatted conversation as an array of (role, text)."""
    blocks = F.split(formatted, END)
    blocks = F.slice(blocks, F.lit(1), F.size(blocks) - 1)
    parts = F.transform(blocks, lambda b: F.split(b, ">"))
    return F.transform(parts, lambda p: F.struct(
        unescape(F.substring(p[0], len(TURN) + 1, 1 << 30)).alias("role"),
        unescape(p[1]).alias("text")))


def loss_text(formatted: Column, spans: Column) -> Column:
    """All text under the loss mask, unescaped."""
    return F.array_join(F.transform(spans, lambda s: unescape(
        F.substring(formatted, s["start"].cast("int") + 1, s["length"].cast("int")))), "")
