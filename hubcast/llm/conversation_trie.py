"""Prefix trie of conversations by vertical bitmaps.

Conversations are cut into shards of neighbouring ids. A shard indexes (position, turn) to the
bitset of its conversations with that turn there, and (position, end) to those that end there.
A depth-first walk intersects a node's bitset with the postings of the next position: each
intersection is a child, its population the members, and the intersection with the ends
gives the node's list of finished conversations. Nodes of all shards that spell the same
turns (128-bit chained hashes) merge by sums and minima; what a hot prefix sends is a row
a shard. Leaves and saved tokens of subtrees are summed upwards by pointers that double
their reach, in a number of rounds that grows with the logarithm of the depth.

Defined cases: turns order by turn (null first), then role and text, so ties and repeated rows
each stay a turn; null role or text counts as empty; rows without conv_id belong to no
conversation; a conversation without turns ends at the root; an empty table gives no nodes;
other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hubcast.llm import common

SHARD = 4000  # conversations of a shard at most
SHARD_TURNS = 100_000  # turns after which a shard is cut before that
ROOT = b"\0" * 16
NODES = "path binary, parent binary, depth bigint, n_convs bigint, conv_id bigint, chars bigint, ends string"


def turns_of(conversations: DataFrame) -> DataFrame:
    """(conv_id, pos, key, chars): every turn with its place from 1 on, a hash of role and text, and the text's length."""
    rows = conversations.filter("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("long").alias("conv_id"), "turn", F.coalesce("role", F.lit("")).alias("role"),
        F.coalesce("text", F.lit("")).alias("text"))
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    told = F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text")
    return rows.select("conv_id", F.row_number().over(order).alias("pos"), F.unhex(F.md5(told)).alias("key"),
                       F.length("text").cast("long").alias("chars"))


def with_heads(turns: DataFrame, base: Column, taken: Column, most: int) -> DataFrame:
    """(conv_id, part, pos, key, chars): the first ``taken`` turns of conversation ``base``, then the own turns after as many.

    ``base`` and ``taken`` (``most`` at most) are expressions of conv_id. Part -1 is a row for the
    conversation itself, 0 its head, 1 its own turns.
    """
    turns = common.cut(turns)
    convs = turns.filter("pos = 1").select("conv_id", base.alias("base"), taken.alias("taken"))
    heads = turns.filter(F.col("pos") <= most).select(F.col("conv_id").alias("base"), "pos", "key", "chars")
    own = turns.filter(F.col("pos") > taken).select("conv_id", F.lit(1).alias("part"), "pos", "key", "chars")
    head = convs.join(heads, "base").filter("pos <= taken").select("conv_id", F.lit(0).alias("part"), "pos", "key", "chars")
    return _present(convs).unionByName(head).unionByName(own)


def _present(convs: DataFrame) -> DataFrame:
    return convs.select("conv_id", F.lit(-1).alias("part"), F.lit(0).alias("pos"), F.lit(None).cast("binary").alias("key"),
                        F.lit(None).cast("long").alias("chars"))


def whole(turns: DataFrame) -> DataFrame:
    """Conversations as they are, in the form that ``trie`` takes."""
    turns = common.cut(turns)
    return _present(turns.filter("pos = 1")).unionByName(
        turns.select("conv_id", F.lit(1).alias("part"), "pos", "key", "chars"))


def _walk(convs: list[tuple[int, list[tuple[bytes, int]]]]) -> Iterator[tuple]:
    """Nodes of one shard; ``convs`` are (conv_id, turns) in order of conv_id, bit i of a bitset is the i-th."""
    postings: dict[tuple[int, bytes | None], int] = {}
    for i, (_, turns) in enumerate(convs):
        for d, (key, _) in enumerate(turns):
            postings[d, key] = postings.get((d, key), 0) | 1 << i
        postings[len(turns), None] = postings.get((len(turns), None), 0) | 1 << i
    stack = [(ROOT, None, 0, (1 << len(convs)) - 1, 0)]
    lowest = lambda bits: (bits & -bits).bit_length() - 1
    while stack:
        path, parent, d, members, chars = stack.pop()
        ended = members & postings.get((d, None), 0)
        ids, left = [], ended
        while left:
            ids.append(str(convs[lowest(left)][0]))
            left &= left - 1
        yield path, parent, d, members.bit_count(), convs[lowest(members)][0], chars, ",".join(ids) or None
        rest = members & ~ended
        while rest:
            key, size = convs[lowest(rest)][1][d]
            child = members & postings[d, key]
            stack.append((hashlib.blake2b(path + key, digest_size=16).digest(), path, d + 1, child, size))
            rest &= ~child


def _shards(rows: DataFrame) -> DataFrame:
    """The nodes of every shard."""
    schema = pa.schema([("path", pa.binary()), ("parent", pa.binary()), ("depth", pa.int64()), ("n_convs", pa.int64()),
                        ("conv_id", pa.int64()), ("chars", pa.int64()), ("ends", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def nodes() -> Iterator[tuple]:
            at, held, convs = None, 0, []
            for b in batches:
                for shard, conv, key, chars in zip(*(b.column(c).to_pylist() for c in ("shard", "conv_id", "key", "chars"))):
                    if convs and conv != convs[-1][0] and (shard != at or held > SHARD_TURNS):
                        yield from _walk(convs)
                        held, convs = 0, []
                    if not convs or conv != convs[-1][0]:
                        at = shard
                        convs.append((conv, []))
                    if key is not None:
                        convs[-1][1].append((key, chars))
                        held += 1
            if convs:
                yield from _walk(convs)

        out = []
        for node in nodes():
            out.append(node)
            if len(out) == 4096:
                yield pa.RecordBatch.from_arrays([pa.array(list(c), f.type) for c, f in zip(zip(*out), schema)], schema=schema)
                out = []
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(list(c), f.type) for c, f in zip(zip(*out), schema)], schema=schema)

    shard = F.floor(F.col("conv_id") / SHARD)
    dealt = rows.withColumn("shard", shard).repartition(common.partitions(rows.sparkSession), "shard")
    return dealt.sortWithinPartitions("shard", "conv_id", "part", "pos").mapInArrow(run, NODES)


def _end_hashes(shards: DataFrame) -> DataFrame:
    """(path, ends_sha256): lists of the shards follow each other by id; a task holds one of them at a time."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, digest = None, None
        for b in batches:
            out = []
            for path, ends in zip(b.column("path").to_pylist(), b.column("ends").to_pylist()):
                if path != at:
                    if at is not None:
                        out.append((at, digest.hexdigest()))
                    at, digest = path, hashlib.sha256()
                else:
                    digest.update(b",")
                digest.update(ends.encode())
            yield pa.RecordBatch.from_arrays([pa.array([x[0] for x in out], pa.binary()), pa.array([x[1] for x in out], pa.string())],
                                             names=["path", "ends_sha256"])
        if at is not None:
            yield pa.RecordBatch.from_arrays([pa.array([at], pa.binary()), pa.array([digest.hexdigest()])], names=["path", "ends_sha256"])

    lists = shards.filter("ends IS NOT NULL").select("path", "conv_id", "ends")
    return (lists.repartition(common.partitions(shards.sparkSession), "path").sortWithinPartitions("path", "conv_id")
            .mapInArrow(run, "path binary, ends_sha256 string"))


def _subtrees(nodes: DataFrame) -> DataFrame:
    """(path, n_leaves, saved_tokens): ``leaves`` and ``saved`` of nodes summed over their subtrees.

    After round k a node holds the sum over its descendants nearer than 2^k and ``up`` points 2^k
    ancestors higher; pointers to the root or above need no join.
    """
    state = common.cut(nodes.select("path", F.col("parent").alias("up"), "leaves", "saved"))
    root = F.lit(ROOT)
    while not state.filter("up IS NOT NULL").isEmpty():
        below = state.filter("up IS NOT NULL").groupBy(F.col("up").alias("path")).agg(
            F.sum("leaves").alias("more_leaves"), F.sum("saved").alias("more_saved"))
        higher = state.filter("up IS NOT NULL").select(F.col("path").alias("up"), F.col("up").alias("next"))
        moved = state.filter(F.col("up") != root).join(higher, "up").select("path", F.col("next").alias("up"))
        state = common.cut(
            state.drop("up").join(below, "path", "left").join(moved, "path", "left")
            .select("path", "up", (F.col("leaves") + F.coalesce("more_leaves", F.lit(0))).alias("leaves"),
                    (F.col("saved") + F.coalesce("more_saved", F.lit(0))).alias("saved")))
    return state.select("path", F.col("leaves").alias("n_leaves"), F.col("saved").alias("saved_tokens"))


def trie(rows: DataFrame) -> DataFrame:
    """A row per node: conv_id (smallest member), depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256.

    ``rows`` come from ``whole`` or ``with_heads``.
    """
    shards = common.cut(_shards(rows))
    nodes = common.cut(shards.groupBy("path").agg(
        F.first("parent").alias("parent"), F.first("depth").alias("depth"), F.sum("n_convs").alias("n_convs"),
        F.min("conv_id").alias("conv_id"), F.first("chars").alias("chars")))
    children = nodes.filter("parent IS NOT NULL").groupBy(F.col("parent").alias("path")).agg(
        F.count(F.lit(1)).alias("n_children"))
    nodes = common.cut(nodes.join(children, "path", "left").withColumn("n_children", F.coalesce("n_children", F.lit(0))))
    valued = nodes.select("path", "parent", (F.col("n_children") == 0).cast("long").alias("leaves"),
                          ((F.col("n_convs") - 1) * F.col("chars")).alias("saved"))
    above = nodes.select(F.col("path").alias("parent"), F.col("conv_id").alias("parent_conv_id"))
    none = F.lit(hashlib.sha256(b"").hexdigest())
    return (nodes.join(above, "parent", "left").join(_subtrees(valued), "path").join(_end_hashes(shards), "path", "left")
            .select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
                    F.coalesce("ends_sha256", none).alias("ends_sha256")))
